"""Command line: documents filtered, reviewed, normalised, joined, typeset and read from pages.

    python -m glyphweave.cli filter INPUT... --output-dir DIR --report-dir DIR [--audit-only] [--no-strict] [--overwrite]
    python -m glyphweave.cli batch FOLDER OUTPUT --report-dir DIR [--recursive] [--overwrite] ...
    python -m glyphweave.cli review --report-dir DIR --status pass --notes TEXT
    python -m glyphweave.cli normalise INPUT_DIR OUTPUT_DIR [--font-size PT] [--force] | --self-test
    python -m glyphweave.cli concat INPUT_DIR OUTPUT [--first 1] [--last 114]
    python -m glyphweave.cli typeset INPUT_DIR OUTPUT_DIR [--page-size A1] [--points 5]
    python -m glyphweave.cli extract PAGES OUTPUT_DIR
"""

from __future__ import annotations

import argparse
import contextlib
import os
import sys
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as sc
from .operators import assembly, audit, preflight, rules
from .plans import documents, normalizer
from .sources import docx, files, pages, reports

# Exit codes.
OK, ARGUMENT, BLOCKED, FAILED, INVALID, EXISTS, PARTIAL = 0, 2, 3, 4, 5, 6, 7
# End of fixed values.


class Stop(Exception):
    """Ends a command with an exit code."""

    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def session() -> SparkSession:
    return SparkSession.builder.appName("glyphweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def discover(spark: SparkSession, inputs: list[str], recursive: bool = False) -> DataFrame:
    """(path, content) of documents: files as they are named, and those of folders but for outputs of earlier runs."""
    folders, single = [p for p in inputs if os.path.isdir(p)], [p for p in inputs if not os.path.isdir(p)]
    gone = [p for p in single if not os.path.exists(p)]
    if gone:
        raise Stop(ARGUMENT, f"not found: {', '.join(gone)}")
    found = [files.read_files(spark, p, recursive=recursive).where(files.is_source_document(F.col("path"))) for p in folders]
    found += [spark.read.format("binaryFile").load(single)] if single else []
    listed = found[0] if found else None
    for x in found[1:]:
        listed = listed.union(x)
    if listed is None or listed.isEmpty():
        raise Stop(ARGUMENT, "no documents")
    return listed.select("path", "content").dropDuplicates(["path"])


def _outputs(rows: DataFrame, ending: str) -> DataFrame:
    return rows.withColumn("path", F.concat(sc.stem(F.col("path")), F.lit(ending)))


def _publish_all(rows: DataFrame, folder: str) -> None:
    docx.publish(rows.select("path", "content"), folder, overwrite=True)


@contextlib.contextmanager
def kept() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Persists tables for the time of a command; folders may hold other files by the next."""
    held: list[DataFrame] = []

    def keep(rows: DataFrame) -> DataFrame:
        held.append(rows.persist())
        return held[-1]

    try:
        yield keep
    finally:
        for rows in held:
            rows.unpersist()


def run_filter(spark: SparkSession, source: DataFrame, output_dir: str, report_dir: str, audit_only: bool = False, strict: bool = True, overwrite: bool = False, target: str = docx.TARGET_FONT, symbol: str = docx.SYMBOL_FONT) -> int:
    """Reports first; then, if nothing is unknown or unresolved, outputs that pass all gates, and final reports.

    Outputs are checked before they are published, and never replace a file unless told to.
    """
    twins = assembly.duplicate_stems(source).first()
    if twins:
        raise Stop(ARGUMENT, f"two inputs named {twins.stem}")
    names = _outputs(source, ".filtered.docx").select("path")
    there = [r.path for r in names.collect() if os.path.exists(os.path.join(output_dir, r.path))]
    if there and not (overwrite or audit_only):
        raise Stop(EXISTS, f"refusing to replace {', '.join(sorted(there))}")
    with kept() as keep:
        return _filter(spark, keep(source), output_dir, report_dir, audit_only, strict, overwrite, target, symbol, keep)


def _filter(spark: SparkSession, source: DataFrame, output_dir: str, report_dir: str, audit_only: bool, strict: bool, overwrite: bool, target: str, symbol: str, keep: Callable[[DataFrame], DataFrame]) -> int:
    hashes = source.select(F.col("path").alias("doc_id"), F.sha2("content", 256).alias("sha256"))
    before = keep(hashes.select(F.col("doc_id").alias("path"), "sha256"))
    before.count()
    done = documents.transform(source, strict, target, symbol)
    report = keep(done.report)
    done = documents.Rewritten(keep(done.files), keep(done.segments), report, keep(done.targets))
    runs = documents.marked_runs(source, target, symbol)
    flights = keep(preflight.preflight(hashes, runs, done.segments, report, documents.joined_text(done.segments)).join(hashes, "doc_id"))
    decisions = keep(documents.decision_counts(report))
    counts = done.segments.select("doc_id", F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").groupBy("doc_id", "ch").agg(F.count("*").alias("n"))
    triggers = counts.where(rules.is_trigger(F.col("ch"))).select("doc_id", sc.codepoint_label(F.col("ch")).alias("codepoint"), "n")
    zero = audit.zero_match(rules.matchable_labels(spark), audit.text_labels(done.segments), hashes)
    name = lambda ending: F.concat(sc.stem(F.col("doc_id")), F.lit(ending))
    _publish_all(reports.json_reports(flights.join(reports.lists(decisions, "decisions", "rule", "n", "n_cross_run"), "doc_id", "left"), name(".preflight.json")), report_dir)
    _publish_all(reports.preflight_pages(flights, decisions, triggers, zero).select(name(".preflight.md").alias("path"), "content"), report_dir)
    combined = keep(preflight.combine_preflights(flights))
    columns = ["identity", "doc_id", "sha256", "target_characters", "unknown_count", "unresolved_count", "preflight_ok"]
    _publish_all(reports.json_reports(combined, F.lit("combined.preflight.json")), report_dir)
    _publish_all(reports.corpus_page("Before the change", combined, flights, columns).withColumn("path", F.lit("combined.preflight.md")), report_dir)
    if not combined.first().preflight_ok:
        raise Stop(BLOCKED, "preflight: something is unknown, unresolved or unidentified")
    if audit_only:
        return OK
    gates = keep(documents.document_gates(source, done, before, target, symbol, keep))
    good = gates.where("passed").select(F.col("doc_id").alias("path"))
    outputs = done.files.join(good, "path", "left_semi")
    docx.publish(_outputs(outputs, ".filtered.docx"), output_dir, overwrite)
    hashed = done.files.select(F.col("path").alias("doc_id"), F.sha2("content", 256).alias("output_sha256"))
    finals = flights.select("doc_id", "identity", "unknown_count", F.col("sha256").alias("input_sha256")).join(documents.document_sums(report), "doc_id", "left")
    finals = finals.join(hashed, "doc_id", "left").join(gates.select("doc_id", F.col("passed").alias("automated_pass")), "doc_id", "left")
    finals = keep(finals.withColumn("visual_qa_complete", F.lit(None).cast("boolean")))
    listed = gates.select("doc_id", "passed", F.struct(*(c for c in gates.columns if c not in ("doc_id", "passed"))).alias("gates"))
    _publish_all(reports.json_reports(finals.join(listed, "doc_id").join(reports.lists(decisions, "decisions", "rule", "n", "n_cross_run"), "doc_id", "left"), name(".audit.json")), report_dir)
    _publish_all(reports.final_pages(finals, decisions, gates).select(name(".audit.md").alias("path"), "content"), report_dir)
    _publish_finals(finals, report_dir)
    if gates.where("NOT passed").isEmpty():
        return OK
    raise Stop(INVALID, "an output fails a gate")


def _publish_finals(finals: DataFrame, report_dir: str) -> None:
    combined = preflight.combine_finals(finals)
    columns = ["identity", "doc_id", "input_sha256", "output_sha256", "input_characters", "output_characters", "automated_pass", "visual_qa_complete"]
    _publish_all(reports.json_reports(combined, F.lit("combined.audit.json")), report_dir)
    _publish_all(reports.corpus_page("After the change", combined, finals, columns).withColumn("path", F.lit("combined.audit.md")), report_dir)


def run_batch(spark: SparkSession, source: DataFrame, **options) -> tuple[int, list[tuple[str, int]]]:
    """Each document by itself, so that one that fails does not hold up others: the verdict, and the code of each."""
    results = []
    for row in source.select("path").orderBy("path").toLocalIterator():
        try:
            code = run_filter(spark, source.where(F.col("path") == row.path), **options)
        except Stop as stop:
            code = stop.code
        except Exception as error:  # noqa: BLE001
            print(error, file=sys.stderr)
            code = FAILED
        results.append((row.path, code))
    return assembly.batch_verdict(spark.createDataFrame(results, "path string, code int"), partial=PARTIAL).first().verdict, results


def run_review(spark: SparkSession, report_dir: str, status: str, notes: str) -> int:
    """All final reports of a folder marked as reviewed; the corpus's reports are written anew."""
    with kept() as keep:
        audits = files.read_audits(spark, report_dir)
        marked = keep(preflight.review(audits, status, notes).drop("visually_reviewed").withColumn("visual_qa_complete", F.lit(True)))
        if not marked.count():
            raise Stop(ARGUMENT, "no reports")
        _publish_all(reports.json_reports(marked, F.concat(sc.stem(F.col("doc_id")), F.lit(".audit.json"))), report_dir)
        _publish_finals(marked, report_dir)
    return OK


def run_normalise(spark: SparkSession, source: DataFrame, output_dir: str, points: float = 18.0, force: bool = False) -> tuple[int, list]:
    """The normaliser over every document of a folder: the code, and (path, paragraphs, characters in, characters out,
    error) of each. What is written is read back and compared before it is published."""
    with kept() as keep:
        return _normalise(keep(docx.paragraphs(source)), source, output_dir, points, force, keep)


def _normalise(read: DataFrame, source: DataFrame, output_dir: str, points: float, force: bool, keep: Callable[[DataFrame], DataFrame]) -> tuple[int, list]:
    good = read.where("error IS NULL").select("path", "paragraph", "text", normalizer.normalize(F.col("text")).alias("new"))
    wrong = good.where(F.size(normalizer.problems(F.col("new"))) > 0).select("path").distinct()
    new = keep(good.join(wrong, "path", "left_anti").select("path", "paragraph", F.col("new").alias("text")))
    made = keep(docx.documents(new, points=points))
    bad = docx.verify_written(made, new).select("path").distinct()
    sound = made.join(bad, "path", "left_anti")
    counts = good.groupBy("path").agg(F.count("*").alias("paragraphs"), F.sum(F.length("text")).alias("n_in"), F.sum(F.length("new")).alias("n_out"))
    errors = read.where("error IS NOT NULL").select("path", "error").union(wrong.select("path", F.lit("characters outside the rules"))).union(bad.select("path", F.lit("not written as expected")))
    listed = source.select("path").join(counts, "path", "left").join(errors.groupBy("path").agg(F.min("error").alias("error")), "path", "left").orderBy("path").collect()
    docx.publish(sound.withColumn("path", sc.base_name(F.col("path"))), output_dir, force)
    failed = sum(r.error is not None for r in listed)
    return OK if not failed else FAILED if failed == len(listed) else PARTIAL, [tuple(r) for r in listed]


def self_test(spark: SparkSession) -> list[str]:
    """Texts whose normal form is known, and what came out where it differs."""
    forms = [("".join(c + normalizer.MADDAH for c in f), f) for f in normalizer.FORMS]
    mapped = [(k, v) for k, v in normalizer.MAPPING.items()]
    cases = [*forms, *mapped, (normalizer.DELETED, ""), ("ب" + normalizer.MADDAH, "با"), ("ب" + normalizer.MADDAH + "ا", "با"), ("ااا", "ا"), ("في" + normalizer.MADDAH, "في"), ("كلمة١٢ كلمة", "كلمة كلمة"), ("ك١لمة", "ك١لمة")]
    rows = spark.createDataFrame(cases, "source string, expected string").withColumn("found", normalizer.normalize(F.col("source")))
    return [f"{r.source!r}: {r.found!r} is not {r.expected!r}" for r in rows.where("found <> expected").collect()]


def run_concat(spark: SparkSession, source: DataFrame, output: str, first: int, last: int) -> int:
    """Numbered documents as one, in the order of their numbers; a number that is missing or there twice is an error."""
    numbered = assembly.number_files(source)
    twice = assembly.duplicates(numbered, ["number"]).collect()
    missing = assembly.missing_numbers(numbered, "number", first, last).orderBy("number").collect()
    if twice or missing or not numbered.where("number IS NULL").isEmpty():
        raise Stop(ARGUMENT, f"numbers there twice: {[int(r.number) for r in twice]}; missing: {[r.number for r in missing]}; every file needs one")
    texts = docx.block_text(source).withColumn("text", sc.normalize_text(F.col("text"))).join(numbered.select("path", "number"), "path")
    marker = F.format_string("%03d", F.col("number").cast("int"))
    joined = assembly.ordered_concat(texts.withColumn("all", F.lit(1)), ["all"], ["number"], F.col("text"), marker=marker)
    made = docx.documents(joined.select(F.lit(os.path.basename(output)).alias("path"), F.lit(0).alias("paragraph"), "text"))
    docx.publish(made, os.path.dirname(output) or ".")
    return OK


def run_typeset(spark: SparkSession, source: DataFrame, output_dir: str, size: str, points: float) -> int:
    """A page for paged media of each document; turning it into PDF is left to a renderer."""
    read = docx.paragraphs(source)
    made = pages.typeset(read.where("error IS NULL"), "path", "paragraph", docx.TARGET_FONT, points, size)
    docx.publish(made.select(F.concat(sc.stem(F.col("path")), F.lit(".html")).alias("path"), F.encode("html", "UTF-8").alias("content")), output_dir)
    return OK


def run_extract(spark: SparkSession, stored: DataFrame, output_dir: str) -> int:
    """Verses of stored pages (page_id, html) as one numbered document a page, joined by spaces."""
    verses = pages.keyed_verses(stored)
    joined = verses.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("verse", "text"))).alias("v"))
    text = F.array_join(F.transform("v", lambda v: v["text"]), " ")
    name = sc.numbered_name(F.col("page_id").cast("int"), F.concat(F.lit("Page "), F.col("page_id").cast("string")))
    docx.publish(docx.documents(joined.select(name.alias("path"), F.lit(0).alias("paragraph"), text.alias("text"))), output_dir)
    return OK


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="glyphweave", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("filter", "batch"):
        p = commands.add_parser(name)
        if name == "filter":
            p.add_argument("inputs", nargs="+")
            p.add_argument("--output-dir", required=True)
        else:
            p.add_argument("inputs", nargs=1, metavar="folder")
            p.add_argument("output_dir")
            p.add_argument("--recursive", action="store_true")
        p.add_argument("--report-dir", required=name == "filter")
        p.add_argument("--audit-only", action="store_true")
        p.add_argument("--strict", action=argparse.BooleanOptionalAction, default=True)
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--target-font", default=docx.TARGET_FONT)
        p.add_argument("--symbol-font", default=docx.SYMBOL_FONT)
    p = commands.add_parser("review")
    p.add_argument("--report-dir", required=True)
    p.add_argument("--status", required=True, choices=("pass", "pass_with_font_limitation", "fail"))
    p.add_argument("--notes", required=True)
    p = commands.add_parser("normalise")
    p.add_argument("input_dir", nargs="?")
    p.add_argument("output_dir", nargs="?")
    p.add_argument("--font-size", type=float, default=18.0)
    p.add_argument("--force", action="store_true")
    p.add_argument("--self-test", action="store_true")
    p = commands.add_parser("concat")
    p.add_argument("input_dir")
    p.add_argument("output")
    p.add_argument("--first", type=int, default=1)
    p.add_argument("--last", type=int, default=114)
    p = commands.add_parser("typeset")
    p.add_argument("input_dir")
    p.add_argument("output_dir")
    p.add_argument("--page-size", choices=tuple(pages.PRESETS), default="A1")
    p.add_argument("--points", type=float, default=5.0)
    p = commands.add_parser("extract")
    p.add_argument("pages")
    p.add_argument("output_dir")
    return top


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.command in ("filter", "batch"):
        options = {
            "output_dir": args.output_dir, "report_dir": args.report_dir or os.path.join(args.output_dir, "reports"), "audit_only": args.audit_only, "strict": args.strict,
            "overwrite": args.overwrite, "target": args.target_font, "symbol": args.symbol_font,
        }
        source = discover(spark, args.inputs, getattr(args, "recursive", False))
        if args.command == "filter":
            return run_filter(spark, source, **options)
        twins = assembly.duplicate_stems(source).first()
        if twins:
            raise Stop(ARGUMENT, f"two inputs named {twins.stem}")
        code, results = run_batch(spark, source, **options)
        for path, own in results:
            print(f"{own} {path}")
        return code
    if args.command == "review":
        return run_review(spark, args.report_dir, args.status, args.notes)
    if args.command == "normalise":
        if args.self_test:
            wrong = self_test(spark)
            print("\n".join(wrong) or "all texts as expected")
            return FAILED if wrong else OK
        if not (args.input_dir and args.output_dir):
            raise Stop(ARGUMENT, "two folders are needed")
        code, listed = run_normalise(spark, discover(spark, [args.input_dir]), args.output_dir, args.font_size, args.force)
        for row in listed:
            print(*row)
        print(f"{sum(r[-1] is None for r in listed)} of {len(listed)} documents")
        return code
    if args.command == "concat":
        return run_concat(spark, discover(spark, [args.input_dir]), args.output, args.first, args.last)
    if args.command == "typeset":
        return run_typeset(spark, discover(spark, [args.input_dir]), args.output_dir, args.page_size, args.points)
    return run_extract(spark, spark.read.parquet(args.pages), args.output_dir)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return _run(spark or session(), args)
    except Stop as stop:
        print(stop, file=sys.stderr)
        return stop.code
    except Exception as error:  # noqa: BLE001
        if "FileExistsError" in str(error):
            print("refusing to replace a file", file=sys.stderr)
            return EXISTS
        print(error, file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    raise SystemExit(main())

"""Reports: one JSON document and one Markdown page for each document, and one of each for the corpus.

Reports are columns of text, made where the rows are; ``docx.publish`` writes them, each by a temporary file and a
rename.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import base_name


def json_reports(rows: DataFrame, name: Column) -> DataFrame:
    """(path, content): each row as one indented JSON document, its fields by name; ``name`` is the file's name."""
    text = F.to_json(F.struct(*sorted(rows.columns)), {"pretty": "true", "ignoreNullFields": "false"})
    return rows.select(name.alias("path"), F.encode(F.concat(text, F.lit("\n")), "UTF-8").alias("content"))


def markdown_table(rows: Column, head: list[str], cells: list) -> Column:
    """A table of an array of structs; each of ``cells`` makes one cell of a struct."""
    line = lambda r: F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c(r).cast("string"), F.lit("")) for c in cells)), F.lit(" |"))
    top = f"| {' | '.join(head)} |\n|{'---|' * len(head)}"
    return F.concat_ws("\n", F.lit(top), F.when(F.size(rows) > 0, F.array_join(F.transform(rows, line), "\n")).otherwise("| none |" + " |" * (len(head) - 1)))


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise("FAIL")


def _page(*parts: Column) -> Column:
    return F.encode(F.concat(F.concat_ws("\n\n", *parts), F.lit("\n")), "UTF-8")


def _bullets(*pairs: tuple[str, Column]) -> Column:
    return F.concat_ws("\n", *(F.concat(F.lit(f"- {label}: "), F.coalesce(value.cast("string"), F.lit("-"))) for label, value in pairs))


def lists(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """(doc_id, name): the rows of each document as a sorted array of structs."""
    return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))


def _with(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    empty = F.array().cast(right.schema[name].dataType)
    return left.join(right, "doc_id", "left").withColumn(name, F.coalesce(name, empty))


def preflight_pages(preflights: DataFrame, decisions: DataFrame, triggers: DataFrame, zero: DataFrame) -> DataFrame:
    """(doc_id, content). ``preflights``: rows of ``preflight`` with sha256. ``decisions``: (doc_id, rule, n,
    n_cross_run). ``triggers``: (doc_id, codepoint, n). ``zero``: (doc_id, label), rules that matched nothing."""
    rows = _with(preflights, lists(decisions, "d", "rule", "n", "n_cross_run"), "d")
    rows = _with(rows, lists(triggers, "t", "codepoint", "n"), "t")
    rows = rows.join(zero.groupBy("doc_id").agg(F.array_sort(F.collect_list("label")).alias("z")), "doc_id", "left")
    col = F.col
    return rows.select("doc_id", _page(
        F.concat(F.lit("# Before the change: "), base_name(col("doc_id"))),
        _bullets(("Chapter", col("identity")), ("SHA-256 of the input", col("sha256")), ("Characters, target and other", F.concat_ws(" / ", "target_characters", "other_characters")),
                 ("Stop sequences", col("stop_sequence_count")), ("Unknown characters", col("unknown_count")), ("Unresolved", col("unresolved_count")), ("Preflight", _status(col("preflight_ok")))),
        F.lit("## Decisions by context"), markdown_table(col("d"), ["Decision", "Count", "Across runs"], [lambda r: r["rule"], lambda r: r["n"], lambda r: r["n_cross_run"]]),
        F.lit("## Characters that rules act on"), markdown_table(col("t"), ["Code point", "Count"], [lambda r: r["codepoint"], lambda r: r["n"]]),
        F.lit("## Rules that match nothing here"), F.coalesce(F.array_join("z", ", "), F.lit("None.")),
    ).alias("content"))


def final_pages(finals: DataFrame, decisions: DataFrame, gates: DataFrame) -> DataFrame:
    """(doc_id, content). ``finals``: doc_id, identity, input_sha256, output_sha256, input_characters,
    output_characters, word_boundary_repairs, unknown_count, unresolved, automated_pass. ``gates``: the table of gates."""
    names = [c for c in gates.columns if c not in ("doc_id", "passed")]
    listed = gates.select("doc_id", F.array(*(F.struct(F.lit(n).alias("gate"), F.col(n).alias("ok")) for n in names)).alias("g"))
    rows = _with(_with(finals, lists(decisions, "d", "rule", "n"), "d"), listed, "g")
    col = F.col
    return rows.select("doc_id", _page(
        F.concat(F.lit("# After the change: "), base_name(col("doc_id"))),
        _bullets(("Chapter", col("identity")), ("SHA-256 of input and output", F.concat_ws(" / ", "input_sha256", "output_sha256")), ("Target characters, before and after", F.concat_ws(" / ", "input_characters", "output_characters")),
                 ("Word boundaries repaired", col("word_boundary_repairs")), ("Unknown and unresolved", F.concat_ws(" / ", "unknown_count", "unresolved")), ("Gates", _status(col("automated_pass")))),
        F.lit("## Applied decisions"), markdown_table(col("d"), ["Rule", "Count"], [lambda r: r["rule"], lambda r: r["n"]]),
        F.lit("## Gates"), markdown_table(col("g"), ["Gate", "Status"], [lambda r: r["gate"], lambda r: _status(r["ok"])]),
    ).alias("content"))


def corpus_page(title: str, summary: DataFrame, rows: DataFrame, columns: list[str], extra: Column | None = None) -> DataFrame:
    """(content): one page over a corpus: the fields of ``summary``, which is one row, and a table of ``columns`` of
    ``rows``, which is one line for each document and has as many."""
    col = F.col
    table = rows.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("__rows"))
    cells = [lambda r, c=c: r[c] for c in columns]
    both = summary.join(table, F.lit(True), "inner")
    parts = [F.lit(f"# {title}"), _bullets(*((c, col(c)) for c in summary.columns)), F.lit("## Documents"), markdown_table(col("__rows"), columns, cells)]
    return both.select(_page(*parts, *([] if extra is None else [extra])).alias("content"))

"""Segments of text and their characters as tables.

A segment is keyed by ``KEYS``. Its characters are rows with their position. Texts are dealt by key before they are
exploded: the shuffle moves texts rather than characters, and every window over a segment reuses that partitioning.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.unicode import ARABIC_BLOCKS, ARABIC_CLASS, ARABIC_ELSEWHERE, SPACE, chars, has_arabic

KEYS = ("doc_id", "paragraph", "segment")

#: Letters of the projection, for a to z; fixed values. It makes every contextual rule fire on Latin text.
PROJECTION = "ابٰدٓفّۤيجكلمنوَقرستٗ۝ءٞىٱ"
LATIN = "abcdefghijklmnopqrstuvwxyz"


def project(text: Column) -> Column:
    """Latin letters as Arabic letters and marks."""
    return F.translate(F.lower(text), LATIN, PROJECTION)


def paragraphs(docs: DataFrame, text: Column | None = None, key: str = "doc_id") -> DataFrame:
    """Lines of documents as paragraphs of one segment each: doc_id, paragraph, segment, text, surah_start.

    A null text has no paragraph; an empty line is an empty paragraph. The start is the line of the text's first Arabic
    character, counted before lines are exploded: nothing is shuffled.
    """
    own = docs.select(F.col(key).alias("doc_id"), (F.col("text") if text is None else text).alias("__text"))
    at = F.regexp_instr("__text", F.lit(ARABIC_CLASS))
    first = F.when(at > 0, F.size(F.split(F.substring("__text", F.lit(1), at), "\n")) - 1)
    rows = own.select("doc_id", first.alias("__first"), F.posexplode(F.split("__text", "\n")).alias("paragraph", "text"))
    return rows.select("doc_id", "paragraph", F.lit(0).alias("segment"), "text", F.coalesce(F.col("paragraph") == F.col("__first"), F.lit(False)).alias("surah_start"))


def mark_starts(segments: DataFrame) -> DataFrame:
    """Adds ``surah_start``: whether the segment is its document's first one with an Arabic character."""
    arabic = has_arabic(F.col("text"))
    place = F.struct(*KEYS[1:])
    flagged = segments.withColumn("__arabic", arabic)
    first = flagged.where("__arabic").groupBy("doc_id").agg(F.min(place).alias("__first"))
    joined = flagged.join(first, "doc_id", "left")
    return joined.withColumn("surah_start", F.coalesce(place == F.col("__first"), F.lit(False))).drop("__arabic", "__first")


def islands(rows: DataFrame, group: list[str], order: list[str], cut: Column, name: str = "segment") -> DataFrame:
    """Adds the number of the island a row falls into: one starts at the first row and wherever ``cut`` holds."""
    w = Window.partitionBy(*group).orderBy(*order)
    step = F.when(F.row_number().over(w) == 1, 0).otherwise(F.coalesce(cut.cast("int"), F.lit(0)))
    return rows.withColumn("__step", step).withColumn(name, F.sum("__step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__step")


def segments_of_runs(runs: DataFrame) -> DataFrame:
    """Segments of text runs: maximal stretches of target runs within a paragraph.

    ``runs``: doc_id, part, paragraph, run, text, target, is_break. A stretch is cut by a break run, whose own text
    opens the next one, and by a run that is no target and not empty; empty runs cut nothing. Returns doc_id, part,
    paragraph, segment (numbered within the paragraph), text, runs (number and length of each, and positive, lexical
    and nodes where ``runs`` has them), surah_start (the first segment of the main part with an Arabic character).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    wall = ~F.col("target") & (F.length(text) > 0)
    w = Window.partitionBy("doc_id", "part", "paragraph").orderBy("run")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = runs.withColumn("__cut", F.sum((wall | F.col("is_break")).cast("int")).over(before))
    own = cuts.where(F.col("target") & (F.length(text) > 0))
    extra = [c for c in ("positive", "lexical", "nodes") if c in runs.columns]
    rows = own.groupBy("doc_id", "part", "paragraph", "__cut").agg(F.array_sort(F.collect_list(F.struct("run", text.alias("text"), *extra))).alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    lengths = F.transform("pieces", lambda p: F.struct(p["run"].alias("run"), F.length(p["text"]).alias("length"), *(p[c].alias(c) for c in extra)))
    number = F.row_number().over(Window.partitionBy("doc_id", "part", "paragraph").orderBy("__cut")) - 1
    out = rows.select("doc_id", "part", "paragraph", number.alias("segment"), joined.alias("text"), lengths.alias("runs"))
    main = (F.col("part") == "word/document.xml") & has_arabic(F.col("text"))
    first = out.where(main).groupBy("doc_id").agg(F.min(F.struct("paragraph", "segment")).alias("__first"))
    marked = out.join(first, "doc_id", "left")
    start = F.coalesce((F.col("part") == "word/document.xml") & (F.struct("paragraph", "segment") == F.col("__first")), F.lit(False))
    return marked.withColumn("surah_start", start).drop("__first")


_ARABIC = re.compile("[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in (*ARABIC_BLOCKS, *ARABIC_ELSEWHERE)) + "]")


def segment_rows(runs: list[dict]) -> list[dict]:
    """Segments of one document's runs, which stand in order and have target, is_break, positive, lexical and nodes:
    what ``segments_of_runs`` makes of a table of them."""
    out: list[dict] = []
    place, cut, own = None, 0, None
    for x in runs:
        if (x["part"], x["paragraph"]) != place:
            place, cut, own, number = (x["part"], x["paragraph"]), 0, None, 0
        cut += (not x["target"] and x["text"] != "") or x["is_break"]
        if not x["target"] or x["text"] == "":
            continue
        if own is None or own["cut"] != cut:
            own = {"part": x["part"], "paragraph": x["paragraph"], "segment": number, "cut": cut, "texts": [], "runs": []}
            number += 1
            out.append(own)
        own["texts"].append(x["text"])
        own["runs"].append({"run": x["run"], "length": len(x["text"]), "positive": x["positive"], "lexical": x["lexical"], "nodes": x["nodes"]})
    begun = False
    for own in out:
        own["text"] = "".join(own.pop("texts"))
        own["surah_start"] = not begun and own["part"] == "word/document.xml" and _ARABIC.search(own["text"]) is not None
        begun |= own["surah_start"]
        del own["cut"]
    return out


def characters(segments: DataFrame, keys: tuple[str, ...] = KEYS, partitions: int | None = None) -> DataFrame:
    """One row per character: all columns but ``text``, and ``pos`` (from 0) and ``ch``.

    Dealt by ``keys`` first, so that windows over segments need no further shuffle. Where ``runs`` has them, each
    character gets its run's number, positive and lexical, by its place among the runs' lengths.
    """
    dealt = segments.repartition(*([partitions] if partitions else []), *keys)
    rest = [c for c in segments.columns if c not in ("text", "runs")]
    if "runs" in segments.columns:
        of_run = lambda r: F.array_repeat(F.struct(r["run"].alias("run"), r["positive"].alias("positive"), r["lexical"].alias("lexical")), r["length"])
        both = F.arrays_zip(chars(F.col("text")).alias("ch"), F.flatten(F.transform("runs", of_run)).alias("r"))
        return dealt.select(*rest, F.posexplode(both).alias("pos", "c")).select(*rest, "pos", "c.ch", "c.r.run", "c.r.positive", "c.r.lexical")
    return dealt.select(*rest, F.posexplode(F.split("text", "")).alias("pos", "ch")).where("ch <> ''")


def first_word(text: Column) -> Column:
    return F.regexp_extract(text, f"^[{SPACE}]*([^{SPACE}]+)", 1)


def leading_space(text: Column) -> Column:
    return F.length(F.regexp_extract(text, f"^[{SPACE}]*", 0))

"""Inventory of characters, occurrences of rule triggers, and their roll-ups over a corpus."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import codepoint_label, unicode_escape
from ..functions.unicode import SPACE, chars, is_arabic, is_mark, is_numeric, is_space
from . import rules


def histogram(docs: DataFrame, text: str = "text", target: Column | None = None) -> DataFrame:
    """Characters with their counts: codepoint, escaped, n, n_target and n_other.

    Characters are counted within each text before they are shuffled, as runs of an array's distinct members would
    cost more; Spark's partial aggregate does so by task. Without ``target`` all are target.
    """
    flag = F.lit(True) if target is None else F.coalesce(target, F.lit(False))
    rows = docs.select(flag.alias("target"), F.explode(chars(F.col(text))).alias("ch"))
    counts = rows.groupBy("ch").agg(F.count("*").alias("n"), F.count_if("target").alias("n_target"), F.count_if(~F.col("target")).alias("n_other"))
    return counts.select(codepoint_label(F.col("ch")).alias("codepoint"), unicode_escape(F.col("ch")).alias("escaped"), "n", "n_target", "n_other")


def character_sets(docs: DataFrame, sets: dict[str, Column], text: str = "text") -> DataFrame:
    """Characters with the sorted distinct values that each of ``sets`` takes where they occur, comma-joined.

    Each text gives each of its characters once, so the shuffle has a row for each distinct combination.
    """
    rows = docs.select(*(c.cast("string").alias(n) for n, c in sets.items()), F.explode(F.array_distinct(chars(F.col(text)))).alias("ch"))
    once = rows.groupBy("ch", *sets).agg(F.count("*").alias("n_texts"))
    out = once.groupBy("ch").agg(F.sum("n_texts").alias("n_texts"), *(F.array_join(F.array_sort(F.collect_set(F.coalesce(n, F.lit("(none)")))), ",").alias(n) for n in sets))
    return out.select(codepoint_label(F.col("ch")).alias("codepoint"), "n_texts", *sets)


def first_contexts(segments: DataFrame, most: int = 12, radius: int = 8) -> DataFrame:
    """The first ``most`` occurrences of each character, by doc_id, paragraph and position, with their contexts.

    Ranks are limited within each task before anything is shuffled (Spark's partial window limit): what is dealt is
    bounded by characters, tasks and ``most``.
    """
    rows = segments.select("doc_id", "paragraph", F.posexplode(F.split("text", "")).alias("pos", "ch")).where("ch <> ''")
    rank = F.row_number().over(Window.partitionBy("ch").orderBy("doc_id", "paragraph", "pos"))
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    # contexts are cut for what is left, some rows for each character, which meets the texts again
    found = segments.select("doc_id", "paragraph", "text").join(ranked, ["doc_id", "paragraph"])
    first = F.greatest(F.lit(0), F.col("pos") - radius)
    context = F.substring("text", first + 1, F.col("pos") + radius + 1 - first)
    return found.select(codepoint_label(F.col("ch")).alias("codepoint"), "rank", "doc_id", "paragraph", "pos", unicode_escape(context).alias("context"))


def occurrences(segments: DataFrame) -> DataFrame:
    """Characters that a rule triggers on, are special, or are unknown, with their contexts; the rest are left out
    before anything is exploded."""
    cs = chars(F.col("text"))
    found = F.filter(
        F.transform(cs, lambda c, i: F.struct(i.alias("pos"), c.alias("ch"), *(k.alias(n) for n, k in kinds_of(c).items()))),
        lambda x: x["trigger"] | x["special"] | x["unknown"],
    )
    # contexts are cut here, so that no row carries its whole text along
    cut = lambda x: F.array_join(F.slice("__cs", F.greatest(F.lit(0), x["pos"] - 14) + 1, F.least(x["pos"], F.lit(14)) + 15), "")
    with_context = F.transform("__found", lambda x: F.struct(*(x[n].alias(n) for n in ("pos", "ch", "trigger", "special", "unknown")), cut(x).alias("context")))
    rows = segments.select("doc_id", "paragraph", "segment", cs.alias("__cs"), found.alias("__found")).where(F.size("__found") > 0)
    rows = rows.select("doc_id", "paragraph", "segment", F.explode(with_context).alias("o"))
    return rows.select("doc_id", "paragraph", "segment", "o.pos", "o.ch", "o.trigger", "o.special", "o.unknown", unicode_escape(F.col("o.context")).alias("context"))


@functools.lru_cache(maxsize=1)
def _escaped_sizes() -> np.ndarray:
    """By code point, the characters of its escape."""
    size = np.full(0x110000, 10, np.int64)
    size[:0x10000], size[:0x100], size[32:127] = 6, 4, 1
    size[[9, 10, 13, 92]] = 2
    return size


def special_occurrences(segments: DataFrame) -> DataFrame:
    """Special characters with their contexts, as ``occurrences`` has them: doc_id, paragraph, segment, pos, codepoint,
    context. The texts of a batch are escaped once, and contexts are pieces of that."""
    own = segments.select("doc_id", "paragraph", "segment", F.coalesce("text", F.lit("")).alias("text"))
    most = 1 << 18

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= most):
                    size, end = size + len(texts[end]), end + 1
                joined = "".join(texts[at:end])
                cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
                lengths = np.array([len(t) for t in texts[at:end]], np.int64)
                ends = np.cumsum(lengths)
                every = np.flatnonzero(np.isin(cp, rules.SPECIAL))
                of = np.searchsorted(ends, every, "right")
                first = ends - lengths
                into = np.concatenate([[0], np.cumsum(_escaped_sizes()[cp])])
                low, high = into[np.maximum(first[of], every - 14)], into[np.minimum(ends[of], every + 15)]
                escaped = joined.encode("unicode_escape").decode("ascii")
                names = pa.array([f"U+{c:04X}" for c in rules.SPECIAL])
                code = np.zeros(len(every), np.int64)
                for i, c in enumerate(rules.SPECIAL):
                    code[cp[every] == c] = i
                for k in range(0, len(every), 1 << 16):  # a text without end gives no batch without end
                    part = slice(k, k + (1 << 16))
                    context = [escaped[a:b] for a, b in zip(low[part].tolist(), high[part].tolist(), strict=True)]
                    rows = pa.array(of[part] + at)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in range(3)), pa.array((every - first[of])[part].astype(np.int32)), names.take(pa.array(code[part])), pa.array(context, pa.string())], names=["doc_id", "paragraph", "segment", "pos", "codepoint", "context"])
                at = end

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields[:3])
    return own.mapInArrow(run, f"{schema}, pos int, codepoint string, context string")


def kinds_of(ch: Column) -> dict[str, Column]:
    """What makes a character an occurrence; it depends on the character alone."""
    return {"trigger": rules.is_trigger(ch), "special": F.ascii(ch).isin(*rules.SPECIAL), "unknown": is_arabic(ch) & ~rules.is_known(ch)}


def kind_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences by kind and code point: (kind, codepoint, n). Characters are counted first, then some hundred of
    them are told apart."""
    counts = docs.select(F.explode(chars(F.col(text))).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))
    named = F.array(*(F.when(c, F.lit(k)) for k, c in kinds_of(F.col("ch")).items()))
    kinds = counts.select(F.explode(F.filter(named, lambda k: k.isNotNull())).alias("kind"), codepoint_label(F.col("ch")).alias("codepoint"), "n")
    return kinds


def occurrence_counts(found: DataFrame) -> DataFrame:
    """Occurrences by code point and kind."""
    kinds = found.select("ch", F.explode(F.filter(F.array(F.when(F.col("trigger"), "trigger"), F.when(F.col("special"), "special"), F.when(F.col("unknown"), "unknown")), lambda k: k.isNotNull())).alias("kind"))
    return kinds.groupBy("kind", codepoint_label(F.col("ch")).alias("codepoint")).agg(F.count("*").alias("n"))


def stop_sequences(segments: DataFrame) -> DataFrame:
    """All places, overlapping ones too, at which a stop sequence stands: doc_id, paragraph, segment, pos, sequence."""
    sequences = ["".join(map(chr, x)) for x in rules.DELETE_SEQUENCES]
    held = F.lit(False)
    for x in sequences:
        held = held | F.col("text").contains(x)
    split = segments.where(held).select("doc_id", "paragraph", "segment", chars(F.col("text")).alias("__cs"))
    found = F.concat(*(_places(F.col("__cs"), x) for x in sequences))
    return split.select("doc_id", "paragraph", "segment", F.explode(found).alias("f")).select("doc_id", "paragraph", "segment", "f.pos", "f.sequence")


def _places(cs: Column, sequence: str) -> Column:
    """Positions (from 0) at which a sequence stands in an array of characters."""

    def here(c: Column, i: Column) -> Column:
        same = c == sequence[0]
        for k, x in enumerate(sequence[1:], 1):
            same = same & (F.get(cs, i + k) == x)
        return F.when(same, F.struct(i.alias("pos"), F.lit(sequence).alias("sequence")))

    return F.filter(F.transform(cs, here), lambda x: x.isNotNull())


def matched_labels(found: DataFrame, stops: DataFrame) -> DataFrame:
    """(doc_id, label) of the effective rules that a document's text matched."""
    single = found.where("trigger").select("doc_id", codepoint_label(F.col("ch")).alias("label"))
    numeric = found.where(is_numeric(F.col("ch"))).select("doc_id", F.lit(rules.NUMERIC_LABEL).alias("label"))
    names = F.create_map(*(F.lit(x) for s in rules.DELETE_SEQUENCES for x in ("".join(map(chr, s)), rules.label(s))))
    return single.union(numeric).union(stops.select("doc_id", names[F.col("sequence")].alias("label"))).distinct()


def text_labels(segments: DataFrame) -> DataFrame:
    """(doc_id, label) like ``matched_labels``, from the distinct characters of each text: each is told apart once."""
    once = segments.select("doc_id", F.explode(F.array_distinct(chars(F.col("text")))).alias("ch")).distinct()
    named = F.filter(F.array(F.when(rules.is_trigger(F.col("ch")), codepoint_label(F.col("ch"))), F.when(is_numeric(F.col("ch")), F.lit(rules.NUMERIC_LABEL))), lambda x: x.isNotNull())
    stops = F.filter(F.array(*(F.when(F.col("text").contains("".join(map(chr, s))), F.lit(rules.label(s))) for s in rules.DELETE_SEQUENCES)), lambda x: x.isNotNull())
    return once.select("doc_id", F.explode(named).alias("label")).union(segments.select("doc_id", F.explode(stops).alias("label"))).distinct()


def zero_match(labels: DataFrame, matched: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, label): effective rules that a document did not match. Labels are some fifty rows."""
    return docs.select("doc_id").distinct().crossJoin(F.broadcast(labels)).join(matched, ["doc_id", "label"], "left_anti")


def zero_match_corpus(labels: DataFrame, matched: DataFrame) -> DataFrame:
    """Labels that no document matched."""
    return labels.join(matched.select("label").distinct(), "label", "left_anti")


def orphan_marks(segments: DataFrame) -> DataFrame:
    """Marks at the start of a text or after white space: doc_id, paragraph, segment, pos, codepoint."""
    cs = chars(F.col("text"))
    before = F.concat(F.array(F.lit(" ")), cs)
    zipped = F.transform(F.arrays_zip(cs.alias("ch"), before.alias("before")), lambda x, i: F.struct(i.alias("pos"), x["ch"].alias("ch"), x["before"].alias("before")))
    found = F.filter(zipped, lambda x: x["ch"].isNotNull() & is_mark(x["ch"]) & is_space(x["before"]))
    rows = segments.where(F.col("text").rlike(rf"(^|[{SPACE}])\p{{M}}")).select("doc_id", "paragraph", "segment", F.explode(found).alias("o"))
    return rows.select("doc_id", "paragraph", "segment", "o.pos", codepoint_label(F.col("o.ch")).alias("codepoint"))

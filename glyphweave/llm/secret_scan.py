"""Incremental secret scan over content-addressed blobs, in DataFrame operations alone.

Every historical version of a path is known by the SHA-256 of its content. A ledger holds which pairs of blob and
rule version were scanned, with their findings. A scan takes the versions, finds the blobs that the ledger does
not have for this rule version, reads one version of each, scans it, and joins all findings back to all paths.

Spans come from splitting: the text between matches and the matches themselves alternate, so running sums of
their lengths give every start and end in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and which matches count: ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int
    least: int


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")

#: Order matters: findings that start together are listed in it.
RULES = (
    Rule("assign", "(" + _KEYS + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "(AKIA[A-Z0-9]{16,})", 1, 20),
    Rule("hex", "([0-9a-f]{24,})", 1, 24),
)
RULE_VERSION = "2"
_SPANS = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _spans(text: Column, index: int, rule: Rule) -> Column:
    """Matches of one rule as structs (start, kind, stop).

    Runs of one class that are longer than asked for are the same runs whether the least length stands in the
    pattern or not; where a failing match can hide a later one, the length is tested on the match.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        stop = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), F.lit(index).alias("kind"), stop.alias("stop"))
        good = F.length(F.regexp_extract(pair["hit"], rule.pattern, rule.group)) >= rule.least
        return F.struct(stop.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    return F.when(text.rlike(rule.pattern), F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(none)


def scan_column(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text, by start, then by the order of the rules."""
    return F.array_sort(F.concat(*(_spans(text, i, r) for i, r in enumerate(rules))))


def spans_string(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ",")


LEDGER_SCHEMA = f"blob string, rule_version string, spans {_SPANS}"


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger at ``path``; an empty one where nothing was written yet or no path is given."""
    if path is not None:
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
            return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_versions(spark: SparkSession, versions: DataFrame, path: str = "path", content: str = "content", ledger: str | None = None, rule_version: str = RULE_VERSION, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every version: ``path``, ``blob`` (SHA-256) and ``spans``, one row per row of ``versions``.

    With ``ledger`` (a Parquet folder), only pairs of blob and rule version that it lacks are scanned, and they are
    appended to it; without, a ledger for this run alone is kept in the shared folder. Null content counts as
    empty; null paths and repeated rows stay as they are; columns besides ``path`` and ``content`` are ignored.
    Empty tables give no rows.

    One version stands for its blob: the least path. Its text is fetched by a hash join whose build side is the
    list of unseen blobs, so texts are dealt by path (one third of all rows may be one blob: it is read once) and
    never sorted.
    """
    scratch = Scratch(spark, "secrets")
    text = F.coalesce(F.col(content), F.lit(""))
    known = scratch.save(versions.select(F.col(path).alias("path"), F.sha2(text, 256).alias("blob")), "versions")
    held = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version)
    unseen = known.groupBy("blob").agg(F.min("path").alias("path")).join(held.select("blob"), "blob", "left_anti")
    # no path at all: the key is null-safe, as text without a path is scanned as well
    source = versions.select(F.col(path).alias("path"), text.alias("text"))
    fetched = source.join(unseen.hint("shuffle_hash"), source["path"].eqNullSafe(unseen["path"]) & (F.sha2(source["text"], 256) == unseen["blob"]))
    scanned = fetched.select("blob", scan_column(F.col("text"), rules).alias("spans"))
    fresh = scanned.groupBy("blob").agg(F.max("spans").alias("spans")).select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    entries = scratch.save(fresh, "ledger")
    if ledger is not None:
        entries.write.mode("append").parquet(ledger)
        held = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version)
        entries = scratch.save(held.groupBy("blob").agg(F.max("spans").alias("spans")), "entries")  # writers may have raced
    found = entries.where(F.size("spans") > 0).select("blob", "spans")
    return known.join(found, "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))

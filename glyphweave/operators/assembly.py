"""Assembly of numbered pieces into ordered texts, with checks of their numbering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import base_name, file_number, stem
from .segments import islands


def number_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds name, number and place: the rank by number (none last), then by name in lower case."""
    named = files.withColumn("name", base_name(F.col(path)))
    return named.withColumn("number", file_number(F.col("name")))


def natural_order() -> list[Column]:
    return [F.col("number").asc_nulls_last(), F.lower("name").asc()]


def order_key() -> Column:
    """The natural order as one text that sorts like it: numbers filled up to 38 digits, those without one last."""
    return F.concat(F.coalesce(F.lpad(F.col("number").cast("string"), 38, "0"), F.lit("~")), F.lit(" "), F.lower("name"))


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often; null is no key."""
    filled = rows
    for k in keys:
        filled = filled.where(F.col(k).isNotNull())
    return filled.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").withColumnRenamed("__n", "n")


def repeats(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows whose key occurred before, by ``order``: all columns, and ``first``, the place of the first occurrence."""
    w = Window.partitionBy(*keys).orderBy(*order)
    place = F.struct(*order)
    marked = rows.withColumns({"__nth": F.row_number().over(w), "first": F.first(place).over(w)})
    for k in keys:
        marked = marked.where(F.col(k).isNotNull())
    return marked.where("__nth > 1").drop("__nth")


def duplicate_stems(files: DataFrame, path: str = "path") -> DataFrame:
    """Files whose stem an earlier file, by path, has: their outputs would be one file. (path, stem, twin)"""
    found = repeats(files.select(F.col(path).alias("path"), stem(F.col(path)).alias("stem")), ["stem"], ["path"])
    return found.select("path", "stem", F.col("first.path").alias("twin"))


def missing_numbers(rows: DataFrame, number: str, first: int = 1, last: int | None = None) -> DataFrame:
    """Numbers from ``first`` to ``last`` (by default the greatest) that do not occur: (number)."""
    seen = rows.select(F.col(number).cast("bigint").alias("number")).where("number IS NOT NULL").distinct()
    if last is None:
        last = seen.agg(F.max("number")).first()[0]
    stop = first if last is None else last + 1
    return rows.sparkSession.range(first, max(first, stop)).withColumnRenamed("id", "number").join(seen, "number", "left_anti")


def missing_runs(rows: DataFrame, number: str) -> DataFrame:
    """Gaps between numbers that occur: (after, first_missing, n_missing), without making the missing numbers.

    Neighbours are found within buckets of 65,536 numbers, and across them by the buckets' ends, level by level: four
    levels hold all numbers of 64 bits, so no window spans the whole table.
    """
    level = rows.select(F.col(number).cast("bigint").alias("least")).where("least IS NOT NULL").distinct().withColumn("most", F.col("least"))
    steps = []
    for shift in (16, 32, 48, 63):
        bucket = F.shiftright("least", shift) if shift < 63 else F.lit(0)
        marked = level.withColumn("bucket", bucket)
        following = F.lead("least").over(Window.partitionBy("bucket").orderBy("least"))
        steps.append(marked.select(F.col("most").alias("number"), following.alias("next")).where("next IS NOT NULL"))
        level = marked.groupBy("bucket").agg(F.min("least").alias("least"), F.max("most").alias("most")).drop("bucket")
    gaps = reduce(DataFrame.union, steps)
    return gaps.where("next > number + 1").select(F.col("number").alias("after"), (F.col("number") + 1).alias("first_missing"), (F.col("next") - F.col("number") - 1).alias("n_missing"))


def ordered_concat(rows: DataFrame, group: Sequence[str], order: Sequence[str], text: Column, separator: str = " . ", tail: str = " .", marker: Column | None = None) -> DataFrame:
    """One text for each group: pieces in order, joined by ``separator`` and closed by ``tail``.

    ``marker``: a piece put before that row's own where it is not null. Empty and null pieces are left out, and so
    are groups without any.
    """
    pieces = F.array(marker, text) if marker is not None else F.array(text)
    full = F.filter(pieces, lambda p: p.isNotNull() & (p != ""))
    listed = rows.withColumn("__o", F.struct(*order, full.alias("__p"))).groupBy(*group).agg(F.array_sort(F.collect_list("__o")).alias("__l"))
    flat = F.flatten(F.transform("__l", lambda x: x["__p"]))
    joined = listed.select(*group, flat.alias("__f")).where(F.size("__f") > 0)
    return joined.select(*group, F.concat(F.array_join("__f", separator), F.lit(tail)).alias("text"), F.size("__f").cast("bigint").alias("n_pieces"))


def last_write_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of each key's last row by ``order``; ties go to the greatest values."""
    latest = F.max(F.struct(*dict.fromkeys([*order, *values]))).alias("__r")
    return rows.groupBy(*keys).agg(latest).select(*keys, *(F.col(f"__r.{v}").alias(v) for v in values))


def stagnation(polls: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adds stagnant: how many polls in a row, up to this one, saw no change."""
    w = Window.partitionBy(*group).orderBy(*order)
    change = ~F.col(value).eqNullSafe(F.lag(value).over(w))
    cut = polls.withColumn("__change", change)
    runs = islands(cut, list(group), list(order), F.col("__change"), "__run")
    return runs.withColumn("stagnant", F.row_number().over(Window.partitionBy(*group, "__run").orderBy(*order)) - 1).drop("__change", "__run")


def batch_verdict(results: DataFrame, code: str = "code", partial: int = 7) -> DataFrame:
    """(verdict, n, n_failed): 0 if all are, the one code if all failed alike, else ``partial``."""
    failed = F.col(code) != 0
    agg = results.agg(F.count("*").alias("n"), F.count_if(failed).alias("n_failed"), F.count_distinct(code).alias("k"), F.max(code).alias("top"))
    verdict = F.when(F.coalesce(F.col("n_failed"), F.lit(0)) == 0, 0).when(F.col("k") == 1, F.col("top")).otherwise(partial)
    return agg.select(verdict.cast("int").alias("verdict"), "n", "n_failed")

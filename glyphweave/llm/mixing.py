"""Mixing sources by temperature.

A source's weight is its token share to the power of an exponent, normalised. The exponent is found by
bisection: the one nearest to 1 (natural shares) with which the weights have the wanted entropy, or the least with
which no source is repeated more often than the limit. Weights become token budgets, and budgets become block
permutations: documents of a source fall into blocks by a hash; each epoch runs through the blocks in its own
order; the last epoch stops in the block where the budget ends.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Weights are sent to all executors up to so many sources (some 100 bytes each); beyond, they are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Rows of a block, by default.
BLOCK_ROWS = 1 << 16


def count_words(text: Column) -> Column:
    """Words between white space; none of a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def bisect_exponent(meets: Callable[[float], bool], steps: int = 40) -> float:
    """The largest exponent in [0, 1] at which ``meets`` holds, which holds below any at which it holds; else 0."""
    if meets(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if meets(middle) else (low, middle)
    return low


def find_exponent(totals: DataFrame, entropy: float | None = None, repeats: float | None = None) -> float:
    """Exponent for ``totals`` (source, n > 0): ``entropy`` is a share of the greatest possible, ``repeats`` a limit.

    Entropy falls as the exponent grows: the largest exponent whose weights still have that entropy is taken.
    Repeats of the smallest source, when the largest is used once, fall as well: the least exponent within the
    limit is taken. Each step is one aggregate over the sources; no row of theirs comes to the driver.
    """
    few = totals.agg(F.count("*").alias("k"), F.min("n").alias("least"), F.max("n").alias("most")).first()
    if few["k"] < 2 or few["least"] == few["most"]:
        return 1.0
    if repeats is not None:
        # (most / least) ** (1 - exponent) <= repeats
        return 1.0 - bisect_exponent(lambda flat: (few["most"] / few["least"]) ** flat <= repeats)
    if entropy is None:
        raise ValueError("give a target entropy or a limit of repeats")
    share = F.col("n") / F.lit(few["most"])

    def enough(exponent: float) -> bool:
        weight = F.pow(share, F.lit(exponent))
        z, s = totals.agg(F.sum(weight), F.sum(weight * F.log(share) * exponent)).first()
        return math.log(z) - s / z >= entropy * math.log(few["k"])

    return bisect_exponent(enough)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", entropy: float | None = None, repeats: float | None = None, budget: int | None = None, blocks: int | None = None, seed: int = 0, tokens: str | None = None) -> DataFrame:
    """All columns of ``docs``, and mix_tokens, mix_epoch (from 1), mix_block and mix_order, one row for each use.

    ``tokens``: the column that counts each row's tokens; by default words are counted. ``blocks`` of each source are by
    default as many as give blocks of about ``BLOCK_ROWS`` rows of a table, 1,024 at least, so that the one block of a
    source that is cut is a bounded piece of work at every size.

    Read in order of (mix_epoch, mix_order, ``key``), each source runs through its blocks in that epoch's order.
    ``budget``: tokens of all sources together; by default as many as let the largest source be used just once, so
    that no document is left out. The last epoch takes documents while their tokens fit what is left of the budget;
    it falls short by less than one document. Null is a source of its own; a document without words takes nothing
    from the budget and goes with its block; a source of such documents alone is used once. Repeated rows are
    rows like any other, and equal keys stay together. Columns of the input with one of the four names are replaced.
    An empty table gives no rows.

    Texts are never shuffled: block totals, and the documents of the one block of each source in which its budget
    ends, are aggregated; the plan that comes of it has a row for each source.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    docs = docs.drop("mix_tokens", "mix_epoch", "mix_block", "mix_order")
    if blocks is None:
        blocks = max(1024, 1 << (docs.count() // BLOCK_ROWS).bit_length())
    place = F.xxhash64(F.lit(seed), F.col(key))
    marked = docs.withColumns({"__hash": place, "__source": F.col(source), "__text": F.col(text if tokens is None else tokens)}).withColumn("mix_block", F.pmod("__hash", F.lit(blocks)).cast("int"))
    words = count_words(F.col("__text")) if tokens is None else F.coalesce(F.col("__text"), F.lit(0)).cast("bigint")
    light = scratch.save(marked.groupBy("__source", "mix_block").agg(F.sum(words).alias("n")), "blocks")
    totals = scratch.save(light.groupBy("__source").agg(F.sum("n").alias("n")), "totals")
    used = totals.where("n > 0")
    exponent = find_exponent(used, entropy, repeats)
    stats = used.agg(F.max("n").alias("most"), F.count("*").alias("k")).first()
    most = stats["most"] or 1
    z = used.agg(F.sum(F.pow(F.col("n") / F.lit(most), F.lit(exponent)))).first()[0] or 1.0
    if budget is None:  # the largest source has weight 1 / z and is used once
        wanted = F.greatest(F.col("n"), F.round(F.pow(F.col("n") / F.lit(most), F.lit(exponent)) * F.lit(float(most))).cast("bigint"))
    else:
        wanted = F.floor(F.pow(F.col("n") / F.lit(most), F.lit(exponent)) / F.lit(z) * F.lit(float(budget))).cast("bigint")
    plan = totals.withColumn("budget", F.when(F.col("n") > 0, wanted).otherwise(F.lit(0)))
    plan = plan.withColumn("epochs", F.when(F.col("n") > 0, F.floor(F.col("budget") / F.col("n"))).otherwise(F.lit(1)).cast("int"))
    plan = plan.withColumn("left", F.when(F.col("n") > 0, F.col("budget") - F.col("epochs") * F.col("n")).otherwise(F.lit(0)))

    def order(epoch: Column, block: Column) -> Column:
        return F.xxhash64(F.lit(seed), F.col("__source"), epoch, block)

    same = lambda a, b: a["__source"].eqNullSafe(b["__source"])
    p = plan.select("__source", "epochs", "left").withColumnRenamed("__source", "__s")
    ranked = light.join(p, light["__source"].eqNullSafe(p["__s"])).drop("__s").withColumn("rank", order(F.col("epochs") + 1, F.col("mix_block")))
    window = Window.partitionBy("__source").orderBy("rank", "mix_block")
    summed = ranked.withColumn("through", F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    # the first block that does not fit whole; a source without one is used in whole epochs
    edge = summed.where((F.col("left") > 0) & (F.col("through") > F.col("left"))).groupBy("__source").agg(F.min(F.struct("rank", "mix_block", (F.col("left") - F.col("through") + F.col("n")).alias("room"))).alias("edge"))
    edge = scratch.save(edge.select("__source", "edge.*"), "edges")
    small = edge.count() <= BROADCAST_SOURCES
    hint = F.broadcast if small else lambda df: df
    inside = marked.select("__source", "mix_block", "__hash", "__text")
    e = edge.select(F.col("__source").alias("__s"), F.col("mix_block").alias("__b"), "room")
    last = inside.join(hint(e), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("mix_block") == F.col("__b")))
    last = last.groupBy("__source", "__hash", "room").agg(F.sum(words).alias("n"))
    summed = last.withColumn("through", F.sum("n").over(Window.partitionBy("__source").orderBy("__hash").rowsBetween(Window.unboundedPreceding, 0)))
    cut = summed.where(F.col("through") <= F.col("room")).groupBy("__source").agg(F.max("__hash").alias("cut"))
    full = plan.join(edge, same(plan, edge), "left").select(plan["__source"], "epochs", "rank", "mix_block")
    full = full.join(cut, same(full, cut), "left").select(full["__source"].alias("__s"), "epochs", F.col("rank").alias("__rank"), F.col("mix_block").alias("__b"), "cut")
    full = scratch.save(full, "plan")
    own = order(F.col("epochs") + 1, F.col("mix_block"))
    at_edge = F.col("mix_block") == F.col("__b")
    more = F.when(F.col("__rank").isNull(), False).when(at_edge, F.coalesce(F.col("__hash") <= F.col("cut"), F.lit(False))).otherwise((own < F.col("__rank")) | (own == F.col("__rank")) & (F.col("mix_block") < F.col("__b")))
    joined = marked.withColumn("mix_tokens", words).join(hint(full), F.col("__source").eqNullSafe(F.col("__s")))
    times = F.col("epochs") + more.cast("int")
    out = joined.where(times > 0).withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), times)))
    return out.withColumn("mix_order", order(F.col("mix_epoch"), F.col("mix_block"))).select(*docs.columns, "mix_tokens", "mix_epoch", "mix_block", "mix_order")

"""N-gram Jaccard join: a blocked sparse product of documents by n-grams, pruned by bounds from sizes.

Rows are documents, columns their distinct word n-grams. All columns stand in one order, rare ones first. Two
documents that link share so many n-grams that one of them lies among the first of both: a set of n needs only its
first n - ceil(n * similarity) + 1 columns in the product. Blocks of these columns give the pairs with any overlap
there; what they share in these columns, and what stands behind, bound the whole overlap, and pairs below are
dropped. For the rest the overlap is counted over all columns.

The order needs no exact counts: n-grams that are frequent in a block of texts are counted, and the 65,536 most
frequent of all stand last. Any order gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_batches
from .linking import link_components
from .shingles import fingerprint, shingle_sets

#: Frequent n-grams that are known to all tasks: 16 bytes each, 1 MB at most.
FREQUENT = 1 << 16
#: Bytes of a block of texts, and documents of it in which an n-gram counts as frequent there.
BLOCK_BYTES, OFTEN = 4 << 20, 4


def prefix_order(own: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set's n-grams in the order of all columns. ``frequent`` is sorted; ``rank`` grows with the count."""
    if not len(frequent):
        return own
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    place = np.where(frequent[at] == own, rank[at], -1)
    return own[np.lexsort((own, place))]


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``key``, n_shingles and component_id (the least key that links lead to) of every row.

    Documents link when den * shared >= num * union over their distinct shingles of ``size`` words; a text of fewer
    words is one shingle, one without words (or null) has none and links with nothing. Keys are integers; a row
    without one has no component. Rows with one key are one document, whose links are those of all its rows. Equal
    sets are met once, by their least key. An empty table gives no rows; columns besides the two are left out, so names
    can't clash; a very long text is one row of work, at some 50 bytes of memory a word.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    own = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "f1", "f2", "gram", "times"]
        for batch in batches:
            for at, end, data, offsets in text_batches(batch.column("text"), BLOCK_BYTES):
                sets = shingle_sets(data, offsets, size)
                prints = [fingerprint(s) for s in sets]
                n = len(sets)
                columns = [batch.column("id").slice(at, end - at), pa.array([len(s) for s in sets], pa.int32()), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                different = {p: s for p, s in zip(prints, sets, strict=True)}
                grams, times = np.unique(np.concatenate(list(different.values())), return_counts=True)
                grams, times = grams[times >= OFTEN].view(np.int64), times[times >= OFTEN]
                n = len(grams)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(grams), pa.array(times.astype(np.int32))], names=names)

    counted = scratch.save(own.mapInArrow(count, "id bigint, n int, f1 bigint, f2 bigint, gram bigint, times int"), "counted")
    known = counted.where("gram IS NULL").select("id", "n", "f1", "f2")
    top = counted.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "gram").limit(FREQUENT).collect()
    grams = np.array([r["gram"] for r in top], np.int64).view(np.uint64)
    rank = np.arange(len(grams), 0, -1)
    by_gram = np.argsort(grams)
    shared = spark.sparkContext.broadcast((grams[by_gram], rank[by_gram]))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        for batch in batches:
            for at, _, data, offsets in text_batches(batch.column("text")):
                seen = set()
                keys, ids, sizes, places = [], [], [], []
                for i, s in enumerate(shingle_sets(data, offsets, size), at):
                    name = batch.column("id")[i].as_py()
                    if name is None or not len(s) or (mark := fingerprint(s)) in seen:
                        continue  # equal sets link by their fingerprints
                    seen.add(mark)
                    first = prefix_order(s, frequent, rank)[: len(s) - -(-num * len(s) // den) + 1]
                    keys.append(first)
                    ids.append(np.full(len(first), name))
                    sizes.append(np.full(len(first), len(s), np.int32))
                    places.append(np.arange(len(first), dtype=np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (ids, sizes, places))], names=["key", "id", "size", "pos"])

    scratch.save(own.mapInArrow(prefixes, "key bigint, id bigint, size int, pos int"), "buckets")
    copies = known.where("n > 0 AND id IS NOT NULL").groupBy("n", "f1", "f2").agg(F.min("id").alias("first"), F.count("*").alias("many")).where("many > 1")
    copies = scratch.save(copies.drop("many"), "copies")
    named = scratch.save(known.join(copies, ["n", "f1", "f2"], "left").select("id", "n", F.coalesce("first", "id").alias("first")), "named")
    # a key with several texts is a vertex of its own, tied to the first of each
    several = scratch.save(named.groupBy("id").agg(F.min("first").alias("x"), F.max("first").alias("y")).where("x <> y").select("id", F.lit(True).alias("several")), "several")
    named = named.join(several, "id", "left")
    tied = named.where("several AND id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    named = scratch.save(named.select("id", "n", F.when(F.col("several"), F.col("id")).otherwise(F.col("first")).alias("first")), "named")
    same = scratch.save(named.where("id <> first").select("id", "first").distinct(), "same")
    comps = link_components(scratch, "buckets", own.where("id IS NOT NULL"), size, num, den, True, same, tied)
    found = named.join(comps.withColumnRenamed("id", "first"), "first", "left")
    return found.select(F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))

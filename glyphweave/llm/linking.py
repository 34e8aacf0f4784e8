"""Links between sets of shingles that share a key, and the components that they make.

Pairs of items that share a key are candidates. Writing all pairs of a key would grow with the square of its items,
so they are taken in two steps that lose no component:

1. Each item is compared with the least item of its key and size class. Copies with small changes mostly meet in
   this step, at a cost that is linear in the items. Links found make components.
2. Keys whose items still lie in different components are met again. Only pairs across components are compared, in
   blocks of bounded size, and of these only such as sizes, places and counts of shared keys allow, or sketches: an
   item's sketch has a bit for each remainder of its shingles, set where an odd number of them has it. Sketches of two
   sets differ in no more bits than the sets differ in shingles, so the bound loses no pair.

A pair within one component needs no comparison: whatever it gives, components stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_batches
from .components import components
from .shingles import shingle_sets

#: Items of a key that are met at once in step 2, and items compared with one other in a task's run.
BLOCK = 256
#: Ids that are sent to all tasks at most, 16 MB as a hash table.
SHORT_LIST = 500_000


def least_overlap(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Shared shingles that two sets of these sizes need: den * shared >= num * union."""
    return -(-num * (a + b) // (num + den))


def parity(own: np.ndarray) -> bytes:
    """The sketch of a set: at least four bits for each shingle, a power of two of them, 128 to 16,384."""
    bits = min(1 << 14, max(128, 1 << (4 * len(own) - 1).bit_length()))
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(x: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64 bits each) at a smaller width."""
    while x.shape[1] > width:
        half = x.shape[1] // 2
        x = x[:, :half] ^ x[:, half:]
    return x


def sketch_distance(sketches: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the sketches (objects of bytes) of rows i and j differ: what the sets differ by, at least."""
    widths = np.array([len(s) // 8 for s in sketches], np.int64)
    rank = np.zeros(len(sketches), np.int64)
    tables = {}
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        rank[at] = np.arange(len(at))
        tables[w] = np.frombuffer(b"".join(sketches[at]), "<u8").reshape(-1, w)
    out = np.zeros(len(i), np.int64)
    code = widths[i] * (1 << 20) + widths[j]
    for c in np.unique(code).tolist():
        a, b = divmod(c, 1 << 20)
        least = min(a, b)
        x, y = _fold(tables[a], least), _fold(tables[b], least)
        pairs = np.flatnonzero(code == c)
        step = max(1, (1 << 20) // least)
        for at in range(0, len(pairs), step):
            p = pairs[at : at + step]
            out[p] = np.bitwise_count(x[rank[i[p]]] ^ y[rank[j[p]]]).sum(1)
    return out


def verify(scratch: Scratch, pairs: DataFrame, items: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts in ``items`` (id, text) have den * shared >= num * union; ids are longs.

    Pairs are dealt by b, a bounded number to a run; the text of b is sent to each of its runs once. Several texts
    of one id count as alternatives.
    """
    many = scratch.save(pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n")), "runs")
    first = many.select(F.col("b").alias("id"), "b", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("run"), F.lit(0).alias("role"))
    rest = pairs.join(many, "b").select(F.col("a").alias("id"), "b", F.pmod(F.xxhash64("a"), F.col("n")).cast("int").alias("run"), F.lit(1).alias("role"))
    wanted = first.union(rest)
    met = items.join(wanted.hint("shuffle_hash"), "id").select("b", "run", "role", "id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hubs = None, []
        for batch in batches:
            bs, runs, roles, ids = (batch.column(c).to_numpy() for c in ("b", "run", "role", "id"))
            found: list[tuple[int, int]] = []
            for at, end, data, offsets in text_batches(batch.column("text")):
                for i, own in zip(range(at, end), shingle_sets(data, offsets, size), strict=True):
                    if (bs[i], runs[i]) != now:
                        now, hubs = (bs[i], runs[i]), []
                    if roles[i] == 0:
                        hubs.append(own)
                        continue
                    for hub in hubs:
                        total = len(own) + len(hub)
                        need = -(-num * total // (num + den))
                        if min(len(own), len(hub)) < need or not len(own):
                            continue
                        merged = np.concatenate([own, hub])
                        merged.sort()
                        if np.count_nonzero(merged[1:] == merged[:-1]) >= need:
                            found.append((int(ids[i]), int(bs[i])))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return met.repartition("b", "run").sortWithinPartitions("b", "run", "role").mapInArrow(compare, "a bigint, b bigint")


def _across(num: int, den: int, prefix: bool, sketched: bool) -> Callable:
    """Pairs across components, from rows that come in runs of (key, lo, hi).

    With ``prefix``, a key that stands at some place in an item's order leaves no more than what stands behind it to
    be shared after it. A pair whose first shared key leaves too little cannot link, and is dropped at each such key.
    With ``sketched``, pairs whose sketches differ by too much are dropped, and a pair is given at the least of the keys
    at which both are met, so that it is given once.
    """
    names = ("key", "lo", "hi", "id", "component", "size", "pos", "side") + (("sketch", "keys") if sketched else ())

    def pairs(c: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers of all pairs of each run that its block is to compare."""
        lengths = np.diff(cuts)
        two = cuts[:-1][lengths == 2]
        yield two, two + 1
        for at, n in zip(cuts[:-1][lengths > 2].tolist(), lengths[lengths > 2].tolist(), strict=True):
            if c["lo"][at] == c["hi"][at]:
                i, j = np.triu_indices(n, 1)
            else:
                left = c["side"][at : at + n] == c["lo"][at]
                i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(left), np.flatnonzero(~left), indexing="ij"))
            yield i + at, j + at

    def count(c: dict[str, np.ndarray], cuts: np.ndarray) -> list[np.ndarray]:
        out = []
        for i, j in pairs(c, cuts):
            n, m = c["size"][i].astype(np.int64), c["size"][j].astype(np.int64)
            whole = (c["lo"][i] == c["hi"][i]) | (c["side"][i] != c["side"][j])
            left = np.minimum(n - c["pos"][i], m - c["pos"][j]) if prefix else np.minimum(n, m)
            keep = (c["component"][i] != c["component"][j]) & (left >= least_overlap(n, m, num, den)) & whole
            i, j = i[keep], j[keep]
            if sketched and len(i):
                n, m = n[keep], m[keep]
                at, both = np.unique(np.concatenate([i, j]), return_inverse=True)
                far = sketch_distance(c["sketch"][at], both[: len(i)], both[len(i) :])
                near = (n + m - far) // 2 >= least_overlap(n, m, num, den)
                i, j = i[near], j[near]
                first = [c["key"][x] == np.intersect1d(c["keys"][x], c["keys"][y])[0] for x, y in zip(i.tolist(), j.tolist(), strict=True)]
                i, j = i[np.array(first, bool)], j[np.array(first, bool)]
            swap = c["id"][i] < c["id"][j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            if len(i):
                out.append(np.column_stack([c["id"][i], c["id"][j], c["size"][i], c["size"][j]]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            both = np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 4), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k])) for k in range(4)], names=["a", "b", "n", "m"])

        rest: dict[str, np.ndarray] | None = None
        for batch in (*batches, None):
            if batch is not None:
                c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
                if rest is not None:
                    c = {k: np.concatenate([rest[k], c[k]]) for k in names}
            elif rest is not None:
                c = rest
            else:
                break
            total = len(c["key"])
            change = np.flatnonzero((c["key"][1:] != c["key"][:-1]) | (c["lo"][1:] != c["lo"][:-1]) | (c["hi"][1:] != c["hi"][:-1])) + 1
            cuts = np.concatenate([[0], change, [total]])
            if batch is not None:  # the last run may go on
                rest = {k: v[cuts[-2] :] for k, v in c.items()}
                cuts = cuts[:-1]
            for x in count(c, cuts):
                held.append(x)
                rows += len(x)
                if rows > 1 << 19:
                    yield flush()
                    held, rows = [], 0
        yield flush()

    return run


def _texts(items: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of these ids, each once. A list of ids that is short is sent to all tasks, so that texts stay where
    they are; a long one is met by a hash join that sorts no text."""
    short = ids.count() <= SHORT_LIST
    met = items.join(F.broadcast(ids) if short else ids.hint("shuffle_hash"), "id", "left_semi")
    return met.withColumn("digest", F.xxhash64("text")).dropDuplicates(["id", "digest"]).select("id", "text")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def link_components(scratch: Scratch, buckets: str, items: DataFrame, size: int, num: int, den: int, prefix: bool, same: DataFrame | None = None, tied: DataFrame | None = None) -> DataFrame:
    """(id, component) of the items that link with another one.

    ``buckets``: name of a table in ``scratch`` (key, id, size, pos, sketch) of longs, ints and bytes, dropped when it
    is used up. ``size`` counts the item's shingles and ``pos`` is the key's place among the item's keys (0 without
    ``prefix``). Without ``prefix``, one row of each item has its sketch and no key. ``items``: (id, text). ``size``, ``num``,
    ``den``: words of a shingle, and the least similarity num / den. ``prefix``: keys
    are the first shingles, in one order, of each item: all but ceil(num * size / den) - 1; the keys that two items
    share then bound their overlap. ``same``: (id, first) of items that equal another item, which alone is then met.
    ``tied``: further links (a, b) that need no comparison.
    """
    keyed = scratch.read(buckets).where("key IS NOT NULL").select("key", "id", "size", "pos")
    keys = scratch.save(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    shared = keyed.join(keys, "key")
    if same is not None:
        shared = scratch.save(shared, "met")
        renamed = same.select(F.col("id").alias("__i"), F.col("first").alias("__f"))
        shared = shared.join(renamed, shared["id"] == renamed["__i"], "left").select("key", F.coalesce("__f", "id").alias("id"), "size", "pos")
    # sizes of one class differ by less than the similarity allows
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(den / num)) + F.lit(1e-9)).cast("int")
    shared = scratch.save(shared.distinct().withColumn("band", band), "shared")
    if not prefix:
        sketches = scratch.save(scratch.read(buckets).where("sketch IS NOT NULL").select("id", "sketch"), "sketches")
    scratch.drop(buckets, "keys", "met")

    def enough(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose shared keys, with all that stands behind the keys of one of them, may suffice."""
        if not prefix:
            return pairs.select("a", "b")
        behind = lambda n: F.ceil(F.col(n) * num / den) - 1
        need = F.ceil((F.col("n") + F.col("m")) * num / (num + den))
        return pairs.where(F.col("shared") >= need - F.greatest(behind("n"), behind("m"))).select("a", "b")

    hubs = shared.groupBy("key", "band").agg(F.min(F.struct("id", "size")).alias("hub"), F.max("id").alias("last")).where("hub.id <> last")
    hubs = scratch.save(hubs.select("key", "band", F.col("hub.id").alias("hub"), F.col("hub.size").alias("m")), "hubs")
    met = shared.join(hubs, ["key", "band"]).where("id <> hub")
    first = scratch.save(enough(met.groupBy(F.col("id").alias("a"), F.col("hub").alias("b"), F.col("size").alias("n"), "m").agg(F.count("*").alias("shared"))).distinct(), "first")
    scratch.drop("hubs")
    found = verify(scratch, first, scratch.save(_texts(items, _ends(first)), "texts"), size, num, den)
    links = scratch.save(found if tied is None else found.union(tied), "links")
    scratch.drop("texts", "runs")
    comps = scratch.save(components(scratch, links), "components")

    labelled = shared.join(comps, "id", "left").select("key", "id", "size", "pos", F.coalesce("component", "id").alias("component"))
    labelled = scratch.save(labelled, "labelled")
    split = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count("*") / BLOCK).cast("int").alias("n")).where("x <> y")
    split = scratch.save(split.select("key", "n"), "split")
    dealt = labelled.join(split, "key")
    if not prefix:
        dealt = scratch.save(dealt, "dealt")
        met_at = dealt.groupBy("id").agg(F.collect_set("key").alias("keys"))
        wanted = sketches.join(met_at, "id").groupBy("id").agg(F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
        dealt = dealt.join(wanted, "id")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("key", F.least("side", "x").alias("lo"), F.greatest("side", "x").alias("hi"), "side", "id", "size", "pos", "component", *([] if prefix else ["sketch", "keys"]))
    met = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_across(num, den, prefix, not prefix), "a bigint, b bigint, n bigint, m bigint")
    pairs = scratch.save(met.distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    scratch.drop("labelled", "split", "dealt", "sketches", "first")
    if prefix:  # count what they share among the keys
        lists = scratch.save(shared.join(_ends(pairs), "id", "left_semi").groupBy("id").agg(F.collect_set("key").alias("keys")), "lists")
        side_of = lambda end: lists.select(F.col("id").alias(end), F.col("keys").alias(f"keys_{end}"))
        both = pairs.join(side_of("a"), "a").join(side_of("b"), "b")
        pairs = enough(both.withColumn("shared", F.size(F.array_intersect("keys_a", "keys_b"))))
    second = scratch.save(pairs.select("a", "b").distinct(), "second")
    scratch.drop("shared", "pairs", "lists")
    more = scratch.save(verify(scratch, second, scratch.save(_texts(items, _ends(second)), "texts"), size, num, den), "more")
    scratch.drop("texts", "runs", "second")
    if not more.isEmpty():
        both = links.union(more)
        scratch.drop("components")
        comps = scratch.save(components(scratch, both), "components")
    scratch.drop("links", "more")
    return comps

"""Line dedup by winnowing: runs of lines that occurred before are deleted.

Each line that is not blank has a hash. A window is a line of ``alone`` words or more, or ``window`` consecutive lines
not all of which are that long; its least hash (the last, if several are equal) marks a fingerprint. Any shared run
that holds a window thus has a fingerprint in both places. Fingerprints that stand at one place only are dropped. The
positions of the others are joined where whole windows agree: each window with its first occurrence by key and line
number. Matches extend both ways, window by window, to the longest run; all lines of such runs go, but for those that
belong to the first occurrence itself, where a run repeats into its own lines.

A line is thus deleted if and only if it lies in a window that stands at an earlier place, outside of that place.
Windows are compared by 128 bits of their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _hash(data: str) -> int:
    h = xxhash.xxh3_64_intdigest(data.encode())
    return h - (1 << 64) if h >> 63 else h


def lines_of(text: str) -> tuple[list[str], list[int]]:
    """Lines, and the numbers of those that are not blank."""
    lines = text.split("\n")
    return lines, [i for i, line in enumerate(lines) if line.strip()]


def windows_of(hashes: list[int], long: list[bool], window: int) -> list[tuple[int, int, int]]:
    """(start, lines, place of the fingerprint) of each window."""
    out = [(i, 1, i) for i, alone in enumerate(long) if alone]
    for start in range(len(hashes) - window + 1):
        if all(long[start : start + window]):
            continue
        best = start
        for i in range(start + 1, start + window):
            if hashes[i] <= hashes[best]:
                best = i
        out.append((start, window, best))
    return out


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 2, alone: int = 5) -> DataFrame:
    """All columns of ``docs`` with ``text`` rid of repeated runs, and n_lines (not blank) and n_removed.

    Runs are ``window`` lines or more, or single lines of ``alone`` words or more (between ASCII white space); shorter
    single lines stay. The first occurrence, by ``key`` and line, stays whole; lines compare without white space at
    their ends. Blank lines are no part of runs and stay. A null text stays null, an empty one empty, an empty table
    empty; a very long text is one row of work and costs in proportion to its lines. Rows with the same key and text
    are one document: all are treated alike. Input columns named n_lines or n_removed are replaced. Hot lines are
    never gathered: all grouping is by aggregates, and joins on line hashes are of two shuffled tables, which Spark
    splits where they are skewed.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    docs = docs.drop("n_lines", "n_removed")
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = own.schema[0].dataType.simpleString()
    fields = ["k", "h", "fp", "lead", "start", "n", "d1", "d2"]
    types = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64())

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, scalar in enumerate(batch.column("t")):
                content = scalar.as_py()
                if not content:
                    continue
                lines, full = lines_of(content)
                bare = [lines[i].strip().encode() for i in full]
                hashes = [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in bare]
                seen = set()
                digest = _hash(content)
                for start, n, at in windows_of(hashes, [len(x.split()) >= alone for x in bare], window):
                    whole = xxhash.xxh3_128_intdigest(b"\n".join(bare[start : start + n]))
                    rows.append(row)
                    found.append((digest, hashes[at], at not in seen, start, n, (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63)))
                    seen.add(at)
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(rows, pa.int64())), *columns], names=fields)

    found = scratch.save(own.mapInArrow(fingerprints, f"k {kind}, h bigint, fp bigint, lead boolean, start int, n int, d1 bigint, d2 bigint"), "fingerprints")
    repeated = scratch.save(found.groupBy("fp").agg(F.count_if("lead").alias("places")).where("places > 1").select("fp"), "repeated")
    places = scratch.save(found.join(repeated, "fp").select("d1", "d2", "k", "h", "start", "n"), "windows")
    scratch.drop("fingerprints", "repeated")
    first = places.groupBy("d1", "d2").agg(F.min(F.struct("k", "h", "start")).alias("first"), F.count("*").alias("times")).where("times > 1")
    first = scratch.save(first.select("d1", "d2", "first"), "first")
    later = places.join(first, ["d1", "d2"]).where(F.struct("k", "h", "start") != F.col("first"))
    within = F.when(F.col("k").eqNullSafe(F.col("first.k")) & (F.col("h") == F.col("first.h")), F.col("first.start"))
    gone = later.groupBy("k", "h").agg(F.collect_set(F.struct("start", "n", within.alias("first"))).alias("__runs"))
    gone = scratch.save(gone.withColumnsRenamed({"k": "__k", "h": "__h"}), "gone")
    scratch.drop("windows", "first")

    # the digest of a text is taken again by the same code, so that rows meet their own windows only
    names = docs.columns
    digest_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", __digest bigint"

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = [_hash(t.as_py()) if t.is_valid and t.as_py() else 0 for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest, pa.int64())], names=[*names, "__digest"])

    marked = docs.mapInArrow(digests, digest_schema)
    joined = marked.join(gone.hint("shuffle_hash"), marked[key].eqNullSafe(gone["__k"]) & (marked["__digest"] == gone["__h"]), "left").select(*(marked[n] for n in names), "__runs")
    out_schema = digest_schema.removesuffix(", __digest bigint") + ", n_lines bigint, n_removed bigint"

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in batches:
            texts, counts, removed = [], [], []
            for content, runs in zip((x.as_py() for x in batch.column(at)), batch.column(len(names)).to_pylist(), strict=True):
                lines, full = lines_of(content or "")
                counts.append(len(full))
                away = set()
                for x in runs or ():
                    own_first = range(0) if x["first"] is None else range(x["first"], x["first"] + x["n"])
                    away |= {full[i] for i in range(x["start"], x["start"] + x["n"]) if i not in own_first}
                removed.append(len(away))
                texts.append("\n".join(line for i, line in enumerate(lines) if i not in away) if away else content)
            columns = list(batch.columns)[: len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed"])

    return joined.mapInArrow(delete, out_schema)

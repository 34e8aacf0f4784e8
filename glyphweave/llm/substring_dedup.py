"""Substring dedup: paragraphs that repeat, exactly or nearly, across documents, by MinHash banding.

Paragraphs are lines. Each distinct paragraph has a MinHash signature over its word shingles, cut into bands that
are tuned for recall. Paragraphs that collide in a band are compared by the exact Jaccard similarity of their
shingles; those that link make components, and of every component's occurrences all but the first are to be removed.

Whole texts of 50 words or more that are equal count as occurrences as well. In what is not removed by then, any run of
50 words that two texts share is found wherever it stands, within paragraphs or over short lines: the least of the
hashes of its runs of 25 words is its fingerprint, and runs whose fingerprint occurs in several texts are grouped by
their own hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_batches
from .linking import link_components, parity
from .shingles import mix, placed_words, shingle_sets

#: Words of a run that is found wherever it stands, and of those from which its fingerprint is chosen.
RUN, PRINT = 50, 25
_BASE = 0x9E3779B97F4A7C15


def tune(similarity: float, recall: float, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the fewest hashes with which a pair of that similarity collides with that probability.

    Among equally many, more rows a band, as those let fewer unlike pairs collide.
    """
    best: tuple[int, int, int] | None = None
    for rows in range(1, 9):
        miss = 1 - similarity**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(miss)))
        # unlike pairs (half of that similarity) that collide cost more than hashes do
        if bands <= most and (best is None or bands * (1 + 20 * (similarity / 2) ** rows) < best[0]):
            best = (bands * (1 + 20 * (similarity / 2) ** rows), bands, rows)
    return best[1], best[2]


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Keys (uint64) by set and band; no set may be empty."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(sets)
    keys = np.zeros((len(sets), bands), np.uint64)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    for b in range(bands):
        for r in range(rows):  # the shingles' hashes are random already: an odd factor orders them anew
            least = np.minimum.reduceat(flat * seeds[b * rows + r], starts)
            keys[:, b] = mix(keys[:, b] + least)
        keys[:, b] ^= seeds[b]
    return keys


def paragraphs_of(text: str, least_words: int) -> list[tuple[int, int, int, str]]:
    """(number, first code point, one after the last, content) of the paragraphs with so many words."""
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        content = line.strip()
        if len(content.split()) >= least_words:
            start = at + line.index(content)
            out.append((i, start, start + len(content), content))
        at += len(line) + 1
    return out


def _digests(text: str) -> tuple[int, int]:
    """126 bits of a text, as two integers."""
    whole = xxhash.xxh3_128_intdigest(text.encode())
    return whole & (1 << 63) - 1, whole >> 65


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words."""
    up, down = _powers(1 << max(16, len(hashes).bit_length()))
    through = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=through[1:])
    return mix((through[n:] - through[:-n]) * down[: len(hashes) + 1 - n])


@dataclass
class Runs:
    """Runs of ``RUN`` words, each within one text: ``text`` and ``word`` say where it starts, ``mark`` is its fingerprint,
    which is that of its least 25 words. Words of the batch have ``hash``, ``byte`` and ``size``; ``at`` cuts them by text."""

    hash: np.ndarray
    byte: np.ndarray
    size: np.ndarray
    at: np.ndarray
    start: np.ndarray
    text: np.ndarray
    mark: np.ndarray

    @staticmethod
    def of(data: np.ndarray, offsets: np.ndarray) -> Runs:
        hashes, byte, size = placed_words(data, offsets)
        at = np.searchsorted(byte, offsets)
        if len(hashes) < RUN:
            none = np.zeros(0, np.int64)
            return Runs(hashes, byte, size, at, none, none, none.astype(np.uint64))
        least, reach, width = _rolled(hashes, PRINT), 1, RUN - PRINT + 1
        while reach < width:
            step = min(reach, width - reach)
            least, reach = np.minimum(least[:-step], least[step:]), reach + step
        lengths = np.maximum(np.diff(at) - RUN + 1, 0)
        text = np.repeat(np.arange(len(lengths)), lengths)
        start = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + at[text]
        return Runs(hashes, byte, size, at, start, text, least[start])

    def marks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, fingerprint and line of each stretch of runs with one fingerprint; -1 where its words stand on several lines."""
        new = np.ones(len(self.start), bool)
        new[1:] = (self.mark[1:] != self.mark[:-1]) | (self.text[1:] != self.text[:-1])
        start, text, mark = self.start[new], self.text[new], self.mark[new]
        rolled = _rolled(self.hash, PRINT) if len(start) else self.hash
        place = start + (rolled[start[:, None] + np.arange(RUN - PRINT + 1)] == mark[:, None]).argmax(1) if len(start) else start
        breaks = np.flatnonzero(data == 10)
        first, last = np.searchsorted(breaks, self.byte[place]), np.searchsorted(breaks, self.byte[place + PRINT - 1])
        return text, mark.view(np.int64), np.where(first == last, first - np.searchsorted(breaks, offsets)[text], -1)

    def wholes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the runs with these numbers."""
        if not len(rows):
            return (np.zeros(0, np.int64),) * 2
        return tuple(_rolled(x, RUN)[self.start[rows]].view(np.int64) for x in (self.hash, mix(self.hash ^ np.uint64(RUN))))


def _shared_runs(scratch: Scratch, own: DataFrame, paragraphs: DataFrame, key: str) -> DataFrame:
    """Rows like those of ``paragraphs``, for runs of words that texts of several rows of ``own`` (k, t) share.

    Fingerprints in removed paragraphs and removed whole texts are left out before they are compared. A run stays in
    the first text by key, if possible one where no removed paragraph touches it. Consecutive runs with the same first
    text make one row. Rows that a paragraph's row says already are left out.
    """
    kind = own.schema[0].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in text_batches(batch.column("t")):
                text, prints, line = Runs.of(data, offsets).marks(data, offsets)
                wanted = np.unique(text)
                digests = np.zeros(end - at, np.int64)
                digests[wanted] = [_digests(x)[0] for x in batch.column("t").take(pa.array(wanted + at)).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(text + at)), pa.array(digests[text]), pa.array(prints), pa.array(line)], names=["k", "h", "fp", "line"])

    gone = paragraphs.where("removed").groupBy(F.col(key).alias("__k"))
    gone = scratch.save(gone.agg(F.collect_set(F.when(F.col("whole").isNull(), F.col("paragraph").cast("bigint"))).alias("lines"), F.collect_set("whole").alias("texts")), "gone")
    marks = own.mapInArrow(mark, f"k {kind}, h bigint, fp bigint, line bigint")
    left = marks.join(gone.hint("shuffle_hash"), marks["k"].eqNullSafe(gone["__k"]), "left")
    away = F.array_contains("lines", F.col("line")) | F.array_contains("texts", F.col("h"))
    marks = scratch.save(left.where(~F.coalesce(away, F.lit(False))).select("k", "h", "fp"), "marks")
    row = F.xxhash64("k", "h")
    repeated = scratch.save(marks.groupBy("fp").agg(F.min(row).alias("first"), F.max(row).alias("last")).where("first <> last").select("fp"), "prints")
    scratch.drop("gone")
    spans = paragraphs.groupBy(F.col(key).alias("__s")).agg(F.collect_set(F.struct("start", "stop", "removed")).alias("spans"))
    spans = scratch.save(spans, "spans")
    wanted = marks.join(repeated, "fp").groupBy(F.col("k").alias("__k"), F.col("h").alias("__h")).agg(F.collect_set("fp").alias("fps"))
    wanted = wanted.join(spans, F.col("__k").eqNullSafe(F.col("__s")), "left")
    wanted = scratch.save(wanted.select(F.xxhash64("__k").alias("r"), F.col("__h").alias("h"), "fps", "spans"), "wanted")
    scratch.drop("marks", "prints")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([_digests(x.as_py() or "")[0] for x in batch.column("t")], pa.int64())], names=["k", "t", "h"])

    texts = own.mapInArrow(digest, f"k {kind}, t string, h bigint")
    # equal rows are one; they meet where the join has dealt them already
    texts = texts.withColumn("r", F.xxhash64("k")).join(wanted.hint("shuffle_hash"), ["r", "h"])
    texts = texts.groupBy("r", "h").agg(*(F.first(c).alias(c) for c in ("k", "t", "fps", "spans")))
    fields = ["k", "h", "run", "run2", "touched", "word", "start", "stop", "line"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, spans_ = batch.column("fps"), batch.column("spans")
            for at, end, data, offsets in text_batches(batch.column("t")):
                runs = Runs.of(data, offsets)
                marks_, keep = runs.mark.view(np.int64), np.zeros(len(runs.start), bool)
                edges = np.searchsorted(runs.text, np.arange(end - at + 1))
                for i in range(end - at):
                    here = slice(edges[i], edges[i + 1])
                    keep[here] = np.isin(marks_[here], prints[at + i].values.to_numpy(zero_copy_only=False))
                rows = np.flatnonzero(keep)
                through = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                first, last, text = runs.start[rows], runs.start[rows] + RUN - 1, runs.text[rows]
                base = through[offsets[text]]
                a, b = through[runs.byte[first]] - base, through[runs.byte[last] + runs.size[last]] - base
                breaks = np.flatnonzero(data == 10)
                line = np.searchsorted(breaks, runs.byte[first]) - np.searchsorted(breaks, offsets)[text]
                touched, within = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
                edges = np.searchsorted(text, np.arange(end - at + 1))
                for i in np.unique(text).tolist():
                    here = slice(edges[i], edges[i + 1])
                    for x in spans_[at + i].as_py() or ():
                        if x["removed"]:
                            touched[here] |= (a[here] < x["stop"]) & (b[here] > x["start"])
                            within[here] |= (a[here] >= x["start"]) & (b[here] <= x["stop"])
                left_ = np.flatnonzero(~within)
                row = pa.array(text[left_] + at)
                whole = runs.wholes(rows[left_])
                columns = [*whole, touched[left_].astype(np.int32), *(v[left_].astype(np.int32) for v in (first - runs.at[text], a, b, line))]
                yield pa.RecordBatch.from_arrays([batch.column("k").take(row), batch.column("h").take(row), *map(pa.array, columns)], names=fields)

    runs = scratch.save(texts.mapInArrow(cut, f"k {kind}, h bigint, run bigint, run2 bigint, touched int, word int, start int, stop int, line int"), "runs")
    scratch.drop("wanted")
    place = F.struct("k", "h")
    first = runs.groupBy("run", "run2").agg(F.min(F.struct("touched", "k", "h")).alias("first"), F.max(place).alias("last"), F.min(place).alias("least"), F.count("*").alias("n"))
    first = scratch.save(first.where("least <> last").select("run", "run2", "n", F.col("first.k").alias("fk"), F.col("first.h").alias("fh")), "firsts")
    removed = place != F.struct(F.col("fk").alias("k"), F.col("fh").alias("h"))
    found = F.struct("word", "start", "stop", "line", "n", "fk", F.xxhash64("fk", "fh").alias("component"), removed.alias("removed"))
    lists = runs.join(first, ["run", "run2"]).groupBy("k", "h").agg(F.collect_list(found).alias("runs"))
    lists = lists.join(spans, lists["k"].eqNullSafe(spans["__s"]), "left").select("k", "runs", "spans")
    out_fields = [f for f in paragraphs.schema.fields if f.name != "whole"]
    names, out_schema = [f.name for f in out_fields], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_runs = batch.column("runs")
            flat = all_runs.flatten()
            doc = np.repeat(np.arange(len(all_runs)), np.diff(all_runs.offsets.to_numpy()))
            c = {n: flat.field(n).to_numpy(zero_copy_only=False) for n in ("word", "start", "stop", "line", "n", "component", "removed")}
            order = np.lexsort((c["word"], doc))
            doc, c = doc[order], {n: v[order] for n, v in c.items()}
            cut_ = np.ones(len(doc), bool)
            cut_[1:] = (doc[1:] != doc[:-1]) | (c["word"][1:] > c["word"][:-1] + 1) | (c["component"][1:] != c["component"][:-1]) | (c["removed"][1:] != c["removed"][:-1])
            heads = np.flatnonzero(cut_)
            tails = np.append(heads[1:], len(doc)) - 1
            most = np.maximum.reduceat(c["n"], heads) if len(heads) else c["n"]
            said = batch.column("spans").to_pylist()
            keep = []
            for j, (d, a, b, away) in enumerate(zip(doc[heads].tolist(), c["start"][heads].tolist(), c["stop"][tails].tolist(), c["removed"][heads].tolist(), strict=True)):
                if not any(p["start"] <= a and b <= p["stop"] and (p["removed"] or not away) for p in said[d] or ()):
                    keep.append(j)
            head, tail = heads[keep], tails[keep]
            columns = [
                batch.column("k").take(pa.array(doc[head])), pa.array(c["line"][head].astype(np.int32)), pa.array(c["start"][head].astype(np.int32)), pa.array(c["stop"][tail].astype(np.int32)),
                pa.array((c["word"][tail] - c["word"][head] + RUN).astype(np.int32)), pa.array(c["component"][head]), pa.array(most[keep].astype(np.int64)),
                flat.field("fk").take(pa.array(order[head])), pa.array(c["removed"][head].astype(bool)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return lists.mapInArrow(merge, out_schema)


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 25, size: int = 5, num: int = 4, den: int = 5, recall: float = 0.999) -> DataFrame:
    """Occurrences of paragraphs that repeat: one row for each, with its component and whether it is to be removed.

    Returns ``key``, paragraph (line number from 0), start and stop (code points), n_words, component_id (a number
    for all paragraphs that repeat each other), n_occurrences, first_key (the key of the occurrence that stays: the
    least by key and paragraph) and removed. Paragraphs of fewer than ``least_words`` words (white space apart) and
    such as occur once are not in the result of this step. Null and empty texts have no paragraphs. Keys may be null and may
    repeat; equal rows count as one occurrence. Similarity is at least num / den over shingles of ``size`` words.

    Equal texts of 50 words and two lines or more have a row each for the whole text, from line 0.

    Runs of 50 words or more that texts of several rows share, outside of what these rows remove, in any case of letters
    and with any white space between words, have rows of their own: paragraph is the line where they begin,
    component_id stands for the text where they come first, n_occurrences counts their most frequent 50 words.

    An empty table gives no rows; columns besides the two are left out, so names can't clash; a very long text is worked
    on as a whole, at some 100 bytes of memory a word.

    Copies of a paragraph are one item, so a passage that a third of all documents hold is met once.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = own.schema[0].dataType.simpleString()
    bands, rows = tune(num / den, recall)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, content in enumerate(batch.column("t")):
                if content.is_valid:
                    here, whole = paragraphs_of(content.as_py(), least_words), content.as_py()
                    found += [(n, a, b, len(c.split()), *_digests(c), False) for n, a, b, c in here]
                    if (n := len(whole.split())) >= RUN and "\n" in whole.strip():
                        found.append((0, 0, len(whole), n, *_digests(whole), True))
                    at += [i] * (len(found) - len(at))
            columns = [pa.array([f[j] for f in found], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(at, pa.int64())), *columns], names=["k", "paragraph", "start", "stop", "n_words", "id", "id2", "whole"])

    places = scratch.save(own.mapInArrow(cut, f"k {kind}, paragraph int, start int, stop int, n_words int, id bigint, id2 bigint, whole boolean"), "places")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, _, _ in text_batches(batch.column("t")):
                seen: dict[int, str] = {}
                for content in batch.column("t").slice(at, end - at).to_pylist():
                    for _, _, _, c in paragraphs_of(content or "", least_words):
                        seen[_digests(c)[0]] = c
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.string())], names=["id", "text"])

    items = own.select("t").mapInArrow(texts, "id bigint, text string")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, _, _ in text_batches(batch.column("t")):
                seen: dict[int, str] = {}
                for content in batch.column("t").slice(at, end - at).to_pylist():
                    for _, _, _, c in paragraphs_of(content or "", least_words):
                        seen[_digests(c)[0]] = c
                for i, j, data, offsets in text_batches(pa.array(list(seen.values()), pa.string())):
                    sets = shingle_sets(data, offsets, size)
                    keys = band_keys(sets, bands, rows).view(np.int64)
                    ids = np.array(list(seen)[i:j], np.int64)
                    sizes = np.array([len(s) for s in sets], np.int32)
                    n = len(sets)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, bands)), pa.array(np.repeat(sizes, bands)), pa.array(np.zeros(keys.size, np.int32)), pa.nulls(keys.size, pa.binary())], names=names)
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(ids), pa.array(sizes), pa.array(np.zeros(n, np.int32)), pa.array([parity(s) for s in sets], pa.binary())], names=names)

    names = ["key", "id", "size", "pos", "sketch"]
    scratch.save(own.select("t").mapInArrow(sign, "key bigint, id bigint, size int, pos int, sketch binary"), "buckets")
    comps = link_components(scratch, "buckets", items, size, num, den, False)
    # paragraphs are equal if both numbers are; should only the first be, the lesser by the second counts
    counts = places.groupBy("id").agg(F.count("*").alias("n"), F.min("id2").alias("id2"))
    named = counts.join(comps, "id", "left").where("n > 1 OR component IS NOT NULL").select("id", "id2", F.coalesce("component", "id").alias("component"))
    named = scratch.save(named, "named")
    scratch.drop("components")
    met = scratch.save(places.join(named, ["id", "id2"]).select("k", "paragraph", "start", "stop", "n_words", "component", F.when(F.col("whole"), F.col("id")).alias("whole")).distinct(), "occurrences")
    scratch.drop("places", "named")
    first = met.groupBy("component").agg(F.count("*").alias("n_occurrences"), F.min(F.struct("k", "paragraph", "start", "stop")).alias("first")).where("n_occurrences > 1")
    first = scratch.save(first, "first")
    paragraphs = met.join(first, "component").select(
        F.col("k").alias(key), "paragraph", "start", "stop", "n_words", F.col("component").alias("component_id"), "n_occurrences",
        F.col("first.k").alias("first_key"), (F.struct("k", "paragraph", "start", "stop") != F.col("first")).alias("removed"), "whole",
    )
    paragraphs = scratch.save(paragraphs, "paragraphs")
    scratch.drop("occurrences", "first")
    return paragraphs.drop("whole").unionAll(_shared_runs(scratch, own, paragraphs, key))


def remove_paragraphs(docs: DataFrame, occurrences: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, its ``text`` without what ``occurrences`` marks as removed; lines of which nothing is left go.

    Rows of ``docs`` that share a key are all cut alike; null and empty texts, and rows without a place to be removed,
    stay as they are; an empty table stays empty, and with an empty ``occurrences`` nothing changes. A very long text is
    cut in time in proportion to its lines and places. Columns of ``docs`` may have any names but __k and __gone.
    """
    gone = occurrences.where("removed").groupBy(F.col(key).alias("__k")).agg(F.collect_set(F.struct("start", "stop")).alias("__gone"))
    names, at = docs.columns, docs.columns.index(text)
    joined = docs.join(gone.hint("shuffle_hash"), docs[key].eqNullSafe(gone["__k"]), "left").select(*(docs[c] for c in names), "__gone")

    def cut(content: str, spans: list[dict]) -> str:
        gaps: list[list[int]] = []  # apart from each other, in order
        for x in sorted(spans, key=lambda x: x["start"]):
            if gaps and x["start"] <= gaps[-1][1]:
                gaps[-1][1] = max(gaps[-1][1], x["stop"])
            else:
                gaps.append([x["start"], x["stop"]])
        lines, begin, i = [], 0, 0
        for line in content.split("\n"):
            stop, parts, pos = begin + len(line), [], begin
            while i < len(gaps) and gaps[i][0] < stop:
                if gaps[i][1] > pos:
                    parts.append(content[pos : max(pos, gaps[i][0])])
                    pos = min(stop, gaps[i][1])
                if gaps[i][1] > stop:
                    break
                i += 1
            left = "".join([*parts, content[pos:stop]])
            if not parts or left.strip():
                lines.append(left)
            begin = stop + 1
        return "\n".join(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)
            columns = list(batch.columns)[: len(names)]
            columns[at] = pa.array([cut(t, spans) if t and spans else t for t, spans in both], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))

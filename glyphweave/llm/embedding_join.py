"""Embedding near-dedup: an epsilon grid order join over cosine similarity.

Vectors of length 1 whose cosine is c or more lie within epsilon = sqrt(2 - 2 c). They are rotated onto their
principal axes and sorted by the cells, epsilon wide, that they fall into on the leading axes. The sorted sequence is
cut into stretches, each with its box on the axes. A vector is sent to its own stretch and to those whose boxes lie
within epsilon of it; stretches that are provably distant never meet. Each pair of stretches that do is joined
recursively: a pair of intervals whose boxes lie farther apart than epsilon is skipped, others are halved until they
are small, then compared by a matrix product.
The product is in single precision with a margin for its error; what passes is computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components

#: Vectors of a stretch, on average; pairs of stretches are the units of work.
STRETCH = 8192
#: Vectors below which an interval is compared rather than halved.
LEAF = 512
#: Leading axes whose cells make the order, and keys sampled to cut the sequence.
AXES, SAMPLE = 5, 20_000
#: Axes of the boxes, and boxes known to all tasks at most: 128 bytes each, 8 MB. Beyond, neighbours share a box.
BOX_AXES, MOST_BOXES = 16, 1 << 16


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that hold a finite vector other than zero, and these vectors, whatever their widths.

    A list that is null, empty, or holds null or non-finite numbers is no vector.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    good, out = [], []
    for i, v in enumerate(column):
        if not v.is_valid or not len(v.values):
            continue
        x = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
        if np.isfinite(x).all() and x.any():
            good.append(i)
            out.append(x)
    return np.array(good, np.int64), out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
    """The same at once where all lists have one width and no number is null; None elsewhere."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths()
    if column.null_count or not len(column) or lengths.null_count:
        return None
    sizes = lengths.to_numpy()
    values = column.flatten()
    if values.null_count or sizes.min() != sizes.max() or not sizes[0]:
        return None
    x = values.to_numpy().astype(np.float64).reshape(len(column), -1)
    good = np.flatnonzero(np.isfinite(x).all(1) & x.any(1))
    return good, x[good]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(-1, keepdims=True)
    return x / np.sqrt((x * x).sum(-1, keepdims=True))


def _join(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, eps2: float, cosine: float, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``a`` and ``b`` (doubles of length 1) with that cosine. ``pa_``, ``pb``: places on the axes."""
    small = [x.astype(np.float32) for x in (a, b)]
    margin = np.float32(cosine - (a.shape[1] + 8) * 2.0**-22)
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i0, i1, j0, j1 = stack.pop()
        if i0 == i1 or j0 == j1 or within and j1 <= i0:
            continue
        p, q = pa_[i0:i1], pb[j0:j1]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        if (gap * gap).sum() > eps2:
            continue
        if i1 - i0 > LEAF or j1 - j0 > LEAF:
            i, j = ((i0 + i1) // 2, (j0 + j1) // 2)
            halves = [(i0, i), (i, i1)] if i1 - i0 > LEAF else [(i0, i1)]
            others = [(j0, j), (j, j1)] if j1 - j0 > LEAF else [(j0, j1)]
            stack += [(*x, *y) for x in halves for y in others]
            continue
        x, y = np.nonzero(small[0][i0:i1] @ small[1][j0:j1].T >= margin)
        x, y = x + i0, y + j0
        if within:
            x, y = x[x < y], y[x < y]
        if len(x):
            exact = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
            if exact.any():
                yield x[exact], y[exact]


def near_boxes(p: np.ndarray, low: np.ndarray, high: np.ndarray, eps2: float) -> np.ndarray:
    """By point (row) and box (column), whether the box lies so near, its distance squared, that a link may cross."""
    gap = np.zeros((len(p), len(low)), np.float32)
    for k in range(p.shape[1]):
        x = p[:, k : k + 1]
        g = np.maximum(np.maximum(low[None, :, k] - x, x - high[None, :, k]), 0)
        gap += g * g
    return gap <= np.float32(eps2) + np.float32(1e-4)


def _forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs, over 0..n-1."""
    up = list(range(n))
    out = []
    for xs, ys in pairs:
        for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
            a, b = x, y
            while up[a] != a:
                up[a] = a = up[up[a]]
            while up[b] != b:
                up[b] = b = up[up[b]]
            if a != b:
                up[a] = b
                out.append((x, y))
    return out


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9, stretch: int = STRETCH) -> DataFrame:
    """``key``, n_links, component_id and kept of every row.

    n_links counts the other rows whose cosine with this one is ``cosine`` or more, computed in double precision;
    component_id is the least key that links lead to, and kept says that it is this one. A vector that is null,
    empty, zero, or holds null or non-finite numbers links with nothing; vectors of different widths never link.
    Keys are integers; rows with equal vectors are met once and linked; rows with one key are one vertex. A row
    without a key counts as a link of others, and has no component. An empty table gives no rows; columns besides the
    two are left out, so names can't clash; vectors may be of any width. ``stretch``: vectors of a unit of work.

    Tasks return counts and a spanning forest of what they find, so that a group of thousands of near copies makes
    rows in proportion to its vectors, not its pairs.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    own = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(embedding).alias("v"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row; vectors come as bytes of doubles of length 1, others as null."""
        for batch in batches:
            flat = _flat(batch.column("v"))
            good, x = flat if flat is not None else vectors_of(batch.column("v"))
            units: list[bytes | None] = [None] * batch.num_rows
            for i, row in zip(good.tolist(), x, strict=True):
                units[i] = unit(row).astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(units, pa.binary())], names=["id", "u"])

    rows = own.mapInArrow(read, "id bigint, u binary").withColumn("h", F.when(F.col("u").isNotNull(), F.sha2("u", 256)))
    rows = scratch.save(rows, "rows")
    named = rows.where("u IS NOT NULL").groupBy("h").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    classes = scratch.save(named, "classes")
    # one row of each class: the vector's text of bytes is the same in all
    distinct = rows.where("u IS NOT NULL").select("h", "u").groupBy("h").agg(F.min("u").alias("u"))
    distinct = scratch.save(distinct.join(classes, "h").withColumn("node", F.xxhash64("h")).select("node", "n", "u"), "distinct")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for u in batch.column("u").to_pylist():
                x = np.frombuffer(u, "<f8")
                held = sums.setdefault(len(x), [0, [], None])
                held[1].append(x)
                if len(held[1]) >= 1024:
                    _add(held)
        for held in sums.values():
            _add(held)
        names = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([sums[n][0] for n in names], pa.int64()), pa.array([sums[n][2].tobytes() for n in names], pa.binary())], names=["width", "n", "m"])

    def _add(held: list) -> None:
        if held[1]:
            x = np.vstack([np.column_stack([np.ones(len(held[1])), np.array(held[1])])])
            held[0] += len(x)
            held[2] = x.T @ x if held[2] is None else held[2] + x.T @ x
            held[1] = []

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for width, n, m in zip(*(batch.column(c).to_pylist() for c in ("width", "n", "m")), strict=True):
                held = sums.setdefault(width, [0, np.zeros((width + 1) ** 2)])
                held[0] += n
                held[1] += np.frombuffer(m)
        names = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([sums[n][0] for n in names], pa.int64()), pa.array([sums[n][1].tobytes() for n in names], pa.binary())], names=["width", "n", "m"])

    # one small matrix for each width and task, summed in steps, comes to the driver
    shape = "width int, n bigint, m binary"
    parts = distinct.mapInArrow(moments, shape).repartition(8, "width", F.spark_partition_id() % 8).mapInArrow(total, shape)
    sums: dict[int, list] = {}
    for r in parts.collect():
        held = sums.setdefault(r["width"], [0, np.zeros((r["width"] + 1) ** 2)])
        held[0] += r["n"]
        held[1] += np.frombuffer(r["m"])
    axes = {}
    for width, (n, m) in sums.items():
        m = m.reshape(width + 1, width + 1)
        mean = m[0, 1:] / n
        _, basis = np.linalg.eigh(m[1:, 1:] / n - np.outer(mean, mean))
        axes[width] = np.ascontiguousarray(basis[:, ::-1][:, : min(width, BOX_AXES)])
    eps2 = 2 - 2 * cosine + 1e-9
    eps = float(np.sqrt(eps2))

    def order(x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Cells on the leading axes, first the first, and a hash that cuts even within a cell: one number."""
        cells = np.clip(np.floor(x[:, :AXES] / eps) + 32, 0, 63).astype(np.int64)
        out = np.zeros(len(x), np.int64)
        for k in range(cells.shape[1]):
            out = out << 6 | cells[:, k]
        return out << 30 | (node.view(np.uint64) >> np.uint64(34)).astype(np.int64)

    n_all = sum(n for n, _ in sums.values())

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, nodes = batch.column("u").to_pylist(), batch.column("node").to_numpy()
            widths = np.array([len(u) // 8 for u in us])
            keys, places = np.zeros(len(us), np.int64), np.zeros((len(us), BOX_AXES), np.float32)
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                x = np.array([np.frombuffer(us[i], "<f8") for i in at]) @ axes[int(w)]
                keys[at] = order(x, nodes[at])
                places[at, : x.shape[1]] = x
            lists = pa.FixedSizeListArray.from_arrays(pa.array(places.ravel()), BOX_AXES).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), batch.column("u"), pa.array(widths.astype(np.int32)), pa.array(keys), lists], names=["node", "n", "u", "width", "ord", "p"])

    shape = "node bigint, n bigint, u binary, width int, ord bigint, p array<float>"
    sorted_ = scratch.save(distinct.mapInArrow(keyed, shape), "keyed")
    scratch.drop("distinct")
    step = max(1, n_all // SAMPLE)
    sample = sorted_.where(F.pmod("node", F.lit(step)) == 0).orderBy(F.xxhash64("node")).limit(2 * SAMPLE).select("width", "ord").collect()
    cuts: dict[int, list[int]] = {}
    for width, (n, _) in sums.items():
        own_keys = sorted(r["ord"] for r in sample if r["width"] == width)
        k = -(-n // stretch)
        cuts[width] = sorted({own_keys[len(own_keys) * i // k] for i in range(1, k)}) if own_keys else []

    def stretch_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, keys = batch.column("width").to_numpy(), batch.column("ord").to_numpy()
            own_stretch = np.zeros(len(keys), np.int32)
            for w in np.unique(widths):
                own_stretch[widths == w] = np.searchsorted(cuts[int(w)], keys[widths == w], side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own_stretch)], names=[*batch.schema.names, "stretch"])

    placed = sorted_.mapInArrow(stretch_of, f"{shape}, stretch int")
    # a box for each stretch, or for each few neighbours where there are very many
    share = -(-max((len(c) + 1 for c in cuts.values()), default=1) // MOST_BOXES)
    ends = [f(F.col("p")[k]).alias(f"{f.__name__}{k}") for f in (F.min, F.max) for k in range(BOX_AXES)]
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    found_boxes = placed.groupBy("width", F.floor(F.col("stretch") / share).cast("int").alias("box")).agg(*ends).collect()
    for width in sums:
        own_boxes = sorted((r for r in found_boxes if r["width"] == width), key=lambda r: r["box"])
        low, high = (np.array([[r[f"{f}{k}"] for k in range(BOX_AXES)] for r in own_boxes], np.float32).reshape(-1, BOX_AXES) for f in ("min", "max"))
        boxes[width] = np.array([r["box"] for r in own_boxes], np.int64), low, high

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, own_stretch = batch.column("width").to_numpy(), batch.column("stretch").to_numpy()
            p = np.array(batch.column("p").flatten()).reshape(-1, BOX_AXES)
            for w in np.unique(widths).tolist():
                names, low, high = boxes[w]
                mine = np.flatnonzero(widths == w)
                step = max(1, (1 << 21) // max(1, len(names)))
                for at in range(0, len(mine), step):
                    part = mine[at : at + step]
                    row, box = np.nonzero(near_boxes(p[part], low, high, eps2))
                    other = (names[box, None] * share + np.arange(share)).ravel()
                    row = part[np.repeat(row, share)]
                    good = other <= len(cuts[w])
                    row, other = row[good], other[good].astype(np.int32)
                    i, j = np.minimum(own_stretch[row], other), np.maximum(own_stretch[row], other)
                    for a in range(0, len(row), 4096):  # few at a time, as each row carries its vector
                        b = a + 4096
                        near = batch.take(pa.array(row[a:b]))
                        yield pa.RecordBatch.from_arrays([near.column("width"), pa.array(i[a:b]), pa.array(j[a:b]), *(near.column(c) for c in ("stretch", "ord", "node", "n", "u"))], names=["width", "i", "j", "stretch", "ord", "node", "n", "u"])

    dealt = placed.mapInArrow(deal, "width int, i int, j int, stretch int, ord bigint, node bigint, n bigint, u binary")

    none = pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "links")})

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("stretch", "ascending"), ("ord", "ascending")])
        stretch, node, n = (table.column(c).to_numpy() for c in ("stretch", "node", "n"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        x = np.frombuffer(b"".join(table.column("u").to_pylist()), "<f8").reshape(len(node), -1)
        p = x @ axes[x.shape[1]]
        left, right = np.flatnonzero(stretch == i), np.flatnonzero(stretch == j)
        if not (len(left) and len(right)):
            return none
        links = np.zeros(len(node), np.int64)
        pairs = []
        for a, b in _join(x[left], x[right], p[left], p[right], eps2, cosine, i == j):
            a, b = left[a], right[b]
            np.add.at(links, a, n[b])
            np.add.at(links, b, n[a])
            pairs.append((a, b))
        edges = _forest(len(node), pairs)
        linked = np.flatnonzero(links)
        a = np.concatenate([node[linked], node[[e[0] for e in edges]] if edges else node[:0]])
        b = np.concatenate([node[linked], node[[e[1] for e in edges]] if edges else node[:0]])
        return pa.table({"a": pa.array(a), "b": pa.array(b), "links": pa.array(np.concatenate([links[linked], np.zeros(len(edges), np.int64)]))})

    found = scratch.save(dealt.groupBy("width", "i", "j").applyInArrow(join, "a bigint, b bigint, links bigint"), "found")
    counts = found.where("a = b").groupBy("a").agg(F.sum("links").alias("links"))
    # components of nodes; their least keys, and those of rows that share a key
    comps = components(scratch, found.where("a <> b").select("a", "b"))
    nodes = classes.withColumn("node", F.xxhash64("h"))
    nodes = nodes.join(comps, nodes["node"] == comps["id"], "left").select("h", "node", "n", "first", F.coalesce("component", "node").alias("component"))
    nodes = nodes.join(counts, nodes["node"] == counts["a"], "left").select("h", "component", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    nodes = scratch.save(nodes, "nodes")
    least = scratch.save(nodes.groupBy("component").agg(F.min("first").alias("least")), "least")
    nodes = scratch.save(nodes.join(least, "component").select("h", "n_links", "least"), "named")
    out = rows.select("id", "h").join(nodes, "h", "left").select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"))
    return out.withColumn("kept", F.col(key) == F.col("component_id"))

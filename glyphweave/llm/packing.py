"""Packing of tokenised documents into sequences of a fixed length.

Bounded-space online packing: each partition keeps a fixed number of open windows. A document longer than a
sequence gives whole sequences of its own first; what is left goes into the open window with the least room that
still holds it. Where none does, a new window is opened, and if that would be too many, the fullest is emitted.
Windows still open at a partition's end are leftovers: those of 32 partitions at a time are merged by chaining
their pieces and cutting at the sequence length, so that one sequence of each merge is not full.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import encoder

#: Partitions whose leftovers are merged together.
MERGE = 32
#: Sequence ids: partition and number within it; those of merges have this bit.
MERGED = 1 << 62


class _Rows:
    """Pieces to be returned, by column."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values: object) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
            self.columns = [[] for _ in self.schema]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = 2048, end_id: int = 1, windows: int = 64, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file on every executor. Every document's ids are followed by ``end_id``; a
    null or empty text is that id alone. Each row of ``docs`` is packed by itself, repeated rows and keys too. With
    ``with_ids``, the piece's ids come as little-endian unsigned 32-bit integers in ``ids``. Other columns are left
    out, so names can't clash; an empty table gives no rows; a very long text is encoded whole, as one row of work, and
    cut into pieces. Sequences not full are to be padded to ``length``.

    Tokenised once: pieces and leftovers go to one table in the shared folder. Only leftovers, at most ``windows``
    sequences a partition, are dealt anew.
    """
    own = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = own.schema[0].dataType.simpleString()
    columns = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    schema = f"`{key}` {kind}, {columns}, leftover int"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        n_sequences = 0
        rows: _Rows | None = None
        free: list[tuple[int, int]] = []  # room and number of the open windows, in order
        held: dict[int, list[tuple]] = {}

        def emit(pieces: list[tuple], leftover: int | None = None) -> None:
            nonlocal n_sequences
            at = 0
            for name, start, ids, total in pieces:
                kept = ids.astype("<u4", copy=False).tobytes() if with_ids or leftover is not None else None
                rows.add(name, start, len(ids), _crc(ids), total, part << 32 | n_sequences, at, kept, leftover)
                at += len(ids)
            n_sequences += 1

        opened = 0
        for batch in batches:
            rows = rows or _Rows(pa.schema([(key, batch.schema.field(0).type), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary()), ("leftover", pa.int32())]))
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(content.as_py() or ""), np.uint32(end_id)).astype(np.uint32, copy=False)
                whole = len(ids) // length * length
                for start in range(0, whole, length):
                    emit([(name, start, ids[start : start + length], len(ids))])
                rest = ids[whole:]
                if not len(rest):
                    continue
                best = bisect.bisect_left(free, (len(rest), -1))
                if best < len(free):
                    room, window = free.pop(best)
                else:
                    if len(free) == windows:
                        emit(held.pop(free.pop(0)[1]))
                    room, window = length, opened
                    held[window] = []
                    opened += 1
                held[window].append((name, whole, rest.copy(), len(ids)))
                if room == len(rest):
                    emit(held.pop(window))
                else:
                    bisect.insort(free, (room - len(rest), window))
            yield from rows.take()
        for _, window in free:
            emit(held.pop(window), part // MERGE)
        if rows:
            yield from rows.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come in order of their groups; a group's are chained and cut."""
        rows: _Rows | None = None
        group, at, number = None, 0, 0
        for batch in batches:
            rows = rows or _Rows(batch.schema)
            for row in batch.to_pylist():
                if row["leftover"] != group:
                    group, at, number = row["leftover"], 0, 0
                ids = np.frombuffer(row["ids"], "<u4")
                start = 0
                while start < len(ids):
                    piece = ids[start : start + length - at]
                    rows.add(row[key], row["start"] + start, len(piece), _crc(piece), row["doc_tokens"], MERGED | group << 32 | number, at, piece.tobytes() if with_ids else None, None)
                    start, at = start + len(piece), at + len(piece)
                    if at == length:
                        at, number = 0, number + 1
            yield from rows.take()

    placed = Scratch(docs.sparkSession, "packing").save(own.mapInArrow(place, schema), "pieces")
    left = placed.where(F.col("leftover").isNotNull()).repartition("leftover").sortWithinPartitions("leftover", "sequence_id", "offset")
    out = placed.where(F.col("leftover").isNull()).unionAll(left.mapInArrow(merge, schema))
    return out.drop("leftover") if with_ids else out.drop("leftover", "ids")

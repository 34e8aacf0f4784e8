"""Media columns: baseline JPEG files with their dimensions and thumbnail hashes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jpeg
from .common import CHUNK_BYTES, text_batches

#: Payload that one carrier image holds (``jpeg.shape`` takes just under 32 MiB); a longer one goes to several images, one after the other.
PART_BYTES = 16 << 20


def _schema(own: DataFrame, more: str) -> tuple[list[str], str]:
    return own.columns[:-1], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]) + ", " + more


def encode_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` and ``media``: each whole text, in UTF-8 and zero-padded to a positive multiple of 64 bytes, as JPEG.

    A null or empty text is stored as 64 zero bytes. One row for each row, repeated ones too; other columns are
    left out. No shuffle; memory is bounded by an Arrow batch and the longest text.
    """
    own = docs.select(F.col(key), F.col(text).alias("__text"))
    names, schema = _schema(own, "n_bytes bigint, media binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in text_batches(batch.column("__text")):
                payloads, cuts = [], [0]
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    padded = np.zeros(max(64, (int(b - a) + 63) // 64 * 64), np.uint8)
                    padded[: b - a] = data[a:b]
                    payloads += [padded[i : i + PART_BYTES] for i in range(0, len(padded), PART_BYTES)]
                    cuts.append(len(payloads))
                # the parts of a long text one at a time, as all at once take 60 times its bytes
                images = jpeg.carry(payloads) if len(payloads) == end - at else [jpeg.carry([p])[0] for p in payloads]
                media = [images[a] if b - a == 1 else b"".join(images[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(at, end - at) for n in names), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], names=[*names, "n_bytes", "media"])

    return own.mapInArrow(run, schema)


def split_images(media: bytes) -> list[bytes]:
    """The images of a file that holds one or more. Stuffing keeps an end marker out of coded data."""
    out = []
    while media:
        try:
            end = media.find(b"\xff\xd9", jpeg.parse(media).scan) + 2
        except (jpeg.JpegError, IndexError, struct.error):
            end = 1
        if end == 1:
            return [*out, media]
        out.append(media[:end])
        media = media[end:]
    return out or [b""]


OUTPUTS = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "width", "height", "feature", "error")


def media_features(media: DataFrame, keep: tuple[str, ...] = ("doc_id",), column: str = "media") -> DataFrame:
    """Read stored JPEGs back: dimensions, thumbnail hashes, and what a carrier holds.

    Returns ``keep``, then payload_bytes, payload_sha256, tail_crc32 (of the payload's last 64 bytes; these three
    null where the file is no carrier), media_bytes, media_sha256, width, height (of the first image), feature
    (``<width>x<height>:<average hash>:<gradient hash>``, joined by ``;`` over images) and error. A null file counts
    as empty; a file that is no baseline JPEG gets its ``error`` and null features. Repeated rows stay, an empty table
    gives no rows, very long files are read an image at a time; a name in ``keep`` that is one of these is left out.
    """
    keep = tuple(k for k in keep if k not in OUTPUTS)
    own = media.select(*keep, F.col(column).alias("__media"))
    more = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, width int, height int, feature string, error string"
    names, schema = _schema(own, more)
    added = pa.schema([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("feature", pa.string()), ("error", pa.string())])

    def features(files: list[bytes]) -> list[dict]:
        parts = [split_images(f) for f in files]
        flat = [p for f in parts for p in f]
        flat = iter(jpeg.thumbnails(flat)) if sum(map(len, flat)) < PART_BYTES else (jpeg.thumbnails([p])[0] for p in flat)
        rows = []
        for file, images in zip(files, parts, strict=True):
            row = dict.fromkeys(added.names) | {"media_bytes": len(file), "media_sha256": jpeg.digest(file)}
            found = [next(flat) for _ in images]
            if bad := next((x for x in found if isinstance(x, jpeg.JpegError)), None):
                rows.append(row | {"error": str(bad)})
                continue
            row |= {"width": found[0][0].width, "height": found[0][0].height, "feature": ";".join(f"{f.width}x{f.height}:{jpeg.hashes(t)}" for f, t in found)}
            if all(len(f.comment) == 8 for f, _ in found):
                payload = b"".join(jpeg.carried(f, t) for f, t in found)
                row |= {"payload_bytes": len(payload), "payload_sha256": jpeg.digest(payload), "tail_crc32": jpeg.tail_crc32(payload)}
            rows.append(row)
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column("__media")
            at = 0
            while at < len(stored):
                files, end, size = [], at, 0
                while end < len(stored) and (not files or size < CHUNK_BYTES):
                    files.append(stored[end].as_py() or b"")
                    size, end = size + len(files[-1]), end + 1
                own_columns = [batch.column(n).slice(at, end - at) for n in names]
                made = pa.Table.from_pylist(features(files), added).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([*own_columns, *made.columns], names=[*names, *added.names])
                at = end

    return own.mapInArrow(run, schema)

"""Exact round trips of the JPEG carrier, general baseline files, and odd inputs."""

import hashlib
import struct
import zlib

import numpy as np

from glyphweave.llm import jpeg
from glyphweave.llm.media import PART_BYTES, encode_texts, media_features


def payload(text):
    data = (text or "").encode()
    return data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))


def test_round_trip_of_texts(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows)
    rows = media_features(encode_texts(docs), keep=("doc_id", "n_bytes")).collect()
    assert len(rows) == len(edge_rows)
    expected = sorted((i or -1, len((t or "").encode()), hashlib.sha256(payload(t)).hexdigest(), zlib.crc32(payload(t)[-64:]), len(payload(t))) for i, t in edge_rows)
    assert sorted((r.doc_id or -1, r.n_bytes, r.payload_sha256, r.tail_crc32, r.payload_bytes) for r in rows) == expected
    same = [r for r in rows if r.doc_id == 4]
    assert same[0] == same[1]
    assert encode_texts(docs.limit(0)).count() == 0


def test_random_payloads():
    rng = np.random.default_rng(3)
    payloads = [rng.integers(0, 256, 64 * n, dtype=np.uint8) for n in (1, 2, 7, 9000, 5, 1)] + [np.full(6400, 255, np.uint8), np.arange(256, dtype=np.uint8)]
    for (frame, thumb), p in zip(jpeg.thumbnails(jpeg.carry(payloads)), payloads, strict=True):
        assert jpeg.carried(frame, thumb) == p.tobytes()


def test_a_text_longer_than_one_image(spark):
    texts = {1: "abcdefgh" * (PART_BYTES // 8) + "é tail", 2: "é" * (17 << 20), 3: "x" * PART_BYTES}
    made = encode_texts(spark.createDataFrame([*texts.items()], "doc_id bigint, text string").repartition(3))
    rows = {r.doc_id: r for r in media_features(made, keep=("doc_id", "n_bytes")).collect()}
    for i, t in texts.items():
        assert (rows[i].n_bytes, rows[i].payload_bytes, rows[i].payload_sha256) == (len(t.encode()), len(payload(t)), hashlib.sha256(payload(t)).hexdigest())
        assert rows[i].error is None and rows[i].feature.count(";") == (len(payload(t)) - 1) // PART_BYTES


def general_jpeg(width, height, blocks, sampling=(2, 1), quantiser=16):
    """A colour JPEG with AC terms and no restart markers, written bit by bit. ``blocks``: DC of Y blocks by MCU."""
    codes = {0: "00", 1: "010", 2: "011", 3: "100", 4: "101", 5: "1100", 6: "1101", 7: "1110", 8: "11110", 9: "111110"}
    ac = {0x00: "00", 0x01: "01", 0xF0: "10", 0x32: "110"}
    dht = b""
    for kind, table in ((0, codes), (0x10, ac)):
        counts = [sum(len(c) == n for c in table.values()) for n in range(1, 17)]
        dht += b"\xff\xc4" + struct.pack(">HB", 19 + len(table), kind) + bytes(counts) + bytes(sorted(table, key=lambda s, t=table: (len(t[s]), t[s])))
    bits, last = "", [0, 0, 0]

    def dc(part, value):
        nonlocal bits
        d, last[part] = value - last[part], value
        size = abs(d).bit_length()
        bits += codes[size] + (format(d if d > 0 else d + (1 << size) - 1, f"0{size}b") if size else "")

    for mcu in blocks:
        for y in mcu:
            dc(0, y)
            bits += ac[0x01] + "1" + ac[0xF0] + ac[0x32] + "01" + ac[0x00]
        for part in (1, 2):
            dc(part, 5 * part)
            bits += ac[0x00]
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    sof = struct.pack(">HBHHB", 17, 8, height, width, 3) + bytes([1, sampling[0] << 4 | sampling[1], 0, 2, 0x11, 0, 3, 0x11, 0])
    return b"\xff\xd8\xff\xdb" + struct.pack(">HB", 67, 0) + bytes([quantiser]) * 64 + b"\xff\xc0" + sof + dht + b"\xff\xda" + struct.pack(">HB", 12, 3) + bytes([1, 0, 2, 0, 3, 0, 0, 63, 0]) + scan + b"\xff\xd9"


def test_colour_files_with_ac_terms():
    (frame, thumb), = jpeg.thumbnails([general_jpeg(30, 8, [[10, -20], [30, 0]])])
    assert (frame.width, frame.height) == (30, 8)
    assert thumb.tolist() == [[148, 88, 188, 128]]


def test_files_that_are_no_baseline_jpeg(spark):
    good = jpeg.carry([np.zeros(64, np.uint8)])[0]
    files = [b"", None, b"GIF89a", good[:40], good[:-10], good.replace(b"\xff\xc0", b"\xff\xc2"), good]
    frame = spark.createDataFrame([(i, None if f is None else bytearray(f)) for i, f in enumerate(files)], "doc_id bigint, media binary")
    rows = {r.doc_id: r for r in media_features(frame).collect()}
    assert [bool(rows[i].error) for i in range(7)] == [True] * 6 + [False]
    assert rows[6].payload_bytes == 64 and rows[6].feature.startswith("512x8:")

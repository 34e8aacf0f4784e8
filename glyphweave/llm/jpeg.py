"""Baseline JPEG in numpy: marker parsing, Huffman decoding, DC-only luminance thumbnails, and a lossless byte carrier.

Decoding runs in lockstep: every entropy-coded segment (what lies between restart markers) of every image in a
batch advances one symbol a step, so the work of a step is a few vector operations. Only DC coefficients are kept:
an 8x8 block's DC coefficient times its quantiser over 8, plus 128, is the block's mean sample, so the DC terms of
the luminance component are the image scaled down by 8.

The carrier stores one byte in each block as a DC coefficient with quantiser 8 and no AC terms. All 64 samples of
such a block are that byte, so the DC-only thumbnail gives the bytes back exactly.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Zig-zag scan order is not needed: only coefficient 0 of each block is kept.
#: Code lengths of the carrier's DC categories 0..8; fixed values, chosen for differences of text bytes.
CARRIER_DC_LENGTHS = (4, 4, 3, 3, 3, 3, 3, 3, 4)
#: Blocks in a row of the carrier, and in each of its entropy-coded segments.
ROW = 64
#: Blocks that a side of an image may have (65,535 samples).
MOST_BLOCKS = 8191


class JpegError(ValueError):
    """Not a baseline JPEG that this decoder reads."""


def canonical(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(code, length, symbol) of a DHT segment's table, in code order."""
    out, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            if at >= len(symbols) or code >> length:
                raise JpegError("bad Huffman table")
            out.append((code, length, symbols[at]))
            code, at = code + 1, at + 1
        code <<= 1
    return out


@functools.lru_cache(maxsize=256)
def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """By the next 16 bits: length << 8 | symbol; 0 where no code fits."""
    table = np.zeros(1 << 16, np.int32)
    for code, length, symbol in canonical(counts, symbols):
        table[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return table


@dataclass(frozen=True)
class Frame:
    """Headers of one image, and where its scan lies. ``units``: for each block of an MCU, component and its tables."""

    width: int
    height: int
    sampling: tuple[tuple[int, int], ...]
    quantiser: int
    units: tuple[tuple[int, tuple[bytes, bytes], tuple[bytes, bytes]], ...]
    mcus_across: int
    mcus_down: int
    restart: int
    comment: bytes
    scan: int


def parse(data: bytes) -> Frame:
    """Read markers up to the scan."""
    if data[:2] != b"\xff\xd8":
        raise JpegError("no SOI")
    at, quant, tables = 2, {}, {}
    restart, comment, frame = 0, b"", None
    while True:
        while at < len(data) and data[at] == 0xFF and at + 1 < len(data) and data[at + 1] == 0xFF:
            at += 1
        if at + 4 > len(data) or data[at] != 0xFF:
            raise JpegError("no marker where one is due")
        marker, (size,) = data[at + 1], struct.unpack_from(">H", data, at + 2)
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC0 or marker == 0xC1:
            precision, height, width, n = struct.unpack_from(">BHHB", body)
            if precision != 8 or not height or not width:
                raise JpegError("not 8-bit, or no size")
            frame = (height, width, [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)])
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise JpegError("not baseline")
        elif marker == 0xDD:
            (restart,) = struct.unpack_from(">H", body)
        elif marker == 0xFE:
            comment = body
        elif marker == 0xDA:
            break
    if frame is None:
        raise JpegError("no frame header")
    height, width, parts = frame
    chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
    if len(chosen) != len(parts):
        raise JpegError("several scans")
    most_h, most_v = max(p[1] for p in parts), max(p[2] for p in parts)
    alone = len(parts) == 1
    sampling = ((1, 1),) if alone else tuple((p[1], p[2]) for p in parts)
    units = []
    for i, (name, _, _, _) in enumerate(parts):
        if name not in chosen:
            raise JpegError("a component is not in the scan")
        dc, ac = tables.get(chosen[name] >> 4), tables.get(0x10 | chosen[name] & 15)
        if dc is None or ac is None:
            raise JpegError("a Huffman table is missing")
        units += [(i, dc, ac)] * (sampling[i][0] * sampling[i][1])
    step = (8, 8) if alone else (8 * most_h, 8 * most_v)
    if parts[0][3] not in quant:
        raise JpegError("a quantisation table is missing")
    return Frame(width, height, sampling, quant[parts[0][3]], tuple(units), -(-width // step[0]), -(-height // step[1]), restart, comment, at)


def _segments(scan: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entropy-coded bytes without stuffing; first byte of every segment; first segment of every image."""
    follows = np.empty_like(scan)
    follows[:-1], follows[-1:] = scan[1:], 0xD9
    marks = np.flatnonzero(scan == 0xFF)
    kind = follows[marks]
    stuffed, restarts, ends = marks[kind == 0], marks[(kind & 0xF8) == 0xD0], marks[kind == 0xD9]
    keep = np.ones(len(scan), bool)
    keep[stuffed + 1] = False
    for markers in (restarts, ends):
        keep[markers] = False
        keep[np.minimum(markers + 1, len(scan) - 1)] = False
    place = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    starts = np.sort(np.concatenate([offsets[:-1], restarts + 2]))
    return scan[keep], place[np.minimum(starts, len(scan))], np.searchsorted(starts, offsets[:-1])


def _lockstep(data: np.ndarray, bits: np.ndarray, ends: np.ndarray, blocks: np.ndarray, units: tuple) -> np.ndarray:
    """DC coefficients by segment and block. ``bits``, ``ends``: first bit of each segment and the one after its last;
    ``blocks``: its number of blocks."""
    n, most = len(bits), int(blocks.max(initial=0))
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    last = len(window) - 1
    out = np.zeros((most, n), np.int16)
    parts = 1 + max(u[0] for u in units)
    order = np.argsort(-blocks, kind="stable")  # segments that end first stand last
    pos, left = bits[order].astype(np.int64), blocks[order]
    previous = np.zeros((parts, n), np.int32)

    def peek(at: np.ndarray) -> np.ndarray:
        return window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)

    for b in range(most):
        live = int(np.searchsorted(-left, -b, side="left"))
        part, dc, ac = units[b % len(units)]
        here = pos[:live]
        view = peek(here)
        code = lookup(*dc)[view >> 16]
        length, size = code >> 8, code & 255
        if (length == 0).any() or (size > 11).any():
            raise JpegError("bad DC code")
        view = peek(here + length)
        raw = (view.astype(np.int64) >> (32 - size)).astype(np.int32)
        value = np.where((raw << 1) >> size != 0, raw, raw - (1 << size) + 1)
        value[size == 0] = 0
        previous[part, :live] += value
        out[b, :live] = previous[part, :live]
        here = here + length + size
        table = lookup(*ac)
        code = table[peek(here) >> 16]
        here += code >> 8
        if (code == 0).any():
            raise JpegError("bad AC code")
        pending = np.flatnonzero(code & 255)  # no end of block yet
        if len(pending):
            k = np.ones(len(pending), np.int32)
            code = code[pending]
            while len(pending):
                run, size = (code & 255) >> 4, code & 15
                here[pending] += size
                k += run + 1
                going = (k < 64) & ((size > 0) | (run == 15))
                pending, k = pending[going], k[going]
                if len(pending):
                    code = table[peek(here[pending]) >> 16]
                    if (code == 0).any():
                        raise JpegError("bad AC code")
                    here[pending] += code >> 8
                    done = (code & 255) == 0
                    pending, k, code = pending[~done], k[~done], code[~done]
        pos[:live] = here
    if (pos > ends[order]).any():
        raise JpegError("cut short")
    back = np.empty_like(order)
    back[order] = np.arange(n)
    return out[:, back]


def thumbnails(images: list[bytes]) -> list[tuple[Frame, np.ndarray] | JpegError]:
    """Frame and DC-only luminance thumbnail (uint8, one sample a block) of each image, or why there is none."""
    out: list = [None] * len(images)
    groups: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        try:
            out[i] = parse(image)
            groups.setdefault(out[i].units, []).append(i)
        except (JpegError, IndexError, struct.error) as error:
            out[i] = error if isinstance(error, JpegError) else JpegError("cut short")
    for units, members in groups.items():
        try:
            for i, thumb in zip(members, _decode([images[i] for i in members], [out[i] for i in members], units), strict=True):
                out[i] = (out[i], thumb)
        except JpegError as error:
            if len(members) == 1:
                out[members[0]] = error
            else:  # one bad image must not take the others with it
                for i in members:
                    out[i] = thumbnails([images[i]])[0]
    return out


def _decode(images: list[bytes], frames: list[Frame], units: tuple) -> list[np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(x) - f.scan for x, f in zip(images, frames, strict=True)])]).astype(np.int64)
    scan = np.frombuffer(b"".join([x[f.scan :] for x, f in zip(images, frames, strict=True)]), np.uint8)
    data, starts, first = _segments(scan, offsets)
    counts = np.diff(np.append(first, len(starts)))
    mcus = np.array([f.mcus_across * f.mcus_down for f in frames])
    each = np.array([f.restart for f in frames])
    each = np.where(each == 0, mcus, each)
    if (-(-mcus // each) != counts).any():
        raise JpegError("segments are missing")
    within = np.arange(len(starts)) - np.repeat(first, counts)
    blocks = np.minimum(np.repeat(each, counts), np.repeat(mcus, counts) - within * np.repeat(each, counts)) * len(units)
    dc = _lockstep(data, starts * 8, np.append(starts[1:], len(data)) * 8, blocks, units)
    own = [j for j, u in enumerate(units) if u[0] == 0]
    result = []
    for f, at, n, mcu in zip(frames, first, counts, mcus, strict=True):
        cells = dc[:, at : at + n].T.reshape(-1)
        if n > 1:  # all but the last segment are full
            per = f.restart * len(units)
            cells = dc[:per, at : at + n].T.reshape(-1)
        cells = cells[: mcu * len(units)].reshape(f.mcus_down, f.mcus_across, len(units))[:, :, own]
        h, v = f.sampling[0]
        grid = cells.reshape(f.mcus_down, f.mcus_across, v, h).transpose(0, 2, 1, 3).reshape(f.mcus_down * v, f.mcus_across * h)
        grid = grid[: -(-f.height // 8), : -(-f.width // 8)]
        result.append(np.clip((grid.astype(np.int32) * f.quantiser + 4 >> 3) + 128, 0, 255).astype(np.uint8))
    return result


def hashes(thumb: np.ndarray) -> str:
    """Average hash and gradient hash (64 bits each, hex) of a thumbnail, scaled to 8 by 9 cells."""

    def cells(size: int, n: int) -> np.ndarray:
        return np.arange(n) * size // n

    h, w = thumb.shape
    rows, columns = cells(h, 8), cells(w, 9)
    if h < 8 or w < 9:
        small = thumb[np.ix_(rows, columns)].astype(np.int64)
    else:
        sums = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), rows, 0), columns, 1)
        small = sums * 256 // np.outer(np.diff(np.append(rows, h)), np.diff(np.append(columns, w)))
    average = small[:, :8] * 64 > small[:, :8].sum()
    gradient = small[:, 1:] > small[:, :-1]
    return f"{np.packbits(average).tobytes().hex()}:{np.packbits(gradient).tobytes().hex()}"


@functools.lru_cache(maxsize=1)
def _carrier_tables() -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """DHT segments, and by difference + 255 the bits of a block (DC code, amplitude, end of block) and their number."""
    counts = bytearray(16)
    by_length = sorted(range(9), key=lambda c: (CARRIER_DC_LENGTHS[c], c))
    for c in by_length:
        counts[CARRIER_DC_LENGTHS[c] - 1] += 1
    codes = {symbol: (code, length) for code, length, symbol in canonical(bytes(counts), bytes(by_length))}
    bits, lengths = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, length = codes[size]
        amplitude = d if d >= 0 else d + (1 << size) - 1
        bits[d + 255], lengths[d + 255] = (code << size | amplitude) << 1, length + size + 1  # end of block is one 0 bit
    ac = bytes([1] + [0] * 15)
    dht = lambda kind, c, s: b"\xff\xc4" + struct.pack(">HB", 3 + len(c) + len(s), kind) + c + s
    return dht(0, bytes(counts), bytes(by_length)), dht(0x10, ac, b"\x00"), bits, lengths


def shape(payload: int) -> tuple[int, int]:
    """Blocks across and down for so many bytes: rows of 64, wider by powers of two where there would be too many."""
    across = ROW
    while -(-payload // across) > MOST_BLOCKS:
        across *= 2
    if across > MOST_BLOCKS:
        raise JpegError("payload is too long for one image")
    return across, -(-payload // across)


def carry(payloads: list[np.ndarray]) -> list[bytes]:
    """Each payload (uint8, a positive multiple of 64 bytes) as a JPEG whose thumbnail starts with these bytes."""
    dc_table, ac_table, code_bits, code_lengths = _carrier_tables()
    shapes = [shape(len(p)) for p in payloads]
    rows = np.array([a * d // ROW for a, d in shapes])
    flat = np.zeros(int(rows.sum()) * ROW, np.uint8)
    at = 0
    for p, n in zip(payloads, rows, strict=True):
        flat[at : at + len(p)] = p
        at += int(n) * ROW
    level = flat.reshape(-1, ROW).astype(np.int16)
    d = level.copy()
    d[:, 0] -= 128
    d[:, 1:] -= level[:, :-1]
    d += 255
    bits, lengths = code_bits[d].reshape(-1, ROW // 4, 4), code_lengths[d].reshape(-1, ROW // 4, 4)
    word, size = bits[:, :, 0], lengths[:, :, 0]
    for j in range(1, 4):  # four blocks have 56 bits at most
        word, size = word << lengths[:, :, j].astype(np.uint64) | bits[:, :, j], size + lengths[:, :, j]
    ends = np.cumsum(size, axis=1)
    n_bytes = (ends[:, -1] + 7) // 8
    base = np.concatenate([[0], np.cumsum(n_bytes)])
    buffer = np.zeros(int(base[-1]) + 8, np.uint8)
    for j in range(ROW // 4):
        bit = base[:-1] * 8 + ends[:, j] - size[:, j]
        shift = 64 - (bit & 7) - size[:, j]
        spread = np.ascontiguousarray((word[:, j] << shift.astype(np.uint64)).astype(">u8")).view(np.uint8).reshape(-1, 8)
        byte = bit >> 3
        for k in range(8):
            buffer[byte + k] |= spread[:, k]
    pad = n_bytes * 8 - ends[:, -1]
    buffer[base[1:] - 1] |= ((1 << pad) - 1).astype(np.uint8)
    buffer = buffer[: base[-1]]
    # stuffing after 0xFF, and two bytes for the marker that ends each segment
    width = 1 + (buffer == 0xFF).astype(np.int64)
    place = np.concatenate([[0], np.cumsum(width)])
    segment_end = place[base[1:]] + 2 * np.arange(1, len(base))
    shift = np.repeat(2 * np.arange(len(n_bytes)), n_bytes)
    out = np.zeros(int(segment_end[-1]), np.uint8)
    out[place[:-1] + shift] = buffer
    first = np.concatenate([[0], np.cumsum(rows)])
    out[segment_end - 2] = 0xFF
    out[segment_end - 1] = 0xD0 | (np.arange(len(n_bytes)) - np.repeat(first[:-1], rows)) % 8
    out[segment_end[first[1:] - 1] - 1] = 0xD9
    edges = np.concatenate([[0], segment_end[first[1:] - 1]])
    stream = out.tobytes()
    quant = b"\xff\xdb" + struct.pack(">HB", 67, 0) + b"\x08" * 64
    result = []
    for i, ((across, down), p) in enumerate(zip(shapes, payloads, strict=True)):
        head = b"\xff\xd8\xff\xfe" + struct.pack(">HQ", 10, len(p)) + quant + b"\xff\xc0" + struct.pack(">HBHHB3B", 11, 8, down * 8, across * 8, 1, 1, 0x11, 0)
        head += dc_table + ac_table + b"\xff\xdd" + struct.pack(">HH", 4, ROW) + b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0, 0, 63, 0)
        result.append(head + stream[edges[i] : edges[i + 1]])
    return result


def carried(frame: Frame, thumb: np.ndarray) -> bytes:
    """The payload of a carrier."""
    if len(frame.comment) != 8:
        raise JpegError("not a carrier")
    (n,) = struct.unpack(">Q", frame.comment)
    return thumb.tobytes()[:n]


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tail_crc32(data: bytes) -> int:
    return zlib.crc32(data[-64:])

"""Hashed word shingles of whole batches of texts, in numpy.

Words are what stands between ASCII white space, with A-Z in lower case. A word's hash mixes its bytes, eight at a
time; shingle hashes combine those of their words. All are 64 bits.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash

_PIECE = 2 << 20
#: Bytes of a word up to which words are hashed together.
_LONG = 64
#: Masks that keep so many of eight bytes.
_TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SALTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2545F4914F6CDD1D], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Each byte with A-Z in lower case; whether it is white space."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return lower, space


def _word_hashes(data: np.ndarray, starts_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and bytes of each word; ``starts_row`` marks bytes at which a text starts.

    Words are taken eight bytes at a time, all words at once; each step mixes what was before with the next bytes
    by a bijection that is not linear. Words beyond ``_LONG`` bytes are hashed one by one.
    """
    lower, space = _letters()
    blank = space[data]
    before = np.empty_like(blank)
    before[:1] = True
    before[1:] = blank[:-1]
    first = np.flatnonzero(~blank & (before | starts_row))
    if not len(first):
        return np.zeros(0, np.uint64), first, first
    after = np.empty_like(blank)
    after[-1:] = True
    after[:-1] = blank[1:] | starts_row[1:]
    size = np.flatnonzero(~blank & after) + 1 - first
    low = np.zeros(len(data) + 8, np.uint8)
    low[: len(data)] = lower[data]
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), buffer=low.data, strides=(1,))
    out = mix(size.astype(np.uint64))
    todo = np.arange(len(first))
    for at in range(0, _LONG, 8):
        todo = todo[size[todo] > at] if at else todo
        if not len(todo):
            break
        left = np.minimum(size[todo] - at, 8)
        lane = eight[first[todo] + at] & _TAILS[left]
        out[todo] = mix(out[todo] ^ lane) + _SALTS[at >> 3 & 7]
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(low[first[i] : first[i] + size[i]].tobytes())
    return out, first, size


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, and offsets into them by text."""
    hashes, firsts, _ = placed_words(data, offsets)
    return hashes, np.searchsorted(firsts, offsets)


def placed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and bytes of all words of a batch."""
    marks = np.zeros(len(data) + 1, bool)
    marks[offsets[:-1]] = True
    marks = marks[:-1]
    hashes, firsts, sizes = [], [], []
    at = 0
    space = _letters()[1]
    while at < len(data):
        end = min(at + _PIECE, len(data))
        if end < len(data):  # cut where no word is cut
            ends = np.flatnonzero(space[data[at:end]] | marks[at:end])
            if len(ends) and ends[-1]:
                end = at + int(ends[-1])
            else:
                rest = np.flatnonzero(space[data[end:]] | marks[end:])
                end = end + int(rest[0]) if len(rest) else len(data)
        h, f, n = _word_hashes(data[at:end], marks[at:end])
        hashes.append(h)
        firsts.append(f + at)
        sizes.append(n)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(sizes)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text: its runs of ``size`` words, or all its words if fewer."""
    hashes, at = words(data, offsets)
    total = len(hashes)
    rolled = np.zeros(max(0, total - size + 1), np.uint64)
    for j in range(size):
        rolled += hashes[j : j + len(rolled)] * _SALTS[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(rolled[a : b - size + 1])
            keep = np.empty(len(s), bool)
            keep[:1] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(mix((hashes[a:b] * _SALTS[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    a, b = mix(s).sum(dtype=np.uint64), mix(s ^ _SALTS[7]).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))

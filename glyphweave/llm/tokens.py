"""Token ids of a byte-level BPE tokenizer file, by the faster of two public libraries that agree on it.

The file is one of ``tokenizers``. Where its vocabulary is ordered by its merges and it cuts words by the usual
byte-level pattern, ``tiktoken`` gives the same ids about seven times faster (the tests compare both on every code
point); any other file is run by ``tokenizers`` itself, and so is a text that ``tiktoken`` cannot cut (its pattern
gives up on about a million white-space characters in a row).
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The byte-level pattern; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """Byte-level tokenizers write each byte as one printable character: itself, or the next free one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _fast(path: str) -> Callable[[str], np.ndarray] | None:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        return None
    if any(t.get(k) for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
        return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    base = len(ranks) - len(model["merges"])
    merged = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    if any(model["vocab"].get(a + b) != base + i for i, (a, b) in enumerate(merged)):
        return None
    try:
        import tiktoken
    except ImportError:
        return None
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


@functools.lru_cache(maxsize=4)
def _plain(path: str) -> Callable[[str], np.ndarray]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function from text to ids (uint32), without added special tokens; one for each process and file."""
    fast = _fast(path)
    if not fast:
        return _plain(path)

    def encode(text: str) -> np.ndarray:
        try:
            return fast(text)
        except ValueError:  # the stack of its regular expressions is full
            return _plain(path)(text)

    return encode


def count_tokens(text: Column, path: str) -> Column:
    """How many ids a text has; 0 of a null one. Texts are encoded whole, one Arrow batch at a time."""

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        encode = encoder(path)
        return pa.array([len(encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())

    return counted(text)

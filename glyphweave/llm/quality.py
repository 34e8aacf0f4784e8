"""Quality classifier by co-training of two views of a document.

One view is the text's content (characters and words), the other its page metadata (language, source, sizes, the
layout of its lines). Each has a logistic classifier. They start from labelled documents; in every round, each
labels those documents of the whole corpus that it is surest of, and the other learns from these as well. Scores
of both are calibrated on labelled documents that neither learned from, and combined there into the final score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_batches

TEXT_FEATURES = ("upper", "digit", "mark", "symbol", "space", "wide", "repeated_words", "top_word", "next_same", "word_length", "one_letter", "stops", "marks_per_word", "repeated_pairs")
META_FEATURES = ("log_chars", "log_lines", "log_line_mean", "log_line_max", "line_spread", "bytes_per_char", "known_lang", "known_source")
#: Characters counted as symbols rather than marks of a sentence.
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 upper, 2 digit, 3 mark, 4 symbol, 5 space, 6 first byte of a wide character."""
    c = np.zeros(256, np.uint8)
    c[65:91] = 1
    c[48:58] = 2
    for b in range(33, 127):
        if not chr(b).isalnum():
            c[b] = 4 if b in SYMBOLS else 3
    c[[32, 9, 10, 11, 12, 13]] = 5
    c[0xC0:] = 6
    return c


_CLASSES = _byte_classes()


def text_features(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> np.ndarray:
    """One row of TEXT_FEATURES for each text; all 0 for an empty one."""
    kinds = _CLASSES[data]
    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((len(texts), len(TEXT_FEATURES)))
    for k in range(1, 7):
        through = np.concatenate([[0], np.cumsum(kinds == k)])
        out[:, k - 1] = (through[offsets[1:]] - through[offsets[:-1]]) / size
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        n = len(words)
        counts = Counter(words)
        letters = sum(map(len, words))
        pairs = len(set(zip(words, words[1:], strict=False)))
        out[i, 6:] = (1 - len(counts) / n, (max(counts.values()) - 1) / n, sum(map(eq, words, words[1:])) / n, letters / n, sum(v for w, v in counts.items() if len(w) == 1) / n, text.count(".") / n, out[i, 2] * size[i] / n, 1 - pairs / max(1, n - 1))
    return out


def meta_features(texts: list[str], langs: list, sources: list, known: tuple[dict, dict]) -> np.ndarray:
    """One row of META_FEATURES for each document. ``known``: by language and by source, the labelled documents' log odds."""
    out = np.zeros((len(texts), len(META_FEATURES)))
    for i, (text, lang, source) in enumerate(zip(texts, langs, sources, strict=True)):
        lengths = [len(x) for x in text.split("\n")]
        mean = sum(lengths) / len(lengths)
        spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths)) / (mean + 1)
        out[i] = (math.log1p(len(text)), math.log(len(lengths)), math.log1p(mean), math.log1p(max(lengths)), spread, len(text.encode()) / max(1, len(text)), known[0].get(lang, 0.0), known[1].get(source, 0.0))
    return out


def _spread_out(x: np.ndarray) -> np.ndarray:
    """Features, their square roots of magnitude, and squares: what a linear score needs for thresholds both ways."""
    return np.hstack([x, np.sqrt(np.abs(x)), x * x])


@dataclass
class Logistic:
    """L2-regularised logistic regression by Newton steps on standardised columns."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
        mean, scale = x.mean(0), x.std(0)
        scale[scale < 1e-9] = 1.0
        z = np.hstack([np.ones((len(x), 1)), np.clip((x - mean) / scale, -8, 8)])
        w = np.zeros(z.shape[1])
        penalty = np.full(len(w), ridge)
        penalty[0] = 1e-6
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        each = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))  # both classes weigh the same
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
            slope = z.T @ (each * (p - y)) + penalty * w
            curve = (z * (each * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
            step = np.linalg.solve(curve, slope)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-6:
                break
        return Logistic(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weight[0] + np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight[1:]


@dataclass
class QualityModel:
    """Two calibrated views and their combination. ``constant``: the score of all where labels can't teach anything."""

    views: tuple[Logistic, Logistic]
    platt: tuple[Logistic, Logistic]
    both: Logistic
    known: tuple[dict, dict]
    cut: float = 0.5
    constant: float | None = None

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by content, by metadata, and by both."""
        if self.constant is not None:
            return (np.full(len(a), self.constant),) * 3
        logits = np.column_stack([p.logit(v.logit(_spread_out(x))[:, None]) for v, p, x in zip(self.views, self.platt, (a, b), strict=True)])
        squash = lambda t: 1 / (1 + np.exp(-np.clip(t, -35, 35)))
        return squash(logits[:, 0]), squash(logits[:, 1]), squash(self.both.logit(logits))


def _featured(docs: DataFrame, known: tuple[dict, dict], key: str, text: str, lang: str, source: str) -> DataFrame:
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), F.col(source).cast("string").alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in text_batches(batch.column("t")):
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column("t").to_pylist()]
                a = text_features(data, offsets, texts)
                b = meta_features(texts, part.column("l").to_pylist(), part.column("s").to_pylist(), known)
                digests = pa.array([xxhash.xxh3_64_intdigest(t.encode()) >> 1 for t in texts], pa.int64())
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), x.shape[1]).cast(pa.list_(pa.float32())) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([part.column("k"), digests, *lists], names=["k", "h", "a", "b"])

    return own.mapInArrow(run, f"k {own.schema[0].dataType.simpleString()}, h bigint, a array<float>, b array<float>")


def _logit_column(values: str, model: Logistic, n: int) -> Column:
    """``model.logit`` over the spread-out features of an array column, in the JVM."""
    raw = [F.col(values)[i].cast("double") for i in range(n)]
    columns = [*raw, *(F.sqrt(F.abs(c)) for c in raw), *(c * c for c in raw)]
    out = F.lit(float(model.weight[0]))
    for c, m, s, w in zip(columns, model.mean, model.scale, model.weight[1:], strict=True):
        out = out + F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (c - F.lit(float(m))) / F.lit(float(s)))) * F.lit(float(w))
    return out


def _log_odds(values: list, y: np.ndarray) -> dict:
    """Smoothed log odds of good quality by value, against those of all."""
    good, bad = Counter(), Counter()
    for v, q in zip(values, y, strict=True):
        (good if q > 0.5 else bad)[v] += 1
    base = math.log((sum(good.values()) + 1) / (sum(bad.values()) + 1))
    return {v: math.log((good[v] + 5 * math.exp(base)) / (bad[v] + 5)) - base for v in {*good, *bad}}


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", quality: str = "quality", most_labels: int = 20_000, rounds: int = 3, pseudo: int = 400, sure: float = 0.97, cost: float = 3.0) -> QualityModel:
    """Fit on at most ``most_labels`` labelled documents, chosen by hash, and on pseudo-labels from all documents.

    In each of ``rounds``, either view picks, over the whole corpus, the documents of distinct texts that it is surest
    of, beyond ``sure``: ``pseudo`` in the first round, twice as many in the second and so on, as many of each class as
    the labels have in proportion; these teach the other view. A fifth of the labelled documents calibrates the views
    and their combination. A document is accepted where accepting it is expected to cost no more than rejecting it,
    if rejecting a good one costs ``cost`` times as much as accepting a bad one: from a score of 1 / (1 + cost).

    Labels that are null or of one class only, an empty table among them, give a model that accepts all. Documents
    labelled more than once count once for each label; very long texts are read whole, a batch at a time.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    wanted = labels.where(F.col(quality).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(quality).cast("double").alias("y"))
    order = F.xxhash64("__k", "y")
    chosen = scratch.save(wanted.orderBy(order, "__k", "y").limit(most_labels), "labels")
    meta = docs.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l"), F.col(source).cast("string").alias("s"))
    tags = [(r["l"], r["s"], r["y"]) for r in meta.join(chosen, F.col("k") == F.col("__k")).select("l", "s", "y", "k").limit(2 * most_labels).collect()]
    y = np.array([t[2] for t in tags]) if tags else np.zeros(0)
    empty = Logistic()
    if not len(y) or y.min() > 0.5 or y.max() <= 0.5:
        return QualityModel((empty, empty), (empty, empty), empty, ({}, {}), constant=1.0)
    known = (_log_odds([t[0] for t in tags], y), _log_odds([t[1] for t in tags], y))
    features = scratch.save(_featured(docs, known, key, text, lang, source), "features")
    rows = features.join(chosen, F.col("k") == F.col("__k")).select("h", "a", "b", "y").limit(2 * most_labels).collect()
    rows.sort(key=lambda r: (r["h"], r["y"]))
    a, b = (_spread_out(np.array([r[c] for r in rows], float)) for c in "ab")
    y = np.array([r["y"] for r in rows]) > 0.5
    aside = np.array([r["h"] % 5 == 0 for r in rows])
    if len({*y[aside]}) < 2 or len({*y[~aside]}) < 2:
        aside = np.zeros(len(y), bool)
    learn, held = ~aside, aside if aside.any() else ~aside
    good_share = float(y[learn].mean())
    taught = [(a[learn], y[learn].astype(float)), (b[learn], y[learn].astype(float))]
    views = [Logistic.fit(*taught[0]), Logistic.fit(*taught[1])]
    edge = math.log(sure / (1 - sure))
    for r in range(rounds):
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for view, column, other, n in ((views[0], "a", "b", len(TEXT_FEATURES)), (views[1], "b", "a", len(META_FEATURES))):
            xs, ys = [], []
            for label, share, test in ((1.0, good_share, lambda s: s >= edge), (0.0, 1 - good_share, lambda s: s <= -edge)):
                score = _logit_column(column, view, n)
                firm = features.where(test(score)).select("h", F.col(other).alias("x"), F.abs(score).alias("s"))
                once = firm.groupBy("h").agg(F.min("x").alias("x"), F.max("s").alias("s"))  # copies of a text teach once
                picked = once.orderBy(F.desc("s"), "h").limit(max(1, round(pseudo * share * (r + 1)))).collect()
                xs += [p["x"] for p in picked]
                ys += [label] * len(picked)
            found.append((np.array(xs, float), np.array(ys)))
        for i, (x, label) in enumerate((found[1], found[0])):
            if len(label):
                taught[i] = (np.vstack([taught[i][0], _spread_out(x)]), np.concatenate([taught[i][1], label]))
        views = [Logistic.fit(*taught[0]), Logistic.fit(*taught[1])]
    raw = [v.logit(x[held])[:, None] for v, x in zip(views, (a, b), strict=True)]
    truth = y[held].astype(float)
    platt = [Logistic.fit(x, truth, ridge=0.1) for x in raw]
    both = Logistic.fit(np.column_stack([p.logit(x) for p, x in zip(platt, raw, strict=True)]), truth, ridge=0.1)
    return QualityModel(tuple(views), tuple(platt), both, known, 1 / (1 + cost))


def classify(docs: DataFrame, model: QualityModel, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All columns of ``docs``, and p_text, p_meta, score (probabilities of good quality) and accepted.

    A null text counts as empty; null languages and sources have no say; repeated rows get the same scores; an empty
    table stays empty; a very long text is one row of work. Input columns with one of the four names are replaced. One
    pass without shuffle.
    """
    docs = docs.drop("p_text", "p_meta", "score", "accepted")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", p_text double, p_meta double, score double, accepted boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in text_batches(batch.column(names.index(text))):
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column(names.index(text)).to_pylist()]
                langs, sources = ([None if v is None else str(v) for v in part.column(names.index(c)).to_pylist()] for c in (lang, source))
                a = text_features(data, offsets, texts).astype(np.float32).astype(float)
                b = meta_features(texts, langs, sources, model.known).astype(np.float32).astype(float)
                p, q, s = model.scores(a, b)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array(q), pa.array(s), pa.array(s >= model.cut)], names=[*names, "p_text", "p_meta", "score", "accepted"])

    return docs.mapInArrow(run, schema)

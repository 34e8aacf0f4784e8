"""The contextual character transducer ("K" rules) over whole batches of segments, in numpy.

The same rules as ``transducer``, whose windows shuffle and sort characters; here the characters of an Arrow batch of
segments are one array, each rule a few vector operations on it, and nothing is shuffled. The two are independent:
each checks the other. This is the plan to use at scale; the windows are for plans that stay in SQL.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import codepoint_label, unicode_escape
from ..functions.unicode import ARABIC_BLOCKS, ARABIC_ELSEWHERE
from . import rules
from .segments import KEYS
from .transducer import ALEF, INVERTED_DAMMA, MADDAH, SMALL_MADDAH

#: Characters of segments that are worked on at once, unless one segment has more.
CHUNK = 1 << 20
#: Kinds of stretches that a task keeps before it passes them on.
MOST_SEEN = 200_000
#: Events whose hashes a task keeps before it passes them on.
MOST_EVENTS = 3_000_000
SPACES = frozenset("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　")

_WHITE = re.escape("".join(sorted(SPACES)))
HEAD = re.compile(f"[{_WHITE}]*[^{_WHITE}]*[^ ]*")

RULES = (
    "", "E5_stop_sequence", "E6_decorative_bismillah", "E2_Farsi_Yeh", "E1_Dammatan_anomaly", "C3_Muqattaat_strip_Maddah",
    "C2_long_vowel_strip_Maddah", "C5_existing_Alef_strip_Maddah", "C5_nominal_Maddah_to_Alef", "C1_Inverted_Damma_plus_Alef",
    "C1_Inverted_Damma_nominal_Alef", "C6_small_high_Maddah_to_Alef", "consumed",
)
GONE = (1, 2, 5, 6, 7, 12)
PLAIN = {k: v for k, v in rules.SIMPLE.items() if k not in rules.OVERRIDES}
_FIRST_PLAIN = len(RULES)
ALL_RULES = (*RULES, *(f"simple_U+{k:04X}_to_U+{v:04X}" for k, v in PLAIN.items()))


@functools.lru_cache(maxsize=1)
def _classes() -> dict[str, np.ndarray]:
    """By code point: mark, space, number, letter (Arabic), deleted, separator."""
    category = [unicodedata.category(chr(c)) for c in range(0x110000)]
    mark = np.array([c[0] == "M" for c in category])
    number = np.array([c[0] == "N" for c in category])
    arabic = np.zeros(0x110000, bool)
    for low, high in (*ARABIC_BLOCKS, *ARABIC_ELSEWHERE):
        arabic[low : high + 1] = True
    letter = arabic & np.array([c in ("Lo", "Lm") for c in category])
    space = np.zeros(0x110000, bool)
    space[[ord(c) for c in SPACES]] = True
    deleted, separator = number.copy(), number.copy()
    deleted[list(rules.EFFECTIVE_DELETE)] = True
    separator[list(rules.SEPARATORS)] = True
    return {"mark": mark, "space": space, "number": number, "letter": letter, "deleted": deleted, "separator": separator}


@dataclass
class Lineage:
    """Columns by source character; ``segment`` numbers the batch's segments. -1 stands for none in out and out_id."""

    cp: np.ndarray
    segment: np.ndarray
    pos: np.ndarray
    rule: np.ndarray
    out: np.ndarray
    introduced: np.ndarray
    out_id: np.ndarray
    merged: np.ndarray
    deleted: np.ndarray
    nbsp: np.ndarray
    kept: np.ndarray
    repaired: np.ndarray
    stop: np.ndarray
    unresolved: np.ndarray


def _initial_form(text: str) -> tuple[int, int]:
    """Bounds of the first word if it is an initial form, else (-1, -1)."""
    start = 0
    while start < len(text) and text[start] in SPACES:
        start += 1
    end = start
    while end < len(text) and text[end] not in SPACES:
        end += 1
    bare = "".join(c for c in text[start:end] if unicodedata.category(c)[0] != "M")
    return (start, end) if bare in rules.INITIAL_FORMS else (-1, -1)


def _decorated(letters: np.ndarray, cp: np.ndarray, at: int) -> bool:
    """Whether the ligature at row ``at`` repeats an opening formula that its segment spells out: whether the formula
    stands in the segment's ``letters`` (rows that are neither marks nor white space) once the ligature is left out."""
    rest = cp[letters[letters != at]].astype("<u4")
    for formula in rules.BISMILLAH_SKELETONS:
        wanted = np.frombuffer(formula.encode("utf-32-le"), "<u4")
        if len(rest) >= len(wanted) and (np.lib.stride_tricks.sliding_window_view(rest, len(wanted)) == wanted).all(1).any():
            return True
    return False


def _last(where: np.ndarray, strict: bool = False) -> np.ndarray:
    """By row, the last row up to it (before it if ``strict``) at which ``where`` holds; -1 if none."""
    at = np.maximum.accumulate(np.where(where, np.arange(len(where)), -1)) if len(where) else np.zeros(0, np.int64)
    return np.concatenate([[-1], at[:-1]]) if strict and len(at) else at


def _next(where: np.ndarray, strict: bool = False) -> np.ndarray:
    n = len(where)
    back = _last(where[::-1], strict)[::-1]
    return np.where(back < 0, n, n - 1 - back)


def _any_of_next(flags: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each place, whether any of the next ``length`` flags is set."""
    through = np.concatenate([[0], np.cumsum(flags)])
    return through[at + length] > through[at]


def transduce_batch(texts: list[str], starts: list[bool], positive: np.ndarray | None = None, lexical: np.ndarray | None = None) -> Lineage:
    """All texts at once. ``starts``: whether a text may open with an initial form. ``positive``, ``lexical``: by
    character, whether its run says that a stop sequence is a sign, or that it is a word; without them all are words.

    A stop sequence is proven, and goes, if any of its characters is positive; it is a word if all are lexical, and
    unresolved otherwise.
    """
    k = _classes()
    lengths = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    segment = np.repeat(np.arange(len(texts)), lengths)
    n = len(cp)
    begin = first[segment] if n else np.zeros(0, np.int64)
    pos = np.arange(n) - begin

    def shifted(by: int) -> np.ndarray:
        """Code point so many places on within the segment; 0 outside."""
        at = np.arange(n) + by
        good = (at >= 0) & (at < n)
        inside = good & (segment[np.clip(at, 0, max(n - 1, 0))] == segment) if n else good
        return np.where(inside, cp[np.clip(at, 0, max(n - 1, 0))], 0) if n else cp

    after, after2, before = shifted(1), shifted(2), shifted(-1)
    mark = k["mark"][cp]
    base_at = _last(~mark, strict=True)
    base = np.where((base_at >= begin) & (base_at >= 0), cp[np.maximum(base_at, 0)] if n else cp, 0)
    form = np.zeros(n, bool)
    for i, (text, start) in enumerate(zip(texts, starts, strict=True)):
        if start:
            a, b = _initial_form(text)
            if a >= 0:
                form[first[i] + a : first[i] + b] = True
    stop = np.zeros(n, np.int64)
    for s in rules.DELETE_SEQUENCES:
        stop[(cp == s[0]) & (after == s[1]) & ((after2 == s[2]) if len(s) > 2 else True)] = len(s)
    alef = ord(ALEF)
    rule = np.zeros(n, np.int64)
    for i, c in enumerate(PLAIN):
        rule[cp == c] = _FIRST_PLAIN + i
    rule[cp == 0x06CC] = 3
    rule[cp == 0x065E] = 4
    maddah = cp == MADDAH
    rule[maddah] = np.where(form, 5, np.where(np.isin(base, rules.LONG_VOWELS), 6, np.where(after == alef, 7, 8)))[maddah]
    damma = cp == INVERTED_DAMMA
    rule[damma] = np.where(after == alef, 9, 10)[damma]
    rule[cp == SMALL_MADDAH] = 11
    rule[(cp == alef) & (before == INVERTED_DAMMA)] = 12
    solid = np.flatnonzero(~mark & ~k["space"][cp]) if (cp == rules.GUARDED_DELETE).any() else np.zeros(0, np.int64)
    for at in np.flatnonzero(cp == rules.GUARDED_DELETE).tolist():
        own = solid[np.searchsorted(solid, begin[at]) : np.searchsorted(solid, begin[at] + lengths[segment[at]])]
        if _decorated(own, cp, at):
            rule[at] = 2
    unresolved = np.zeros(n, bool)
    if positive is not None and n:
        at = np.flatnonzero(stop)
        proven = _any_of_next(positive, at, stop[at])
        unresolved[at] = ~proven & _any_of_next(~lexical, at, stop[at])
        for length in (2, 3):
            rows = at[proven & (stop[at] == length)]
            rule[(rows[:, None] + np.arange(length)).ravel()] = 1
    out = np.where(rule == 0, cp, alef)
    out[rule == 3], out[rule == 4] = rules.OVERRIDES[0x06CC], rules.OVERRIDES[0x065E]
    for i, v in enumerate(PLAIN.values()):
        out[rule == _FIRST_PLAIN + i] = v
    gone = np.isin(rule, GONE)
    introduced = (rule > 0) & ~gone
    out[gone] = -1

    live = np.flatnonzero(~gone)
    lo, ls = out[live], segment[live]
    same = np.zeros(len(live), bool)
    same[1:] = (lo[1:] == alef) & (lo[:-1] == alef) & (ls[1:] == ls[:-1])
    index = np.arange(len(live))
    run_start = _last(~same)
    i = index - run_start + 1
    new = np.where((lo == alef) & introduced[live], i, n + 1)
    heads = np.flatnonzero(~same)
    least = np.minimum.reduceat(new, heads) if len(heads) else new
    k_run = np.repeat(least, np.diff(np.append(heads, len(live)))) if len(heads) else new
    stays = (i == 1) | (i < k_run)
    keeper = _last(stays)
    out_id = np.full(n, -1, np.int64)
    out_id[live] = live[keeper] if len(live) else live
    merged = np.zeros(n, bool)
    merged[live] = ~stays
    taken = np.flatnonzero(rule == 12)
    out_id[taken] = out_id[taken - 1]

    stand = live[stays]
    so, ss = out[stand], segment[stand]
    smark = k["mark"][so]
    follows = np.zeros(len(stand), bool)
    follows[:-1] = (stand[1:] == stand[:-1] + 1) & (ss[1:] == ss[:-1]) & k["number"][so[1:]]
    left = _last(~smark, strict=True)
    left_letter = (left >= 0) & (ss[np.maximum(left, 0)] == ss) & k["letter"][so[np.maximum(left, 0)]] if len(stand) else follows
    space = (so == 0xA0) & follows & left_letter
    dead = space | k["deleted"][so]
    deleted, nbsp, kept, separator = (np.zeros(n, bool) for _ in range(4))
    deleted[stand], nbsp[stand], kept[stand] = dead, space, ~dead
    separator[stand] = space | (dead & k["separator"][so])
    separator |= (rule == 1) | (rule == 2)

    lasting = kept | ((out_id >= 0) & (out_id != np.arange(n)))
    rank = np.cumsum(kept)
    back, ahead = _last(lasting), _next(lasting)
    a, b = np.maximum(back, 0), np.minimum(ahead, max(n - 1, 0))
    repaired = np.zeros(n, bool)
    if n:
        within = (back >= begin) & (back >= 0) & (ahead < n) & (segment[b] == segment)
        solid = kept & ~k["mark"][np.maximum(out, 0)]
        l, r = _last(solid), _next(solid)
        lm, rm = np.maximum(l, 0), np.minimum(r, n - 1)
        l_ok = (l >= begin) & (l >= 0) & k["letter"][np.maximum(out[lm], 0)]
        r_ok = (r < n) & (segment[rm] == segment) & k["letter"][np.maximum(out[rm], 0)]
        gap = np.flatnonzero(separator & within & (rank[b] == rank[a] + 1) & l_ok & r_ok)
        if len(gap):
            opens = np.ones(len(gap), bool)
            opens[1:] = (rank[a[gap[1:]]] != rank[a[gap[:-1]]]) | (segment[gap[1:]] != segment[gap[:-1]])
            repaired[gap[opens]] = True
    return Lineage(cp, segment, pos, rule, out, introduced, np.where(out_id >= 0, out_id - begin, -1) if n else out_id, merged, deleted, nbsp, kept, repaired, stop, unresolved)


def output_texts(x: Lineage, n: int) -> list[str]:
    shown = x.kept | x.repaired
    codes = np.where(x.repaired, 32, x.out)[shown].astype("<u4")
    text = codes.tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.cumsum(np.bincount(x.segment[shown], minlength=n))
    ends = [0, *ends.tolist()]
    return [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _chunks(texts: list[str], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size, end = size + len(texts[end]), end + 1
        yield at, end
        at = end


def run_flags(runs_: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By character of all segments: whether its run is positive, is lexical, and the run's number."""
    flat = [x for own in runs_ for x in own or ()]
    lengths = np.array([x["length"] for x in flat], np.int64)
    spread = lambda name, kind: np.repeat(np.array([x[name] for x in flat], kind), lengths)
    return spread("positive", bool), spread("lexical", bool), spread("run", np.int64)


def pieces(x: Lineage, runs_: list[list[dict]]) -> list[list[dict]]:
    """What is written back: for each run of each segment its number and the new text of each of its text nodes. A
    character goes to the node of the source character that it stands for; a space that was put in, to that of the
    first deleted one."""
    shown = x.kept | x.repaired
    codes = np.where(x.repaired, 32, x.out)
    out, at = [], 0
    for own in runs_:
        pieces = []
        for r in own or ():
            texts = []
            for length in r["nodes"]:
                here = slice(at, at + length)
                texts.append(codes[here][shown[here]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"))
                at += length
            pieces.append({"run": r["run"], "texts": texts})
        out.append(pieces)
    return out


def undecided(x: Lineage) -> np.ndarray:
    """Rows that strict mode refuses: unresolved stop sequences, and ligatures that are not proven decoration."""
    return np.concatenate([np.flatnonzero(x.unresolved), np.flatnonzero((x.cp == rules.GUARDED_DELETE) & (x.rule != 2))])


def lost(x: Lineage) -> np.ndarray:
    """Rows that neither stand nor went into another nor fell to a rule."""
    return np.flatnonzero(~(x.kept | x.merged | (x.rule > 0) | x.deleted))


def doubled_alefs(x: Lineage) -> np.ndarray:
    """Rows of Alefs that stand after another one, where either is new or took one in."""
    took = np.zeros(len(x.cp), bool)
    base = np.arange(len(x.cp)) - x.pos
    took[(x.out_id + base)[x.merged]] = True
    shown = np.flatnonzero(x.kept | x.repaired)
    alef = ~x.repaired[shown] & (x.out[shown] == ord(ALEF))
    fresh = x.repaired[shown] | x.introduced[shown] | took[shown]
    twice = np.zeros(len(shown), bool)
    twice[1:] = alef[1:] & alef[:-1] & (fresh[1:] | fresh[:-1]) & (x.segment[shown][1:] == x.segment[shown][:-1])
    return shown[twice]


def unlisted(cp: np.ndarray) -> np.ndarray:
    """Whether a character is Arabic and not in the ledger; it may still be a number."""
    arabic = np.zeros(len(cp), bool)
    for low, high in (*ARABIC_BLOCKS, *ARABIC_ELSEWHERE):
        arabic |= (cp >= low) & (cp <= high)
    return arabic & ~np.isin(cp, rules.KNOWN)


def _blockers(x: Lineage, n: int) -> list[list[dict]]:
    found: list[list[dict]] = [[] for _ in range(n)]
    for at in np.flatnonzero(x.unresolved).tolist():
        found[x.segment[at]].append({"type": "unresolved_stop_sequence", "pos": int(x.pos[at])})
    for at in np.flatnonzero((x.cp == rules.GUARDED_DELETE) & (x.rule != 2)).tolist():
        found[x.segment[at]].append({"type": "sole_or_unproven_bismillah_ligature", "pos": int(x.pos[at])})
    return [sorted(f, key=lambda b: b["pos"]) for f in found]


#: Columns that runs add to those of ``transduce_texts``.
RUN_COLUMNS = {"pieces": "array<struct<run:int,texts:array<string>>>", "blockers": "array<struct<type:string,pos:int>>", "cross_run": "map<string,bigint>", "again": "string"}
RUN_PARTS = tuple(RUN_COLUMNS)
_RUN_KINDS = {
    "pieces": pa.list_(pa.struct([("run", pa.int32()), ("texts", pa.list_(pa.string()))])), "blockers": pa.list_(pa.struct([("type", pa.string()), ("pos", pa.int32())])),
    "cross_run": pa.map_(pa.string(), pa.int64()), "again": pa.string(),
}


def transduce_texts(segments: DataFrame, keys: tuple[str, ...] = KEYS, parts: tuple[str, ...] = RUN_PARTS) -> DataFrame:
    """One row per segment: ``keys``, text, input_count, output_count, word_boundary_repairs,
    unapproved_duplicate_alef, lineage_complete (every character stands, went into another, or fell to a rule), and
    decisions (a map from rule to count). A null text counts as empty.

    Segments with a column ``runs`` (run, length, nodes, positive, lexical; see ``segments_of_runs``) have their stop
    sequences told apart, and four more columns: pieces (the new texts of each run's text nodes), blockers (what no
    rule decides, with its place), cross_run (decisions whose evidence lies in several runs) and again (the output's
    own output, which equals it if the rules are idempotent). Of these four, ``parts`` are made.
    """
    with_runs = "runs" in segments.columns
    own = segments.select(*keys, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("surah_start", F.lit(False)).alias("surah_start"), *(["runs"] if with_runs else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(keys)])
    counts = ("input_count", "output_count", "word_boundary_repairs", "unapproved_duplicate_alef")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column("text").to_pylist(), batch.column("surah_start").to_pylist()
            for at, end in _chunks(texts):
                n = end - at
                more, names = [], []
                if with_runs:
                    runs_ = batch.column("runs").slice(at, n).to_pylist()
                    positive, lexical, number = run_flags(runs_)
                    x = transduce_batch(texts[at:end], starts[at:end], positive, lexical)
                else:
                    x = transduce_batch(texts[at:end], starts[at:end])
                per = lambda mask, x=x, n=n: pa.array(np.bincount(x.segment[mask], minlength=n))
                columns = [per(np.ones(len(x.cp), bool)), per(x.kept | x.repaired), per(x.nbsp | x.repaired), per(doubled_alefs(x))]
                complete = pa.array(np.bincount(x.segment[lost(x)], minlength=n) == 0)
                maps = pa.array([sorted(d.items()) for d in _decisions(x, n)], pa.map_(pa.string(), pa.int64()))
                new = output_texts(x, n)
                if with_runs:
                    names = list(parts)
                    made = {
                        "pieces": lambda x=x, runs_=runs_: pieces(x, runs_), "blockers": lambda x=x, n=n: _blockers(x, n), "cross_run": lambda x=x, number=number, n=n: [sorted(d.items()) for d in _crossed(x, number, n)],
                        "again": lambda new=new, at=at, end=end, n=n: output_texts(transduce_batch(new, starts[at:end]), n),
                    }
                    more = [pa.array(made[name](), _RUN_KINDS[name]) for name in parts]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, n) for i in range(len(keys))), pa.array(new, pa.string()), *columns, complete, maps, *more], names=[*keys, "text", *counts, "lineage_complete", "decisions", *names])

    return own.mapInArrow(run, f"{schema}, text string, {', '.join(f'{c} bigint' for c in counts)}, lineage_complete boolean, decisions map<string,bigint>" + "".join(f", {c} {RUN_COLUMNS[c]}" for c in parts if with_runs))


def _crossed(x: Lineage, number: np.ndarray, n: int) -> list[dict[str, int]]:
    """By segment, decisions on special characters and stop sequences whose characters lie in several runs."""
    found: list[dict[str, int]] = [{} for _ in range(n)]
    total = len(x.cp)
    base = _last(~_classes()["mark"][x.cp], strict=True)
    for at in np.flatnonzero(np.isin(x.cp, rules.SPECIAL) & (x.rule > 0)).tolist():
        near = {int(number[at])}
        if x.rule[at] in (5, 6, 7, 8) and base[at] >= 0 and x.segment[base[at]] == x.segment[at]:
            near.add(int(number[base[at]]))
        if x.cp[at] in rules.CONTEXTUAL and at + 1 < total and x.segment[at + 1] == x.segment[at] and x.cp[at + 1] == ord(ALEF):
            near.add(int(number[at + 1]))
        if len(near) > 1:
            d, name = found[x.segment[at]], ALL_RULES[x.rule[at]]
            d[name] = d.get(name, 0) + 1
    for at in np.flatnonzero(x.stop).tolist():
        if number[at] != number[at + x.stop[at] - 1]:
            d, name = found[x.segment[at]], f"stop_sequence:{_stop_class(x, at)}"
            d[name] = d.get(name, 0) + 1
    return found


def _stop_class(x: Lineage, at: int) -> str:
    return "proven_stop_sign" if x.rule[at] == 1 else "unresolved" if x.unresolved[at] else "lexical"


def rule3_names(x: Lineage) -> np.ndarray:
    """Names of phase-3 rules by character; '' where none."""
    out = np.full(len(x.cp), "", object)
    for at in np.flatnonzero(x.deleted).tolist():
        c = int(x.out[at])
        if x.nbsp[at]:
            out[at] = "C8_numeric_label_NBSP_cleanup"
        elif unicodedata.category(chr(c))[0] == "N":
            out[at] = "E3_numeric_category_delete"
        else:
            out[at] = f"E4_U+{c:04X}_delete" if c in (0xFDFA, 0xFDFB) else f"delete_U+{c:04X}"
    return out


def _decisions(x: Lineage, n: int) -> list[dict[str, int]]:
    found: list[dict[str, int]] = [{} for _ in range(n)]

    def add(where: np.ndarray, names: np.ndarray | str) -> None:
        at = np.flatnonzero(where)
        if isinstance(names, str):
            for s, c in zip(*np.unique(x.segment[at], return_counts=True), strict=True):
                found[s][names] = found[s].get(names, 0) + int(c)
            return
        both, c = np.unique(np.column_stack([x.segment[at], names[at]]), axis=0, return_counts=True)
        for (s, r), m in zip(both.tolist(), c.tolist(), strict=True):
            found[s][ALL_RULES[r]] = found[s].get(ALL_RULES[r], 0) + m

    add((x.rule > 2) & (x.rule != 12), x.rule)
    add(x.rule == 2, "bismillah:decorative_duplicate")
    add(x.merged, "C6_new_duplicate_Alef_collapse")
    add(x.repaired, "C8_word_boundary_repair")
    proven = (x.stop > 0) & (x.rule == 1)
    add((x.stop > 0) & ~proven & ~x.unresolved, "stop_sequence:lexical")
    add(proven, "stop_sequence:proven_stop_sign")
    add(x.unresolved, "stop_sequence:unresolved")
    add(x.nbsp, "C8_numeric_label_NBSP_cleanup")
    rest = x.deleted & ~x.nbsp
    for c in np.unique(x.out[rest]).tolist():
        name = "E3_numeric_category_delete" if unicodedata.category(chr(c))[0] == "N" else f"E4_U+{c:04X}_delete" if c in (0xFDFA, 0xFDFB) else f"delete_U+{c:04X}"
        add(rest & (x.out == c), name)
    return found


def transduce_events(segments: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per source character that a rule touched: ``keys``, pos, source, rule, merged, rule3, repaired, out_id,
    context (escaped, fourteen characters to both sides), and, of segments with ``runs``, the character's run."""
    with_runs = "runs" in segments.columns
    own = segments.select(*keys, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("surah_start", F.lit(False)).alias("surah_start"), *(["runs"] if with_runs else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column("text").to_pylist(), batch.column("surah_start").to_pylist()
            for at, end in _chunks(texts):
                positive = lexical = number = None
                if with_runs:
                    positive, lexical, number = run_flags(batch.column("runs").slice(at, end - at).to_pylist())
                x = transduce_batch(texts[at:end], starts[at:end], positive, lexical)
                hit = np.flatnonzero((x.rule > 0) | x.merged | x.deleted | x.repaired)
                rows = pa.array(x.segment[hit] + at)
                third = rule3_names(x)[hit]
                context = [texts[at + s][max(0, p - 14) : p + 15].encode("unicode_escape").decode("ascii") for s, p in zip(x.segment[hit].tolist(), x.pos[hit].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(rows) for i in range(len(keys))), pa.array(x.pos[hit].astype(np.int32)), pa.array([chr(c) for c in x.cp[hit].tolist()], pa.string()), pa.array([ALL_RULES[r] or None for r in x.rule[hit].tolist()], pa.string()),
                     pa.array(x.merged[hit]), pa.array([t or None for t in third], pa.string()), pa.array(x.repaired[hit]), pa.array([v if v >= 0 else None for v in x.out_id[hit].tolist()], pa.int32()),
                     pa.array(context, pa.string()), pa.nulls(len(hit), pa.int32()) if number is None else pa.array(number[hit].astype(np.int32))],
                    names=[*keys, "pos", "source", "rule", "merged", "rule3", "repaired", "out_id", "context", "run"],
                )

    return own.mapInArrow(run, f"{schema}, pos int, source string, rule string, merged boolean, rule3 string, repaired boolean, out_id int, context string, run int")


def _phase3_name(c: int) -> str:
    """The rule that deletes a code point after the collapse of Alefs."""
    if unicodedata.category(chr(c))[0] == "N":
        return "E3_numeric_category_delete"
    return f"E4_U+{c:04X}_delete" if c in (0xFDFA, 0xFDFB) else f"delete_U+{c:04X}"


#: Events that are told by numbers: a rule's place in ALL_RULES, these, or _DELETED and the code point that went.
_MERGED, _REPAIRED, _NBSP, _DELETED = 1000, 1001, 1002, 2000


def _event(code: int) -> tuple[str, str, str]:
    """(rule, phase, action) of an event by its number."""
    if code >= _DELETED:
        return _phase3_name(code - _DELETED), "phase3", "DELETE"
    if code >= _MERGED:
        return {
            _MERGED: ("C6_new_duplicate_Alef_collapse", "phase2", "COLLAPSE"), _REPAIRED: ("C8_word_boundary_repair", "phase4", "INSERT_BOUNDARY"), _NBSP: ("C8_numeric_label_NBSP_cleanup", "phase3", "DELETE_BOUNDARY"),
        }[code]
    name = ALL_RULES[code]
    return name, "phase2" if code >= _FIRST_PLAIN else "phase1", "DELETE" if code in (1, 2) else "TRANSFORM"


def _events(x: Lineage) -> tuple[np.ndarray, np.ndarray]:
    """Rows and numbers of all events: a row may be transformed, then merged or deleted. A stop sign is one event."""
    first = np.flatnonzero((x.rule > 1) & (x.rule != 12) | (x.rule == 1) & (x.stop > 0))
    rest = np.flatnonzero(x.deleted & ~x.nbsp)
    parts = [(first, x.rule[first]), (rest, _DELETED + x.out[rest])]
    for where, code in ((x.merged, _MERGED), (x.repaired, _REPAIRED), (x.nbsp, _NBSP)):
        at = np.flatnonzero(where)
        parts.append((at, np.full(len(at), code, np.int64)))
    return np.concatenate([a for a, _ in parts]), np.concatenate([c for _, c in parts])


def event_counts(segments: DataFrame) -> DataFrame:
    """(doc_id, rule, phase, action, n): events of each document. They are counted where they are found."""
    own = segments.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("surah_start", F.lit(False)).alias("surah_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column("text").to_pylist(), batch.column("surah_start").to_pylist()
            for at, end in _chunks(texts):
                x = transduce_batch(texts[at:end], starts[at:end])
                docs = batch.column("doc_id").slice(at, end - at).dictionary_encode(null_encoding="encode")
                rows, codes = _events(x)
                number = np.asarray(docs.indices)[x.segment[rows]].astype(np.int64)
                both, n = np.unique(number << 32 | codes, return_counts=True)
                names = {c: _event(c) for c in np.unique(codes).tolist()}
                named = [names[c] for c in (both & 0xFFFFFFFF).tolist()]
                yield pa.RecordBatch.from_arrays([docs.dictionary.take(pa.array(both >> 32)), *(pa.array([v[i] for v in named], pa.string()) for i in range(3)), pa.array(n.astype(np.int64))], names=["doc_id", "rule", "phase", "action", "n"])

    kind = own.schema["doc_id"].dataType.simpleString()
    found = own.mapInArrow(run, f"doc_id {kind}, rule string, phase string, action string, n bigint")
    return found.groupBy("doc_id", "rule", "phase", "action").agg(F.sum("n").alias("n"))


def _stretches(text: np.ndarray, first: np.ndarray, lengths: np.ndarray, heads: list[tuple[int, int]], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the stretches of all segments, and of nothing else: see ``transducer.stretches``."""
    cut = text == 32
    for at, end in heads:
        cut[at:end] = False
    for i in np.flatnonzero(whole).tolist():
        cut[first[i] : first[i] + lengths[i]] = False
    spaces = np.flatnonzero(cut)
    begin = np.sort(np.concatenate([first, spaces + 1]), kind="stable")
    end = np.sort(np.concatenate([first + lengths, spaces]), kind="stable")
    return begin, end


def stretch_texts(segments: DataFrame) -> DataFrame:
    """(text, surah_start, output, n): what whole segments make of their stretches (see ``transducer.stretches``), each
    kind once; a cut space counts as one. ``n``, on the row without text: segments that hold a character."""
    own = segments.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("surah_start", F.lit(False)).alias("surah_start"))
    names = ["text", "surah_start", "output", "n"]

    def rows(seen: set, n: int) -> pa.RecordBatch:
        listed = [*seen, ("", False, "")]
        return pa.RecordBatch.from_arrays([pa.array([v[0] for v in listed], pa.string()), pa.array([v[1] for v in listed]), pa.array([v[2] for v in listed], pa.string()), pa.array([0] * len(seen) + [n], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = set(), 0
        for batch in batches:
            texts, starts = batch.column("text").to_pylist(), batch.column("surah_start").to_pylist()
            for at, end in _chunks(texts):
                own_, flags = texts[at:end], starts[at:end]
                x = transduce_batch(own_, flags)
                shown = x.kept | x.repaired
                into = np.concatenate([[0], np.cumsum(shown)])
                source, output = "".join(own_), np.where(x.repaired, 32, x.out)[shown].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                lengths = np.array([len(t) for t in own_], np.int64)
                first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                heads = {int(first[i]): int(first[i]) + len(HEAD.match(own_[i])[0]) for i in range(len(own_)) if flags[i] and own_[i]}
                a, b = _stretches(x.cp.copy(), first, lengths, list(heads.items()), np.array([chr(rules.GUARDED_DELETE) in t for t in own_], bool))
                for i, j, k, m in zip(a.tolist(), b.tolist(), into[a].tolist(), into[b].tolist(), strict=True):
                    if i < j:
                        seen.add((source[i:j], i in heads, output[k:m]))
                spaces = np.flatnonzero(x.cp == 32)
                seen.update((" ", False, output[k:m]) for k, m in {(int(into[s]), int(into[s + 1])) for s in spaces[~(shown[spaces] & (x.out[spaces] == 32) & ~x.repaired[spaces])].tolist()})
                n += int((lengths > 0).sum())
                if len(seen) > MOST_SEEN:
                    yield rows(seen, n)
                    seen, n = set(), 0
        yield rows(seen, n)

    found = own.mapInArrow(run, "text string, surah_start boolean, output string, n bigint")
    return found.groupBy("text", "surah_start", "output").agg(F.sum("n").alias("n"))


#: Top bits of a context's hash that say where it is dealt, and the bits that are kept beside them.
_PLACES, _TOP = 64, 16
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ROLLUP = "code bigint, source bigint, place int, n bigint, first_context string, hashes binary"


@functools.lru_cache(maxsize=1)
def _ranks() -> np.ndarray:
    """By code point, its place in the order of escapes: no escape opens another, so texts of such places compare as
    their escapes do."""
    escapes = np.arange(0x110000, dtype=np.int64) << 24
    odd = np.ones(0x110000, bool)
    odd[32:127] = False
    odd[92] = True
    kind = np.full(0x110000, 0, np.int64)  # U, \\, n, r, t, u, x: the order of what follows the backslash
    kind[:0x10000], kind[:0x100] = 5, 6
    kind[[92, 10, 13, 9]] = 1, 2, 3, 4
    escapes[odd] = (92 << 24) + (kind[odd] << 21) + np.flatnonzero(odd)
    return escapes


def _least(ranks: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
    """Which of the stretches ``low`` to ``high`` comes first in order."""
    left, k = np.arange(len(low)), 0
    while len(left) > 1:
        at = low[left] + k
        ended = at >= high[left]
        if ended.any():
            return int(left[ended][0])
        r = ranks[at]
        left, k = left[r == r.min()], k + 1
        if k > 29:
            break
    return int(left[0])


def _hashes(cp: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each stretch ``low`` to ``high``."""
    padded = np.concatenate([cp, np.zeros(29, cp.dtype)]).astype(np.uint64)
    size = (high - low).astype(np.uint64)
    lanes = [size * np.uint64(s) for s in _SEEDS]
    for k in range(29):
        c = np.where(size > k, padded[low + k], np.uint64(0x1FFFFF))
        for i, s in enumerate(_SEEDS):
            h = (lanes[i] ^ c) * np.uint64(s)
            lanes[i] = h ^ (h >> np.uint64(29 + i))
    return lanes[0], lanes[1]


def _packed(top: np.ndarray, low: np.ndarray) -> bytes:
    """Sorted distinct pairs of 64 and 16 bits: counts by the first _TOP bits, then what is left of each."""
    first = int(top[0] >> np.uint64(64 - _TOP)) if len(top) else 0
    counts = np.bincount((top >> np.uint64(64 - _TOP)).astype(np.int64) - first).astype("<u4")
    rest = (top & np.uint64((1 << (64 - _TOP)) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - _TOP // 8]
    return np.array([len(top), first, len(counts)], "<i8").tobytes() + counts.tobytes() + np.ascontiguousarray(rest).tobytes() + low.astype("<u2").tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, first, m = np.frombuffer(data, "<i8", 3).tolist()
    counts, width = np.frombuffer(data, "<u4", m, 24), 8 - _TOP // 8
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8, n * width, 24 + 4 * m).reshape(n, width)
    top = whole.view("<u8").ravel() | (np.repeat(np.arange(first, first + m), counts).astype(np.uint64) << np.uint64(64 - _TOP))
    return top, np.frombuffer(data, "<u2", n, 24 + 4 * m + n * width)


def _distinct(top: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((low, top))
    top, low = top[order], low[order]
    new = np.ones(len(top), bool)
    new[1:] = (top[1:] != top[:-1]) | (low[1:] != low[:-1])
    return top[new], low[new]


def event_rollup(segments: DataFrame) -> DataFrame:
    """(rule, phase, action, source_codepoint, n, n_contexts, first_context): events of all segments, how many contexts
    they have (see ``transduce_events``), and the first of these in order.

    Contexts stay where they are: of each kind of event a task passes on the least one and, sorted, 80 bits of hash of
    each distinct one, which are dealt by their first bits and counted there. Two of a hundred million contexts of one
    kind share all 80 bits with a chance of some 4 in a thousand million.
    """
    own = segments.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("surah_start", F.lit(False)).alias("surah_start"))

    def rows(held: dict) -> pa.RecordBatch:
        out = []
        for (code, source), (n, least, parts) in held.items():
            top, low = _distinct(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))
            cuts = np.searchsorted(top, np.arange(1, _PLACES, dtype=np.uint64) << np.uint64(64 - 6))
            for place, (a, b) in enumerate(zip([0, *cuts.tolist()], [*cuts.tolist(), len(top)], strict=True)):
                if a < b or not place:
                    out.append((code, source, place, 0 if place else n, None if place else least, _packed(top[a:b], low[a:b])))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in ROLLUP.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, str, list]] = {}
        n = 0
        for batch in batches:
            texts, starts = batch.column("text").to_pylist(), batch.column("surah_start").to_pylist()
            for at, end in _chunks(texts, CHUNK >> 3):
                x = transduce_batch(texts[at:end], starts[at:end])
                found, codes = _events(x)
                lengths = np.array([len(t) for t in texts[at:end]], np.int64)
                ends = np.cumsum(lengths)
                kind = codes << 21 | x.cp[found]
                order = np.argsort(kind, kind="stable")
                found, kind = found[order], kind[order]
                low, high = np.maximum(found - x.pos[found], found - 14), np.minimum(ends[x.segment[found]], found + 15)
                top, rest = _hashes(x.cp, low, high)
                rest = rest >> np.uint64(48)
                ranks = _ranks()[x.cp]
                kinds, first = np.unique(kind, return_index=True)
                for k, a, b in zip(kinds.tolist(), first.tolist(), [*first[1:].tolist(), len(kind)], strict=True):
                    i = a + _least(ranks, low[a:b], high[a:b])
                    least = "".join(map(chr, x.cp[low[i] : high[i]].tolist())).encode("unicode_escape").decode("ascii")
                    m, before, parts = held.get((k >> 21, k & 0x1FFFFF), (0, least, []))
                    held[k >> 21, k & 0x1FFFFF] = m + b - a, min(before, least), [*parts, (top[a:b], rest[a:b].astype(np.uint16))]
                n += len(kind)
                if n > MOST_EVENTS:
                    yield rows(held)
                    held, n = {}, 0
        yield rows(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for blobs in batch.column("hashes").to_pylist():
                parts = [_unpacked(b) for b in blobs]
                n.append(len(_distinct(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))[0]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("code", "source", "n", "first_context")), pa.array(n, pa.int64())], names=["code", "source", "n", "first_context", "n_contexts"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [_event(c) for c in batch.column("code").to_pylist()]
            labels = pa.array([f"U+{c:04X}" for c in batch.column("source").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array([v[i] for v in named], pa.string()) for i in range(3)), labels, *(batch.column(c) for c in ("n", "n_contexts", "first_context"))], names=["rule", "phase", "action", "source_codepoint", "n", "n_contexts", "first_context"])

    found = own.mapInArrow(run, ROLLUP)
    dealt = found.groupBy("code", "source", "place").agg(F.sum("n").alias("n"), F.min("first_context").alias("first_context"), F.collect_list("hashes").alias("hashes"))
    counted = dealt.mapInArrow(count, "code bigint, source bigint, n bigint, first_context string, n_contexts bigint")
    total = counted.groupBy("code", "source").agg(F.sum("n").alias("n"), F.sum("n_contexts").alias("n_contexts"), F.min("first_context").alias("first_context"))
    return total.mapInArrow(name, "rule string, phase string, action string, source_codepoint string, n bigint, n_contexts bigint, first_context string")


def event_records(touched: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Events of ``transduce_events``, one for each thing done to a character: ``keys``, pos, rule, phase, action,
    source_codepoint, source, context and run. A character may have several: transformed, then merged or deleted."""
    rule1 = F.col("rule")
    transform = F.struct(
        rule1.alias("rule"), F.when(rule1.startswith("simple"), "phase2").otherwise("phase1").alias("phase"),
        F.when(rule1.isin("E5_stop_sequence", "E6_decorative_bismillah"), "DELETE").otherwise("TRANSFORM").alias("action"),
    )
    kinds = F.array(
        F.when(rule1.isNotNull() & (rule1 != "consumed"), transform),
        F.when(F.col("merged"), F.struct(F.lit("C6_new_duplicate_Alef_collapse").alias("rule"), F.lit("phase2").alias("phase"), F.lit("COLLAPSE").alias("action"))),
        F.when(F.col("rule3").isNotNull(), F.struct(F.col("rule3").alias("rule"), F.lit("phase3").alias("phase"), F.when(F.col("rule3").startswith("C8"), "DELETE_BOUNDARY").otherwise("DELETE").alias("action"))),
        F.when(F.col("repaired"), F.struct(F.lit("C8_word_boundary_repair").alias("rule"), F.lit("phase4").alias("phase"), F.lit("INSERT_BOUNDARY").alias("action"))),
    )
    rows = touched.select(*keys, "pos", "source", "context", "run", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("e"))
    return rows.select(*keys, "pos", "e.rule", "e.phase", "e.action", codepoint_label(F.col("source")).alias("source_codepoint"), unicode_escape(F.col("source")).alias("source"), "context", "run")


def decisions(texts: DataFrame) -> DataFrame:
    """Applied rules and how often, over all segments of ``transduce_texts``."""
    return texts.select(F.explode("decisions").alias("rule", "n")).groupBy("rule").agg(F.sum("n").alias("n"))

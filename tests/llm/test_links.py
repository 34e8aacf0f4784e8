"""N-gram join, substring dedup, vectors and components against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from glyphweave.llm.common import Scratch
from glyphweave.llm.components import components
from glyphweave.llm.embedding_join import near_boxes, near_vectors
from glyphweave.llm.linking import parity, sketch_distance
from glyphweave.llm.ngram_join import ngram_join
from glyphweave.llm.substring_dedup import remove_paragraphs, substring_dedup, tune

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else {tuple(w)} if w else set()


def least(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def corpus(seed, n=160):
    """Copies, near copies with changes of all sizes, shared passages and plain texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.randrange(3, 90))] for _ in range(12)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.2:
            text = passage + text
        rows.append((i * 3 + 1, " ".join(t.upper() if rng.random() < 0.1 else t for t in text)))
    return rows


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 4, 5)])
def test_ngram_join_equals_brute_force(docs_of, edge_rows, k, num, den):
    rows = [*corpus(k), *((None if i is None else i + 100_000, t) for i, t in edge_rows)]
    found = ngram_join(docs_of(rows).withColumnRenamed("lang", "n_shingles"), size=k, num=num, den=den).collect()
    assert len(found) == len(rows)
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    expected = least(sets, edges)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert all(r.n_shingles == len(sets[r.doc_id]) for r in found if r.doc_id is not None)
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert len(set(expected.values())) < len(expected)


def test_ngram_join_of_an_empty_table(docs_of):
    assert ngram_join(docs_of([(1, "a")]).limit(0)).count() == 0


def test_keys_with_several_texts_are_one_document(docs_of):
    a, b, c = ("alpha beta gamma delta one two", "omega psi chi phi three four", "plain text that stands quite alone")
    found = {r.doc_id: r.component_id for r in ngram_join(docs_of([(1, a), (2, a), (2, b), (3, b), (4, c)])).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4}


def test_bands_are_tuned_for_recall():
    for s, recall in ((0.8, 0.999), (0.5, 0.9)):
        bands, rows = tune(s, recall)
        assert 1 - (1 - s**rows) ** bands >= recall


def test_substring_dedup_finds_repeats_and_leaves_others(docs_of, edge_rows):
    rng = random.Random(5)
    words = [f"t{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    near = passage.copy()
    near[30] = "changed"
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(40)) for _ in range(3))) for i in range(100, 130)]
    for i in (3, 9, 12):
        rows[i] = (rows[i][0], rows[i][1] + "\n" + " ".join(passage))
    rows[20] = (rows[20][0], "  " + " ".join(near) + " \n" + rows[20][1])
    docs = docs_of([*rows, *edge_rows]).withColumnRenamed("lang", "removed")
    out = substring_dedup(docs)
    found = {(r.doc_id, r.paragraph): r for r in out.collect()}
    assert set(found) == {(103, 3), (109, 3), (112, 3), (120, 0)}
    assert {k: r.removed for k, r in found.items()} == {(103, 3): False, (109, 3): True, (112, 3): True, (120, 0): True}
    assert {(r.component_id, r.n_occurrences, r.first_key) for r in found.values()} == {(found[(103, 3)].component_id, 4, 103)}
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.stop].split()[0] == passage[0] for r in found.values())
    kept = {r.doc_id: r.text for r in remove_paragraphs(docs, out).collect()}
    assert kept[120] == texts[120].partition("\n")[2] and kept[103] == texts[103] and kept[1] is None
    assert substring_dedup(docs.limit(0)).count() == 0


def passages(docs_of, layout):
    rng = random.Random(6)
    text = lambda n: " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, f"{text(40)}\n{text(70)}") for i in range(200, 220)]
    passage = text(60)
    rows[4] = (204, f"{text(50)} {passage} {text(80)}")
    rows[9] = (209, layout(text, passage))
    rows += [(300, "again and " * 400), (301, None), (None, text(20))]
    docs = docs_of(rows)
    out = substring_dedup(docs)
    assert sorted((r.doc_id, rows[r.doc_id - 200][1][r.start : r.stop].split(), r.n_words, r.first_key, r.n_occurrences, r.removed) for r in out.collect()) == [(i, passage.split(), 60, 204, 2, i == 209) for i in (204, 209)]
    kept = {r.doc_id: r.text for r in remove_paragraphs(docs, out).collect()}
    assert {i: kept[i] for i, _ in rows if i != 209} == {i: t for i, t in rows if i != 209}
    assert sorted(kept[209].split()) == sorted((Counter(rows[9][1].split()) - Counter(passage.split())).elements())


def test_substring_dedup_finds_passages_within_paragraphs(docs_of):
    passages(docs_of, lambda text, passage: f"é {text(90)} {passage} {text(30)}\n{text(9)}")


def test_substring_dedup_finds_passages_over_short_lines(docs_of):
    passages(docs_of, lambda text, passage: text(5) + "\n" + "\n".join(" ".join(passage.split()[i : i + 12]) for i in range(0, 60, 12)) + "\n" + text(7))


def test_distant_boxes_do_not_meet():
    rng = np.random.default_rng(3)
    p = rng.normal(size=(300, 16)).astype(np.float32)
    low, high = p.reshape(30, 10, 16).min(1), p.reshape(30, 10, 16).max(1)
    for eps2 in (0.2, 2.0, 8.0):
        near = near_boxes(p, low, high, eps2)
        gap = np.maximum(0, np.maximum(low[None] - p[:, None], p[:, None] - high[None]))
        exact = (gap.astype(float) ** 2).sum(2)
        assert near[exact <= eps2].all() and not near[exact > eps2 + 0.01].any()
        assert 0 < near.sum() < near.size


@pytest.mark.parametrize("stretch", [8192, 20])
def test_vectors_equal_brute_force(spark, stretch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    x = np.vstack([rng.normal(size=(150, 16)), centres.repeat(6, 0) + 0.12 * rng.normal(size=(120, 16)), centres[:3].repeat(5, 0) * 1e30])
    rows = [(i + 10, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] + [1.0] * 15), (1005, [None] + [1.0] * 15), (1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (1008, rows[0][1]), (1008, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS n_links")
    found = near_vectors(frame, stretch=stretch).collect()
    assert len(found) == len(rows)
    good = [(i, np.array(v) / np.linalg.norm(np.array(v))) for i, v in rows if i < 1000 or i >= 1006]
    links, edges = {j: 0 for j in range(len(good))}, []
    for a in range(len(good)):
        for b in range(len(good)):
            if a != b and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.9:
                links[a] += 1
                edges.append((good[a][0], good[b][0]))
    expected = least({i for i, _ in rows}, edges)
    assert {r.vec_id: (r.component_id, r.kept) for r in found} == {i: (c, c == i) for i, c in expected.items()}
    counts = {good[j][0]: n for j, n in links.items()}
    assert all(r.n_links == counts.get(r.vec_id, 0) for r in found)
    assert near_vectors(frame.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    found = {r.id: r.component for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == least(nodes, edges[:-1])


def test_words_with_equal_polynomials_are_different(docs_of):
    first, second = "a", "b"
    for _ in range(11):  # such words agree under every polynomial modulo 2**64
        first, second = first + second, second + first
    docs = docs_of([(1, f"{first} x y z"), (2, f"{second} x y z"), (3, f"{first.upper()} x  y z")])
    assert {r.doc_id: r.component_id for r in ngram_join(docs, size=4).collect()} == {1: 1, 2: 2, 3: 1}


def test_sketches_never_differ_by_more_than_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 30, 33, 500, 520, 6000)]
    sets += [np.unique(np.concatenate([x[: len(x) * 9 // 10], rng.integers(0, 1 << 63, len(x) // 10 + 1).astype(np.uint64)])) for x in sets]
    sketches = np.array([parity(x) for x in sets], object)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    far = sketch_distance(sketches, i, j)
    exact = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    assert (far <= exact).all() and (far[i == j] == 0).all()
    near = (exact > 0) & (exact < 120)
    assert (far[near] > 0.6 * exact[near] - 3).all()


def test_substring_dedup_recall_against_brute_force(docs_of):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, truth = [], {}
    for i in range(150):
        base = [word() for _ in range(rng.randrange(40, 120))]
        rows.append((2 * i, " ".join(base)))
        near = list(base)
        for _ in range(rng.randrange(0, 4)):
            near[rng.randrange(len(near))] = word()
        rows.append((2 * i + 1, " ".join(near)))
    sets = {i: shingles(t, 5) for i, t in rows}
    for i in range(0, 300, 2):
        a, b = sets[i], sets[i + 1]
        truth[i] = 5 * len(a & b) >= 4 * len(a | b)
    found = substring_dedup(docs_of(rows)).collect()
    by_component = {}
    for r in found:
        if r.n_words >= 40:
            by_component.setdefault(r.component_id, set()).add(r.doc_id)
    linked = {i for c in by_component.values() for i in c if i % 2 == 0 and i + 1 in c}
    similar = {i for i, same in truth.items() if same}
    assert len(similar) > 60 and len(linked & similar) >= 0.98 * len(similar)

"""Golden contexts, the two plans against each other, and properties of the transducer."""

import random

import pytest
from pyspark.sql import functions as F

from glyphweave.operators import rules, transducer, transducer_arrays, transducer_patterns

SCHEMA = "doc_id int, paragraph int, segment int, text string, surah_start boolean"
GOLDEN = [
    ("مَرَضٗا", "مَرَضا", False), ("فِيٓ", "فِي", False), ("سُوٓءَ", "سُواَ", False), ("الٓمٓ", "الم", True), ("وٓا", "وا", False), ("بٓ", "با", False),
    ("بٗ", "با", False), ("بۤ", "با", False), ("ٞ", "ٌ", False), ("ی", "ي", False), ("اا", "اا", False), ("ءا", "ا", False), ("ب۝ت", "ب ت", False),
    ("ب ١ ت", "ب ت", False), ("ب ١", "ب", False), ("ب ت", "ب ت", False), ("Ⅷ", "", False), ("ࢠ", "ࢠ", False), ("لا", "لا", False), ("﷽", "﷽", False),
    ("﷽ بسم الله الرحمن الرحيم", " بسم الله الرحمن الرحيم", False),
]


def segments(spark, rows):
    return spark.createDataFrame([(i, 0, 0, t, s) for i, (t, s) in enumerate(rows)], SCHEMA)


def test_golden_contexts(spark):
    frame = segments(spark, [(t, s) for t, _, s in GOLDEN])
    windows = {r.doc_id: r.text for r in transducer.output_text(transducer.transduce(frame)).collect()}
    arrays = {r.doc_id: r.text for r in transducer_arrays.transduce_texts(frame).collect()}
    for i, (_, expected, _) in enumerate(GOLDEN):
        assert windows[i] == expected
        assert arrays[i] == expected


def test_plans_agree_on_random_texts(spark):
    rng = random.Random(7)
    pool = [chr(c) for c in (*rules.KEEP, *rules.TRANSFORM, *rules.DELETE, 0x06CC, 0xFDFA)] + list("  ا ا ا ٓٗۤ ١لاقي﷽")
    rows = [("".join(rng.choice(pool) for _ in range(rng.randrange(40))), rng.random() < 0.3) for _ in range(300)]
    frame = segments(spark, [*rows, (None, False), ("", True)])
    lineage = transducer.transduce(frame).cache()
    windows = {r.doc_id: r.text for r in transducer.output_text(lineage).collect()}
    arrays = {r.doc_id: r for r in transducer_arrays.transduce_texts(frame).collect()}
    assert {i: arrays[i].text for i in windows} == windows
    assert all(arrays[i].text == "" for i in set(arrays) - set(windows))
    report = {r.doc_id: r for r in transducer.segment_report(lineage).collect()}
    for name in ("input_count", "output_count", "word_boundary_repairs", "unapproved_duplicate_alef", "lineage_complete"):
        assert all(report[i][name] == arrays[i][name] for i in report)
    events = {tuple(r) for r in transducer_arrays.transduce_events(frame).select("doc_id", "pos", "rule", "merged", "rule3", "repaired", "out_id").collect()}
    touched = lineage.where("rule IS NOT NULL OR merged OR rule3 IS NOT NULL OR repaired").select("doc_id", "pos", "rule", "merged", "rule3", "repaired", "out_id")
    assert {tuple(r) for r in touched.collect()} == events
    counts = {r.rule: r.n for r in transducer_arrays.decisions(transducer_arrays.transduce_texts(frame)).collect()}
    assert {r.rule: r.n for r in transducer.decisions(lineage).collect()} == counts


def test_patterns_agree_on_random_texts(spark):
    rng = random.Random(11)
    pool = [chr(c) for c in (*rules.KEEP, *rules.TRANSFORM, *rules.EFFECTIVE_DELETE, 0x06CC, 0x065E)] + list("  ا ا ا ٓٗۤ ١لاقي") + ["\u00a0١", "اٗٓ", "يٓ", "ٗا", "ٗٓا"]
    rows = [(t, s) for t, _, s in GOLDEN]
    for i in range(600):
        own = rng.sample(pool, rng.randrange(2, 9)) if i % 2 else pool
        head = "".join(c + rng.choice(["", "ٓ", "َ", "ٗ"]) for c in rng.choice(rules.INITIAL_FORMS)) + rng.choice([" ", ""]) if i % 5 == 0 else ""
        rows.append((rng.choice(["", " "]) + head + "".join(rng.choice(own) for _ in range(rng.randrange(30))), i % 5 == 0))
    arrays = {r.doc_id: r.text for r in transducer_arrays.transduce_texts(segments(spark, rows)).collect()}
    wall, pairs = transducer_patterns.WALL, [(i, (rows[i - 1][0] + transducer_patterns.WALL if i else "") + t, (len(rows[i - 1][0]) + 1 if i else 0) if s else -1) for i, (t, s) in enumerate(rows)]
    frame = spark.createDataFrame(pairs, "i int, text string, start int")
    out = frame.select("i", transducer_patterns.output(F.col("text"), F.col("start")).alias("o"), transducer_patterns.decidable(F.col("text")).alias("d")).collect()
    assert all(r.d == ("﷽" not in pairs[r.i][1]) for r in out)
    assert {r.i: r.o.split(wall)[-1] for r in out if r.d} == {r.i: arrays[r.i] for r in out if r.d}


def test_every_rule_of_the_ledger(spark):
    rows = [(chr(c), False) for c in (*rules.KEEP, *rules.TRANSFORM, *rules.EFFECTIVE_DELETE)]
    out = {r.doc_id: r.text for r in transducer_arrays.transduce_texts(segments(spark, rows)).collect()}
    for i, (text, _) in enumerate(rows):
        c = ord(text)
        expected = text if c in rules.KEEP else "" if c in rules.EFFECTIVE_DELETE else chr(rules.SIMPLE.get(c, rules.TRANSFORM.get(c)))
        assert out[i] == expected


def test_kept_characters_pass_and_texts_are_stable(spark):
    rng = random.Random(20260822)
    text = "".join(chr(rng.choice(rules.KEEP)) for _ in range(500))
    frame = segments(spark, [(text, False)])
    assert transducer_arrays.transduce_texts(frame).first().text == text


def test_stop_signs_need_evidence(spark):
    rows = [(0, 0, 0, i, c, i in (1, 2), True) for i, c in enumerate("بلا ت")] + [(1, 0, 0, i, c, False, False) for i, c in enumerate("لا")]
    chars = spark.createDataFrame(rows, "doc_id int, paragraph int, segment int, pos int, ch string, positive boolean, lexical boolean")
    chars = chars.withColumns({"form_from": F.lit(-1), "form_to": F.lit(-1), "decorated": F.array().cast("array<int>"), "surah_start": F.lit(False)})
    keys = transducer.KEYS
    done = transducer.repairs(transducer.deletions(transducer.collapse(transducer.phase1(transducer.stop_flags(chars, keys), keys), keys), keys), keys)
    texts = {r.doc_id: r.text for r in transducer.output_text(done).collect()}
    assert texts == {0: "ب ت", 1: "لا"}
    assert [r.type for r in transducer.blockers(done).collect()] == ["unresolved_stop_sequence"]


@pytest.mark.parametrize("name", ["transduce"])
def test_windows_shuffle_texts_once(spark, name):
    plan = getattr(transducer, name)(segments(spark, [("ب", False)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def random_texts():
    rng = random.Random(11)
    pool = [chr(c) for c in (*rules.KEEP, *rules.TRANSFORM, *rules.DELETE, 0x06CC, 0xFDFA)] + list("     ا ا ا ٓٗۤ ١لاقي﷽\t\x85")
    rows = [("".join(rng.choice(pool) for _ in range(rng.randrange(40))), rng.random() < 0.3) for _ in range(300)]
    return [*rows, ("", True), ("با لا", False), ("\t الٓمٓ  فِيٓ", True), (" ", False), (None, False), ("ءا " * 40, False), ("بٓ" * 50 + " " + "بٓ" * 50, False)]


def test_events_are_counted_by_document(spark):
    frame = segments(spark, random_texts()).withColumns({"doc_id": F.col("doc_id") % 20, "paragraph": F.col("doc_id")})
    expected = transducer.events(transducer.transduce(frame)).groupBy("doc_id", "rule", "phase", "action").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in transducer_arrays.event_counts(frame).collect()} == {tuple(r) for r in expected.collect()}
    plan = transducer_arrays.event_counts(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_stretches_hold_every_character_once(spark):
    frame = segments(spark, random_texts())
    explained = F.col("kept") | F.col("merged") | F.col("rule").isNotNull() | F.col("rule3").isNotNull()
    lineage = transducer.stretch_lineage(frame)
    assert lineage.agg(F.sum("n")).first()[0] == sum(len(t or "") for t, _ in random_texts())
    whole = transducer.transduce(frame).groupBy("ch", "rule", "out1", "merged", "rule3", "kept", "repaired").agg(F.count("*").alias("n"))
    pieces = lineage.groupBy("ch", "rule", "out1", "merged", "rule3", "kept", "repaired").agg(F.sum("n").alias("n"))
    assert {tuple(r) for r in pieces.collect()} == {tuple(r) for r in whole.collect()}
    assert lineage.where(~explained).count() == 0


def test_plans_agree_on_stretches(spark):
    frame = segments(spark, random_texts())
    pairs = transducer_arrays.stretch_texts(frame).cache()
    assert pairs.agg(F.sum("n")).first()[0] == sum(bool(t) for t, _ in random_texts())
    assert transducer.unlike(pairs).count() == 0
    counted = transducer.stretches(frame).select("text", "surah_start").where("text <> ' '").distinct()
    assert {tuple(r) for r in pairs.where("text <> ''").select("text", "surah_start").collect()} == {tuple(r) for r in counted.collect()}
    wrong = pairs.withColumn("output", F.when(F.col("text") == "با", "ب").otherwise(F.col("output")))
    assert [tuple(r) for r in transducer.unlike(wrong).collect()] == [("با", False)]


def test_events_are_rolled_up_where_they_are_found(spark):
    frame = segments(spark, [*random_texts(), ("\\ٓ\t~ٓé😀ٓ" + "x" * 40 + "ٓ", False)])
    rows = transducer_arrays.event_records(transducer_arrays.transduce_events(frame))
    expected = rows.groupBy("rule", "phase", "action", "source_codepoint").agg(F.count("*").alias("n"), F.count_distinct("context").alias("n_contexts"), F.min("context").alias("first_context"))
    found = transducer_arrays.event_rollup(frame)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}
    assert "distinct" not in found._jdf.queryExecution().executedPlan().toString()


def test_hashes_are_packed_without_loss():
    import numpy as np

    rng = np.random.default_rng(1)
    top, low = transducer_arrays._distinct(rng.integers(0, 1 << 64, 5000, np.uint64) | np.uint64(1 << 63), rng.integers(0, 1 << 16, 5000, np.uint16))
    again = transducer_arrays._unpacked(transducer_arrays._packed(top, low))
    assert (again[0] == top).all() and (again[1] == low).all() and len(transducer_arrays._unpacked(transducer_arrays._packed(top[:0], low[:0]))[0]) == 0

"""Ledger, inventories, assembly, scalars and the streaming upsert on small tables."""

from pyspark.sql import functions as F

from glyphweave.functions import scalars as sc
from glyphweave.operators import assembly, audit, gates, rules
from glyphweave.streaming import upsert


def test_ledger(spark):
    assert {r.action: r.n_rules for r in rules.action_counts(spark).collect()} == {"KEEP": 50, "TRANSFORM": 13, "DELETE": 37}
    assert (len(rules.ledger_rows()), len(rules.SIMPLE), len(rules.EFFECTIVE_DELETE)) == (100, 12, 33)
    found = {tuple(r.source): (r.action, list(r.target)) for r in rules.effective_actions(rules.ledger(spark)).collect()}
    assert found[(0x065E,)] == ("TRANSFORM", [0x064C])
    assert found[(0xFDFD,)] == ("CONTEXT_GUARDED_DELETE", [])
    assert found[(0x0653,)] == ("CONTEXTUAL_TRANSFORM", [0x0627])


def test_scalars(spark):
    row = spark.createDataFrame([("a\x07 b  c", "12 x", "x٣y", "tab\té😀")], "a string, b string, c string, d string")
    out = row.select(sc.normalize_text(F.col("a")), sc.file_number(F.col("b")), sc.file_number(F.col("c")), sc.unicode_escape(F.col("d")), sc.file_number(F.lit("none"))).first()
    assert tuple(out) == ("a b c", 12, 3, "tab\\t\\xe9\\U0001f600", None)


def test_assembly(spark):
    numbers = spark.createDataFrame([(1,), (2,), (2,), (5,), (70000,), (None,)], "k int")
    assert sorted(r.number for r in assembly.missing_numbers(numbers, "k", 1, 6).collect()) == [3, 4, 6]
    assert {tuple(r) for r in assembly.missing_runs(numbers, "k").collect()} == {(2, 3, 2), (5, 6, 69994)}
    assert [tuple(r) for r in assembly.duplicates(numbers, ["k"]).collect()] == [(2, 2)]
    pieces = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a"), ("g", 3, None)], "g string, o int, t string")
    assert assembly.ordered_concat(pieces, ["g"], ["o"], F.col("t")).first().text == "a . b ."
    verdict = lambda codes: assembly.batch_verdict(spark.createDataFrame([(c,) for c in codes], "code int")).first().verdict
    assert [verdict(c) for c in ([0, 0], [3, 3], [0, 3], [])] == [0, 3, 7, 0]


def test_audit(spark):
    segs = spark.createDataFrame([(1, 0, 0, "بلا قلي ٓ١"), (2, 0, 0, ""), (3, 0, 0, None)], "doc_id int, paragraph int, segment int, text string")
    assert {(r.pos, r.sequence) for r in audit.stop_sequences(segs).collect()} == {(1, "لا"), (4, "قلي")}
    assert [(r.pos, r.codepoint) for r in audit.orphan_marks(segs).collect()] == [(8, "U+0653")]
    found = audit.occurrences(segs)
    assert {(r.kind, r.codepoint) for r in audit.occurrence_counts(found).collect()} == {("trigger", "U+0653"), ("special", "U+0653"), ("trigger", "U+0661")}
    matched = audit.matched_labels(found, audit.stop_sequences(segs))
    missing = audit.zero_match_corpus(rules.matchable_labels(spark), matched)
    assert missing.count() == rules.matchable_labels(spark).count() - 5


def test_positional_diff(spark):
    a = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (1, 2, "z")], "d int, o int, t string")
    b = spark.createDataFrame([(1, 0, "x"), (1, 1, "q"), (1, 3, "z")], "d int, o int, t string")
    diff = gates.positional_diff(a, b, ["d"], "o", "t")
    assert {(r.o, r.kind) for r in diff.collect()} == {(1, "different"), (2, "only_left"), (3, "only_right")}
    assert tuple(gates.first_mismatch(diff, ["d"], "o").first()) == (1, 1, 3)


def test_upsert_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string").write.parquet(source)
    rows = spark.readStream.schema("k int, o int, v string").parquet(source)
    args = (["k"], ["o"], ["v"])
    state = str(tmp_path / "state")
    upsert.upsert_stream(rows, state, str(tmp_path / "c"), *args).trigger(availableNow=True).start().awaitTermination()
    spark.createDataFrame([(1, 3, "z")], "k int, o int, v string").write.mode("append").parquet(source)
    upsert.upsert_stream(rows, state, str(tmp_path / "c"), *args).trigger(availableNow=True).start().awaitTermination()
    assert {(r.k, r.v) for r in upsert.latest(spark.read.parquet(state), *args).collect()} == {(1, "z"), (2, "c")}


def test_special_occurrences_are_those_of_all_occurrences(spark):
    texts = ["بٓ\t\\ٗé😀ٰ" + "x" * 30 + "ۤ", "", None, "ٓ", "ٓٗ" * 40, "none"]
    segs = spark.createDataFrame([(i, 0, 0, t) for i, t in enumerate(texts)], "doc_id int, paragraph int, segment int, text string")
    expected = audit.occurrences(segs).where("special").select("doc_id", "paragraph", "segment", "pos", sc.codepoint_label(F.col("ch")), "context")
    found = audit.special_occurrences(segs)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) and found.count() == 85
    assert "transform(" not in found._jdf.queryExecution().executedPlan().toString()

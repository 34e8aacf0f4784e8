"""Every operator has its query; the pipeline keeps what it should on the smallest table."""

import random
from collections import Counter

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__
from glyphweave.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"


def test_names():
    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", ["op3_ngram_join", "op4_embedding_join", "op5_line_dedup", "op7_secret_scan"])
def test_sql_agrees(spark, name):
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL")
    frame = __spark_entry__.queries()[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    relation = con.sql(sql)
    order = sorted(frame.columns)
    assert sorted(relation.columns) == order
    theirs = sorted(str(tuple(row[relation.columns.index(c)] for c in order)) for row in relation.fetchall())
    assert sorted(str(tuple(r[c] for c in order)) for r in frame.collect()) == theirs


def test_pipeline_decides_as_brute_force_does(spark, docs_of, edge_rows):
    rng = random.Random(21)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    rows = []
    for i in range(60):
        words = line(60).split()
        rows.append((100 + 3 * i, "\n".join([" ".join(words[:30]), " ".join(words[30:])])))
        if i % 2:  # a near copy on one line, which no line of the first equals
            words[rng.randrange(60)] = "changed"
            rows.append((101 + 3 * i, " ".join(words)))
        if i % 5 == 0:  # a repeated line and one of its own
            rows.append((102 + 3 * i, rows[-1][1].split("\n")[0] + "\n" + line(12)))
    docs = docs_of(rows + edge_rows)
    for stage in (corpus_pipeline.quality, corpus_pipeline.lines, corpus_pipeline.near_duplicates, corpus_pipeline.sources):
        assert stage(spark, docs.limit(0), DATA).columns == docs.columns
    done = {r.doc_id: r for r in corpus_pipeline.lines(spark, docs_of(rows), DATA).collect()}
    seen = set()
    for i, t in rows:
        kept = [x for x in t.split("\n") if x.strip() not in seen]
        seen |= {x.strip() for x in t.split("\n")}
        assert done[i].text == "\n".join(kept) and done[i].n_chars == len(done[i].text) if kept else i not in done
    texts = {i: r.text for i, r in done.items()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    gone = {b for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    left = corpus_pipeline.near_duplicates(spark, docs_of(list(texts.items())), DATA).collect()
    assert gone and {r.doc_id for r in left} == set(texts) - gone
    mixed = corpus_pipeline.sources(spark, docs_of([(r.doc_id, r.text) for r in left]), DATA).collect()
    times = Counter(r.doc_id for r in mixed)
    assert set(times) == {r.doc_id for r in left} and max(times.values()) <= 2
    pieces = corpus_pipeline.packing(spark, docs_of([(r.doc_id, r.text) for r in mixed]), DATA).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(r.length for r in pieces) == wanted


def test_rows_come_in_the_order_of_the_mix(spark, docs_of):
    docs = docs_of([(i, f"word {i} " * (i % 7 + 1)) for i in range(300)])
    found = [r.doc_id for r in corpus_pipeline.sources(spark, docs, DATA).collect()]
    counted = docs.withColumn("n", corpus_pipeline.count_tokens(docs["text"], tokenizer_path()))
    mixed = corpus_pipeline.mix(counted, repeats=corpus_pipeline.REPEATS, tokens="n").collect()
    assert found == [r.doc_id for r in sorted(mixed, key=lambda r: (r.mix_epoch, r.mix_order, r.doc_id))]
    assert len(found) > 300 and all(a != b for a, b in zip(found, found[1:]))

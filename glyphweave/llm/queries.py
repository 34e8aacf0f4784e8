"""Queries over the driver's tables, one for each operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table
from .embedding_join import near_vectors
from .html_extraction import extract_main_text
from .line_dedup import dedup_lines
from .media import encode_texts, media_features
from .mixing import mix
from .ngram_join import ngram_join
from .packing import pack
from .quality import classify, train
from .secret_scan import RULES, scan_versions, spans_string
from .substring_dedup import substring_dedup
from .tokens import count_tokens

#: Times that mixing uses a document at most.
REPEATS = 2.0


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = encode_texts(read_table(spark, sf_dir, "documents"))
    read = media_features(stored, keep=("doc_id", "n_bytes"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return classify(docs, train(docs, read_table(spark, sf_dir, "labels"))).drop("text")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join(docs, size=4, num=85, den=100)


def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


_OP3_SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS c FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a)
    SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id"""

_OP5_SQL = r"""
    WITH a AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM a),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t FROM l WHERE regexp_matches(line, '\S')),
    z AS (SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= 5 AS long FROM f),
    q AS (SELECT doc_id, k, t, long, lead(t) OVER (PARTITION BY doc_id ORDER BY k) AS u, lead(long) OVER (PARTITION BY doc_id ORDER BY k) AS next_long FROM z),
    w AS (SELECT doc_id, k, 1 AS n, t AS body FROM q WHERE long UNION ALL SELECT doc_id, k, 2, t || chr(10) || u FROM q WHERE u IS NOT NULL AND NOT (long AND next_long)),
    o AS (SELECT *, row_number() OVER v AS nth, first_value(doc_id) OVER v AS first_doc, first_value(k) OVER v AS first_k FROM w WINDOW v AS (PARTITION BY body ORDER BY doc_id, k)),
    r AS (SELECT *, k + unnest(range(n)) AS line FROM o WHERE nth > 1),
    g AS (SELECT DISTINCT doc_id, line AS k FROM r WHERE NOT (first_doc = doc_id AND line BETWEEN first_k AND first_k + n - 1)),
    m AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.k IS NULL) AS text, count(f.k) AS n_lines, count(g.k) AS n_removed
          FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN g ON g.doc_id = f.doc_id AND g.k = f.k GROUP BY l.doc_id)
    SELECT a.doc_id, CASE WHEN n_removed > 0 THEN coalesce(m.text, '') ELSE a.text END AS text, n_lines, n_removed FROM a JOIN m ON m.doc_id = a.doc_id"""

_OP4_SQL = """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
    r AS (SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a),
    c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a),
    k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM v JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


def tokenizer_path() -> str:
    """Public tokenizer file of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_versions(spark, read_table(spark, sf_dir, "documents"), "doc_id", "text")
    kinds = F.col("spans")["kind"]
    counts = [F.size(F.filter(kinds, F.lit(i).__eq__)).cast("bigint").alias(f"n_{r.kind}") for i, r in enumerate(RULES)]
    listed = found.select(F.col("path").alias("doc_id"), *counts, spans_string(F.col("spans")).alias("spans"))
    return listed.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


def _op7_sql() -> str:
    quoted = ["'" + r.pattern.replace("'", "''") + "'" for r in RULES]
    each = " UNION ALL ".join(f"SELECT doc_id, {i} AS kind, '{r.kind}' AS name, regexp_extract_all(t, {q}, 0) AS hits, string_split_regex(t, {q}) AS gaps FROM d" for i, (r, q) in enumerate(zip(RULES, quoted, strict=True)))
    good = " OR ".join(f"(kind = {i} AND length(regexp_extract(hit, {q}, {r.group})) >= {r.least})" for i, (r, q) in enumerate(zip(RULES, quoted, strict=True)))
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({each}),
        u AS (SELECT doc_id, kind, name, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM m WHERE len(hits) > 0),
        p AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM u),
        f AS (SELECT doc_id, kind, name || ':' || (stop - length(hit))::BIGINT || ':' || stop::BIGINT AS span, stop - length(hit) AS start FROM p WHERE {good}),
        g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) AS spans FROM f GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (doc_id)"""



def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = F.col("doc_id"), F.col("source"), count_tokens(F.col("text"), tokenizer_path()).alias("n_tokens")
    docs = Scratch(spark, "mixing").save(read_table(spark, sf_dir, "documents").select(*counted), "tokens")
    return mix(docs, repeats=REPEATS, tokens="n_tokens").drop("n_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_quality": op2_quality,
    "op3_ngram_join": op3_ngram_join,
    "op4_embedding_join": op4_embedding_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_html_extraction": op10_html_extraction,
}

#: DuckDB SQL for those queries that SQL can express at this size.
ORACLE_SQL: dict[str, str] = {
    "op3_ngram_join": _OP3_SQL,
    "op4_embedding_join": _OP4_SQL,
    "op5_line_dedup": _OP5_SQL,
    "op7_secret_scan": _op7_sql(),
}

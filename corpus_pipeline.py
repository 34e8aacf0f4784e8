"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next one's input.
Near duplicates are taken by shingles of five words and a similarity of 0.8 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphweave.llm.common import Scratch, read_table
from glyphweave.llm.line_dedup import dedup_lines
from glyphweave.llm.mixing import mix
from glyphweave.llm.ngram_join import ngram_join
from glyphweave.llm.packing import pack
from glyphweave.llm.quality import classify, train
from glyphweave.llm.queries import REPEATS, tokenizer_path
from glyphweave.llm.tokens import count_tokens

#: The result has no SQL: a trained model and a tokenizer decide it.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier accepts.

    Null texts count as empty and are judged like others; a very long text is judged whole; equal rows get equal
    verdicts; without labels of both kinds, or on an empty table, all rows stay. An extra column named like a score gets the score.
    """
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return classify(docs, model).where("accepted").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete repeated runs of lines, and documents of which nothing is left; n_chars follows the text.

    Null and empty texts, from which nothing is deleted, stay; of equal texts the one with the least doc_id (a null one
    first) stays whole; an empty table stays empty. An extra column named like one of the operator's gets its values.
    """
    done = dedup_lines(docs)
    kept = done.where((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    text_length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.select(*(text_length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the least doc_id.

    Rows without words link with nothing and stay, as do rows without doc_id; rows that share a doc_id are one document
    and stay or go together; an empty table stays empty. Other columns pass through.
    """
    found = ngram_join(docs)
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat small sources to flatten their shares of tokens; every document stays at least once.

    Rows are in the order of the mix. A null source is one of its own; a null or empty text takes no tokens and is
    used as its block is; repeated rows stay; an empty table stays empty. An extra column named like one of the mix's
    gets its values.
    """
    order = ("mix_epoch", "mix_order", "doc_id")
    counted = Scratch(spark, "mixing").save(docs.withColumn("__tokens", count_tokens(F.col("text"), tokenizer_path())), "tokens")
    return mix(counted, repeats=REPEATS, tokens="__tokens").repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; a null or empty text is its closing id alone, an empty table gives no piece."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", sources),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

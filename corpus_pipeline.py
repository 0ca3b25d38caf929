"""A corpus pipeline of five of the training-data operators, each stage written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm import bpe, decontaminate, exact_dedup, quality, similar
from barmill.llm.common import written
from barmill.llm.queries import tokenizer


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the pairwise quality ranking predicts to be poor go; a null text counts as empty, rows that repeat are judged alike."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (a null one equals an empty one) one row stays, that with the largest id; a null id is less than any other."""
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose five-word shingle sets have a similarity of 0.8 or more, linked, the row with the smallest id stays; texts without words are one group."""
    return similar.drop_similar(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or a shorter item as a whole, go; a null text has no words and stays."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents", n=10)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): what remains as token ids, with the text that they decode to; a null text becomes empty."""
    coded = bpe.round_trip(docs, tokenizer())
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]
#: Fitted scores and fingerprints are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; an empty table gives an empty result. Further columns are kept up to the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

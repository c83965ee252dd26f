"""From raw documents to packed training sequences: the stages, and a run over all of them.

Every stage works on what its predecessor kept, written as Parquet and read again, and all
but the last return the columns of ``documents``.

In every stage: a null or empty text is a clean document without words or tokens and stays;
rows without a doc_id are judged by their text, and near dedup keeps them; rows that repeat a
doc_id are one document, which stays or goes as a whole; ties go to the smallest doc_id;
other columns, whatever their names, are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purseflow.llm.op02_packing import pack_documents
from purseflow.llm.op03_toxicity import score, train
from purseflow.llm.op04_setsketch import near_duplicates
from purseflow.llm.op05_decontamination import decontaminate
from purseflow.llm.op10_line_runs import dedup_lines
from purseflow.llm.registry import modest_batches
from purseflow.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic (score below 0.5); others keep text and columns."""
    modest_batches(spark)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(*COLUMNS), model).where("score < 0.5").drop("score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that loses every worded line goes.

    ``n_chars`` follows the text where lines went; an untouched document keeps all columns.
    """
    modest_batches(spark)
    done = dedup_lines(docs.select(*COLUMNS))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return (
        done.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
        .withColumn("n_chars", changed)
        .select(*COLUMNS)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest doc_id.

    If that document comes in several rows, all of them stay.
    """
    modest_batches(spark)
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    # dropped documents grow with the input, so they are not broadcast at any size
    return docs.select(*COLUMNS).join(gone.hint("merge"), F.col("doc_id") == F.col("_gone"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    modest_batches(spark)
    return decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, as pieces of the documents that are left."""
    modest_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: learned scores and packing by local search have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

"""The corpus pipeline: five stages over the documents, each an operator of the llm subpackage.

Toxic documents go, one row of equal texts stays, one document of each near-duplicate group
stays, documents that hold benchmark items go, and what is left is encoded into pieces. Every
stage takes null ids, null and empty texts, repeated rows and columns of any name; of an empty
table it makes an empty one, and whole texts are read, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.llm.decontamination import drop_contaminated
from wayweave.llm.exact_dedup import drop_copies
from wayweave.llm.language_id import held_out
from wayweave.llm.ngram_join import drop_near_copies
from wayweave.llm.queries import PIECES
from wayweave.llm.sentence_pieces import encode_documents, load
from wayweave.llm.toxicity import fit, toxicity
from wayweave.plans.workspace import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score below 0.5; labels are learned as in op2.

    Null texts score as empty ones. Repeated rows share their score; without labels all have the prior's.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    return docs.filter(toxicity(spark, F.col("text"), model) < 0.5)


def drop_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of each text; null and empty are one text, null ids lose.

    Rows that repeat the id that stays, with its text, all stay.
    """
    return drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of linked documents; texts without words stay."""
    return drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without any benchmark item; null and empty texts hold none."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document that is left; see encode_documents."""
    return encode_documents(docs, load(PIECES))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_equal),
    ("n-gram Jaccard join", drop_near),
    ("benchmark decontamination", drop_leaks),
    ("sentence pieces", encode),
]

#: A trained model and a segmentation search are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    ws = Workspace(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)

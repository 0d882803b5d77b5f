"""The subpackage's queries over the standard tables, and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.llm import language_id, toxicity
from wayweave.llm.decontamination import find_items
from wayweave.llm.exact_dedup import exact_dedup
from wayweave.llm.fingerprints import compare_edited, fit_rarity
from wayweave.llm.license_scan import scan_licenses
from wayweave.llm.ngram_join import jaccard_components
from wayweave.llm.oracles import ORACLES as ORACLES
from wayweave.llm.periodic_runs import find_runs, run_digests, with_planted_runs
from wayweave.llm.sentence_pieces import encode_documents, load
from wayweave.llm.sharding import assign_shards
from wayweave.llm.suffix_dedup import remove_repeats
from wayweave.llm.url_filter import judge_urls
from wayweave.llm.whitening import whiten

#: Verdict, host and path of the url rules.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Vocabulary of op10; a parameter of the operator.
PIECES = os.environ.get("WAYWEAVE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~kept))
    found = docs.select("doc_id", kept.alias("held_out"), language_id.identify(spark, F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kept = language_id.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.filter(~kept))
    scored = docs.select("doc_id", kept.alias("held_out"), toxicity.toxicity(spark, F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), load(PIECES))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compare_edited(docs, fit_rarity(docs))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(find_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_decontamination": op4_decontamination,
        "op5_ngram_join": op5_ngram_join,
        "op6_license_scan": op6_license_scan,
        "op7_sharding": op7_sharding,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_url_filter": op9_url_filter,
        "op10_sentence_pieces": op10_sentence_pieces,
        "op11_fingerprints": op11_fingerprints,
        "op12_whitening": op12_whitening,
        "op13_periodic_runs": op13_periodic_runs,
    }

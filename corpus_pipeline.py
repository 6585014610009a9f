"""Stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes all rows that the one before has kept. Null and empty texts fail the quality rules' base counts and end there; rows without an id
are never told apart, so the deduplication stages leave them; rows of one id stay or go together, so a row that is repeated whole stays repeated;
an empty table goes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, table
from coursemill.llm.mixing import fit_mix, select_by_rate
from coursemill.llm.pieces import encode
from coursemill.llm.rules import quality_rules
from coursemill.llm.simhash import simhash
from coursemill.llm.substring import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
FACTORS = {"clean": 1.0, "low": 0.3, "toxic": 0.3}  # what is most likely clean is spared whatever its rate


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose n-grams are as likely in trusted text as in the corpus, or nearly so."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return quality_rules(docs, trusted, carry=COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates: fingerprints of three-word shingles that two bits or fewer tell apart."""
    first = simhash(docs).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(first, "doc_id", "left_semi")
    return named.unionByName(docs.filter("doc_id is null")).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words or more that a smaller id has too; every document stays."""
    kept = substring_dedup(docs, carry=["lang", "source"])
    text = F.col("kept_text")
    return kept.select("doc_id", text.alias("text"), "carried.lang", "carried.source", F.length(text).cast("bigint").alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that come once or more in a mixture with three tenths of the low-quality and toxic words that are there."""
    model, rates, _ = fit_mix(docs, table(spark, sf_dir, "labels"), factors=FACTORS)
    return select_by_rate(docs.select(*COLUMNS), model, rates)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return encode(docs, ["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("mixing", mixing),
    ("sentencepiece", pieces),
]

#: Hashes, a fitted mixture and subword pieces are beyond SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs

"""From raw documents to packed training sequences: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontam, packing, pii, simhash, toxicity
from ledgerloom.session import stage_table


def _fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores below one half stay, null and empty texts among them; every row is judged
    by itself, columns stay as they are."""
    grammar = toxicity.learn(toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    score = _fresh("toxicity", docs.columns)
    return toxicity.scored(docs, grammar, score).where(F.col(score) < 0.5).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints one row stays, that with the smallest doc_id; rows are judged by themselves,
    so copies go also where they share their doc_id with another text or have none. Null and empty texts link to each
    other, so one of them stays. Columns stay as they are."""
    return simhash.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the contract's rule stay, each row judged by itself; those without words
    stay, and all of them where the benchmark is empty."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, with personal data and secrets masked; null texts stay null."""
    return pii.masked(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences; a null text has one piece, the end id."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SimHash, the learned grammar and the tokenizer have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs

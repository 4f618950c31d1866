"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, documents, folder of the tables) and gives a DataFrame. ``run`` writes what a stage gives to
the shared folder and reads it back for the next one, so a lost executor costs at most the stage at work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewake.llm import decontamination, packing, pii, quality, simhash
from tradewake.sources import discard, read_table, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The secret of the pseudonyms for tests and queries; a real run gives ``run`` one from its own store of secrets.
PII_KEY = "tradewake-corpus"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, does not reject."""
    return quality.good_documents(docs, read_table(spark, f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.one_of_each_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_benchmark(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str, key: str = PII_KEY) -> DataFrame:
    """The documents with pseudonyms in place of personal numbers, dates and addresses."""
    return pii.pseudonyms(docs, key)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("pii", pseudonymised),
    ("packing", packed),
]

#: Fingerprints, the classifier and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, pii_key: str = PII_KEY) -> DataFrame:
    """All stages over the table of documents; a stage's copy is deleted when the next one's is complete."""
    docs, before = read_table(spark, f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir, pii_key) if stage is pseudonymised else stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs

"""Corpus preparation: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsluice.llm.common import documents, stored, tokenizer_path
from rowsluice.llm.decontaminate import Decontaminator
from rowsluice.llm.jaccard import JaccardJoin
from rowsluice.llm.packing import Packer
from rowsluice.llm.pii import ContextExtractor
from rowsluice.llm.quality import LineFrequency


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, without boilerplate lines."""
    return LineFrequency().cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar ones."""
    return JaccardJoin().representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return Decontaminator().clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return ContextExtractor().redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document's pieces and their place in sequences."""
    return Packer(tokenizer_path()).placed(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", redacted),
    ("best-fit packing", packed),
]
# The tokenizer cannot be expressed in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs

"""From raw documents to packed training sequences.

Five stages, each over everything that the one before it kept: documents of low quality go, one
document of each group of near copies stays, secrets are masked, sources are mixed to their
target weights (a document may be taken twice, or not at all), and the mix is packed.

Every stage takes null ids, null and empty texts, repeated rows and extra columns, and an empty table gives
an empty one. Texts are judged, compared, masked, measured and packed whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidequote.llm.minhash import keep_one
from tidequote.llm.mixing import taken
from tidequote.llm.packing import pack
from tidequote.llm.quality import keep_good, train
from tidequote.llm.secret_scan import mask_secrets
from tidequote.sources.landing import land


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 1) accepts, rows as they are; a null text is judged as an empty one.

    Without labels the network is as it was drawn, and so are its decisions.
    """
    return keep_good(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5; five-word shingles, 0.8 or more).

    The smallest id stays; rows without words or without an id stay, and of rows equal in id and text one.
    """
    return keep_one(docs, words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets (operator 6) masked; a null text stays null."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources (operator 7) takes them; a null source is one of its own."""
    return taken(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens (operator 2); a null text is one token."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# A learned classifier, sampling and packing are not SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs

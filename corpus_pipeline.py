"""Corpus preparation in five stages: quality, language, near duplicates, benchmark passages, mixing.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns a
DataFrame; it is written as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``. Rows with a null or shared ``doc_id`` pass the stages like any
other; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.llm.decontaminate import drop_contaminated_rows
from geoweave.llm.language import UNKNOWN, identify
from geoweave.llm.minhash import Banding, near_duplicates
from geoweave.llm.mixing import mix
from geoweave.llm.quality import quality_scores
from geoweave.session import ensure_checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null and blank texts go."""
    scored = quality_scores(docs, _table(spark, sf_dir, "labels"), keep=docs.columns)
    return scored.filter("accepted").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in one of the learnt languages, and in the one they are filed under.

    A row goes when its text has no letter, or when the classifier is sure (score 0.75 or more) of a
    language other than its ``lang``; rows without ``lang`` stay."""
    found = identify(docs.withColumnRenamed("text", "_body").withColumn("text", F.col("_body")), keep=[*docs.columns, "_body"])
    other = F.col("lang").isNotNull() & (F.col("lang") != F.col("lang_pred")) & (F.col("score") >= 0.75)
    return found.filter((F.col("lang_pred") != UNKNOWN) & ~other).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the smallest id.

    Rows without an id, or with one that other rows have too, get a number above all ids from a hash of all
    their columns; those that repeat each other whole are one row."""
    high = 1 << 62
    shared = docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id", F.lit(True).alias("_shared"))
    marked = docs.join(shared, "doc_id", "left").select(*docs.columns, (F.col("doc_id").isNull() | F.col("_shared").isNotNull()).alias("_odd"))
    single = marked.filter("not _odd").withColumn("_id", F.col("doc_id").cast("long"))
    number = F.xxhash64(*docs.columns).bitwiseAND(F.lit(high - 1)).bitwiseOR(F.lit(high))
    rows = single.unionByName(marked.filter("_odd").dropDuplicates(docs.columns).withColumn("_id", number)).drop("_odd")
    found = near_duplicates(rows.select("_id", "text"), id_col="_id", banding=Banding(size=5, num=80, den=100))
    return rows.join(found.filter("kept").select("_id").distinct(), "_id", "left_semi").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no passage of ``benchmark``."""
    return drop_contaminated_rows(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uses of the documents that mix the sources to their target weights."""
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("mixing", mixing),
]

#: learnt classifiers and sketches have no SQL form; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs

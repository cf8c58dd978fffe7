"""From raw documents to shards: each stage calls one operator and returns what it keeps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandframe.llm.common import shared_folder
from strandframe.llm.decontaminate import contaminated
from strandframe.llm.karmarkar_karp import shards
from strandframe.llm.minhash_dedup import near_duplicates
from strandframe.llm.mixing import mixed
from strandframe.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the one with the least doc_id; of repeated rows one."""
    kept = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    same = docs["doc_id"].eqNullSafe(kept["doc_id"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights."""
    drawn = mixed(docs).filter("selected").select("doc_id").distinct()
    return docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["doc_id"]), "left_semi")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard and place in it."""
    return shards(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing to target weights", mixing), ("sharding", sharding)]

#: SQL cannot express the classifier, so the tests compare run() with a brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        if i:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
        docs = stage(spark, docs, sf_dir)
    return docs

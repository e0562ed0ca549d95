"""Corpus pipeline: quality filter, near-duplicate removal, repeated-passage removal, benchmark
decontamination and packing of ``documents``, each stage written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barcodeforge.llm import dictionary_quality, histogram_packing, lyndon_suffixes, simhash_hamming, string_tiling
from barcodeforge.llm.common import stage_table, table
from barcodeforge.session import ensure_checkpoint_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It is trained on the labels of
    ``docs`` outside fold 0; null and empty texts score the share of good labels."""
    model = dictionary_quality.train_quality_model(docs, table(spark, sf_dir, "labels"))
    return dictionary_quality.keep_quality(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 3 or fewer fingerprint bits, the one with the smallest id (a null
    id after all others; equal ids by text hash). Repeated rows are one document. Texts without
    words have one fingerprint and so are copies of each other."""
    name = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("k"))
    found = simhash_hamming.simhash_near_duplicates(docs.select(name.alias("doc_id"), "text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id.i").alias("_i"), F.col("doc_id.k").alias("_k")).distinct()
    kept = stage_table(kept)
    key = F.xxhash64(F.col("text"))
    rows = docs.withColumn("_key", key)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_i"]) & (rows["_key"] == kept["_k"]), "left_semi")
    first = Window.partitionBy("doc_id", "_key").orderBy(F.lit(0))
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_key")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a document with a smaller id has in strings of 50 bytes;
    ``n_chars`` follows; documents with nothing of their own go."""
    return lyndon_suffixes.remove_repeats(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return string_tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their places in sequences of 2048 tokens."""
    return histogram_packing.pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: compressed sizes, fingerprints and token ids have no SQL; the tests hold every stage against
#: a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, through Parquet tables in the shared folder."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

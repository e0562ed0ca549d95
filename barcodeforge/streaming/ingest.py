"""Incremental ingest of sequence files with Structured Streaming.

The pipeline itself is batch. Sequence downloads, however, arrive as files over time; the
FASTA parsing (S5) and the sequence normalisation are stateless, so they run unchanged on a
streaming DataFrame and land new records in a Parquet table that the batch operators read.
Exactly-once output comes from the checkpoint location (a shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barcodeforge.operators.cleaning import fasta_accession, normalise_sequence
from barcodeforge.sources.io import fasta_records


def fasta_stream(spark: SparkSession, directory: str, glob: str = "*.fa*", max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming (header, accession, sequence, file) records from FASTA files added to ``directory``."""
    raw = (spark.readStream.format("text").option("lineSep", "\n>").option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", max_files_per_trigger).load(directory))
    recs = fasta_records(raw.withColumn("file", F.col("_metadata.file_path")), "file")
    return recs.withColumn("accession", fasta_accession("header")).select("header", "sequence", "file", "accession")


def ingest_fasta(spark: SparkSession, directory: str, table_path: str, checkpoint: str,
                 normalise: bool = False, available_now: bool = True) -> StreamingQuery:
    """Append newly arrived FASTA records to a Parquet table (``availableNow`` by default:
    process what is there, then stop)."""
    recs = fasta_stream(spark, directory)
    if normalise:
        recs = recs.withColumn("sequence", normalise_sequence("sequence"))
    w = recs.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.outputMode("append").start()

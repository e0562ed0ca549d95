"""FASTA records of any length (S5): read by lines, handed on as overlapping chunks.

No row ever holds a whole record. A task joins the lines that it reads to pieces; where a record
runs through several file blocks, a prefix scan over one row per block tells each piece its
record and its place in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barcodeforge.operators.partitioning import materialize

CHUNK = 1 << 20    # letters of a chunk, without the overlap
OVERLAP = 1 << 12  # letters that a chunk shares with the next one

_PIECES = "file string, block bigint, number bigint, record bigint, header string, start bigint, letters bigint, piece string"


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows ``file, block, value`` of text lines, in order, as pieces of at most ``size`` letters and a
    line. ``record`` counts the headers of the block so far (0: goes on from the block before) and
    ``start`` the letters since the last of them. A header is a piece without letters."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    at, number, record, start, held, letters = None, 0, 0, 0, [], 0
    out: list[tuple] = []

    def close() -> None:
        nonlocal number, start, letters
        if held:
            out.append((*at, number, record, None, start, letters, "".join(held)))
            number, start, letters = number + 1, start + letters, 0
            held.clear()

    for batch in batches:
        for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
            if at != (file, block):
                if at is not None:
                    close()
                at, number, record, start = (file, block), 0, 0, 0
                out.append((*at, -1, 0, None, 0, 0, None))  # a block without a line of text counts, too
            if line.startswith(">"):
                close()
                record, start = record + 1, 0
                out.append((*at, number, record, line[1:].removesuffix("\r"), 0, 0, None))
                number += 1
            elif text := "".join(line.split()):
                held.append(text)
                letters += len(text)
                if letters >= size:
                    close()
        if out:
            if held and len(out) > 1000:
                close()
            yield pa.RecordBatch.from_arrays([pa.array(c) if k not in (4, 7) else pa.array(c, pa.string()) for k, c in enumerate(zip(*out, strict=True))], names)
            out.clear()
    if at is not None:
        close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) if k not in (4, 7) else pa.array(c, pa.string()) for k, c in enumerate(zip(*out, strict=True))], names)


def read_fasta_chunks(spark: SparkSession, path: str | Sequence[str], chunk: int = CHUNK, overlap: int = OVERLAP,
                      glob: str | None = None) -> DataFrame:
    """``file, record, header, start, sequence``: FASTA records (numbered from 1 in each file) in chunks
    that begin at multiples of ``chunk`` letters (``start``, from 0) and hold up to ``chunk +
    overlap``. A chunk that would lie wholly in the overlap of the one before is left out; a
    record without letters is one empty chunk. White space is dropped; lines before the first
    header belong to no record.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = materialize(lines.mapInArrow(lambda batches: _pieces(batches, chunk), _PIECES))

    # one row per block of a file: how many headers, how many letters, and those after the last header
    blocks = pieces.groupBy("file", "block").agg(
        F.max("record").alias("headers"), F.sum("letters").alias("letters"),
        F.max(F.struct("record", (F.col("start") + F.col("letters")).alias("end"))).alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"_records": F.coalesce(F.sum("headers").over(before), F.lit(0)),
                                 "_upto": F.coalesce(F.sum("letters").over(before), F.lit(0))})
    # the letter at which a block's last header stands, counted through the file
    header_at = F.when(F.col("headers") > 0, F.col("_upto") + F.col("letters") - F.col("last.end"))
    blocks = blocks.withColumn("_header_at", header_at)
    blocks = blocks.withColumn("_since", F.col("_upto") - F.coalesce(F.max("_header_at").over(before), F.lit(0)))
    blocks = blocks.select("file", "block", "_records", "_since")

    placed = pieces.join(blocks, ["file", "block"]).select(
        "file", (F.col("_records") + F.col("record")).alias("record"), "header", "piece", "letters",
        (F.col("start") + F.when(F.col("record") == 0, F.col("_since")).otherwise(0)).alias("start")).filter("record > 0")
    headers = placed.filter("header is not null").select("file", "record", "header")
    whole = placed.groupBy("file", "record").agg(F.sum("letters").alias("_size"))
    # a piece goes to every chunk that it reaches into, cut to it
    first = F.greatest(F.floor((F.col("start") - F.lit(overlap)) / chunk), F.lit(0))
    last = F.floor((F.col("start") + F.col("letters") - 1) / chunk)
    parts = (placed.filter("letters > 0").withColumn("_k", F.explode(F.sequence(first, last)))
             .withColumn("_low", F.greatest(F.col("_k") * chunk, "start"))
             .withColumn("_high", F.least(F.col("_k") * chunk + chunk + overlap, F.col("start") + F.col("letters"))).filter("_low < _high"))
    parts = parts.select("file", "record", "_k", "_low", F.substring(
        F.col("piece"), (F.col("_low") - F.col("start") + 1).cast("int"), (F.col("_high") - F.col("_low")).cast("int")).alias("_text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_low", "_text"))), lambda x: x["_text"]), "")
    chunks = parts.groupBy("file", "record", "_k").agg(text.alias("sequence"))
    named = headers.join(whole, ["file", "record"]).join(chunks, ["file", "record"], "left")
    needed = (F.coalesce("_k", F.lit(0)) == 0) | (F.col("_size") > F.col("_k") * chunk + overlap)
    return named.filter(needed).select("file", "record", "header", (F.coalesce("_k", F.lit(0)) * chunk).cast("bigint").alias("start"),
                                       F.coalesce("sequence", F.lit("")).alias("sequence"))

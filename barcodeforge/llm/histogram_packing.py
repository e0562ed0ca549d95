"""Packing tokenised documents into fixed-length sequences: shortest-pack-first over the
histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.llm import common as C
from barcodeforge.llm.distinct_chunks import ChunkEncoder, byte_bpe, per_worker

MAX_TOKENS = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k"
#: rows of one length that are ranked together; a more frequent length is ranked in several parts
RANK_ROWS = 100_000
#: text bytes of which equal chunks are found together
ENCODED_BYTES = 1 << 21


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                 max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens[, ids]``: every document's ids, ended by
    ``end_id`` and cut every ``max_tokens`` ids. A null or empty text has the end id alone.

    All ids are those of the ``tokenizers`` file; equal chunks of a worker's texts are encoded
    once (see :mod:`distinct_chunks`), and a very long text is many chunks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

    def run(batches):
        import public_tokenizers

        path = public_tokenizers.path(f"{tokenizer}.json")
        encode = per_worker(f"ids {path}", lambda: ChunkEncoder(byte_bpe(path), fine=True))
        for part in C.passes(batches, "text", ENCODED_BYTES):
            ((ids, cuts),), _ = encode(*C.text_bytes(part.column("text")))
            row, out, kept = [], [], []
            for k in range(part.num_rows):
                raw = np.append(ids[cuts[k]:cuts[k + 1]], end_id).astype("<u4")
                for start in range(0, len(raw), max_tokens):
                    piece = raw[start:start + max_tokens]
                    row.append(k)
                    out.append((start, len(piece), zlib.crc32(piece.tobytes()), len(raw)))
                    if with_ids:
                        kept.append(piece.astype(np.int64))
            columns = [part.column("doc_id").take(pa.array(row, pa.int64()))]
            columns += [pa.array(c) for c in np.array(out, dtype=np.int64).reshape(-1, 4).T]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)
            pa.default_memory_pool().release_unused()  # the worker lives on while others work

    return rows.mapInArrow(run, schema + ", ids array<bigint>" * with_ids)


def shortest_pack_first(histogram: Iterable[tuple[int, int]], max_tokens: int = MAX_TOKENS) -> list[tuple[tuple, int]]:
    """Packing patterns ``(lengths, count)`` of a length histogram ``(length, count)``.

    Lengths are placed longest first. All pieces of a length go to the packs that are shortest
    so far, as many as there are of that pattern; a pattern that takes only some of them is
    split in two. Where even the shortest pack has no room, new packs are opened. The work and
    the result depend on the number of lengths, at most ``max_tokens``, not on the pieces.
    """
    packs: dict[int, list[list]] = {}  # tokens so far -> [[lengths, count], ...]
    sizes: list[int] = []  # their keys, a heap
    import heapq

    def put(size: int, lengths: tuple, count: int) -> None:
        if size not in packs:
            packs[size] = []
            heapq.heappush(sizes, size)
        packs[size].append([lengths, count])

    for length, left in sorted(histogram, reverse=True):
        opened = []
        while left:
            if not sizes or sizes[0] + length > max_tokens:
                opened.append((length, (length,), left))
                break
            size = sizes[0]
            lengths, count = packs[size][-1]
            take = min(count, left)
            left -= take
            if take == count:
                packs[size].pop()
                if not packs[size]:
                    del packs[heapq.heappop(sizes)]
            else:
                packs[size][-1][1] -= take
            # more pieces of this length may follow into the same pack once no shorter one is left
            put(size + length, (*lengths, length), take)
        for x in opened:
            put(*x)
    return [(tuple(lengths), count) for size in sorted(packs) for lengths, count in packs[size]]


def slot_table(patterns: list[tuple[tuple, int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, from_rank, to_rank, sequence, offset)``: pieces of ``length`` with a rank in
    ``[from_rank, to_rank)`` go to ``sequence + rank - from_rank`` at ``offset``."""
    used: dict[int, int] = {}
    slots, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            used[length] = rank + count
            slots.append((length, rank, rank + count, sequence, offset))
            offset += length
        sequence += count
    return slots


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                   max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in a packed sequence.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]``.
    Pieces are ranked among those of equal length by ``(doc_id, start, ids_crc32)``, in hashed
    parts where a length is frequent, and take the pattern slot of their rank. Only the
    histogram (at most ``max_tokens`` rows) and the slots made from it pass the driver.
    Null and empty texts are one piece with the end id; repeated rows are packed each; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = C.stage_table(token_pieces(docs, id_col, text_col, tokenizer, max_tokens, end_id, with_ids))
    histogram = [tuple(r) for r in pieces.groupBy("length").count().collect()]
    slots = slot_table(shortest_pack_first(histogram, max_tokens))
    parts = {n: -(-c // RANK_ROWS) for n, c in histogram if c > RANK_ROWS}
    n_parts = F.lit(1)
    for n, k in parts.items():
        n_parts = F.when(F.col("length") == n, F.lit(k)).otherwise(n_parts)
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), n_parts.cast("bigint")).cast("int"))
    sizes = [tuple(r) for r in pieces.groupBy("length", "part").count().collect()] if parts else \
        [(n, 0, c) for n, c in histogram]
    before: dict[int, int] = {}
    firsts = []
    for n, part, c in sorted(sizes):
        firsts.append((n, part, before.get(n, 0)))
        before[n] = before.get(n, 0) + c
    first = F.broadcast(spark.createDataFrame(firsts, "length bigint, part int, first bigint"))
    slot = F.broadcast(spark.createDataFrame(
        slots, "slot_length bigint, from_rank bigint, to_rank bigint, sequence bigint, offset bigint"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = (pieces.withColumn("rank", F.row_number().over(order)).join(first, ["length", "part"])
              .withColumn("rank", F.col("rank") - 1 + F.col("first")))
    placed = ranked.join(slot, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("from_rank"))
                         & (F.col("rank") < F.col("to_rank")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("sequence") + F.col("rank") - F.col("from_rank")).alias("sequence_id"), "offset",
                         *["ids"] * with_ids)


def op10(spark, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents"))

"""Helpers shared by the operators: byte views of Arrow text columns, vectorised span hashing,
written stage tables in the shared folder, and the cross-validation fold of a document id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.operators.partitioning import materialize

#: text bytes that one numpy pass works on; a longer single text is one pass of its own
PASS_BYTES = 1 << 20

#: white space of the word pattern ``[^\x20\x09-\x0D]+``
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def stage_table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the session's shared folder (``spark.checkpoint.dir``) and
    read back: the plan behind it is cut and a lost executor costs no earlier stage."""
    return materialize(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id written as text, modulo 5 (a null id counts as the empty text)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def sampled(hash_: Column, wanted: int, rows: int) -> Column:
    """Whether a row's hash is among the smallest that hold ``wanted`` of ``rows`` rows, five times
    over: what a sample in hash order is taken from, so that no task offers its own first rows."""
    share = min(1.0, 5 * max(wanted, 20) / max(1, rows))
    return F.lit(True) if share >= 1 else F.pmod(hash_, F.lit(1 << 30)) < int(share * (1 << 30))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (uint8) and the n+1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def passes(batches: Iterator[pa.RecordBatch], text: str, limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``limit`` text bytes (at least one row each)."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        row, n = 0, batch.num_rows
        while row < n:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(n, max(end, row + 1))
            yield batch.slice(row, end - row)
            row = end


class _Powers:
    """Powers of the hash base and of its inverse, kept per task (never shipped)."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (self._powers(b, size) for b in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=_U)
        out[0] = 1
        return np.multiply.accumulate(out, out=out)


_powers = _Powers()


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    h = h + _U(seed & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class SpanHasher:
    """64-bit polynomial hashes of any spans of one sequence (bytes or 64-bit symbols)."""

    def __init__(self, symbols: np.ndarray):
        up, self._down = _powers(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, dtype=_U)
        np.cumsum((symbols.astype(_U) + _U(1)) * up[:-1], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def every(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` symbols, by start."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, _U)
        return mix((self._sums[width:] - self._sums[:n]) * self._down[:n])


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true in ``member`` that do not cross a row boundary: starts, ends, and
    the row of each run."""
    n = len(member)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = member[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = member[1:]
    starts = np.flatnonzero(member & (~before | cut[:-1]))
    ends = np.flatnonzero(member & (~after | cut[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + c)`` for all pairs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) - np.repeat(ends - counts - starts, counts)


#: bytes of a word: ASCII letters and digits, and everything outside ASCII
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the letters U+00C0..U+00DE, in UTF-8 bytes."""
    out = LOWER[data]
    if len(out) > 1:
        second = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][second] += 0x20
    return out


def bitmap(df: DataFrame, cell: str, cells: int) -> np.ndarray:
    """The set of the values ``0 .. cells - 1`` in column ``cell``, as ``cells / 8`` bytes.

    Built by Spark in parts of 4 KB, so what reaches the driver is ``cells / 8`` bytes at most,
    however many rows there are.
    """
    value = F.col(cell) + 1
    parts = (df.select(F.bitmap_bucket_number(value).alias("part"), F.bitmap_bit_position(value).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow())
    out = np.zeros(cells // 8, dtype=np.uint8)
    for part, bits in zip(parts.column("part").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        out[(part - 1) * 4096:(part - 1) * 4096 + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    cell = cell.astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 != 0

"""Benchmark decontamination by greedy string tiling with running Karp-Rabin."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

#: words of a seed and of the shortest tile
MIN_TILE = 5
#: share of an item's words under tiles from which a document holds the item
MIN_COVERAGE = 0.8
#: cells of the seed filter (2 MB); it only saves work, the seed join is exact
FILTER_CELLS = 1 << 24
_MASK = (1 << 61) - 1


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of words: letters and digits, and all beyond ASCII but the punctuation in
    U+0080..U+00BF and U+2000..U+206F."""
    out = C.IS_WORD[data]
    if len(data) > 2:
        latin = np.flatnonzero((data[:-1] == 0xC2) & ~np.isin(data[1:], (0xAA, 0xB5, 0xBA)))
        general = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | ((data[1:-1] == 0x81) & (data[2:] < 0xB0))))
        out[latin] = out[latin + 1] = out[general] = out[general + 1] = out[general + 2] = False
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word and the n+1 word offsets of the rows."""
    data, offsets = C.text_bytes(column)
    data = C.folded(data)
    starts, ends, rows = C.spans(_letters(data), offsets)
    hashes = C.SpanHasher(data)(starts, ends)
    return hashes, np.searchsorted(rows, np.arange(len(offsets)))


def _seeds(words: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words by its first word; runs over a row end are 0."""
    out = np.zeros(len(words), dtype=np.uint64)
    found = C.SpanHasher(words).every(width)
    out[:len(found)] = found
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    out[np.arange(len(words)) + width > row_end] = 0
    return out


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, item_words, seeds``: word hashes of each item and its seed hashes by position.
    An item shorter than a seed is one seed of all its words; one without words has none."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches):
        for part in C.passes(batches, "text"):
            words, offsets = _words(part.column("text"))
            out_words, out_seeds = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                own = words[a:b]
                width = min(MIN_TILE, len(own))
                out_words.append(own.view(np.int64))
                out_seeds.append(C.SpanHasher(own).every(width).view(np.int64) if width else own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), pa.array(out_words, pa.list_(pa.int64())),
                 pa.array(out_seeds, pa.list_(pa.int64()))], ["item_id", "item_words", "seeds"])

    return rows.mapInArrow(run, f"item_id {kind}, item_words array<bigint>, seeds array<bigint>")


def document_seeds(docs: DataFrame, shared: Broadcast, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """Documents that share a seed: ``doc_id, text_key, n_words, seeds, at, words`` with the
    distinct seeds, and the word hashes under them with their positions. Only a match of whole
    seeds can become a tile, so no other word of a document is needed again. ``shared`` holds
    the bitmap of all items' seeds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "n_words", "seeds", "at", "words"]

    def run(batches):
        bits = shared.value
        for part in C.passes(batches, "text"):
            words, offsets = _words(part.column("text"))
            found, under = [np.zeros((2, 0), np.int64)], np.zeros(len(words) + 1, dtype=np.int64)
            for width in widths:
                seeds = _seeds(words, offsets, width)
                hit = np.flatnonzero((seeds != 0) & C.in_bitmap(bits, seeds % np.uint64(FILTER_CELLS)))
                found.append(np.stack([np.searchsorted(offsets, hit, side="right") - 1, seeds[hit].view(np.int64)]))
                np.add.at(under, hit, 1)
                np.add.at(under, hit + width, -1)
            hits = np.unique(np.concatenate(found, axis=1), axis=1)
            kept = np.flatnonzero(np.cumsum(under[:-1]) > 0)
            row_of = np.searchsorted(offsets, kept, side="right") - 1
            rows = np.unique(hits[0])
            cut = lambda values, of: [values[a:b] for a, b in zip(
                np.searchsorted(of, rows), np.searchsorted(of, rows, side="right"), strict=True)]
            arrays = [cut(hits[1], hits[0]), cut(kept - offsets[row_of], row_of), cut(words[kept].view(np.int64), row_of)]
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(taken), part.column("text_key").take(taken),
                 pa.array(np.diff(offsets)[rows]), *(pa.array(a, pa.list_(pa.int64())) for a in arrays)], names)

    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, n_words bigint, seeds array<bigint>, "
                                "at array<bigint>, words array<bigint>")


def _windows(words: list[int], free: list[bool], size: int):
    """``(start, hash)`` of every run of ``size`` unmarked words: a Karp-Rabin hash that takes in
    one word and drops one at each step, and starts anew behind a marked word."""
    base, top = 1_000_003, pow(1_000_003, size - 1, _MASK)
    value = run = 0
    for k, word in enumerate(words):
        if not free[k]:
            value = run = 0
            continue
        if run == size:
            value = (value - words[k - size] * top) % _MASK
        else:
            run += 1
        value = (value * base + word) % _MASK
        if run == size:
            yield k - size + 1, value


def _scan(pattern, p_free, text, t_free, size) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches of at least ``size`` words: ``(length, in pattern, in text)``."""
    table: dict[int, list[int]] = {}
    for at, value in _windows(text, t_free, size):
        table.setdefault(value, []).append(at)
    found = []
    for p, value in _windows(pattern, p_free, size):
        for t in table.get(value, ()):
            if p and t and p_free[p - 1] and t_free[t - 1] and pattern[p - 1] == text[t - 1]:
                continue  # not maximal: found from its first word
            n = 0
            while p + n < len(pattern) and t + n < len(text) and p_free[p + n] and t_free[t + n] \
                    and pattern[p + n] == text[t + n]:
                n += 1
            if n >= size:
                found.append((n, p, t))
    return found


def tile(pattern: list[int], text: list[int], min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles ``(length, in pattern, in text)`` of common, non-overlapping
    word runs, longest first (ties: first in the pattern, then in the text).

    Each round looks for matches of at least ``size`` words with a running Karp-Rabin hash,
    verifies them word by word and marks the longest that still do not overlap; a match that
    lost a part to another is found again, shortened, in a later round. ``size`` falls from
    the pattern's length by halves to ``min_tile``.
    """
    p_free, t_free = [True] * len(pattern), [True] * len(text)
    tiles: list[tuple[int, int, int]] = []
    size = max(min_tile, min(len(pattern), len(text)) // 2)
    while len(pattern) >= min_tile:
        found = sorted(_scan(pattern, p_free, text, t_free, size), key=lambda m: (-m[0], m[1], m[2]))
        cut = False
        for n, p, t in found:
            if all(p_free[p:p + n]) and all(t_free[t:t + n]):
                p_free[p:p + n] = t_free[t:t + n] = [False] * n
                tiles.append((n, p, t))
            else:
                cut = True
                break  # a longer remainder of this one may come before the next
        if cut:
            continue
        if size == min_tile:
            return tiles
        size = max(min_tile, size // 2)
    return tiles


def _text(at, words) -> list[int]:
    """A document's kept words, with a gap (a value no word has) between separate runs."""
    out, last = [], None
    for a, w in zip(at, words, strict=True):
        if last is not None and a != last + 1:
            out.append(-1)
        out.append(int(w) % _MASK)
        last = a
    return out


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, text_key, item_id, item_words, covered_words, coverage, n_tiles`` of every
    document and benchmark item with ``min_coverage`` of the item's words under tiles of at
    least five words, in any order in the document.

    Candidates share a seed of five words. Coverage c of n words in tiles of at least five
    needs c / 5 seed positions, so an item is looked up by its rarest seeds alone, as many as
    leave fewer than that out: a seed that most documents have is not joined unless an item
    needs it, and no pair above the threshold is lost. Repeated rows of one document give
    one result; null, empty and short texts share no seed; null ids stay; an empty table on
    either side gives no rows.
    """
    items = C.stage_table(benchmark_items(benchmark).where(F.size("seeds") > 0))
    at = items.select("item_id", F.size("item_words").alias("n"), F.posexplode("seeds").alias("pos", "seed"))
    widths = sorted(r[0] for r in items.select(F.least(F.size("item_words"), F.lit(MIN_TILE)).alias("w")).distinct().collect())
    bits = C.bitmap(at.select(F.pmod(_unsigned_low("seed"), F.lit(FILTER_CELLS)).alias("cell")), "cell", FILTER_CELLS)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    hits = C.stage_table(document_seeds(docs, shared, widths, id_col, text_col))
    shared.destroy()
    seen = hits.select("doc_id", "text_key", F.explode("seeds").alias("seed"))
    frequency = seen.groupBy("seed").agg(F.count("*").alias("df"))
    order = Window.partitionBy("item_id").orderBy("df", "seed", "pos")
    need = F.greatest(F.lit(1), F.ceil(F.lit(min_coverage) * F.col("n") / MIN_TILE - 1e-9))
    total = F.greatest(F.lit(1), F.col("n") - MIN_TILE + 1)
    rare = (at.join(frequency, "seed", "left").na.fill(0, ["df"]).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= total - need + 1).where("df > 0").select("seed", "item_id").distinct())
    pairs = seen.join(rare, "seed").select("doc_id", "text_key", "item_id").distinct()
    joined = (pairs.join(items.select("item_id", "item_words"), "item_id")
              .join(hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "at", "words")
                    .dropDuplicates(["d", "k"]),
                    F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))).drop("d", "k"))
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    names = ["doc_id", "text_key", "item_id", "item_words", "covered_words", "coverage", "n_tiles"]

    def run(batches):
        for batch in batches:
            keep, out = [], []
            columns = [batch.column(c).to_pylist() for c in ("item_words", "at", "words")]
            for k, (item, at, words) in enumerate(zip(*columns, strict=True)):
                tiles = tile([w % _MASK for w in item], _text(at, words), min(MIN_TILE, len(item)))
                covered = sum(n for n, _, _ in tiles)
                if covered >= min_coverage * len(item) - 1e-9:
                    keep.append(k)
                    out.append((len(item), covered, covered / len(item), len(tiles)))
            taken = pa.array(keep, pa.int64())
            ids = [batch.column(c).take(taken) for c in ("doc_id", "text_key", "item_id")]
            values = list(zip(*out, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(ids + [pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    return joined.mapInArrow(run, f"doc_id {kinds['doc_id']}, text_key bigint, item_id {kinds['item_id']}, "
                                  "item_words bigint, covered_words bigint, coverage double, n_tiles bigint")


def _unsigned_low(col: str):
    """The low bits of a hash, which are the same signed or unsigned."""
    return F.col(col).bitwiseAND(F.lit(FILTER_CELLS - 1))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, columns as they are, that hold no benchmark item."""
    leaks = benchmark_overlaps(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct()
    leaks = C.stage_table(leaks)
    return docs.join(leaks, docs[id_col].eqNullSafe(F.col("_leak_id"))
                     & (F.xxhash64(docs[text_col]) == F.col("_leak_key")), "left_anti")


def op2(spark, sf_dir: str) -> DataFrame:
    found = benchmark_overlaps(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")

"""Homology search and hit post-processing.

H1 is a Spark-native seed-and-extend search, not a wrapper around an aligner binary:

1. **Index.** The distinct texts of the database are reduced to their *minimizers* (k=20, w=9; one
   vectorised pass per batch; words with ambiguity codes never chosen) and written as an
   inverted index: for every word the texts that hold it, and where. A word in very many texts
   is split into parts. The index serves any number of searches (:func:`search_index`).
2. **Candidates.** The seeds' minimizers, on both strands, join the index by word (and part). Two
   sequences that share an exact run of 28 bases share a minimizer at the same distance, so
   words only propose diagonals: a diagonal counts if it really has an exact run of ``run``
   bases, whichever words were chosen. Nothing of seeds or database passes the driver.
3. **Bound.** A window of ``k + w - 1`` bases of a seed whose minimizer the text lacks cannot lie in
   an exact run, so any alignment over it pays for a mismatch or a gap. That bounds the score
   of a pair from its shared words alone (:func:`score_bound`). The most promising seed of each
   primer and text is scored first; other pairs follow only if their bound reaches its score.
4. **Extension.** All proposed diagonals of a batch are scored together: +reward / -penalty per
   aligned base (an ambiguous base never earns the reward), the maximal-scoring ungapped
   segment of each by running sums. Segments of one pair are then chained: a later segment on
   another diagonal continues a chain at the cost of a gap, columns that both cover count once,
   and skipped columns count as mismatches. So an insertion or deletion does not end a hit.
5. **Scores.** bitscore = (lambda * S - ln K) / ln 2 with the Karlin-Altschul parameters
   for the reward/penalty pair (published values; parameters). length = the longer of the two
   aligned spans. qcovs = aligned query span / query length * 100. Reverse-strand hits have
   ``sstart > send``.
6. **Output.** The best hit of every primer and subject: at most primers x subjects rows, however
   alike the seeds of a primer are.

Scores follow these definitions and are not those of any particular aligner.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.functions import columns as C
from barcodeforge.functions.iupac import revcomp, revcomp_str
from barcodeforge.operators.partitioning import checked_broadcast, materialize, shuffled, spread
from barcodeforge.operators.rowpick import desc, keep_first

# --- fixed values: ungapped Karlin-Altschul parameters for reward 1 / penalty -2 ---------
KA_LAMBDA = 1.28
KA_K = 0.46
# --- end of fixed values --------------------------------------------------------------------

HIT_COLUMNS = ("qseqid", "sseqid", "sstart", "send", "length", "qcovs", "bitscore")


_CODE2 = np.full(256, 4, dtype=np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODE2[ord(_b)] = _i
    _CODE2[ord(_b.lower())] = _i
_NO_WORD_U = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (wrapping uint64 arithmetic): a fixed, well-spread k-mer order."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minimizer_positions(seq: str | None, k: int, w: int) -> list[int]:
    """1-based start positions of the minimizer k-mers of ``seq`` (helper for the UDF and tests)."""
    if seq is None or len(seq) < k:
        return []
    codes = _CODE2[np.frombuffer(seq.encode("ascii", "replace"), dtype=np.uint8)]
    win = np.lib.stride_tricks.sliding_window_view(codes, k)
    invalid = (win > 3).any(axis=1)
    val = np.zeros(win.shape[0], dtype=np.uint64)
    for j in range(k):
        val = (val << np.uint64(2)) | (win[:, j] & 3).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = _mix(val)
    h[invalid] = _NO_WORD_U
    n = h.shape[0]
    if n <= w:
        idx = np.array([int(np.argmin(h))])
    else:
        idx = np.lib.stride_tricks.sliding_window_view(h, w).argmin(axis=1) + np.arange(n - w + 1)
        idx = np.unique(idx)
    idx = idx[h[idx] != _NO_WORD_U]
    return (idx + 1).tolist()


def minimizer_batch(seqs: list, k: int, w: int):
    """Minimizers of many sequences at once (one vectorised pass over their concatenation).

    Returns (row index, 1-based position, packed k-mer) arrays. The packed k-mer (2 bits per
    base) is exact for k <= 31 and is the join key. Same choice as
    :func:`minimizer_positions`.
    """
    lens = np.array([len(s) if s is not None else 0 for s in seqs], dtype=np.int64)
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))
    if lens.sum() < k:
        return empty
    ends = np.cumsum(lens)
    starts = ends - lens
    codes = _CODE2[np.frombuffer("".join(s or "" for s in seqs).encode("ascii", "replace"), dtype=np.uint8)]
    m = codes.shape[0] - k + 1                       # k-mer start positions over the concatenation
    val = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        val = (val << np.uint64(2)) | (codes[j:j + m] & 3).astype(np.uint64)
    bad = np.concatenate(([0], np.cumsum(codes > 3)))
    owner = np.repeat(np.arange(len(seqs)), lens)[:m]
    ok = (bad[k:k + m] - bad[:m] == 0) & (np.arange(m) + k <= ends[owner])
    with np.errstate(over="ignore"):
        h = _mix(val)
    h[~ok] = _NO_WORD_U
    nk = np.maximum(lens - k + 1, 0)                 # k-mers per sequence
    picks = []
    if m >= w:
        arg = np.lib.stride_tricks.sliding_window_view(h, w).argmin(axis=1)
        jw = np.arange(m - w + 1)
        own = owner[jw]
        full = jw + w - 1 < starts[own] + nk[own]    # window lies inside one sequence
        picks.append((jw + arg)[full])
    for r in np.nonzero((nk > 0) & (nk < w))[0]:     # fewer than w k-mers: one window
        a = starts[r]
        picks.append(np.array([a + int(np.argmin(h[a:a + nk[r]]))]))
    if not picks:
        return empty
    pos = np.unique(np.concatenate(picks))
    pos = pos[h[pos] != _NO_WORD_U]
    row = owner[pos]
    return row, (pos - starts[row] + 1).astype(np.int32), val[pos].astype(np.int64)


CELL_BLOCK = 250_000          # aligned columns scored together
BASE_BLOCK = 250_000          # bases whose words are found together
SEEDS_A_ROW = 256             # seeds with one word that meet a text in one row
RUN = 28
GAP_OPEN, GAP_EXTEND = 3, 1
SPLIT_POSTINGS = 20_000        # texts of one word that are joined together; more are split into parts


def _codes(text: str) -> np.ndarray:
    return _CODE2[np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)]


def _unpacked(packed: bytes, size: int, minus: bool) -> np.ndarray:
    """Base codes of a text packed two to a byte (an odd one starts in the middle of a byte), or of
    its reverse complement."""
    pairs = np.frombuffer(packed, dtype=np.uint8)
    codes = np.stack([pairs >> 4, pairs & 15], axis=1).ravel()[2 * len(pairs) - size:]
    return np.where(codes < 4, 3 - codes, codes)[::-1] if minus else codes


def score_diagonals(query: np.ndarray, q_start: np.ndarray, q_len: np.ndarray, subject: np.ndarray, s_start: np.ndarray,
                    s_len: np.ndarray, diag: np.ndarray, reward: int, penalty: int):
    """Best ungapped segment of every candidate (rows of the arrays; ``query`` and ``subject``
    hold base codes of all sequences, ``diag`` = subject position - query position).

    Returns (score, first query position, last, longest exact run), positions from 0. Ties: the
    segment that ends first, then the longest.
    """
    low = np.maximum(0, -diag)
    size = np.minimum(q_len, s_len - diag) - low
    edge = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(diag)), size)
    step = np.arange(int(size.sum())) - edge[owner]
    q_at = low[owner] + step
    q = query[q_start[owner] + q_at]
    same = (q == subject[s_start[owner] + q_at + diag[owner]]) & (q < 4)
    value = np.where(same, reward, -penalty).astype(np.int64)
    after = np.cumsum(value)
    before = after - value
    place = np.arange(len(value))
    # running minimum within each candidate: every candidate lies far below the one before it
    far = (int(np.abs(before).max()) + int(np.abs(after).max()) + 1) if len(before) else 1
    sunk = before - owner * (2 * far)
    least = np.minimum.accumulate(sunk)
    drop = np.ones(len(sunk), dtype=bool)
    drop[1:] = least[1:] < least[:-1]
    first = np.maximum.accumulate(np.where(drop, place, 0))
    gain = after - (least + owner * (2 * far))
    best = np.maximum.reduceat(gain, edge)
    ends = np.flatnonzero(gain == best[owner])
    ends = ends[np.concatenate([[True], owner[ends[1:]] != owner[ends[:-1]]])]
    miss = np.maximum.accumulate(np.where(same, edge[owner] - 1, place))
    run = np.maximum.reduceat(place - np.maximum(miss, edge[owner] - 1), edge)
    return best, q_at[first[ends]], q_at[ends], run


def chain_segments(segments: list[tuple[int, int, int, int]], reward: int, penalty: int, gap_open: int,
                   gap_extend: int) -> list[tuple[int, int, int, int, int]]:
    """Best chain that ends in each segment ``(score, diag, first, last)`` of one pair, as
    ``(score, q_first, s_first, q_last, s_last)``. Of equal chains the one that starts first."""
    segments = sorted(segments, key=lambda x: (x[2], x[3], x[1]))
    out: list[tuple[int, int, int, int, int]] = []
    for n, (score, d, q0, q1) in enumerate(segments):
        best = (score, -q0, -(q0 + d))
        for m in range(n):
            _, e, p0, p1 = segments[m]
            if not (q0 > p0 and q1 > p1 and q0 + d > p0 + e and q1 + d > p1 + e) or d == e:
                continue
            q_gap, s_gap = q0 - p1 - 1, q0 + d - (p1 + e) - 1
            over = max(0, -q_gap, -s_gap)
            if over >= min(q1 - q0 + 1, p1 - p0 + 1):
                continue
            cost = gap_open + gap_extend * abs(d - e) + over * reward + max(0, min(q_gap, s_gap)) * penalty
            chained = (out[m][0] + score - cost, -out[m][1], -out[m][2])
            best = max(best, chained)
        out.append((best[0], -best[1], -best[2], q1, q1 + d))
    return out


def _base_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + BASE_BLOCK)))
        yield batch.slice(a, b - a)
        a = b


def _postings(batches: Iterator[pa.RecordBatch], k: int, w: int, minus: bool) -> Iterator[pa.RecordBatch]:
    """Minimizers of ``(id, text)`` rows as ``kmer, id, minus, size, at, windows``: one row for each
    word of a text, with its places from 0 and how many of the disjoint windows of the text it
    is the minimizer of. ``minus`` adds the reverse complement of every text."""
    span = k + w - 1
    for batch in chain.from_iterable(map(_base_slices, batches)):
        ids = batch.column("id").to_numpy()
        texts = batch.column("text").to_pylist()
        for strand in (False, True)[:1 + minus]:
            own = [revcomp_str(t) for t in texts] if strand else texts
            row, pos, kmer = minimizer_batch(own, k, w)
            size = np.array([len(t) for t in own], dtype=np.int64)
            # the first smallest word of every window that starts at a multiple of its length
            count = size // span
            owner = np.repeat(np.arange(len(own)), count)
            begin = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * span
            place = row * (int(size.max(initial=0)) + span + 1) + pos - 1
            base = owner * (int(size.max(initial=0)) + span + 1) + begin
            low, high = np.searchsorted(place, base), np.searchsorted(place, base + w)
            some = low < high
            low, high = low[some], high[some]
            windows = np.zeros(len(row), dtype=np.int32)
            if len(low):
                with np.errstate(over="ignore"):
                    order = _mix(kmer.astype(np.uint64))
                least = np.minimum.reduceat(np.append(order, _NO_WORD_U), np.stack([low, high], axis=1).ravel())[::2]
                inside = np.arange(int((high - low).sum())) - np.repeat(np.cumsum(high - low) - (high - low) - low, high - low)
                hit = np.flatnonzero(order[inside] == np.repeat(least, high - low))
                window = np.repeat(np.arange(len(low)), high - low)[hit]
                np.add.at(windows, inside[hit[np.concatenate([[True], window[1:] != window[:-1]])]], 1)
            by = np.lexsort((pos, kmer, row))
            row, pos, kmer, windows = row[by], pos[by], kmer[by], windows[by]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (kmer[1:] != kmer[:-1])])) if len(row) else np.zeros(0, int)
            cuts = np.append(first, len(row)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kmer[first]), pa.array(ids[row[first]]), pa.array(np.full(len(first), strand)),
                 pa.array(size[row[first]].astype(np.int32)), pa.ListArray.from_arrays(pa.array(cuts), pa.array((pos - 1).astype(np.int32))),
                 pa.array(np.add.reduceat(windows, first).astype(np.int32) if len(first) else windows)],
                ["kmer", "id", "minus", "size", "at", "windows"])


_POSTINGS = "kmer bigint, id bigint, minus boolean, size int, at array<int>, windows int"


def _found_postings(texts: DataFrame, k: int, w: int, minus: bool) -> DataFrame:
    rows = texts.select("id", "text").filter(F.length("text") >= k)
    return spread(rows).mapInArrow(lambda batches: _postings(batches, k, w, minus), _POSTINGS)


@dataclass(frozen=True)
class SearchIndex:
    """A written inverted index of a database: its rows, distinct texts and words in parts."""

    k: int
    w: int
    rows: DataFrame
    texts: DataFrame
    postings: DataFrame
    parts: DataFrame | None


def search_index(database: DataFrame, k: int = 20, w: int = 9, split: int = SPLIT_POSTINGS) -> SearchIndex:
    """The index that :func:`homology_search` looks seeds up in; database: (sseqid, sequence).
    The database is read once. A word in more than ``split`` texts is dealt to parts by text."""
    # written before it is looked at, so that a sequence that is costly to make is made once
    rows = materialize(database.select("sseqid", F.upper(F.col("sequence")).alias("text")))
    rows = rows.filter(F.col("text").isNotNull()).withColumn("digest", F.sha2("text", 256))
    texts = rows.groupBy("digest").agg(F.first("text").alias("text")).withColumn("id", F.monotonically_increasing_id())
    texts = materialize(texts)
    postings = materialize(_found_postings(texts, k, w, minus=False))
    parts = postings.groupBy("kmer").agg(F.count("*").alias("n")).filter(F.col("n") > split)
    parts = materialize(parts.select("kmer", F.ceil(F.col("n") / split).cast("int").alias("parts")))
    if parts.isEmpty():
        return SearchIndex(k, w, rows, texts, postings.withColumn("part", F.lit(0)), None)
    dealt = postings.join(shuffled(parts), "kmer", "left").withColumn("part", F.when(
        F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))).drop("parts")
    return SearchIndex(k, w, rows, texts, dealt, parts)


def score_bound(query: Column, subject: Column, lacking: Column, k: int, w: int, reward: int, penalty: int, gap_open: int,
                gap_extend: int) -> Column:
    """Upper bound on the score of a pair with these lengths, whose subject lacks the minimizers of
    ``lacking`` of the seed's disjoint windows of ``k + w - 1`` bases.

    Such a window is in no exact run. An alignment over it has a mismatch in it (reward + penalty
    less than all bases would earn) or a gap at it; a gap of m skipped bases meets at most
    ``2 + (m - 2) / (k + w - 1)`` windows. At either end one window may be left by giving up a
    single base, and each further one by giving up all its bases.
    """
    cost = min(reward + penalty, gap_open + gap_extend, (gap_open + gap_extend + 2 * reward) // 2, reward * (k + w - 1))
    return F.least(reward * query - max(0, cost) * F.greatest(lacking - 2, F.lit(0)), reward * subject)


def _extended(pairs: DataFrame, run: int, scoring: tuple[int, int, int, int], min_score: int) -> DataFrame:
    """The best chain of every pair ``text, seed, qlen, minus, diagonals`` that has one, next to all
    columns but texts and diagonals, as ``score, q_first, s_first, q_last, s_last`` (from 0)."""
    reward, penalty, gap_open, gap_extend = scoring
    carried = [f for f in pairs.schema if f.name not in ("text", "seed", "diagonals")]
    names = [f.name for f in carried] + ["score", "q_first", "s_first", "q_last", "s_last"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cells = np.minimum(pc.binary_length(batch.column("text")).to_numpy(), batch.column("qlen").to_numpy())
        upto = np.cumsum(cells.astype(np.int64) * pc.list_value_length(batch.column("diagonals")).to_numpy())
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CELL_BLOCK)))
            yield batch.slice(a, b - a)
            a = b

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lists = part.column("diagonals")
                pair = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
                diag = pc.list_flatten(lists).to_numpy().astype(np.int64)
                minus = part.column("minus").to_pylist()
                seeds = list(map(_unpacked, part.column("seed").to_pylist(), part.column("qlen").to_pylist(), minus))
                texts = [_codes(t) for t in part.column("text").to_pylist()]
                sides = []
                for codes in (seeds, texts):
                    size = np.array([len(t) for t in codes], dtype=np.int64)
                    sides.append((np.concatenate(codes), (np.cumsum(size) - size)[pair], size[pair]))
                score, first, last, exact = score_diagonals(*sides[0], *sides[1], diag, reward, penalty)
                good = np.flatnonzero(exact >= run)
                cut = np.flatnonzero(pair[good][1:] != pair[good][:-1]) + 1
                kept, out = [], []
                for group in np.split(good, cut) if len(good) else []:
                    segments = [(int(score[g]), int(diag[g]), int(first[g]), int(last[g])) for g in group]
                    row = int(pair[group[0]])
                    best = None
                    for found in chain_segments(segments, reward, penalty, gap_open, gap_extend):
                        spans = max(found[3] - found[1], found[4] - found[2])
                        ends = (found[4], found[2]) if minus[row] else (found[2], found[4])
                        rank = (-found[0], -spans, *ends, -(found[3] - found[1]))
                        if found[0] >= min_score and (best is None or rank < best[0]):
                            best = (rank, found)
                    if best:
                        kept.append(row)
                        out.append(best[1])
                taken = pa.array(kept, pa.int64())
                values = np.array(out, dtype=np.int32).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name).take(taken) for f in carried), *map(pa.array, values.T)], names)

    return pairs.mapInArrow(extend, schema + ", score int, q_first int, s_first int, q_last int, s_last int")


def homology_search(seeds: DataFrame, database: DataFrame | SearchIndex, k: int = 20, w: int = 9, reward: int = 1, penalty: int = 2,
                    min_score: int = 0, run: int | None = None, gap_open: int = GAP_OPEN, gap_extend: int = GAP_EXTEND) -> DataFrame:
    """H1: the best hit of every primer's seeds on every database sequence (both strands).

    seeds: (primer_name, qseqid, sequence); database: (sseqid, sequence), or the index of one.
    Output: primer_name, qseqid, sseqid, sstart, send, length, qcovs, bitscore; one row per
    primer and subject that share an exact run of ``run`` bases (default and at least
    ``k + w - 1``). Ties: longer, then smaller sstart, send, higher coverage, smaller qseqid.
    """
    index = database if isinstance(database, SearchIndex) else search_index(database, k, w)
    k, w = index.k, index.w
    run = max(run or 0, k + w - 1)
    scoring = (reward, penalty, gap_open, gap_extend)
    # of equal seeds of a primer the smallest name is the one that a hit is reported by
    seeds = materialize(seeds.select("primer_name", "qseqid", F.upper(F.col("sequence")).alias("text")))
    seeds = seeds.filter(F.length("text") >= run).groupBy("primer_name", "text").agg(F.min("qseqid").alias("qseqid"))
    seeds = materialize(seeds.withColumn("id", F.monotonically_increasing_id()))
    tasks = int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a word with the seeds that hold it, some to a row: what a text meets is sent with the text's
    # number once for all of them
    asked = _found_postings(seeds, k, w, minus=True).select("*", F.explode("at").alias("q_at"))
    # the windows of a word count once, at its first place
    mark = F.col("minus").cast("bigint") + F.when(F.col("q_at") == F.col("at")[0], F.col("windows") * 2).otherwise(0)
    asked = asked.select("kmer", "id", (F.shiftleft(F.col("q_at").cast("bigint"), 32) + mark).alias("spot"))
    turn = F.row_number().over(Window.partitionBy("kmer").orderBy(F.lit(0)))
    asked = asked.withColumn("_row", F.floor(turn / SEEDS_A_ROW)).groupBy("kmer", "_row").agg(F.collect_list(F.struct("id", "spot")).alias("s"))
    asked = asked.select("kmer", F.col("s.id").alias("id"), F.col("s.spot").alias("spot"))
    held = index.postings.select("kmer", "part", F.col("id").alias("text_id"), "size", F.col("at")[0].alias("first"), F.explode("at").alias("t_at"))
    # a text's length, the place of the word in it, and whether that is its first
    place = F.shiftleft(F.col("size").cast("bigint"), 32) + F.col("t_at").cast("bigint") * 2 + (F.col("t_at") == F.col("first")).cast("bigint")
    held = held.select("kmer", "part", "text_id", place.alias("place"))
    if index.parts is None:
        met = held.drop("part").join(shuffled(asked), "kmer")
    else:
        asked = asked.join(shuffled(index.parts), "kmer", "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        met = held.join(shuffled(asked), ["kmer", "part"])
    met = met.select("text_id", "place", "id", "spot").repartition(tasks, "text_id").select("*", F.posexplode("id").alias("_i", "seed_id"))
    met = met.selectExpr(
        "text_id", "CAST(shiftright(place, 32) AS INT) AS slen", "seed_id", "spot[_i] & 1 AS minus",
        "CAST((place & 4294967295) DIV 2 - shiftright(spot[_i], 32) AS INT) AS diagonal",
        "IF(place & 1 = 1, (spot[_i] & 4294967295) DIV 2, 0) AS windows")
    # grouped where the text's rows are
    pair = ["text_id", "seed_id", "minus"]
    found = met.groupBy(*pair, "diagonal").agg(F.sum("windows").alias("windows"), F.first("slen").alias("slen"))
    pairs = found.groupBy(*pair).agg(F.collect_list("diagonal").alias("diagonals"), F.sum("windows").alias("shared"), F.first("slen").alias("slen"))
    lacking = F.floor(F.col("qlen") / (k + w - 1)) - F.col("shared")
    bound = score_bound(F.col("qlen"), F.col("slen"), lacking, k, w, *scoring).cast("int")
    names = seeds.select(F.col("id").alias("seed_id"), "primer_name", F.length("text").alias("qlen"))
    pairs = pairs.join(shuffled(names), "seed_id").withColumns({"minus": F.col("minus") == 1, "bound": bound})
    pairs = materialize(pairs.drop("slen"))
    # seeds travel to every text that they meet: two bases in a byte
    packed = F.unhex(F.translate(F.regexp_replace("text", "[^ACGT]", "N"), "ACGTN", "01234"))
    forward = seeds.select(F.col("id").alias("seed_id"), "qseqid", packed.alias("seed"))

    def scored(some: DataFrame) -> DataFrame:
        some = some.select("text_id", "seed_id", "primer_name", "minus", "diagonals", "qlen").join(shuffled(forward), "seed_id")
        # dealt by text to all tasks, since scoring is the costly step; the texts follow
        texts = index.texts.select(F.col("id").alias("text_id"), "text").repartition(tasks, "text_id")
        return _extended(some.repartition(tasks, "text_id").join(shuffled(texts), "text_id"), run, scoring, min_score)

    promising = F.max(F.struct("bound", "shared", "seed_id", "minus", "diagonals", "qlen")).alias("p")
    first = materialize(scored(pairs.groupBy("text_id", "primer_name").agg(promising).select(
        "text_id", "primer_name", "p.seed_id", "p.minus", "p.diagonals", "p.qlen")))
    reached = first.select(F.col("text_id").alias("t"), F.col("primer_name").alias("p"), F.col("score").alias("reached"))
    rest = pairs.join(shuffled(reached), (F.col("text_id") == F.col("t")) & F.col("primer_name").eqNullSafe(F.col("p")), "left")
    hits = scored(rest.filter(F.col("reached").isNull() | (F.col("bound") >= F.col("reached"))))
    hits = hits.withColumn("strand", F.when(F.col("minus"), "-").otherwise("+"))
    plus = F.col("strand") == "+"
    bits = (F.lit(KA_LAMBDA) * F.col("score") - F.lit(math.log(KA_K))) / F.lit(math.log(2.0))
    hits = hits.select(
        "primer_name", "qseqid", "text_id",
        F.when(plus, F.col("s_first")).otherwise(F.col("s_last")).alias("sstart"),
        F.when(plus, F.col("s_last")).otherwise(F.col("s_first")).alias("send"),
        F.greatest(F.col("q_last") - F.col("q_first"), F.col("s_last") - F.col("s_first")).alias("length"),
        F.bround((F.col("q_last") - F.col("q_first") + 1) / F.col("qlen") * 100, 0).alias("qcovs"),
        F.bround(bits, 1).alias("bitscore"))
    hits = hits.withColumns({c: (F.col(c) + 1).cast("int") for c in ("sstart", "send", "length")})
    order = [desc("bitscore"), desc("length"), "sstart", "send", desc("qcovs"), "qseqid"]
    best = keep_first(hits, ["primer_name", "text_id"], order)
    named = best.join(shuffled(index.texts.select(F.col("id").alias("text_id"), "digest")), "text_id")
    named = named.join(shuffled(index.rows.select("sseqid", "digest")), "digest")
    # a subject may be in several rows
    return keep_first(named.select("primer_name", *HIT_COLUMNS), ["primer_name", "sseqid"], order)


# ------------------------------------------------------------------------------------------
# H2-H6
# ------------------------------------------------------------------------------------------

def best_hit_per_subject(hits: DataFrame, by: tuple[str, ...] = ("primer_name",)) -> DataFrame:
    """H2: drop qseqid; keep the highest-bitscore hit per subject (per primer)."""
    h = hits.drop("qseqid")
    keys = [c for c in by if c in h.columns] + ["sseqid"]
    return keep_first(h, keys, [desc("bitscore"), desc("length"), "sstart", "send", desc("qcovs")])


def attach_taxonomy(hits: DataFrame, database: DataFrame) -> DataFrame:
    """H3: subject sequence and header fields; genus; blank / 'NA' subspecies to NULL;
    start <= end and the strand flag."""
    # the original takes the first row of each header; here that is the smallest sequence
    db = keep_first(database.select(F.col("header").alias("sseqid"), "sequence"), ["sseqid"], ["sequence"])
    df = hits.join(shuffled(db), on="sseqid", how="left")
    df = C.split_into(df, "sseqid", ";", ("accession", "family", "species", "subspecies", "beeid"), drop=True)
    df = (df.withColumn("species", F.translate("species", "_", " "))
          .withColumn("subspecies", F.translate("subspecies", "_", " "))
          .withColumn("genus", C.genus_of("species"))
          .withColumn("subspecies", C.blank_to_null("subspecies")))
    rev = F.col("sstart") > F.col("send")
    return (df.withColumn("start", F.when(rev, F.col("send")).otherwise(F.col("sstart")))
            .withColumn("end", F.when(rev, F.col("sstart")).otherwise(F.col("send")))
            .withColumn("reversed", F.coalesce(rev, F.lit(False))))


def crop_by_position(df: DataFrame) -> DataFrame:
    """H4: the subject cut to start..end (1-based, inclusive), computed on the same row;
    score columns dropped, exact duplicates removed."""
    out = df.withColumn("sequence", C.substr_inclusive("sequence", "start", "end"))
    return out.drop("sstart", "send", "bitscore", "qcovs").distinct()


def filter_length(df: DataFrame, primers: DataFrame, cox1: float = 0.05, other: float = 0.15) -> DataFrame:
    """H5: keep rows whose alignment length lies strictly within the primer's expected length
    ± 5 % (COX1) or ± 15 % (other genes); adds ``gene``."""
    meta = checked_broadcast(primers.select(F.col("primer").alias("primer_name"), "gene",
                                      F.col("length").alias("_expected")))
    j = df.join(meta, on="primer_name", how="left")
    lo, hi = C.length_bounds("_expected", C.gene_tolerance("gene", cox1, other))
    return j.filter((F.col("length") > lo) & (F.col("length") < hi)).drop("_expected")


def orient(df: DataFrame) -> DataFrame:
    """H6: reverse-complement the minus-strand rows."""
    return df.withColumn("sequence", F.when(F.col("reversed"), revcomp("sequence")).otherwise(F.col("sequence")))


def hits_to_database(hits: DataFrame, database: DataFrame, primers: DataFrame) -> DataFrame:
    """H2 -> H6: best hits, length filter, taxonomy, crop, orientation. The filter reads only the
    hit's own length, so it comes before any sequence is joined."""
    best = filter_length(best_hit_per_subject(hits), primers)
    return orient(crop_by_position(attach_taxonomy(best, database)))


def stage_counts(best: DataFrame, filtered: DataFrame, seeds: DataFrame | None = None,
                 primers: DataFrame | None = None) -> DataFrame:
    """Rows per primer at the seed, candidate and filtered stages. With ``primers`` every
    primer has a row for each stage, 0 where it has no sequences."""
    stages = [("candidates", best), ("filtered", filtered)]
    if seeds is not None:
        stages.insert(0, ("seeds", seeds))
    parts = None
    for name, rows in stages:
        one = rows.groupBy("primer_name").agg(F.count(F.lit(1)).alias("n_rows"))
        if primers is not None:
            one = primers.select(F.col("primer").alias("primer_name")).join(one, "primer_name", "left").na.fill(0, ["n_rows"])
        one = one.select("primer_name", F.lit(name).alias("stage"), "n_rows")
        parts = one if parts is None else parts.unionByName(one)
    return parts

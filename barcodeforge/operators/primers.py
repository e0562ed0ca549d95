"""In-silico PCR with degenerate primer pairs.

Primer metadata (``primer, gene, forward_sequence, reverse_sequence, length``) is a small
curated table. It is collected once behind a size check and processed in chunks of
``PRIMERS_PER_PASS``; every chunk is one pass over the sequences, so no sequence is ever
paired with a primer through a join, and the per-task closure stays bounded however many
primers there are.

Scans
-----
* ``max_error == 0``: one ``regexp_extract`` per primer (IUPAC codes become character
  classes), JVM-side, no Python.
* ``max_error > 0``: an Arrow-batched ``mapInPandas`` scan. Bases are 4-bit masks; a primer
  position matches a sequence position when their masks intersect, so codes on either side
  are honoured. Mismatches of every window come from one numpy sliding-window AND.
  Contract: errors = mismatches (Hamming); a site is allowed when errors <=
  floor(max_error * primer length); the forward site is the leftmost one with the fewest
  errors, the reverse site (reverse primer reverse-complemented) the leftmost best one
  starting after the forward site ends. The given strand is scanned only.

Error scoring
-------------
The distance of a primer match to a degenerate primer is the minimum over the strings the
primer stands for. Both metrics run their recurrence with "base belongs to the code's set" as
the match test, which equals that minimum without making the strings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barcodeforge.functions import columns as C
from barcodeforge.functions.iupac import (IUPAC_CODES, checked_iupac, code_mask, expansion_size, iupac_member,
                                          mask_table, revcomp, revcomp_str)
from barcodeforge.functions.nulls import join_null_safe
from barcodeforge.operators.fuzzy import rolling_distances
from barcodeforge.operators.partitioning import checked_broadcast, spread
from barcodeforge.operators.rowpick import asc, keep_first

PRIMERS_PER_PASS = 64          # primers handled by one scan pass
CROP_TOLERANCE = 0.2           # fixed value: amplicon length tolerance (±20 %)
MAX_ERROR = 0.2                # fixed value: primer error rate allowed

PRIMER_COLUMNS = ("primer", "gene", "forward_sequence", "reverse_sequence", "length")


# ------------------------------------------------------------------------------------------
# primer metadata
# ------------------------------------------------------------------------------------------

def collect_primers(primers: DataFrame) -> list[dict]:
    """The primer table, read through the driver in order of its names a few rows at a time (it
    is a curated table, one row per primer). A letter that is no nucleotide code is an error."""
    rows = [r.asDict() for r in primers.select(*PRIMER_COLUMNS).orderBy("primer").toLocalIterator()]
    for r in rows:
        checked_iupac(r["forward_sequence"])
        checked_iupac(r["reverse_sequence"])
    return rows


def _chunks(items: list, size: int):
    for i in range(0, len(items), size):
        yield items[i:i + size]


def primer_info(primers: DataFrame) -> DataFrame:
    """Per primer: lengths, reverse complement of the reverse primer, expected length."""
    return primers.select(
        F.col("primer").alias("primer_name"), "gene",
        F.col("length").alias("expected_length"),
        F.col("forward_sequence"),
        revcomp("reverse_sequence").alias("reverse_rc"),
        F.length("forward_sequence").alias("flen"),
        F.length("reverse_sequence").alias("rlen"))


def primer_dictionary(primers: DataFrame) -> DataFrame:
    """Every disambiguated forward primer and reverse-complemented reverse primer.

    Rows: primer_name, direction ('forward' | 'reverse'), primer (IUPAC), disambiguated. Each
    string is made from its number, row by row, so a very degenerate primer gives many rows
    but no large value. Scoring (D4) does not read this table.
    """
    info = primer_info(primers)
    fwd = info.select("primer_name", F.lit("forward").alias("direction"), F.col("forward_sequence").alias("primer"))
    rev = info.select("primer_name", F.lit("reverse").alias("direction"), F.col("reverse_rc").alias("primer"))
    both = fwd.unionByName(rev).withColumn("_last", expansion_size("primer").cast("bigint") - 1)
    numbered = both.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))))
    return numbered.select("primer_name", "direction", "primer", iupac_member("primer", "_i").alias("disambiguated"))


# ------------------------------------------------------------------------------------------
# Crop between primer sites
# ------------------------------------------------------------------------------------------

def iupac_class(code: str) -> str:
    """Regex class of the sequence letters that can pair with a primer code (mask overlap)."""
    m = code_mask(code)
    letters = sorted({c for c in IUPAC_CODES if code_mask(c) & m})
    return "[" + "".join(letters) + "".join(x.lower() for x in letters) + "]"


def primer_regex(primer: str) -> str:
    return "".join(iupac_class(c) for c in primer.upper())


def amplicon_regex(forward: str, reverse: str) -> str:
    """Leftmost forward site, then the nearest reverse site (reverse-complemented) after it."""
    return "(?:" + primer_regex(forward) + ").*?(?:" + primer_regex(revcomp_str(reverse.upper())) + ")"


def _exact_crops(seqs: DataFrame, chunk: list[dict], keep: list[str]) -> DataFrame:
    hits = F.array(*[F.struct(F.lit(p["primer"]).alias("primer_name"),
                              F.regexp_extract("sequence", amplicon_regex(p["forward_sequence"], p["reverse_sequence"]), 0)
                              .alias("crop"))
                     for p in chunk])
    out = seqs.select(*keep, F.explode(hits).alias("_h")).filter(F.col("_h.crop") != "")
    return out.select(F.col("_h.primer_name").alias("primer_name"), *keep, F.col("_h.crop").alias("sequence"))


_NO_SITE = 255


def _mismatches(codes: np.ndarray, primer: np.ndarray) -> np.ndarray:
    """Mismatches of the primer at every start, over all sequences of a batch at once (a start
    too close to the end of the array has none)."""
    n = codes.shape[0] - primer.shape[0] + 1
    out = np.zeros(max(0, n), dtype=np.uint8 if primer.shape[0] < _NO_SITE else np.uint16)
    for k, mask in enumerate(primer):
        out += (codes[k:k + n] & mask) == 0
    return out


def _best_sites(mism: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """For each range of starts ``[low, high)``: the leftmost one with the fewest mismatches, if
    those are at most ``k``, else -1. Ranges are ascending and do not overlap."""
    out = np.full(low.shape[0], -1, dtype=np.int64)
    live = np.flatnonzero(high > low)
    if not live.shape[0]:
        return out
    edges = np.stack([low[live], high[live]], axis=1).ravel()
    padded = np.append(mism, np.array([np.iinfo(mism.dtype).max], dtype=mism.dtype))  # an end may be the array's
    least = np.minimum.reduceat(padded, edges)[::2]
    good = least <= k
    live, least = live[good], least[good]
    size = high[live] - low[live]
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(live.shape[0]), size)
    at = np.arange(int(size.sum())) - first[owner] + low[live][owner]
    hit = np.flatnonzero(mism[at] == least[owner])
    own = owner[hit]
    hit = hit[np.concatenate([[True], own[1:] != own[:-1]])] if hit.shape[0] else hit
    out[live] = at[hit]
    return out


def scan_batch(seqs: list, primers: list[tuple], table: np.ndarray) -> list[tuple[str, int, int, int]]:
    """``(primer, row, start, end)`` of the amplicon of every sequence and primer pair: one pass of
    mismatch counts per primer position over the whole batch, then a leftmost minimum in each
    sequence, and for the reverse site in what follows the forward one."""
    lens = np.array([len(x) if x is not None else 0 for x in seqs], dtype=np.int64)
    start = np.cumsum(lens) - lens
    codes = table[np.frombuffer("".join(x or "" for x in seqs).encode("ascii", "replace"), dtype=np.uint8)]
    out = []
    for name, fm, rm, kf, kr in primers:
        f = _best_sites(_mismatches(codes, fm), start, start + lens - fm.shape[0] + 1, kf)
        rows = np.flatnonzero(f >= 0)
        if not rows.shape[0]:
            continue
        r = _best_sites(_mismatches(codes, rm), f[rows] + fm.shape[0], start[rows] + lens[rows] - rm.shape[0] + 1, kr)
        for row, a, b in zip(rows[r >= 0].tolist(), f[rows][r >= 0].tolist(), r[r >= 0].tolist()):
            out.append((name, row, a - int(start[row]), b - int(start[row]) + rm.shape[0]))
    return out


AUTOMATON_LETTERS = 64         # pattern letters that one machine word tracks
CHUNK_LETTERS = 1024           # text letters of one row of a batch of automata; longer texts are cut
CELLS = 1 << 20                # letters that run side by side


def _edit_rows(texts: np.ndarray, pattern: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distance of the pattern to what ends at every place of each text (rows of masks, the
    first column stands before the text): from any place if ``free_start``, else from its
    beginning. The insertions within a row of the recurrence are a running minimum of t[k] - k."""
    n, size = texts.shape
    ramp = np.arange(size + 1, dtype=np.int32)
    row = np.zeros((n, size + 1), dtype=np.int32) if free_start else np.repeat(ramp[None, :], n, axis=0)
    for j, letter in enumerate(pattern, 1):
        t = np.empty_like(row)
        t[:, 0] = j
        t[:, 1:] = np.minimum(row[:, :-1] + ((texts & letter) == 0), row[:, 1:] + 1)
        row = np.minimum.accumulate(t - ramp, axis=1) + ramp
    return row


def _automata(texts: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """The last letter's row of :func:`_edit_rows` with a free start, for all texts at once: bit
    vectors hold where a column of the recurrence rises and falls, one machine word a text, and
    one step moves all of them on by a letter."""
    n, size = texts.shape
    word = np.uint64
    one, top = word(1), word(len(pattern) - 1)
    masks = np.array([sum(1 << j for j, letter in enumerate(pattern) if letter & m) for m in range(256)], dtype=word)
    rises, falls = np.full(n, ~word(0)), np.zeros(n, word)
    score = np.full(n, len(pattern), dtype=np.int16)
    out = np.empty((size, n), dtype=np.int16)
    with np.errstate(over="ignore"):
        for t in range(size):
            equal = masks[texts[:, t]]
            vertical = equal | falls
            across = (((equal & rises) + rises) ^ rises) | equal
            up = falls | ~(across | rises)
            down = rises & across
            score += ((up >> top) & one).astype(np.int16) - ((down >> top) & one).astype(np.int16)
            out[t] = score
            up, down = up << one, down << one
            rises = down | ~(vertical | up)
            falls = up & vertical
    return out.T


def _windows(codes: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Texts as rows of equal width, filled up with letters that match nothing."""
    step = np.arange(width)
    inside = step < size[:, None]
    at = np.where(inside, begin[:, None] + step, 0)
    return np.where(inside, codes[at] if len(codes) else 0, 0).astype(np.uint8)


def _best_ends(codes: np.ndarray, start: np.ndarray, size: np.ndarray, pattern: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the fewest edits with which the pattern ends somewhere in it, and the first
    such end (letters before it); -1 where that takes more than ``k``.

    Long texts are cut into chunks that begin early enough to hold any match of at most ``k``
    edits that ends in them.
    """
    least, end = np.full(len(start), k + 1, dtype=np.int64), np.full(len(start), -1, dtype=np.int64)
    found = [np.zeros((3, 0), dtype=np.int64)]
    pieces = -(-size // CHUNK_LETTERS)
    row = np.repeat(np.arange(len(start)), pieces)
    low = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * CHUNK_LETTERS
    high = np.minimum(low + CHUNK_LETTERS, size[row])
    first = np.maximum(0, low - len(pattern) - k)
    a = 0
    while a < len(row):
        b = min(len(row), a + max(1, CELLS // (CHUNK_LETTERS + len(pattern) + k)))
        own, x = row[a:b], first[a:b]
        texts = _windows(codes, start[own] + x, high[a:b] - x, int((high[a:b] - x).max()))
        cost = _automata(texts, pattern) if len(pattern) <= AUTOMATON_LETTERS else _edit_rows(texts, pattern, True)[:, 1:]
        at = x[:, None] + np.arange(1, texts.shape[1] + 1)
        cost = np.where((at > low[a:b, None]) & (at <= high[a:b, None]), cost, k + 1)
        chunk, place = np.arange(b - a), cost.argmin(axis=1)
        found.append(np.stack([own, cost[chunk, place], at[chunk, place]])[:, cost[chunk, place] <= k])
        a = b
    # the fewest edits over all chunks of a text, then the first end
    row, cost, at = np.concatenate(found, axis=1)
    order = np.lexsort((at, cost, row))
    order = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if len(order) else order
    least[row[order]], end[row[order]] = cost[order], at[order]
    return least, end


def _begins(codes: np.ndarray, start: np.ndarray, end: np.ndarray, edits: np.ndarray, pattern: np.ndarray, k: int) -> np.ndarray:
    """The leftmost begin of a match with those edits that ends there (letters before it)."""
    size = np.minimum(end, len(pattern) + k)
    texts = _windows(codes, start + end - size, size, int(size.max(initial=0)))
    # read backwards from the end
    step = np.arange(texts.shape[1])
    back = np.take_along_axis(texts, np.maximum(size[:, None] - 1 - step, 0), axis=1)
    cost = _edit_rows(np.where(step < size[:, None], back, 0).astype(np.uint8), pattern[::-1], False)
    fits = (cost == edits[:, None]) & (np.arange(cost.shape[1]) <= size[:, None])
    return end - (cost.shape[1] - 1 - fits[:, ::-1].argmax(axis=1))


def scan_batch_indels(seqs: list, primers: list[tuple], table: np.ndarray) -> list[tuple[str, int, int, int]]:
    """As :func:`scan_batch`, with insertions and deletions as errors too: the forward site is the
    one that ends first among those with the fewest errors and reaches furthest to the left, the
    reverse site the first such in what follows it."""
    lens = np.array([len(x) for x in seqs], dtype=np.int64)
    start = np.cumsum(lens) - lens
    codes = table[np.frombuffer("".join(seqs).encode("ascii", "replace"), dtype=np.uint8)]
    out = []
    for name, fm, rm, kf, kr in primers:
        edits, end = _best_ends(codes, start, lens, fm, kf)
        rows = np.flatnonzero(end >= 0)
        if not rows.shape[0]:
            continue
        begin = _begins(codes, start[rows], end[rows], edits[rows], fm, kf)
        _, after = _best_ends(codes, start[rows] + end[rows], lens[rows] - end[rows], rm, kr)
        for row, x, e, r in zip(rows.tolist(), begin.tolist(), end[rows].tolist(), after.tolist()):
            if r >= 0:
                out.append((name, row, x, e + r))
    return out


def _scan_fn(chunk: list[dict], max_error: float, keep: list[str], indels: bool = False):
    table = mask_table()
    prim = []
    for p in chunk:
        f = p["forward_sequence"].upper()
        r = revcomp_str(p["reverse_sequence"].upper())
        prim.append((p["primer"],
                     np.array([code_mask(c) for c in f], dtype=np.uint8),
                     np.array([code_mask(c) for c in r], dtype=np.uint8),
                     int(math.floor(max_error * len(f) + 1e-9)),
                     int(math.floor(max_error * len(r) + 1e-9))))
    out_cols = ["primer_name", *keep, "sequence"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            seq_col = pdf["sequence"].tolist()
            kept = [pdf[c].tolist() for c in keep]
            # sites repeat: each distinct sequence of the batch is scanned once
            texts = list(dict.fromkeys(x for x in seq_col if x is not None))
            found: dict[str, list] = {}
            for name, n, a, b in (scan_batch_indels if indels else scan_batch)(texts, prim, table):
                found.setdefault(texts[n], []).append((name, texts[n][a:b]))
            for idx, seq in enumerate(seq_col):
                rows += [(name, *[k[idx] for k in kept], crop) for name, crop in found.get(seq, ())]
            yield pd.DataFrame(rows, columns=out_cols)

    return scan


def crop_by_primers(seqs: DataFrame, primers: DataFrame, max_error: float = MAX_ERROR,
                    keep: tuple[str, ...] = ("accession",), indels: bool = False) -> DataFrame:
    """Amplicon (primer sites included) of every sequence for every primer pair.

    Output: primer_name, *keep, sequence. Sequences without both sites are dropped.
    ``indels=True`` counts insertions and deletions as errors too (semi-global edit distance, by
    bit-parallel automata over all sequences of a batch); the default counts mismatches only.
    """
    plist = collect_primers(primers)
    keep = list(keep)
    src = seqs.select(*keep, "sequence")
    parts = []
    for chunk in _chunks(plist, PRIMERS_PER_PASS):
        if max_error <= 0 and not indels:
            parts.append(_exact_crops(src, chunk, keep))
        else:
            schema = T.StructType([T.StructField("primer_name", T.StringType())]
                                  + [src.schema[c] for c in keep]
                                  + [T.StructField("sequence", T.StringType())])
            parts.append(spread(src).mapInPandas(_scan_fn(chunk, max_error, keep, indels), schema))
    if not parts:
        return seqs.sparkSession.createDataFrame([], "primer_name string, " + ", ".join(
            f"{c} {seqs.schema[c].dataType.simpleString()}" for c in keep) + ", sequence string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------------------------------
# D3: primer match columns
# ------------------------------------------------------------------------------------------

def primer_matches(crops: DataFrame, primers: DataFrame, exact_bounds: bool = False) -> DataFrame:
    """D3: sequence_length, forward_primer_match (first flen chars), reverse_primer_match,
    length_without_primers.

    ``exact_bounds=False`` keeps the original off-by-one: the reverse match starts at
    ``length - rlen`` and so holds rlen + 1 characters. The primer table is tiny (one row
    per primer) and broadcast.
    """
    info = checked_broadcast(primer_info(primers).select("primer_name", "flen", "rlen"))
    df = crops.join(info, on="primer_name", how="left")
    L = F.length("sequence")
    start = L - F.col("rlen") + (1 if exact_bounds else 0)
    return (df.withColumn("sequence_length", L)
            .withColumn("forward_primer_match", F.substring("sequence", F.lit(1), F.col("flen")))
            .withColumn("reverse_primer_match", C.substr_inclusive("sequence", start, F.col("sequence_length")))
            .withColumn("length_without_primers", F.col("sequence_length") - (F.col("flen") + F.col("rlen"))))


# ------------------------------------------------------------------------------------------
# Errors against the degenerate primer
# ------------------------------------------------------------------------------------------

_LETTER_BITS = np.full(256, 16, dtype=np.uint8)
for _b, _v in (("A", 1), ("C", 2), ("G", 4), ("T", 8)):
    _LETTER_BITS[ord(_b)] = _v
    _LETTER_BITS[ord(_b.lower())] = _v


def _set_distance(a_list: list[str], pattern: str, transpositions: bool) -> np.ndarray:
    """OSA (or Levenshtein) distance of equal-length strings to an IUPAC pattern, vectorised
    over the rows: the match test is 'letter is in the code's base set'."""
    n = len(a_list)
    la = len(a_list[0])
    lb = len(pattern)
    A = _LETTER_BITS[np.frombuffer("".join(a_list).encode("ascii", "replace"), dtype=np.uint8)].reshape(n, la)
    B = np.array([code_mask(c) for c in pattern.upper()], dtype=np.uint8)
    return rolling_distances(lambda i, j: (A[:, i] & B[j]) != 0, la, lb, n, transpositions)


def _distance_udf(transpositions: bool):
    @F.pandas_udf(T.IntegerType())
    def dist(match: pd.Series, pattern: pd.Series, limit: pd.Series) -> pd.Series:
        """Distance, or NULL when it exceeds ``limit`` (applied here so the result is used once)."""
        out = pd.Series(pd.array([None] * len(match), dtype="Int32"), index=match.index)
        ok = match.notna() & pattern.notna()
        frame = pd.DataFrame({"m": match[ok], "p": pattern[ok]})
        frame["n"] = frame["m"].str.len()
        for (p, _), grp in frame.groupby(["p", "n"], sort=False):
            if len(grp) == 0:
                continue
            # primer sites repeat: compute each distinct text once per batch
            uniq, inv = np.unique(grp["m"].to_numpy(dtype=object), return_inverse=True)
            if uniq[0] == "":
                vals = np.full(len(uniq), len(p), dtype=np.int32)
            else:
                vals = _set_distance(list(uniq), p, transpositions)
            out.loc[grp.index] = vals[inv]
        lim = pd.Series(pd.array(limit, dtype="Int32"), index=match.index)
        over = (out > lim).fillna(False).astype(bool)
        out[over] = pd.NA
        return out
    return dist


_OSA = None
_LEV = None


def set_distance(match: Column, pattern: Column, metric: str = "osa", limit: Column | None = None) -> Column:
    """Distance between a literal string and a degenerate (IUPAC) pattern, case-insensitive;
    NULL beyond ``limit``."""
    global _OSA, _LEV
    lim = limit if limit is not None else F.lit(None).cast("int")
    if metric == "osa":
        _OSA = _OSA or _distance_udf(True)
        return _OSA(F.upper(match), pattern, lim)
    if metric == "levenshtein":
        _LEV = _LEV or _distance_udf(False)
        return _LEV(F.upper(match), pattern, lim)
    raise ValueError(metric)


def score_primer_errors(matches: DataFrame, primers: DataFrame, metric: str = "osa",
                        keep_best: bool = True) -> DataFrame:
    """forward_primer_errors / reverse_primer_errors = distance to the closest
    disambiguation of the primer, NULL when even that is farther than the primer length.

    The minimum over the disambiguations is computed by letting a base match a code that
    stands for it, so no dictionary is made and a primer may be as degenerate as it likes.
    ``metric`` is ``osa`` (optimal string alignment) or ``levenshtein`` (no transpositions).
    Primer sites repeat across sequences: each distinct text is scored once per Arrow batch.

    With ``keep_best``, one row per (primer_name, accession) survives the forward step
    (fewest errors first), as in the original arrange + distinct.
    """
    info = checked_broadcast(primer_info(primers).select("primer_name", "forward_sequence", "reverse_rc", "flen", "rlen"))
    cols = [c for c in matches.columns if c not in ("flen", "rlen")]
    df = matches.select(*cols).join(info, on="primer_name", how="left")

    def errors(match: str, pattern: str, limit: str) -> Column:
        return set_distance(F.col(match), F.col(pattern), metric, F.col(limit)).cast("double")

    df = df.withColumn("forward_primer_errors", errors("forward_primer_match", "forward_sequence", "flen"))
    if keep_best:
        df = keep_first(df, ["primer_name", "accession"], [asc("forward_primer_errors")])
    df = df.withColumn("reverse_primer_errors", errors("reverse_primer_match", "reverse_rc", "rlen"))
    return df.drop("forward_sequence", "reverse_rc")


# ------------------------------------------------------------------------------------------
# Seed sequences
# ------------------------------------------------------------------------------------------

def seed_sequences(seqs: DataFrame, primers: DataFrame, max_error: float = MAX_ERROR,
                   metric: str = "osa", tolerance: float = CROP_TOLERANCE,
                   exact_bounds: bool = False) -> DataFrame:
    """Crop, score, keep amplicons whose length without primers lies strictly within
    expected ± tolerance, and cut the primers off.

    Output: primer_name, accession, sequence, length, forward_primer_match,
    forward_primer_errors, reverse_primer_match, reverse_primer_errors.
    """
    crops = crop_by_primers(seqs, primers, max_error, keep=("accession", "beeid"))
    scored = score_primer_errors(primer_matches(crops, primers, exact_bounds), primers, metric)
    info = checked_broadcast(primer_info(primers).select("primer_name", "expected_length"))
    lo, hi = C.length_bounds("expected_length", tolerance)
    # score_primer_errors already leaves one row per (primer_name, accession) and the reverse
    # distance is a per-row minimum, so the original second "best reverse match" pick is
    # implied: the length filter only removes rows.
    kept = (scored.join(info, on="primer_name", how="left")
            .filter((F.col("length_without_primers") > lo) & (F.col("length_without_primers") < hi)))
    start = F.col("flen") + 1
    end = F.col("sequence_length") - F.col("rlen")
    return kept.select(
        "primer_name", "accession",
        C.substr_inclusive("sequence", start, end).alias("sequence"),
        F.col("length_without_primers").alias("length"),
        "forward_primer_match", "forward_primer_errors", "reverse_primer_match", "reverse_primer_errors")


def prepare_sequences(database: DataFrame) -> DataFrame:
    """Sequences for cropping from a FASTA-header table: header fields unpacked, one row per
    (sequence, beeid) (smallest accession first)."""
    from barcodeforge.operators.cleaning import split_headers
    t = split_headers(database.select("header", "sequence"))
    return keep_first(t, ["sequence", "beeid"], ["accession"])


# ------------------------------------------------------------------------------------------
# Summary and dedup
# ------------------------------------------------------------------------------------------

def seed_context(seeds: DataFrame, primers: DataFrame, sequences: DataFrame, with_original: bool = True) -> DataFrame:
    """Seeds with their primer's gene / expected length and the source record's taxonomy
    (family, species, genus), one row per (primer_name, accession, sequence).

    ``sequences`` is the table the seeds were cropped from (:func:`prepare_sequences`: header
    fields unpacked, one row per (sequence, beeid)), so the database is de-duplicated once
    for both uses (Spark reuses the identical exchange within one plan). Without
    ``with_original`` the uncropped sequence is left out (the statistics do not read it).
    """
    meta = checked_broadcast(primers.select(F.col("primer").alias("primer_name"), "gene",
                                      F.col("length").alias("expected_length")))
    recs = sequences.select("accession", "family", "species", "subspecies", "beeid",
                            *([F.col("sequence").alias("original_sequence")] if with_original else []))
    recs = (recs.withColumns({c: F.translate(F.col(c), "_", " ") for c in ("species", "subspecies")})
            .withColumn("genus", C.genus_of("species")))
    s = seeds.withColumn("source", C.source_tag("accession")).join(meta, on="primer_name", how="left")
    from barcodeforge.functions.nulls import join_null_safe
    s = join_null_safe(s, recs, ["accession"], how="left")
    return keep_first(s, ["primer_name", "accession", "sequence"], ["beeid"])


_COUNTED = ("accession", "sequence", "family", "genus", "species")
_MEASURED = ("length", "forward_primer_errors", "reverse_primer_errors", "primer_errors")


def _median(histogram: Column) -> Column:
    """Exact median of ``(number, n)`` structs: the number that half of the rows do not exceed, or
    the middle between it and the next."""
    total = F.aggregate(histogram, F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))

    def step(s, x):
        seen = s["seen"] + x["n"]
        return F.struct(seen.alias("seen"), F.coalesce(s["low"], F.when(2 * seen >= total, x["number"])).alias("low"),
                        F.coalesce(s["high"], F.when(2 * seen > total, x["number"])).alias("high"))

    return F.aggregate(F.array_sort(histogram), start, step, lambda s: (s["low"] + s["high"]) / 2)


def primer_summary(seeds_in_context: DataFrame) -> DataFrame:
    """One row per primer with the coverage, length and primer-error statistics.

    Missing values make min / max / mean / median NULL (as the original). Distinct counts
    count a missing value as one.

    The input is read once. Every row is counted under each of its values, so that a first partial
    aggregation leaves a primer's distinct values with their counts: a histogram, of which the
    second takes all statistics. Names are held by digests; what a primer gathers at the end are
    its distinct lengths and error numbers.
    """
    g = ["primer_name", "gene", "expected_length"]
    both = F.col("forward_primer_errors") + F.col("reverse_primer_errors")
    cells = [F.struct(F.lit(c).alias("kind"), F.unhex(F.md5(F.col(c).cast("string"))).alias("name"), F.lit(None).cast("double").alias("number"))
             for c in _COUNTED]
    cells += [F.struct(F.lit(c).alias("kind"), F.lit(None).cast("binary").alias("name"), (both if c == "primer_errors" else F.col(c)).cast("double").alias("number"))
              for c in _MEASURED]
    values = seeds_in_context.select(*g, F.explode(F.array(*cells)).alias("v")).select(*g, "v.*")
    counted = values.groupBy(*g, "kind", "name", "number").agg(F.count(F.lit(1)).alias("n"))
    aggregates = [F.count(F.when(F.col("kind") == c, 1)).alias(f"n_{c}") for c in _COUNTED]
    for c in _MEASURED:
        own = F.col("kind") == c
        missing = F.coalesce(F.max(own & F.col("number").isNull()), F.lit(False))
        known = lambda agg, missing=missing: F.when(~missing, agg)
        number, n = F.when(own, F.col("number")), F.when(own, F.col("n"))
        aggregates += [
            known(F.min(number)).alias(f"min_{c}"), known(F.max(number)).alias(f"max_{c}"), known(F.sum(number * n) / F.sum(n)).alias(f"mean_{c}"),
            known(F.collect_list(F.when(own, F.struct("number", "n")))).alias(f"histogram_{c}")]
    stats = counted.groupBy(*g).agg(*aggregates)
    stats = stats.withColumns({f"median_{c}": _median(F.col(f"histogram_{c}")) for c in _MEASURED if c != "primer_errors"})
    at_median = F.aggregate("histogram_length", F.lit(0).cast("bigint"),
                            lambda s, x: s + F.when(x["number"] == F.col("median_length"), x["n"]).otherwise(0))
    kind = seeds_in_context.schema["length"].dataType
    out = stats.withColumn("n_median", F.coalesce(at_median, F.lit(0).cast("bigint")))

    def errors(side: str) -> list[Column]:
        c = f"{side}_primer_errors"
        return [F.col(f"min_{c}").alias(f"min_{side}_errors"), F.col(f"max_{c}").alias(f"max_{side}_errors"),
                F.bround(f"mean_{c}", 1).alias(f"mean_{side}_errors"), F.bround(f"median_{c}", 0).alias(f"median_{side}_errors")]

    return out.select(
        *g, "n_accession", F.col("n_sequence").alias("n_seqs"), F.col("n_family").alias("n_families"), F.col("n_genus").alias("n_genera"),
        "n_species", F.col("min_length").cast(kind).alias("min_length"), F.col("max_length").cast(kind).alias("max_length"),
        (F.col("max_length") - F.col("min_length")).cast(kind).alias("length_diff"),
        F.bround("mean_length", 1).alias("mean_length"), "median_length", "n_median",
        F.bround(F.col("n_median") / F.col("n_sequence") * 100, 1).alias("percent_median"),
        (F.col("expected_length") - F.col("median_length")).alias("median_diff"),
        F.col("n_sequence").alias("n_sequences"), *errors("forward"), *errors("reverse"),
        F.bround("mean_primer_errors", 1).alias("mean_primer_errors"))


def dedup_seeds(seeds: DataFrame) -> DataFrame:
    """One seed per (primer_name, sequence), the smallest accession kept."""
    return keep_first(seeds.select("primer_name", "accession", "sequence"), ["primer_name", "sequence"], ["accession"])

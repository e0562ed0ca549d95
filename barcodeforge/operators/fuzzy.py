"""Joins on nearly equal strings.

Two strings within ``d`` edits share pieces: cut one side's string into two more pieces than the
edits can touch, and two of them stand unchanged in the other string, moved by at most ``d``
places. So pairs of pieces of one side join substrings of the other by hash, and only strings that
share a pair are compared. Insertions, deletions and substitutions touch one piece each; the swap
of two neighbours that the OSA metric allows may touch two. Where to cut is learnt from all
strings, so that a word that many of them share fills no more than one piece.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barcodeforge.operators.partitioning import materialize, shuffled


def rolling_distances(same, la: int, lb: int, n: int, transpositions: bool) -> np.ndarray:
    """Edit distances of n pairs of strings of ``la`` and ``lb`` letters, three rows of the
    recurrence at a time; ``same(i, j)`` tells for all pairs whether letters i and j match."""
    rows = [np.repeat(np.arange(lb + 1, dtype=np.int16)[:, None], n, axis=1) for _ in range(3)]
    for i in range(1, la + 1):
        before, last, row = rows[(i - 2) % 3], rows[(i - 1) % 3], rows[i % 3]
        row[0] = i
        for j in range(1, lb + 1):
            best = np.minimum(np.minimum(last[j], row[j - 1]) + 1, last[j - 1] + ~same(i - 1, j - 1))
            if transpositions and i > 1 and j > 1:
                swapped = same(i - 1, j - 2) & same(i - 2, j - 1)
                best = np.where(swapped, np.minimum(best, before[j - 2] + 1), best)
            row[j] = best
    return rows[la % 3][lb].astype(np.int32)


def osa_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Optimal string alignment distance of every pair, by code points."""
    out = np.zeros(len(a), dtype=np.int32)
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64).reshape(-1, 2)
    kinds, kind = np.unique(sizes, axis=0, return_inverse=True)
    for k, (la, lb) in enumerate(kinds.tolist()):
        at = np.flatnonzero(kind.ravel() == k)
        left, right = (np.frombuffer("".join(x[i] for i in at).encode("utf-32-le"), dtype=np.uint32).reshape(len(at), n)
                       for x, n in ((a, la), (b, lb)))
        out[at] = rolling_distances(lambda i, j: left[:, i] == right[:, j], la, lb, len(at), True)  # noqa: B023
    return out


@F.pandas_udf(T.IntegerType())
def _osa(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(osa_distances(a.tolist(), b.tolist()))


def _cuts(texts: DataFrame, col: str, count: int) -> DataFrame:
    """``whole, cuts``: for every length of a text where texts of that length are cut into
    ``count`` pieces, as ``count + 1`` places from 0. Each piece tells about the same number of
    texts apart: a letter weighs its entropy given the letter before it, over all texts of that
    length, so words that many texts have in common make one piece and not several. Any cut
    would do; this one keeps pieces from being shared by very many texts. One row per length."""
    n = F.length(col)
    letters = texts.select(n.alias("whole"), F.col(col).alias("_t"), F.explode(F.sequence(F.lit(1), n + 1)).alias("_i"))
    pair = F.when(F.col("_i") > 1, F.expr("substring(_t, _i - 1, 2)")).otherwise(F.expr("substring(_t, 1, 1)"))
    before = F.when(F.col("_i") > 1, F.expr("substring(_t, _i - 1, 1)")).otherwise("")
    counts = letters.groupBy("whole", "_i", before.alias("_before"), pair.alias("_pair")).agg(F.count("*").alias("_n"))
    spent = F.sum("_n") * F.log2(F.sum("_n")) - F.sum(F.col("_n") * F.log2("_n"))
    bits = counts.groupBy("whole", "_i", "_before").agg(spent.alias("_bits"), F.sum("_n").alias("_n"))
    # a little for every letter, so that texts without differences are cut evenly
    bits = bits.groupBy("whole", "_i").agg((F.greatest(F.sum("_bits"), F.lit(0.0)) / F.sum("_n") + 0.01).alias("_bits"))
    bits = bits.where("_i <= whole").unionByName(bits.where("whole = 0"))
    by = Window.partitionBy("whole")
    upto, total = F.sum("_bits").over(by.orderBy("_i")), F.sum("_bits").over(by)
    placed = bits.select("whole", "_i", F.floor(count * (upto - F.col("_bits") / 2) / total).alias("_piece"))
    places = [F.count(F.when((F.col("_i") <= F.col("whole")) & (F.col("_piece") < k), 1)).cast("int") for k in range(count)]
    return placed.groupBy("whole").agg(F.array(*places, F.first("whole")).alias("cuts"))


def _moves(count: int, limit: int) -> list[list[tuple[int, int, int, int]]]:
    """For each difference ``-limit .. limit`` of the lengths (the cut text's less the other's) the
    ways ``(k, l, move of k, move of l)`` in which pieces k < l may stand unchanged in the other
    text. Before, between and after them there are at least as many edits as they are moved; an
    insertion counts to the piece that it comes before, so there is none between neighbours."""
    out = []
    for shift in range(-limit, limit + 1):
        out.append([(k, m, a, b) for k, m in combinations(range(count), 2)
                    for a in range(-limit, limit + 1) for b in range(-limit, limit + 1)
                    if abs(a) + abs(b - a) + abs(shift + b) <= limit
                    and (k > 0 or a == 0) and (m > k + 1 or a == b) and (m < count - 1 or b == -shift)])
    return out


def _keys(texts: DataFrame, col: str, cuts: DataFrame, moves: list[list[tuple[int, int, int, int]]]) -> DataFrame:
    """A row per text and pair of pieces that it may have unchanged: the text and a hash of both."""
    limit = len(moves) // 2
    lists = ", ".join("array(" + ", ".join(f"named_struct('k', {k}, 'l', {m}, 'a', {a}, 'b', {b})" for k, m, a, b in some) + ")" for some in moves)
    rows = texts.withColumn("_n", F.length(col)).withColumn("_shift", F.explode(F.sequence(F.lit(-limit), F.lit(limit))))
    # one row per length of a text, which every task needs
    rows = rows.withColumn("whole", F.col("_n") + F.col("_shift")).join(F.broadcast(cuts), "whole")
    rows = rows.withColumn("_m", F.expr(f"explode(array({lists})[_shift + {limit}])"))
    rows = rows.selectExpr(f"`{col}`", "whole", "_n", "_m.k", "_m.l", "cuts[_m.k] + _m.a AS _p", "cuts[_m.k + 1] - cuts[_m.k] AS _ps",
                           "cuts[_m.l] + _m.b AS _q", "cuts[_m.l + 1] - cuts[_m.l] AS _qs")
    rows = rows.where("_p >= 0 AND _p + _ps <= _n AND _q >= 0 AND _q + _qs <= _n")
    return rows.selectExpr(f"`{col}`", f"xxhash64(whole, k, l, substring(`{col}`, _p + 1, _ps), substring(`{col}`, _q + 1, _qs)) AS key")


def fuzzy_pairs(left: DataFrame, right: DataFrame, left_col: str, right_col: str, max_distance: int, metric: str = "osa",
                ignore_case: bool = True) -> DataFrame:
    """``left_text, right_text, distance``: every pair of distinct texts (lower-cased unless case
    counts) within ``max_distance`` edits. ``metric`` is ``osa`` or ``levenshtein``. NULLs have
    no distance. Copies of a text are one text; two pieces that very many texts share are one hot
    join key, which Spark splits."""
    if metric not in ("osa", "levenshtein"):
        raise ValueError(metric)
    if max_distance < 0:
        raise ValueError("max_distance is at least 0")

    def texts(df: DataFrame, col: str, name: str) -> DataFrame:
        text = F.col(col).cast("string")
        return df.select((F.lower(text) if ignore_case else text).alias(name)).where(F.col(name).isNotNull()).distinct()

    count = (2 if metric == "osa" else 1) * max_distance + 2
    asked, held = texts(left, left_col, "left_text"), materialize(texts(right, right_col, "right_text"))
    cuts = materialize(_cuts(held, "right_text", count))
    asked = _keys(asked, "left_text", cuts, _moves(count, max_distance))
    held = _keys(held, "right_text", cuts, [[(k, m, 0, 0) for k, m in combinations(range(count), 2)]])
    met = asked.join(shuffled(held), "key").select("left_text", "right_text")
    if metric == "levenshtein":
        near = met.withColumn("distance", F.levenshtein("left_text", "right_text", max_distance))
        return near.where(F.col("distance").between(0, max_distance)).distinct()
    # a swap is two edits of the plain distance
    near = met.where(F.levenshtein("left_text", "right_text", 2 * max_distance) >= 0).distinct()
    return near.withColumn("distance", _osa("left_text", "right_text")).where(F.col("distance").between(0, max_distance))


def fuzzy_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str, max_distance: int, metric: str = "osa",
               ignore_case: bool = True, how: str = "inner", distance_col: str = "distance") -> DataFrame:
    """Rows of ``left`` and ``right`` whose strings are within ``max_distance`` edits, with the
    distance. ``how`` is ``inner``, ``left``, ``right`` or ``full``; rows without a partner have a
    NULL distance, and so have NULL strings. Column names of the two sides must differ."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(how)
    clash = {*left.columns, distance_col} & set(right.columns)
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    pairs = materialize(fuzzy_pairs(left, right, left_col, right_col, max_distance, metric, ignore_case))
    key = lambda c: F.lower(F.col(c).cast("string")) if ignore_case else F.col(c).cast("string")
    # who meets whom is decided on distinct texts; the rows follow by equality
    a, b = left.withColumn("_left_text", key(left_col)), right.withColumn("_right_text", key(right_col))
    met = a.join(shuffled(pairs).withColumnRenamed("distance", "_distance"), F.col("_left_text") == F.col("left_text"),
                 "left" if how in ("left", "full") else "inner")
    joined = met.join(shuffled(b), F.col("right_text") == F.col("_right_text"), {"inner": "inner", "left": "left", "right": "right", "full": "full"}[how])
    return joined.select(*left.columns, *right.columns, F.col("_distance").alias(distance_col))

"""Row pickers: first row per key, duplicate groups.

``keep_first`` replaces ``distinct(keys, .keep_all = TRUE)`` / ``arrange + distinct`` /
``slice_head(n = 1)``. The survivor is defined by an explicit total order, so the result
does not depend on partitioning. It is written as ``row_number() == 1``: Catalyst turns
that into a partial WindowGroupLimit *before* the shuffle, so a hot key sends at most one
row per map partition to its reducer (skew-safe), then a final limit after it.

``duplicates`` (``get_dupes``) counts each key with a partial aggregation and joins the
counts back; it never buffers a whole key group in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.functions.nulls import join_null_safe


def asc(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.asc_nulls_last()


def desc(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (strings mean ascending, NULLs last).

    Ties under ``order`` are broken by every remaining column, so the survivor is unique.
    """
    order = [asc(o) if isinstance(o, str) else o for o in (order or [])]
    named = {o for o in order if isinstance(o, str)}
    rest = [asc(c) for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def duplicates(df: DataFrame, keys: Sequence[str], count_col: str = "dupe_count") -> DataFrame:
    """Rows whose key combination occurs more than once, with the group size.

    NULL keys group together (null-safe join back).
    """
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))
    return join_null_safe(df, counts, list(keys), how="inner")


def collapse_in_order(df: DataFrame, by: Sequence[str], cols: Sequence[str], order_by: Column, sep: str = ", ",
                      drop_empty: bool = False) -> DataFrame:
    """One row per group with the distinct values of every column joined by ``sep`` in the order of
    their first appearance, which is the least ``order_by`` of a value (ties: the smaller value).
    NULLs are left out; a column without values gives ''.

    Two partial aggregations: the least position of each value, then the list of a group's
    values. So what a group gathers is its distinct values, and neither the number of
    partitions nor the order of the rows matters.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("string").alias("_value")) for c in cols])
    values = df.select(*by, order_by.alias("_at"), F.explode(cells).alias("_c")).select(*by, "_at", "_c.*")
    first = values.groupBy(*by, "_name", "_value").agg(F.min("_at").alias("_at"))
    wanted = F.col("_value").isNotNull() & ((F.col("_value") != "") if drop_empty else F.lit(True))
    listed = F.collect_list(F.when(wanted, F.struct("_at", "_value")))
    lists = first.groupBy(*by, "_name").agg(F.array_join(F.transform(F.array_sort(listed), lambda x: x["_value"]), sep).alias("_list"))
    return lists.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == c, F.col("_list"))).alias(c) for c in cols])

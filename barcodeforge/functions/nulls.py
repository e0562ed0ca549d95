"""NULL-semantics helpers.

The pipeline's semantics differ from SQL in four places; every operator uses these
helpers instead of ad-hoc expressions:

* joins match NULL with NULL (``<=>``), still planned as equi-joins by Catalyst;
* ``n_distinct`` counts NULL as one value;
* min/max/mean/median return NULL when any input is NULL;
* ``x %in% v`` is NULL-safe, so membership filters are null-safe anti/semi joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_distinct_na(c: Column | str) -> Column:
    """Distinct count where NULL counts as one more value."""
    c = _c(c)
    return (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long")


def na_propagate(agg: Column, c: Column | str) -> Column:
    """``agg`` over ``c`` unless a NULL is present in the group, then NULL."""
    return F.when(F.count(_c(c)) == F.count(F.lit(1)), agg)


def _cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    conds = [(left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]) for a, b in pairs]
    return reduce(lambda x, y: x & y, conds)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str] | dict, how: str = "left",
                   null_safe: bool = True) -> DataFrame:
    """Join that treats NULL keys as equal (dplyr default).

    ``on`` is a list of shared key names or a ``{left_key: right_key}`` mapping. Shared key
    columns appear once, taken from the side that always exists for the join type.
    """
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    tmp = {b: f"__r_{i}_{b}" for i, (_, b) in enumerate(pairs)}
    r = right.withColumnsRenamed(tmp)
    rp = [(a, tmp[b]) for a, b in pairs]
    joined = left.join(r, _cond(left, r, rp, null_safe), how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    # like dplyr: the key columns come from the left side (right keys are dropped); for
    # right / full joins the key value is taken from whichever side has the row.
    if how in ("right", "right_outer", "rightouter"):
        joined = joined.withColumns({a: F.col(tmp[b]) for a, b in pairs})
    elif how in ("full", "outer", "full_outer", "fullouter"):
        joined = joined.withColumns({a: F.coalesce(left[a], F.col(tmp[b])) for a, b in pairs})
    return joined.drop(*[tmp[b] for _, b in pairs])


def anti_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str] | dict) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (``!x %in% v``; NULL matches NULL)."""
    return join_null_safe(left, right, on, how="left_anti")


def semi_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str] | dict) -> DataFrame:
    return join_null_safe(left, right, on, how="left_semi")

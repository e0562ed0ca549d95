"""Scalar column expressions (JVM-side, codegen friendly).

Each helper returns a ``Column``; the string semantics follow the R/stringr behaviour
the pipeline was written against (see README, "Semantics").
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_quote(sep: str) -> str:
    """Regex that matches ``sep`` literally (Spark ``split`` takes a regex)."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", sep)


def squish(c: Column | str) -> Column:
    """Collapse internal white-space runs (no-break and other Unicode spaces too) to one space
    and trim both ends."""
    return F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def remove_all(c: Column | str, pattern: str) -> Column:
    return F.regexp_replace(_c(c), pattern, "")


def remove_leading(c: Column | str, pattern: str) -> Column:
    """Remove one anchored leading match (``str_remove(x, '^N+')``)."""
    return F.regexp_replace(_c(c), "^(?:" + pattern + ")", "")


def split_part(c: Column | str, sep: str, n: int) -> Column:
    """n-th (1-based) piece of a literal split; NULL past the end."""
    return F.try_element_at(F.split(_c(c), java_quote(sep)), F.lit(n))


def split_into(df: DataFrame, col: str, sep: str, names: Sequence[str], drop: bool = True) -> DataFrame:
    """``separate``: one column into ``names``; extra pieces dropped, missing ones NULL."""
    parts = F.split(F.col(col), java_quote(sep))
    out = df.withColumns({n: F.try_element_at(parts, F.lit(i + 1)) for i, n in enumerate(names)})
    if drop and col not in names:
        out = out.drop(col)
    return out


def pack(cols: Sequence[Column | str], sep: str = ";", null_text: str = "NA") -> Column:
    """``unite``: join columns with ``sep``, NULL printed as ``null_text``."""
    return F.array_join(F.array(*[_c(c).cast("string") for c in cols]), sep, null_text)


def genus_of(species: Column | str) -> Column:
    """First word of a binomial."""
    return F.try_element_at(F.split(_c(species), " "), F.lit(1))


def parent_binomial(name: Column | str) -> Column:
    """First two words joined by a space; a missing word prints as ``NA``."""
    parts = F.split(_c(name), " ")
    return F.array_join(F.array(F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))), " ", "NA")


def blank_to_null(c: Column | str, blanks: Sequence[str] = ("", "NA")) -> Column:
    c = _c(c)
    return F.when(c.isin(*blanks), F.lit(None).cast("string")).otherwise(c)


def source_tag(accession: Column | str) -> Column:
    """Sequence source inferred from the accession shape: a dash means the second source."""
    return F.when(F.instr(_c(accession), "-") > 0, F.lit("BOLD")).otherwise(F.lit("NCBI"))


def substr_inclusive(c: Column | str, start: Column | str, end: Column | str) -> Column:
    """1-based inclusive substring ``[start, end]``; empty when end < start."""
    start, end = _c(start), _c(end)
    length = F.greatest(end - start + 1, F.lit(0))
    return F.substring(_c(c), start, length)


def zero_pad_id(prefix: str, n: Column | str, width: int = 5) -> Column:
    """``prefix`` + integer padded to ``width`` digits; never truncates."""
    return F.format_string(f"{prefix}%0{width}d", _c(n))


def collapse_distinct(c: Column | str, sep: str = ", ", drop_empty: bool = False) -> Column:
    """Aggregate: sorted distinct non-NULL values joined by ``sep`` ('' when none)."""
    s = F.collect_set(_c(c))
    if drop_empty:
        s = F.filter(s, lambda x: x != F.lit(""))
    return F.array_join(F.array_sort(s), sep)


def length_bounds(expected: Column | str, tolerance: Column | float) -> tuple[Column, Column]:
    """(min, max) = expected ∓ expected·tolerance, as doubles."""
    e = _c(expected).cast("double")
    t = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return e - e * t, e + e * t


def gene_tolerance(gene: Column | str, cox1: float = 0.05, other: float = 0.15) -> Column:
    """Length tolerance by gene: tighter for COX1."""
    return F.when(_c(gene) == F.lit("COX1"), F.lit(cox1)).otherwise(F.lit(other))


def header_matches(header: Column | str, pattern: str) -> Column:
    """Case-insensitive regex search over a FASTA header (``grep -nri -p``)."""
    return _c(header).rlike("(?i)" + pattern)


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """The column names from ``first`` to ``last`` inclusive, by position (``a:b``)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        raise ValueError(f"{last!r} comes before {first!r}")
    return cols[i:j + 1]

"""Nucleotide alphabet tables (fixed values) and column expressions built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: IUPAC nucleotide codes -----------------------------------
# code -> the bases it stands for (standard IUPAC-IUB nomenclature)
IUPAC_CODES = {
    "A": "A", "C": "C", "G": "G", "T": "T", "U": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
    "I": "ACGT",  # inosine, in primers: pairs with every base
}
# complement pairs, in the order used by translate()
COMPLEMENT_FROM = "ACGTRYSWKMBDHVNacgtryswkmbdhvn"
COMPLEMENT_TO = "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"
# --- end of fixed values -----------------------------------------------------

BASE_BITS = {"A": 1, "C": 2, "G": 4, "T": 8}


def code_mask(code: str) -> int:
    """4-bit mask of the bases an IUPAC code stands for (0 for non-nucleotides)."""
    bases = IUPAC_CODES.get(code.upper(), "")
    m = 0
    for b in bases:
        m |= BASE_BITS[b]
    return m


def mask_table():
    """256-entry uint8 lookup: byte value -> base mask (lower and upper case)."""
    import numpy as np

    table = np.zeros(256, dtype=np.uint8)
    for code in IUPAC_CODES:
        table[ord(code)] = code_mask(code)
        table[ord(code.lower())] = code_mask(code)
    return table


def revcomp(c: Column | str) -> Column:
    """Reverse complement over the IUPAC alphabet (case kept); JVM-side."""
    c = F.col(c) if isinstance(c, str) else c
    return F.reverse(F.translate(c, COMPLEMENT_FROM, COMPLEMENT_TO))


def revcomp_str(s: str) -> str:
    table = str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO)
    return s.translate(table)[::-1]


def checked_iupac(s: str) -> str:
    """``s`` in upper case; a letter that is no nucleotide code is an error that names it."""
    bad = sorted({c for c in s.upper() if c not in IUPAC_CODES})
    if bad:
        raise ValueError(f"not an IUPAC nucleotide code in {s!r}: {', '.join(map(repr, bad))}")
    return s.upper()


def expand_iupac_str(s: str) -> list[str]:
    """All plain-ACGT strings an IUPAC string stands for (driver-side helper for small inputs)."""
    out = [""]
    for ch in checked_iupac(s):
        out = [p + b for p in out for b in IUPAC_CODES[ch]]
    return out


def _code_map():
    return F.create_map(*[x for k, v in IUPAC_CODES.items() for x in (F.lit(k), F.lit(v))])


def iupac_member(c: Column | str, index: Column | str) -> Column:
    """The ``index``-th (from 0) of the strings an IUPAC string stands for, in the order in which
    the first code varies fastest. One string at a time: nothing grows with how many there are."""
    c = F.col(c) if isinstance(c, str) else c
    index = F.col(index) if isinstance(index, str) else index
    codes = _code_map()
    start = F.struct(index.cast("bigint").alias("rest"), F.lit("").alias("s"))

    def step(acc, ch):
        bases = F.coalesce(F.element_at(codes, ch), ch)
        n = F.length(bases)
        return F.struct(F.floor(acc["rest"] / n).cast("bigint").alias("rest"),
                        F.concat(acc["s"], F.substring(bases, (acc["rest"] % n + 1).cast("int"), F.lit(1))).alias("s"))

    return F.aggregate(F.split(F.upper(c), ""), start, step, lambda acc: acc["s"])


def expansion_size(c: Column | str) -> Column:
    """Number of strings an IUPAC string stands for (product of its codes' sizes), as double."""
    c = F.col(c) if isinstance(c, str) else c
    sizes = F.create_map(*[x for k, v in IUPAC_CODES.items() for x in (F.lit(k), F.lit(float(len(v))))])
    return F.aggregate(F.split(F.upper(c), ""), F.lit(1.0),
                       lambda acc, ch: acc * F.coalesce(F.element_at(sizes, ch), F.lit(1.0)))

"""Sequence-source cleaning and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.functions import columns as C
from barcodeforge.functions.nulls import join_null_safe
from barcodeforge.operators.partitioning import shuffled
from barcodeforge.operators.rowpick import keep_first

HEADER_FIELDS = ("accession", "family", "species", "subspecies", "beeid")
MIN_SEQUENCE_LENGTH = 100  # fixed value: strictly longer sequences are kept


def usable_sequence(col: str = "sequence", min_length: int = MIN_SEQUENCE_LENGTH):
    """Not NULL, not empty, longer than ``min_length`` (the length test implies the rest)."""
    return F.length(F.col(col)) > min_length


def _attach_to_checklist(checklist: DataFrame, seqs: DataFrame, min_length: int) -> DataFrame:
    """Checklist rows joined to sequences on synonym == species (NULL-safe, many-to-many),
    rows without a usable sequence dropped, one row per (beeid, sequence).

    The survivor of each (beeid, sequence) is the smallest accession, then the smallest
    checklist columns, then subspecies. Both sides are first reduced to the only rows that
    can win (exact, and done with partial top-1 before the join's shuffle): one checklist row
    per (beeid, synonym) and one sequence row per (species, sequence). A species with many
    identical sequences no longer multiplies the join.
    """
    rest = [c for c in checklist.columns if c not in ("beeid", "species_synonym")]
    cl = keep_first(checklist, ["beeid", "species_synonym"], rest)
    sq = keep_first(seqs.filter(usable_sequence("sequence", min_length)),
                    ["species", "sequence"], ["accession", "subspecies"])
    joined = join_null_safe(cl, shuffled(sq), {"species_synonym": "species"}, how="left")
    joined = joined.filter(usable_sequence("sequence", min_length))
    return keep_first(joined, ["beeid", "sequence"], ["accession"])


def fasta_accession(header: str = "header"):
    """Accession = header text before the first white-space character."""
    return F.try_element_at(F.split(F.col(header), r"\s"), F.lit(1))


def clean_ncbi(fasta: DataFrame, lineage: DataFrame, checklist: DataFrame,
               target_order: str = "Hymenoptera", normalise: bool = False,
               min_length: int = MIN_SEQUENCE_LENGTH) -> DataFrame:
    """FASTA records (header, sequence) + their lineage (accession, order, species,
    subspecies) -> checklist rows with subspecies, accession, sequence.

    ``normalise=True`` applies the second source's sequence cleaning (gap removal, upper
    case, leading-N trim); off by default, as in the original pipeline.
    """
    recs = fasta.select(fasta_accession("header").alias("accession"), "sequence")
    if normalise:
        recs = recs.withColumn("sequence", normalise_sequence("sequence"))
    lin = lineage.filter(F.col("order") == target_order).select("accession", "species", "subspecies")
    clean = lin.join(shuffled(recs), on="accession", how="left").select("species", "subspecies", "accession", "sequence").distinct()
    return _attach_to_checklist(checklist, clean, min_length)


def normalise_sequence(col: str = "sequence"):
    """Remove gap dashes, upper-case, strip a leading run of N (a trailing run stays)."""
    return C.remove_leading(F.upper(C.remove_all(col, "-")), "N+")


def clean_bold(raw: DataFrame, checklist: DataFrame, min_length: int = MIN_SEQUENCE_LENGTH) -> DataFrame:
    """Raw second-source rows (processid, species, subspecies, nuc) -> checklist rows
    with subspecies, accession, sequence."""
    b = raw.select(F.col("processid").alias("accession"), "species", "subspecies", F.col("nuc").alias("sequence"))
    b = b.withColumn("sequence", normalise_sequence("sequence"))
    b = b.filter(usable_sequence("sequence", min_length) & F.col("species").isNotNull() & (F.col("species") != ""))
    return _attach_to_checklist(checklist, b, min_length)


def merge_sources(ncbi: DataFrame, bold: DataFrame) -> DataFrame:
    """Both cleaned sources in one table with a ``seq_source`` column, one row per
    (sequence, beeid); the first source wins ties, then the smaller accession."""
    both = ncbi.withColumn("seq_source", F.lit("NCBI")).unionByName(bold.withColumn("seq_source", F.lit("BOLD")))
    return keep_first(both, ["sequence", "beeid"], [F.col("seq_source").desc(), "accession"])


def to_fasta_headers(df: DataFrame, species_col: str = "species_final") -> DataFrame:
    """Header ``accession;family;species;subspecies;beeid`` (NULL as NA, spaces as _)."""
    header = C.pack(["accession", "family", species_col, "subspecies", "beeid"], ";", "NA")
    return df.select(F.translate(header, " ", "_").alias("header"), "sequence")


def split_headers(df: DataFrame, header: str = "header", underscores_to_spaces: bool = False) -> DataFrame:
    """Unpack a ``;`` header into accession, family, species, subspecies, beeid."""
    out = C.split_into(df, header, ";", HEADER_FIELDS, drop=True)
    if underscores_to_spaces:
        out = out.withColumns({c: F.translate(F.col(c), "_", " ") for c in ("species", "subspecies")})
    return out

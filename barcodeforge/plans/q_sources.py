"""Queries: source cleaning and merging (T10-T12, O5), FASTA headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.functions import columns as C
from barcodeforge.operators import cleaning as S
from barcodeforge.operators.partitioning import materialize, scratch_path
from barcodeforge.plans.fixtures import duckdb_sql, fixtures
from barcodeforge.plans.q_checklist import CHECKLIST_CTES, CHECKLIST_FIXTURES, checklist_with_ids
from barcodeforge.plans.registry import query
from barcodeforge.sources import io
from barcodeforge.sources.long_fasta import read_fasta_chunks


def ncbi_clean(spark: SparkSession, sf_dir: str, checklist: DataFrame | None = None) -> DataFrame:
    fasta, lin = fixtures(spark, sf_dir, "fx_ncbi_fasta", "fx_ncbi_lineage")
    checklist = checklist if checklist is not None else checklist_with_ids(spark, sf_dir)
    return S.clean_ncbi(fasta, lin.withColumnRenamed("taxon_order", "order"), checklist)


def bold_clean(spark: SparkSession, sf_dir: str, checklist: DataFrame | None = None) -> DataFrame:
    raw, = fixtures(spark, sf_dir, "fx_bold_raw")
    checklist = checklist if checklist is not None else checklist_with_ids(spark, sf_dir)
    return S.clean_bold(raw, checklist)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    checklist = materialize(checklist_with_ids(spark, sf_dir))               # both sources join it
    return S.merge_sources(ncbi_clean(spark, sf_dir, checklist), bold_clean(spark, sf_dir, checklist))


_SRC_FIX = CHECKLIST_FIXTURES + ["fx_ncbi_fasta", "fx_ncbi_lineage", "fx_bold_raw"]

_KEEP_FIRST = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY beeid, sequence ORDER BY accession ASC NULLS LAST,
      species_final, species_synonym, family, source, country, taxid_TSN, valid_authority_ITIS,
      valid_species_ITIS, taxonomic_status, subspecies) AS rn
  FROM {src}) WHERE rn = 1"""

_CHECKLIST_COLS = ("c.species_final, c.species_synonym, c.family, c.source, c.country, c.taxid_TSN, "
                   "c.valid_authority_ITIS, c.valid_species_ITIS, c.taxonomic_status, c.beeid")

_SRC_CTES = CHECKLIST_CTES + [
    ("ncbi_recs", r"""
SELECT string_split_regex(header, '\s')[1] AS accession, sequence FROM fx_ncbi_fasta"""),
    ("ncbi_cl", """
SELECT DISTINCT l.species, l.subspecies, l.accession, r.sequence
FROM fx_ncbi_lineage l LEFT JOIN ncbi_recs r ON l.accession = r.accession
WHERE l.taxon_order = 'Hymenoptera'"""),
    ("ncbi_j", f"""
SELECT {_CHECKLIST_COLS}, n.subspecies, n.accession, n.sequence
FROM checklist c JOIN ncbi_cl n ON c.species_synonym IS NOT DISTINCT FROM n.species
WHERE length(n.sequence) > 100"""),
    ("ncbi", _KEEP_FIRST.format(src="ncbi_j")),
    ("bold_b", """
SELECT accession, species, subspecies, sequence FROM (
  SELECT processid AS accession, species, subspecies,
         regexp_replace(upper(replace(nuc, '-', '')), '^(?:N+)', '') AS sequence
  FROM fx_bold_raw)
WHERE length(sequence) > 100 AND species IS NOT NULL AND species <> ''"""),
    ("bold_j", f"""
SELECT {_CHECKLIST_COLS}, b.subspecies, b.accession, b.sequence
FROM checklist c JOIN bold_b b ON c.species_synonym IS NOT DISTINCT FROM b.species
WHERE length(b.sequence) > 100"""),
    ("bold", _KEEP_FIRST.format(src="bold_j")),
    ("merged", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY sequence, beeid ORDER BY seq_source DESC, accession ASC NULLS LAST,
      species_final, species_synonym, family, source, country, taxid_TSN, valid_authority_ITIS,
      valid_species_ITIS, taxonomic_status, subspecies) AS rn
  FROM (SELECT *, 'NCBI' AS seq_source FROM ncbi UNION ALL BY NAME SELECT *, 'BOLD' AS seq_source FROM bold))
WHERE rn = 1"""),
]


def _src_oracle(body: str) -> str:
    return duckdb_sql(_SRC_FIX, body, ctes=_SRC_CTES)


@query("clean_ncbi", _src_oracle("SELECT * FROM ncbi"))
def q_clean_ncbi(spark, sf_dir):
    return ncbi_clean(spark, sf_dir)


@query("clean_bold", _src_oracle("SELECT * FROM bold"))
def q_clean_bold(spark, sf_dir):
    return bold_clean(spark, sf_dir)


@query("merge_sources", _src_oracle("SELECT * FROM merged"))
def q_merge_sources(spark, sf_dir):
    return merged(spark, sf_dir)


@query("fasta_headers", _src_oracle("""
SELECT replace(coalesce(accession, 'NA') || ';' || coalesce(family, 'NA') || ';' || coalesce(species_final, 'NA')
               || ';' || coalesce(subspecies, 'NA') || ';' || coalesce(beeid, 'NA'), ' ', '_') AS header,
       sequence
FROM merged"""))
def q_fasta_headers(spark, sf_dir):
    return S.to_fasta_headers(merged(spark, sf_dir))


@query("split_headers", duckdb_sql(["fx_database"], """
SELECT string_split(header, ';')[1] AS accession, string_split(header, ';')[2] AS family,
       string_split(header, ';')[3] AS species, string_split(header, ';')[4] AS subspecies,
       string_split(header, ';')[5] AS beeid, accession AS acc_column, sequence
FROM fx_database"""))
def q_split_headers(spark, sf_dir):
    db, = fixtures(spark, sf_dir, "fx_database")
    return S.split_headers(db.withColumnRenamed("accession", "acc_column"))


_PATTERN = "^acc[0-9]*[37](-25)? .*OXIDASE subunit i gene"


@query("header_pattern", duckdb_sql(["fx_ncbi_fasta"], f"""
SELECT header FROM fx_ncbi_fasta WHERE regexp_matches(header, '{_PATTERN}', 'i')"""))
def q_header_pattern(spark, sf_dir):
    """records whose header matches a pattern (case-insensitive)."""
    fasta, = fixtures(spark, sf_dir, "fx_ncbi_fasta")
    return fasta.filter(C.header_matches("header", _PATTERN)).select("header")


@query("fasta_roundtrip", duckdb_sql(["fx_database"], "SELECT header, sequence FROM fx_database"))
def q_fasta_roundtrip(spark, sf_dir):
    """K4 then S5 over the whole database: write FASTA (wrapped at 60) into the session's
    checkpoint folder (shared storage on a cluster), read it back as (header, sequence)."""
    db, = fixtures(spark, sf_dir, "fx_database")
    path = scratch_path(spark, "fasta")
    io.write_fasta(db, path, width=60)
    return io.read_fasta(spark, path)


@query("fasta_missing", duckdb_sql(["fx_bold_raw"], """
SELECT coalesce(species, 'NA') AS header, CASE WHEN length(nuc) < 190 THEN '' ELSE nuc END AS sequence
FROM fx_bold_raw WHERE species IS NULL OR species <> ''"""))
def q_fasta_missing(spark, sf_dir):
    """K4 then S5 over the second source's records: a missing name is written as ``NA``, a missing
    sequence as an empty body; a record with a blank header has no name to be read by."""
    raw, = fixtures(spark, sf_dir, "fx_bold_raw")
    rows = raw.select("species", F.when(F.length("nuc") >= 190, F.col("nuc")).alias("nuc"))
    path = scratch_path(spark, "fasta")
    io.write_fasta(rows, path, header="species", sequence="nuc", width=60)
    return io.read_fasta(spark, path)


@query("fasta_chunks", duckdb_sql(["fx_database"], """
SELECT header, CAST(60 * k AS BIGINT) AS start, substr(sequence, CAST(60 * k + 1 AS BIGINT), 85) AS sequence
FROM (SELECT header, sequence, unnest(range(0, (length(sequence) + 59) // 60)) AS k FROM fx_database)
WHERE k = 0 OR length(sequence) > 60 * k + 25"""))
def q_fasta_chunks(spark, sf_dir):
    """S5 for records of any length: lines of a FASTA file as chunks of 60 letters and 25 more."""
    db, = fixtures(spark, sf_dir, "fx_database")
    path = scratch_path(spark, "fasta")
    io.write_fasta(db, path, width=50)
    return read_fasta_chunks(spark, path, 60, 25).select("header", "start", "sequence")

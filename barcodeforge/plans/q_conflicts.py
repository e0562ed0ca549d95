"""Queries: duplicate removal and conflict flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barcodeforge.functions import columns as C
from barcodeforge.operators import conflicts as G
from barcodeforge.plans.fixtures import duckdb_sql, fixture
from barcodeforge.plans.registry import query

# ---------------------------------------------------------------------------------------
# conflicts (G1-G4): the sequence table with a genus column
# ---------------------------------------------------------------------------------------

def sequence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = fixture(spark, sf_dir, "fx_sequences")
    return seqs.withColumn("genus", C.genus_of("species"))


_DB_CTE = ("db", "SELECT *, split_part(species, ' ', 1) AS genus FROM fx_sequences")

def dedup_sql(src: str = "db", by: str = "", group: str = "sequence") -> str:
    """CTEs dups .. dedup for the duplicate-removal rule over ``src`` (``by``: 'a, b, ')."""
    on_by = "".join(f"k.{c.strip()} IS NOT DISTINCT FROM d.{c.strip()} AND " for c in by.split(",") if c.strip())
    on_by_r = on_by.replace("k.", "r.")
    return f"""
dups AS (
  SELECT *, count(*) OVER (PARTITION BY {by}sequence, species) AS dupe_count FROM {src}
), dups2 AS (SELECT * FROM dups WHERE dupe_count > 1),
keep AS (
  SELECT {by}accession FROM (
    SELECT {by}accession, row_number() OVER (PARTITION BY {by}{group}
        ORDER BY dupe_count DESC, species ASC NULLS LAST, accession ASC NULLS LAST) AS rn
    FROM dups2) WHERE rn = 1
), remove AS (
  SELECT DISTINCT {by}accession FROM dups2 d
  WHERE NOT EXISTS (SELECT 1 FROM keep k WHERE {on_by}k.accession IS NOT DISTINCT FROM d.accession)
), dedup AS (
  SELECT * FROM {src} d
  WHERE NOT EXISTS (SELECT 1 FROM remove r WHERE {on_by_r}r.accession IS NOT DISTINCT FROM d.accession)
)"""


def conflict_sql(src: str, by: str = "") -> str:
    """CTEs conf, conf2: per-sequence conflict summary over ``src``."""
    def names(c):
        x = f"CASE WHEN {c} <> '' THEN {c} END"
        return f"coalesce(string_agg(DISTINCT {x}, ', ' ORDER BY {x}), '')"
    return f"""
conf AS (
  SELECT {by}sequence, count(*) AS conflict_count,
         count(DISTINCT species) AS sc, count(DISTINCT genus) AS gc, count(DISTINCT family) AS fc,
         {names('species')} AS sp, {names('genus')} AS ge, {names('family')} AS fa
  FROM {src} GROUP BY {by}sequence HAVING count(*) > 1
), conf2 AS (
  SELECT {by}sequence, conflict_count,
         CASE WHEN fc > 1 THEN 'family' WHEN gc > 1 THEN 'genus' WHEN sc > 1 THEN 'species' END AS conflict_level,
         CASE WHEN fc > 1 THEN fa WHEN gc > 1 THEN ge WHEN sc > 1 THEN sp END AS conflict_taxa
  FROM conf
)"""


def flagged_select(by: str = "") -> str:
    on_by = "".join(f"d.{c.strip()} IS NOT DISTINCT FROM c.{c.strip()} AND " for c in by.split(",") if c.strip())
    return f"""
SELECT d.*, c.conflict_count, c.conflict_level, c.conflict_taxa
FROM dedup d LEFT JOIN conf2 c ON {on_by}d.sequence IS NOT DISTINCT FROM c.sequence
"""


def _dedup_oracle(group: str, final: str) -> str:
    body = ", " + dedup_sql("db", "", group).strip() + ",\n" + conflict_sql("dedup").strip()
    return duckdb_sql(["fx_sequences"], body + "\n" + final, ctes=[_DB_CTE])


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: dedup + conflict flags over the whole sequence table."""
    return G.sequence_database(sequence_table(spark, sf_dir))


query("sequence_database", _dedup_oracle("sequence", flagged_select()))(entry_query)


@query("dedup_taxa", _dedup_oracle("sequence", "SELECT * FROM dedup"))
def q_dedup_taxa(spark, sf_dir):
    return G.dedup_taxa(sequence_table(spark, sf_dir))


@query("dedup_taxa_per_species", _dedup_oracle("sequence, species", "SELECT * FROM dedup"))
def q_dedup_taxa_per_species(spark, sf_dir):
    return G.dedup_taxa(sequence_table(spark, sf_dir), scope="sequence_species")


@query("duplicate_groups", duckdb_sql(["fx_sequences"], """
SELECT * FROM (
  SELECT *, count(*) OVER (PARTITION BY sequence, species) AS dupe_count FROM db
) WHERE dupe_count > 1""", ctes=[_DB_CTE]))
def q_duplicate_groups(spark, sf_dir):
    from barcodeforge.operators.rowpick import duplicates
    return duplicates(sequence_table(spark, sf_dir), ["sequence", "species"])


@query("sequence_conflicts", duckdb_sql(["fx_sequences"], ",\n" + conflict_sql("db").strip() + """
SELECT * FROM conf2""", ctes=[_DB_CTE]))
def q_sequence_conflicts(spark, sf_dir):
    return G.conflict_table(sequence_table(spark, sf_dir))

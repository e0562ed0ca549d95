"""Queries: the whole build from checklist and sources to the flagged database, and every file
format written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.operators import cleaning as S
from barcodeforge.operators import conflicts as G
from barcodeforge.operators import homology as H
from barcodeforge.operators import primers as P
from barcodeforge.operators.partitioning import checked_broadcast, materialize, scratch_path
from barcodeforge.plans.fixtures import duckdb_sql, fixtures
from barcodeforge.plans.q_conflicts import conflict_sql, dedup_sql, flagged_select
from barcodeforge.plans.q_homology import HIT_CTES, search_ctes
from barcodeforge.plans.q_primers import _CONTEXT_CTES, PRIMER_CTES, _oracle, exact_seeds, sequences
from barcodeforge.plans.q_sources import _SRC_CTES, _SRC_FIX, merged
from barcodeforge.plans.registry import query
from barcodeforge.sources import io


@query("seed_context", _oracle("SELECT * FROM ctx", _CONTEXT_CTES))
def q_seed_context(spark, sf_dir):
    """Seeds with their primer, their record's taxonomy and the source their accession tells."""
    _, pr, seqs = sequences(spark, sf_dir)
    return P.seed_context(exact_seeds(spark, sf_dir)[0], pr, seqs)


# ---------------------------------------------------------------------------------------
# the whole build
# ---------------------------------------------------------------------------------------

def _reading(ctes: list[tuple[str, str]], **other: str) -> list[tuple[str, str]]:
    out = []
    for name, text in ctes:
        for old, new in other.items():
            text = text.replace(old, new)
        out.append((name, text))
    return out


_BUILD_CTES = [
    *_SRC_CTES,
    ("built", """
SELECT replace(coalesce(accession, 'NA') || ';' || coalesce(family, 'NA') || ';' || coalesce(species_final, 'NA')
               || ';' || coalesce(subspecies, 'NA') || ';' || coalesce(beeid, 'NA'), ' ', '_') AS header, sequence
FROM merged"""),
    *_reading(PRIMER_CTES, fx_database="built"),
    ("chosen", """
SELECT primer_name, accession AS qseqid, sequence FROM seeds
QUALIFY row_number() OVER (PARTITION BY primer_name, sequence ORDER BY accession) = 1"""),
    ("subjects", "SELECT header AS sseqid, sequence FROM built"),
    *search_ctes("chosen", "subjects"),
    *_reading(HIT_CTES, fx_hits="h1", fx_database="built"),
]


@query("build_database", duckdb_sql(
    [*_SRC_FIX, "fx_primers"],
    ", " + dedup_sql("oriented", "primer_name, ").strip() + ",\n" + conflict_sql("dedup", "primer_name, ").strip()
    + "\n" + flagged_select("primer_name, "), ctes=_BUILD_CTES, recursive=True))
def q_build_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checklist and both sources -> merged records -> FASTA headers -> seeds by primers -> homology
    search of the records -> taxonomy, crop, length filter, orientation -> de-duplication and flags."""
    pr, = fixtures(spark, sf_dir, "fx_primers")
    db = materialize(S.to_fasta_headers(merged(spark, sf_dir)).select("header", "sequence"))  # three stages read it
    seeds = P.dedup_seeds(P.seed_sequences(P.prepare_sequences(db), pr, max_error=0, metric="levenshtein"))
    hits = H.homology_search(seeds.withColumnRenamed("accession", "qseqid"), db.select(F.col("header").alias("sseqid"), "sequence"))
    return G.sequence_database(materialize(H.hits_to_database(hits, db, pr)), by=("primer_name",))


# ---------------------------------------------------------------------------------------
# files: written to the session's shared folder and read again
# ---------------------------------------------------------------------------------------

@query("checklist_file", duckdb_sql(["fx_species_list"], """
SELECT family, species_final, species_synonym, source, country FROM fx_species_list"""))
def q_checklist_file(spark, sf_dir):
    """A tab-separated checklist, columns in another order than the reader's."""
    rows, = fixtures(spark, sf_dir, "fx_species_list")
    path = scratch_path(spark, "checklist")
    io.write_tsv(rows, path)
    return io.read_checklist(spark, path)


@query("sequences_file", duckdb_sql(["fx_sequences"], "SELECT * FROM fx_sequences"))
def q_sequences_file(spark, sf_dir):
    """CSV with missing values as ``NA``."""
    rows, = fixtures(spark, sf_dir, "fx_sequences")
    path = scratch_path(spark, "sequences")
    io.write_csv(rows, path)
    return io.read_table_csv(spark, path, rows.schema)


@query("records_file", duckdb_sql(["fx_bold_raw"], "SELECT processid, species, subspecies, nuc FROM fx_bold_raw"))
def q_records_file(spark, sf_dir):
    """K2 and S3: the second source's export, unquoted; blank and missing species differ."""
    rows, = fixtures(spark, sf_dir, "fx_bold_raw")
    path = scratch_path(spark, "records")
    io.write_tsv(rows, path, quoted=False)
    return io.read_bold(spark, path)


_ODD_NAMES = """
SELECT accession, sequence, CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 9 = 1 THEN 'mlCOI:F/jg R+' || primer_name
       WHEN p_size % 9 = 2 THEN '007' WHEN p_size % 9 = 3 THEN '50% ä=' ELSE primer_name END AS primer_name FROM {fx_relatives}"""


@query("primer_files", duckdb_sql(["fx_relatives"], _ODD_NAMES.format(fx_relatives="fx_relatives")))
def q_primer_files(spark, sf_dir):
    """One folder of CSV files per primer, read as one table with the primer's
    name from the path (P3: the columns of the file). Names hold what paths escape, or are missing."""
    rows, = fixtures(spark, sf_dir, "fx_relatives")
    path = scratch_path(spark, "primers")
    io.write_per_primer(spark.sql(_ODD_NAMES, fx_relatives=rows), path)
    from barcodeforge.functions.columns import columns_between
    back = io.read_per_primer(spark, path)
    return back.select(*columns_between(back, "accession", "sequence"), "primer_name")


@query("primer_table_file", duckdb_sql(["fx_primers", "fx_relatives"], """
SELECT r.accession, p.primer, p.gene, p.forward_sequence, p.reverse_sequence, p.length
FROM fx_relatives r LEFT JOIN fx_primers p ON r.primer_name = p.primer"""))
def q_primer_table_file(spark, sf_dir):
    """The primer file, joined to what each primer found."""
    rows, pr = fixtures(spark, sf_dir, "fx_relatives", "fx_primers")
    path = scratch_path(spark, "primer-table")
    io.write_tsv(pr.select("length", "primer", "reverse_sequence", "gene", "forward_sequence"), path)
    table = io.read_primers(spark, path)
    return rows.join(checked_broadcast(table), rows["primer_name"] == table["primer"], "left").select("accession", *table.columns)


@query("name_lines", duckdb_sql(["fx_species_list"], "SELECT DISTINCT trim(species_final) AS name FROM fx_species_list"))
def q_name_lines(spark, sf_dir):
    """K3: one name per line."""
    rows, = fixtures(spark, sf_dir, "fx_species_list")
    path = scratch_path(spark, "names")
    io.write_lines(rows.select(F.trim("species_final").alias("name")).distinct(), "name", path)
    return spark.read.text(path).withColumnRenamed("value", "name")


@query("taxonomy_files", duckdb_sql(["fx_taxa", "fx_accessions"], """
SELECT a.accession, t.taxid, t.rank, t.name FROM fx_accessions a JOIN fx_taxa t ON t.taxid = a.taxid"""))
def q_taxonomy_files(spark, sf_dir):
    """The taxonomy tables as files."""
    taxa, acc = fixtures(spark, sf_dir, "fx_taxa", "fx_accessions")
    path = scratch_path(spark, "taxonomy")
    io.write_table(taxa.select("taxid", "name", F.lit("scientific name").alias("name_class")), f"{path}/names")
    io.write_table(taxa.select("taxid", "parent_taxid", "rank"), f"{path}/nodes")
    io.write_table(acc, f"{path}/accession_taxa")
    names, nodes, accessions = io.read_taxonomy(spark, path)
    return accessions.join(nodes.select("taxid", "rank"), "taxid").join(names.select("taxid", "name"), "taxid")


@query("authority_file", duckdb_sql(["fx_name_authority"], "SELECT * FROM fx_name_authority WHERE data_source = 3"))
def q_authority_file(spark, sf_dir):
    """The name authority as CSV."""
    rows, = fixtures(spark, sf_dir, "fx_name_authority")
    path = scratch_path(spark, "authority")
    io.write_csv(rows, path)
    return io.read_name_authority(spark, path, data_source=3, fmt="csv")

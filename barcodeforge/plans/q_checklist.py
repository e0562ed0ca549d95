"""Queries: checklist harmonisation (T1-T4) and taxonomy lookups and walks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.operators import taxonomy as T
from barcodeforge.operators.fuzzy import fuzzy_join
from barcodeforge.plans.fixtures import duckdb_sql, fixtures
from barcodeforge.plans.registry import query

# ---------------------------------------------------------------------------------------
# checklist
# ---------------------------------------------------------------------------------------


def resolved_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    cl, au = fixtures(spark, sf_dir, "fx_species_list", "fx_name_authority")
    return T.resolve_names(cl, au)


def checklist_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.assign_ids(resolved_checklist(spark, sf_dir))


CHECKLIST_FIXTURES = ["fx_species_list", "fx_name_authority"]
CHECKLIST_CTES = [
    ("cl", r"""
SELECT trim(regexp_replace(species_final, '\s+', ' ', 'g')) AS species_final,
       trim(regexp_replace(species_synonym, '\s+', ' ', 'g')) AS species_synonym,
       family, source, country
FROM fx_species_list"""),
    ("au", """
SELECT submitted_name AS species_final, current_record_id AS taxid_TSN, current_name AS valid_authority_ITIS,
       current_canonical_simple AS valid_species_ITIS, taxonomic_status AS au_status
FROM fx_name_authority WHERE data_source = 3 AND match_type = 'Exact'"""),
    ("res0", """
SELECT CASE WHEN au.au_status = 'Synonym' THEN au.valid_species_ITIS ELSE cl.species_final END AS species_final,
       cl.species_synonym, cl.family, cl.source, cl.country,
       au.taxid_TSN, au.valid_authority_ITIS, au.valid_species_ITIS
FROM cl LEFT JOIN au ON cl.species_final IS NOT DISTINCT FROM au.species_final"""),
    ("resolved", """
SELECT *, CASE WHEN species_final = species_synonym THEN 'accepted' ELSE 'synonym' END AS taxonomic_status
FROM res0"""),
    ("ids", """
SELECT species_final, printf('B%05d', dense_rank() OVER (ORDER BY species_final ASC NULLS LAST)) AS beeid
FROM (SELECT DISTINCT species_final FROM resolved)"""),
    ("checklist", """
SELECT r.*, i.beeid FROM resolved r LEFT JOIN ids i ON r.species_final IS NOT DISTINCT FROM i.species_final"""),
]

_SUMMARY_CTE = ("summary", """
SELECT beeid,
  coalesce(string_agg(DISTINCT family, ', ' ORDER BY family), '') AS family,
  coalesce(string_agg(DISTINCT species_final, ', ' ORDER BY species_final), '') AS species_final,
  coalesce(string_agg(DISTINCT species_synonym, ', ' ORDER BY species_synonym), '') AS species_synonym,
  CAST(count(DISTINCT species_synonym) + max(CASE WHEN species_synonym IS NULL THEN 1 ELSE 0 END) - 1 AS VARCHAR) AS n_synonyms,
  coalesce(string_agg(DISTINCT source, ', ' ORDER BY source), '') AS source,
  coalesce(string_agg(DISTINCT country, ', ' ORDER BY country), '') AS country
FROM checklist GROUP BY beeid""")


def _checklist_oracle(body: str, extra=()) -> str:
    return duckdb_sql(CHECKLIST_FIXTURES, body, ctes=CHECKLIST_CTES + list(extra))


@query("checklist_resolve", _checklist_oracle("SELECT * FROM resolved", []))
def q_checklist_resolve(spark, sf_dir):
    return resolved_checklist(spark, sf_dir)


@query("checklist_ids", _checklist_oracle("SELECT * FROM checklist"))
def q_checklist_ids(spark, sf_dir):
    return checklist_with_ids(spark, sf_dir)


@query("checklist_summary", _checklist_oracle("SELECT * FROM summary", [_SUMMARY_CTE]))
def q_checklist_summary(spark, sf_dir):
    return T.summarise_checklist(checklist_with_ids(spark, sf_dir))


_SUMMARY_COLS = ("family", "species_final", "species_synonym", "source", "country")


def _first_seen(c: str) -> str:
    return f"""
LEFT JOIN (SELECT beeid, string_agg(v, ', ' ORDER BY first_row, v) AS {c} FROM (
  SELECT beeid, {c} AS v, min(concat_ws('|', source, species_synonym, country)) AS first_row
  FROM checklist WHERE {c} IS NOT NULL GROUP BY beeid, {c}) GROUP BY beeid) t_{c} ON t_{c}.beeid = n.beeid"""


@query("checklist_summary_in_order", _checklist_oracle(
    "SELECT n.beeid, n.n_synonyms, " + ", ".join(f"coalesce(t_{c}.{c}, '') AS {c}" for c in _SUMMARY_COLS)
    + " FROM summary n" + "".join(_first_seen(c) for c in _SUMMARY_COLS), [_SUMMARY_CTE]))
def q_checklist_summary_in_order(spark, sf_dir):
    """A2 and T3 with the values in the order of their first appearance: by source, synonym and country."""
    rows = checklist_with_ids(spark, sf_dir)
    return T.summarise_checklist(rows, order_by=F.concat_ws("|", "source", "species_synonym", "country"))


def _per(key: str) -> str:
    return _checklist_oracle(f"""
SELECT {key}, count(DISTINCT species_final) + max(CASE WHEN species_final IS NULL THEN 1 ELSE 0 END) AS n_species
FROM (SELECT family, species_final,
             CASE WHEN contains(country, ',') THEN 'both' ELSE country END AS country FROM summary)
GROUP BY {key}""", [_SUMMARY_CTE])


@query("species_per_family", _per("family"))
def q_species_per_family(spark, sf_dir):
    return T.count_species_by(T.summarise_checklist(checklist_with_ids(spark, sf_dir)), "family")


@query("species_per_country", _per("country"))
def q_species_per_country(spark, sf_dir):
    return T.count_species_by(T.summarise_checklist(checklist_with_ids(spark, sf_dir)), "country")


@query("name_union", _checklist_oracle("""
SELECT DISTINCT name FROM (SELECT species_final AS name FROM checklist
                           UNION ALL SELECT species_synonym FROM checklist) WHERE name IS NOT NULL"""))
def q_name_union(spark, sf_dir):
    return T.all_names(checklist_with_ids(spark, sf_dir))


# ---------------------------------------------------------------------------------------
# taxonomy (T5-T9) over fx_taxa: order > family > species > subspecies
# ---------------------------------------------------------------------------------------


def taxonomy_tables(spark: SparkSession, sf_dir: str):
    taxa, = fixtures(spark, sf_dir, "fx_taxa")
    names = taxa.select("taxid", "name", F.lit("scientific name").alias("name_class"))
    nodes = taxa.select("taxid", "parent_taxid", "rank")
    return names, nodes


def lookup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to look up: every customer name and every part name (most have no taxon)."""
    cust, part = fixtures(spark, sf_dir, "customer", "part")
    return cust.select(F.col("c_name").alias("name")).union(part.select(F.col("p_name").alias("name"))).distinct()


_NAMES_CTES = [
    ("names", "SELECT c_name AS name FROM customer UNION SELECT p_name FROM part"),
    ("tn", "SELECT DISTINCT name, taxid FROM fx_taxa"),
    ("ids", "SELECT n.name, t.taxid FROM names n LEFT JOIN tn t ON n.name = t.name"),
    ("start", "SELECT DISTINCT taxid FROM ids WHERE taxid IS NOT NULL"),
]

_DESC_CTES = _NAMES_CTES + [
    ("d", """
SELECT t.taxid AS node FROM fx_taxa t JOIN start s ON t.parent_taxid = s.taxid
UNION SELECT t.taxid FROM d JOIN fx_taxa t ON t.parent_taxid = d.node"""),
    ("sub", """
SELECT DISTINCT t.name AS subspecies FROM d JOIN fx_taxa t ON t.taxid = d.node WHERE t.rank = 'subspecies'"""),
    ("subids", """
SELECT DISTINCT s.subspecies, tn.taxid,
       coalesce(string_split(s.subspecies, ' ')[1], 'NA') || ' ' || coalesce(string_split(s.subspecies, ' ')[2], 'NA') AS parent
FROM sub s LEFT JOIN tn ON tn.name = s.subspecies"""),
]


@query("names_to_taxids", duckdb_sql(["fx_taxa"], "SELECT * FROM ids", ctes=_NAMES_CTES))
def q_names_to_taxids(spark, sf_dir):
    names, _ = taxonomy_tables(spark, sf_dir)
    return T.names_to_taxids(lookup_names(spark, sf_dir), names)


def species_descendants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    names, nodes = taxonomy_tables(spark, sf_dir)
    ids = T.names_to_taxids(lookup_names(spark, sf_dir), names)
    start = ids.select("taxid").filter(F.col("taxid").isNotNull()).distinct()
    sub = T.descendants(nodes, start, rank="subspecies")
    sub_names = sub.join(names.select("taxid", F.col("name").alias("subspecies")), on="taxid") \
        .select("subspecies").distinct()
    from barcodeforge.functions.columns import parent_binomial
    sub_ids = T.names_to_taxids(sub_names, names, name_col="subspecies") \
        .withColumn("parent", parent_binomial("subspecies")).distinct()
    return start, sub_ids


@query("taxon_descendants", duckdb_sql(["fx_taxa"], "SELECT * FROM subids", ctes=_DESC_CTES, recursive=True))
def q_taxon_descendants(spark, sf_dir):
    return species_descendants(spark, sf_dir)[1]


@query("accessions_for_taxa", duckdb_sql(["fx_taxa", "fx_accessions"], """
SELECT a.accession, a.taxid FROM fx_accessions a
WHERE a.taxid IN (SELECT taxid FROM start UNION SELECT taxid FROM subids WHERE taxid IS NOT NULL)""",
                                         ctes=_DESC_CTES, recursive=True))
def q_accessions_for_taxa(spark, sf_dir):
    start, sub_ids = species_descendants(spark, sf_dir)
    acc, = fixtures(spark, sf_dir, "fx_accessions")
    taxids = start.union(sub_ids.select("taxid"))
    return T.accessions_for(taxids, acc)


def _accession_oracle(anchored: bool) -> str:
    keep = " OR ".join(f"regexp_matches(accession, '{p}')" for p in T.ACCESSION_KEEP_PATTERNS)
    if anchored:
        wgs, tpa = "^(?:" + T.WGS_PREFIXES + ")", "^(?:" + T.TPA_TSA_PREFIXES.rstrip("]") + ")"
    else:
        wgs, tpa = "^" + T.WGS_PREFIXES, "^" + T.TPA_TSA_PREFIXES.replace("]", "\\]")
    return duckdb_sql(["fx_accessions"], f"""
SELECT * FROM fx_accessions
WHERE ({keep}) AND NOT regexp_matches(accession, '{wgs}') AND NOT regexp_matches(accession, '{tpa}')
  AND NOT contains(accession, '_')""")


@query("filter_accessions", _accession_oracle(False))
def q_filter_accessions(spark, sf_dir):
    acc, = fixtures(spark, sf_dir, "fx_accessions")
    return T.filter_accessions(acc)


@query("filter_accessions_anchored", _accession_oracle(True))
def q_filter_accessions_anchored(spark, sf_dir):
    acc, = fixtures(spark, sf_dir, "fx_accessions")
    return T.filter_accessions(acc, anchored=True)


_RANK_COLS = ",\n".join(f"max(CASE WHEN rank = '{r}' THEN name END) AS \"{r}\"" for r in T.LINEAGE_RANKS)


@query("lineage_wide", duckdb_sql(["fx_taxa", "fx_accessions"], f"""
SELECT a.accession, a.taxid, {", ".join(f'w."{r}"' for r in T.LINEAGE_RANKS)}
FROM fx_accessions a LEFT JOIN wide w ON a.taxid = w.taxid""", ctes=[
    ("st", "SELECT DISTINCT taxid FROM fx_accessions WHERE taxid IS NOT NULL"),
    ("anc", """
SELECT st.taxid AS start, st.taxid AS node FROM st JOIN fx_taxa t ON t.taxid = st.taxid
UNION SELECT anc.start, t.parent_taxid FROM anc JOIN fx_taxa t ON t.taxid = anc.node
WHERE t.parent_taxid IS NOT NULL"""),
    ("named", "SELECT anc.start AS taxid, t.rank, t.name FROM anc JOIN fx_taxa t ON t.taxid = anc.node"),
    ("wide", f"SELECT taxid, {_RANK_COLS} FROM named GROUP BY taxid"),
], recursive=True))
def q_lineage_wide(spark, sf_dir):
    names, nodes = taxonomy_tables(spark, sf_dir)
    acc, = fixtures(spark, sf_dir, "fx_accessions")
    return T.lineage(acc, nodes, names)


# ---------------------------------------------------------------------------------------
# Checklist joined to taxon ids (right join), to subspecies (many-to-many left
# join) and to every name (full join); rows missing both ids dropped
# ---------------------------------------------------------------------------------------

@query("checklist_taxa", duckdb_sql(CHECKLIST_FIXTURES + ["fx_taxa"], """
SELECT * FROM full_j WHERE NOT (taxid IS NULL AND taxid_TSN IS NULL)""", ctes=CHECKLIST_CTES + [
    ("tn", "SELECT DISTINCT name, taxid FROM fx_taxa"),
    ("nm", """
SELECT DISTINCT name FROM (SELECT species_final AS name FROM checklist UNION ALL SELECT species_synonym FROM checklist)
WHERE name IS NOT NULL"""),
    ("nm_ids", "SELECT n.name AS species_final, t.taxid FROM nm n LEFT JOIN tn t ON n.name = t.name"),
    ("right_j", """
SELECT i.taxid, c.* FROM nm_ids i RIGHT JOIN checklist c ON i.species_final IS NOT DISTINCT FROM c.species_final"""),
    ("subs", """
SELECT t.name AS subspecies, t.taxid AS subspecies_taxid,
       coalesce(string_split(t.name, ' ')[1], 'NA') || ' ' || coalesce(string_split(t.name, ' ')[2], 'NA') AS species_final
FROM fx_taxa t WHERE t.rank = 'subspecies'"""),
    ("m2m", """
SELECT r.*, s.subspecies, s.subspecies_taxid FROM right_j r
LEFT JOIN subs s ON r.species_final IS NOT DISTINCT FROM s.species_final"""),
    ("full_j", """
SELECT coalesce(m.species_final, n.name) AS species_final, m.* EXCLUDE (species_final)
FROM m2m m FULL JOIN nm n ON m.species_final IS NOT DISTINCT FROM n.name"""),
]))
def q_checklist_taxa(spark, sf_dir):
    from barcodeforge.functions.columns import parent_binomial
    from barcodeforge.functions.nulls import join_null_safe

    checklist = checklist_with_ids(spark, sf_dir)
    names, nodes = taxonomy_tables(spark, sf_dir)
    nm = T.all_names(checklist)
    ids = T.names_to_taxids(nm, names).withColumnRenamed("name", "species_final")
    right_j = join_null_safe(ids, checklist, ["species_final"], how="right")                 # J8
    taxa, = fixtures(spark, sf_dir, "fx_taxa")
    subs = taxa.filter(F.col("rank") == "subspecies").select(
        F.col("name").alias("subspecies"), F.col("taxid").alias("subspecies_taxid"),
        parent_binomial("name").alias("species_final"))
    m2m = join_null_safe(right_j, subs, ["species_final"], how="left")                     # J10
    full_j = join_null_safe(m2m, nm.withColumnRenamed("name", "species_final"), ["species_final"], how="full")  # J9
    return full_j.dropna(how="all", subset=["taxid", "taxid_TSN"])                          # F12


@query("fuzzy_names", duckdb_sql(["fx_written_names", "fx_known_names"], """
SELECT w.record, w.written_name, k.known_name, k.family, CAST(levenshtein(lower(w.written_name), lower(k.known_name)) AS INT) AS distance
FROM fx_written_names w LEFT JOIN fx_known_names k ON levenshtein(lower(w.written_name), lower(k.known_name)) <= 2"""))
def q_fuzzy_names(spark, sf_dir):
    """J6 on two string columns: misspelt names and the known names within two edits of each."""
    written, known = fixtures(spark, sf_dir, "fx_written_names", "fx_known_names")
    return fuzzy_join(written, known, "written_name", "known_name", 2, metric="levenshtein", how="left")


@query("fuzzy_names_full", duckdb_sql(["fx_written_names", "fx_known_names"], """
SELECT w.record, w.written_name, k.known_name, k.family, CAST(levenshtein(w.written_name, k.known_name) AS INT) AS distance
FROM (SELECT * FROM fx_written_names WHERE record % 3 <> 0) w FULL JOIN fx_known_names k ON levenshtein(w.written_name, k.known_name) <= 1"""))
def q_fuzzy_names_full(spark, sf_dir):
    """J6 as a full join where case counts: known names that nobody wrote stay, too."""
    written, known = fixtures(spark, sf_dir, "fx_written_names", "fx_known_names")
    return fuzzy_join(written.filter("record % 3 <> 0"), known, "written_name", "known_name", 1, metric="levenshtein",
                      ignore_case=False, how="full")

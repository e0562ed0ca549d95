"""Queries: homology search (H1) and hit post-processing (H2-H6, A12), then the per-primer
sequence database with duplicates removed and conflicts flagged (G3, G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.functions.iupac import COMPLEMENT_FROM, COMPLEMENT_TO
from barcodeforge.operators import conflicts as G
from barcodeforge.operators import homology as H
from barcodeforge.operators import primers as P
from barcodeforge.operators.partitioning import materialize
from barcodeforge.plans.fixtures import duckdb_sql, fixtures
from barcodeforge.plans.q_conflicts import conflict_sql, dedup_sql, flagged_select
from barcodeforge.plans.q_primers import PRIMER_CTES
from barcodeforge.plans.registry import query


def hit_inputs(spark: SparkSession, sf_dir: str):
    return fixtures(spark, sf_dir, "fx_hits", "fx_database", "fx_primers")


def best_hits(spark, sf_dir):
    hits, db, pr = hit_inputs(spark, sf_dir)
    return H.best_hit_per_subject(hits), db, pr


def oriented(spark, sf_dir):
    best, db, pr = best_hits(spark, sf_dir)
    return H.orient(H.filter_length(H.crop_by_position(H.attach_taxonomy(best, db)), pr)), best


HIT_CTES = [
    ("best", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY primer_name, sseqid
      ORDER BY bitscore DESC NULLS LAST, length DESC NULLS LAST, sstart ASC NULLS LAST, send ASC NULLS LAST,
               qcovs DESC NULLS LAST) AS rn
  FROM (SELECT * EXCLUDE (qseqid) FROM fx_hits)) WHERE rn = 1"""),
    ("tax0", """
SELECT b.*, d.sequence, replace(string_split(b.sseqid, ';')[3], '_', ' ') AS sp,
       replace(string_split(b.sseqid, ';')[4], '_', ' ') AS ssp
FROM best b LEFT JOIN (SELECT header, min(sequence) AS sequence FROM fx_database GROUP BY header) d ON b.sseqid = d.header"""),
    ("tax", """
SELECT primer_name, sstart, send, length, qcovs, bitscore, sequence,
       string_split(sseqid, ';')[1] AS accession, string_split(sseqid, ';')[2] AS family,
       sp AS species, CASE WHEN ssp IN ('', 'NA') THEN NULL ELSE ssp END AS subspecies,
       string_split(sseqid, ';')[5] AS beeid, string_split(sp, ' ')[1] AS genus,
       CASE WHEN sstart > send THEN send ELSE sstart END AS start,
       CASE WHEN sstart > send THEN sstart ELSE send END AS "end",
       coalesce(sstart > send, false) AS reversed
FROM tax0"""),
    ("crop", """
SELECT DISTINCT primer_name, length, accession, family, species, subspecies, beeid, genus, start, "end", reversed,
       substring(sequence, start, greatest("end" - start + 1, 0)) AS sequence
FROM tax"""),
    ("flt", """
SELECT c.*, p.gene FROM crop c LEFT JOIN fx_primers p ON c.primer_name = p.primer
WHERE c.length > CAST(p.length AS DOUBLE) - CAST(p.length AS DOUBLE) * CASE WHEN p.gene = 'COX1' THEN 0.05 ELSE 0.15 END
  AND c.length < CAST(p.length AS DOUBLE) + CAST(p.length AS DOUBLE) * CASE WHEN p.gene = 'COX1' THEN 0.05 ELSE 0.15 END"""),
    ("oriented", f"""
SELECT * REPLACE (CASE WHEN reversed THEN reverse(translate(sequence, '{COMPLEMENT_FROM}', '{COMPLEMENT_TO}'))
                       ELSE sequence END AS sequence)
FROM flt"""),
]

_HFIX = ["fx_hits", "fx_database", "fx_primers"]


def _hit_oracle(body: str, extra=()) -> str:
    return duckdb_sql(_HFIX, body, ctes=HIT_CTES + list(extra))


@query("best_hit", _hit_oracle("SELECT * FROM best"))
def q_best_hit(spark, sf_dir):
    return best_hits(spark, sf_dir)[0]


@query("hit_taxonomy", _hit_oracle("SELECT * FROM tax"))
def q_hit_taxonomy(spark, sf_dir):
    best, db, _ = best_hits(spark, sf_dir)
    return H.attach_taxonomy(best, db)


@query("hit_crop_oriented", _hit_oracle("SELECT * FROM oriented"))
def q_hit_crop_oriented(spark, sf_dir):
    return oriented(spark, sf_dir)[0]


_STAGES = [("seeds", "seeds"), ("candidates", "best"), ("filtered", "oriented")]


@query("stage_counts", duckdb_sql(["fx_primers", "fx_database", "fx_hits"], " UNION ALL ".join(f"""
SELECT p.primer AS primer_name, '{name}' AS stage, count(r.primer_name) AS n_rows
FROM fx_primers p LEFT JOIN {rows} r ON r.primer_name = p.primer GROUP BY p.primer""" for name, rows in _STAGES),
    ctes=PRIMER_CTES + HIT_CTES, recursive=True))
def q_stage_counts(spark, sf_dir):
    final, best = oriented(spark, sf_dir)
    db, pr = fixtures(spark, sf_dir, "fx_database", "fx_primers")
    seeds = P.seed_sequences(P.prepare_sequences(db), pr, max_error=0, metric="levenshtein")
    return H.stage_counts(materialize(best.select("primer_name")), final, seeds, pr)


@query("hit_sequence_database", duckdb_sql(
    _HFIX,
    ", " + dedup_sql("oriented", "primer_name, ").strip() + ",\n" + conflict_sql("dedup", "primer_name, ").strip()
    + "\n" + flagged_select("primer_name, "), ctes=HIT_CTES))
def q_hit_sequence_database(spark, sf_dir):
    final, _ = oriented(spark, sf_dir)
    return G.sequence_database(materialize(final), by=("primer_name",))      # stage boundary: filtered hits


# --- H1: the search itself -------------------------------------------------------------------

def search_ctes(seeds: str, subjects: str) -> list[tuple[str, str]]:
    """CTEs up to ``h1`` (the hit table) for seeds (primer_name, qseqid, sequence) and subjects
    (sseqid, sequence): every pair that shares a run of 28 bases, every diagonal's best
    segment, every chain of segments, and the best chain per primer and subject."""
    return [
        ("h_q", f"""
SELECT primer_name, qseqid, '+' AS strand, upper(sequence) AS q FROM {seeds}
UNION ALL
SELECT primer_name, qseqid, '-', reverse(translate(upper(sequence), '{COMPLEMENT_FROM}', '{COMPLEMENT_TO}')) FROM {seeds}"""),
        ("h_s", f"SELECT sseqid, upper(sequence) AS s FROM {subjects}"),
        ("h_qk", """
SELECT DISTINCT * FROM (SELECT primer_name, qseqid, strand, p, substring(q, p, 28) AS word
  FROM (SELECT *, unnest(range(1, length(q) - 26)) AS p FROM h_q)) WHERE regexp_full_match(word, '[ACGT]{28}')"""),
        ("h_sk", """
SELECT * FROM (SELECT sseqid, s, p, substring(s, p, 28) AS word
  FROM (SELECT *, unnest(range(1, length(s) - 26)) AS p FROM h_s)) WHERE regexp_full_match(word, '[ACGT]{28}')"""),
        ("h_d", """
SELECT DISTINCT a.primer_name, a.qseqid, a.strand, b.sseqid, b.s, b.p - a.p AS d FROM h_qk a JOIN h_sk b USING (word)"""),
        ("h_c", """
SELECT *, CASE WHEN substring(q, i, 1) = substring(s, i + d, 1) AND substring(q, i, 1) IN ('A', 'C', 'G', 'T') THEN 1 ELSE -2 END AS v
FROM (SELECT h_d.*, h_q.q, unnest(range(greatest(1, 1 - d), least(length(h_q.q), length(h_d.s) - d) + 1)) AS i
      FROM h_d JOIN h_q USING (primer_name, qseqid, strand))"""),
        ("h_p", """
SELECT primer_name, qseqid, strand, sseqid, s, d, i, v,
       sum(v) OVER (PARTITION BY primer_name, qseqid, strand, sseqid, s, d ORDER BY i) AS upto FROM h_c"""),
        ("h_g", """
SELECT *, upto - least AS gain FROM (
  SELECT *, min(upto - v) OVER (PARTITION BY primer_name, qseqid, strand, sseqid, s, d ORDER BY i) AS least FROM h_p)"""),
        ("h_e", """
SELECT * FROM h_g QUALIFY row_number() OVER (PARTITION BY primer_name, qseqid, strand, sseqid, s, d ORDER BY gain DESC, i) = 1"""),
        ("h_seg", """
SELECT e.primer_name, e.qseqid, e.strand, e.sseqid, e.s, e.d, CAST(e.gain AS INT) AS score, min(p.i) AS q0, e.i AS q1
FROM h_e e JOIN h_p p ON p.primer_name = e.primer_name AND p.qseqid = e.qseqid AND p.strand = e.strand
  AND p.sseqid = e.sseqid AND p.s = e.s AND p.d = e.d AND p.i <= e.i AND p.upto - p.v = e.least
GROUP BY ALL"""),
        ("h_chain", """
SELECT primer_name, qseqid, strand, sseqid, s, q0 AS first_q, q0 + d AS first_s, d, q0, q1, score FROM h_seg
UNION ALL
SELECT c.primer_name, c.qseqid, c.strand, c.sseqid, c.s, c.first_q, c.first_s, g.d, g.q0, g.q1, CAST(c.score + g.score
       - (3 + abs(g.d - c.d) + greatest(0, c.q1 - g.q0 + 1, c.q1 + c.d - g.q0 - g.d + 1)
          + 2 * greatest(0, least(g.q0 - c.q1 - 1, g.q0 + g.d - c.q1 - c.d - 1))) AS INT)
FROM h_chain c JOIN h_seg g ON g.primer_name = c.primer_name AND g.qseqid = c.qseqid AND g.strand = c.strand
  AND g.sseqid = c.sseqid AND g.s = c.s
WHERE g.d <> c.d AND g.q0 > c.q0 AND g.q1 > c.q1 AND g.q0 + g.d > c.q0 + c.d AND g.q1 + g.d > c.q1 + c.d
  AND greatest(0, c.q1 - g.q0 + 1, c.q1 + c.d - g.q0 - g.d + 1) < least(g.q1 - g.q0 + 1, c.q1 - c.q0 + 1)"""),
        ("h1", """
SELECT primer_name, qseqid, sseqid, sstart, send, length, qcovs, bitscore FROM (
  SELECT c.primer_name, c.qseqid, c.sseqid,
         CAST(CASE WHEN c.strand = '+' THEN first_s ELSE q1 + d END AS INT) AS sstart,
         CAST(CASE WHEN c.strand = '+' THEN q1 + d ELSE first_s END AS INT) AS send,
         CAST(greatest(q1 - first_q, q1 + d - first_s) + 1 AS INT) AS length,
         round_even((q1 - first_q + 1) / length(h_q.q) * 100, 0) AS qcovs,
         round_even((1.28 * score - ln(0.46)) / ln(2.0), 1) AS bitscore
  FROM h_chain c JOIN h_q USING (primer_name, qseqid, strand) WHERE score >= 0)
QUALIFY row_number() OVER (PARTITION BY primer_name, sseqid
    ORDER BY bitscore DESC, length DESC, sstart, send, qcovs DESC, qseqid) = 1"""),
    ]


_RELATIVES = ["fx_relatives", "fx_relative_seeds"]
_SEARCH_ORACLE = duckdb_sql(_RELATIVES, "SELECT * FROM h1", ctes=[
    ("rel", "SELECT header AS sseqid, sequence FROM fx_relatives"), *search_ctes("fx_relative_seeds", "rel")], recursive=True)


def relatives(spark: SparkSession, sf_dir: str):
    subjects, seeds = fixtures(spark, sf_dir, *_RELATIVES)
    return seeds, subjects.select(F.col("header").alias("sseqid"), "sequence")


@query("homology_search", _SEARCH_ORACLE)
def q_homology_search(spark, sf_dir):
    return H.homology_search(*relatives(spark, sf_dir))


@query("homology_search_join", _SEARCH_ORACLE)
def q_homology_search_join(spark, sf_dir):
    """H1 over an index that is built once: each primer's seeds are a search of their own, and
    frequent words are split."""
    seeds, subjects = relatives(spark, sf_dir)
    index = H.search_index(subjects, split=4)
    found = [H.homology_search(seeds.filter(F.col("primer_name") == p), index) for p in ("P1", "P3")]
    return found[0].unionByName(found[1])


def search_inputs(spark: SparkSession, sf_dir: str):
    """Deduplicated exact seeds of every primer, and the whole database as subjects."""
    db, pr = fixtures(spark, sf_dir, "fx_database", "fx_primers")
    seeds = P.dedup_seeds(P.seed_sequences(P.prepare_sequences(db), pr, max_error=0, metric="levenshtein"))
    return seeds.withColumnRenamed("accession", "qseqid"), db.select(F.col("header").alias("sseqid"), "sequence"), db, pr


def _found(name: str) -> tuple[str, str]:
    """A hit CTE that reads the search's hits in place of the given ones."""
    text = dict(HIT_CTES)[name]
    return name, text.replace("fx_hits", "h1")


_BUILD_ORACLE = duckdb_sql(
    ["fx_primers", "fx_database"],
    ", " + dedup_sql("oriented", "primer_name, ").strip() + ",\n" + conflict_sql("dedup", "primer_name, ").strip()
    + "\n" + flagged_select("primer_name, "),
    ctes=[*PRIMER_CTES, ("chosen", """
SELECT primer_name, accession AS qseqid, sequence FROM seeds
QUALIFY row_number() OVER (PARTITION BY primer_name, sequence ORDER BY accession) = 1"""),
          ("subjects", "SELECT header AS sseqid, sequence FROM fx_database"),
          *search_ctes("chosen", "subjects"), *[_found(n) for n, _ in HIT_CTES]], recursive=True)


@query("homology_sequence_database", _BUILD_ORACLE)
def q_homology_sequence_database(spark, sf_dir) -> DataFrame:
    seeds, subjects, db, pr = search_inputs(spark, sf_dir)
    hits = H.homology_search(seeds, subjects)
    final = materialize(H.hits_to_database(hits, db, pr))                   # stage boundary: filtered hits
    return G.sequence_database(final, by=("primer_name",))

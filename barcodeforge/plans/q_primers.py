"""Queries: in-silico PCR.

Oracle-checked queries use the exact scan (``max_error=0``) and Levenshtein scoring, which
SQL can express (regex with IUPAC classes, a recursive disambiguation, ``levenshtein`` over
the dictionary list). The default fuzzy scan with OSA scoring is registered without an
oracle and checked against brute force in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.functions.iupac import IUPAC_CODES
from barcodeforge.operators import primers as P
from barcodeforge.operators.partitioning import materialize
from barcodeforge.plans.fixtures import duckdb_sql, fixtures
from barcodeforge.plans.registry import query


def sequences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    db, pr = fixtures(spark, sf_dir, "fx_database", "fx_primers")
    return db, pr, P.prepare_sequences(db)


def exact_crops(spark, sf_dir):
    _, pr, seqs = sequences(spark, sf_dir)
    return P.crop_by_primers(seqs, pr, 0, keep=("accession", "beeid")), pr


def exact_seeds(spark, sf_dir):
    _, pr, seqs = sequences(spark, sf_dir)
    return P.seed_sequences(seqs, pr, max_error=0, metric="levenshtein"), pr


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v + "'" for v in r) + ")" for r in rows)


_CODES = _values((k, b) for k, v in IUPAC_CODES.items() for b in v if k != "U")
_CLASSES = _values((k, P.iupac_class(k)) for k in IUPAC_CODES if k != "U")

PRIMER_CTES = [
    ("codes", f"SELECT * FROM (VALUES {_CODES}) AS t(code, base)"),
    ("classes", f"SELECT * FROM (VALUES {_CLASSES}) AS t(code, cls)"),
    ("pr", """
SELECT primer AS primer_name, gene, length AS expected_length, upper(forward_sequence) AS f,
       reverse(translate(upper(reverse_sequence), 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN')) AS r,
       CAST(length(forward_sequence) AS INTEGER) AS flen, CAST(length(reverse_sequence) AS INTEGER) AS rlen
FROM fx_primers"""),
    ("fpos", "SELECT primer_name, f, unnest(range(1, length(f) + 1)) AS i FROM pr"),
    ("rpos", "SELECT primer_name, r, unnest(range(1, length(r) + 1)) AS i FROM pr"),
    ("fpat", """
SELECT p.primer_name, string_agg(c.cls, '' ORDER BY p.i) AS fp
FROM fpos p JOIN classes c ON c.code = substring(p.f, p.i, 1) GROUP BY p.primer_name"""),
    ("rpat", """
SELECT p.primer_name, string_agg(c.cls, '' ORDER BY p.i) AS rp
FROM rpos p JOIN classes c ON c.code = substring(p.r, p.i, 1) GROUP BY p.primer_name"""),
    ("pat", """
SELECT primer_name, '(?:' || fp || ').*?(?:' || rp || ')' AS pattern FROM fpat JOIN rpat USING (primer_name)"""),
    ("fexp", """
SELECT primer_name, 0 AS pos, '' AS s FROM pr
UNION ALL
SELECT e.primer_name, e.pos + 1, e.s || c.base
FROM fexp e JOIN pr ON pr.primer_name = e.primer_name
JOIN codes c ON c.code = substring(pr.f, e.pos + 1, 1)
WHERE e.pos < pr.flen"""),
    ("rexp", """
SELECT primer_name, 0 AS pos, '' AS s FROM pr
UNION ALL
SELECT e.primer_name, e.pos + 1, e.s || c.base
FROM rexp e JOIN pr ON pr.primer_name = e.primer_name
JOIN codes c ON c.code = substring(pr.r, e.pos + 1, 1)
WHERE e.pos < pr.rlen"""),
    ("fd", """
SELECT e.primer_name, list(e.s) AS fdict FROM fexp e JOIN pr USING (primer_name)
WHERE e.pos = pr.flen GROUP BY e.primer_name"""),
    ("rd", """
SELECT e.primer_name, list(e.s) AS rdict FROM rexp e JOIN pr USING (primer_name)
WHERE e.pos = pr.rlen GROUP BY e.primer_name"""),
    ("hdr", """
SELECT string_split(header, ';')[1] AS accession, string_split(header, ';')[2] AS family,
       string_split(header, ';')[3] AS species, string_split(header, ';')[4] AS subspecies,
       string_split(header, ';')[5] AS beeid, sequence
FROM fx_database"""),
    ("seqs", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY sequence, beeid
                               ORDER BY accession, family, species, subspecies) AS rn FROM hdr)
WHERE rn = 1"""),
    ("crops", """
SELECT * FROM (
  SELECT pat.primer_name, s.accession, s.beeid, regexp_extract(s.sequence, pat.pattern, 0) AS sequence
  FROM seqs s CROSS JOIN pat)
WHERE sequence <> ''"""),
    ("m", """
SELECT c.primer_name, c.accession, c.beeid, c.sequence, pr.flen, pr.rlen,
       CAST(length(c.sequence) AS INTEGER) AS sequence_length,
       substring(c.sequence, 1, pr.flen) AS forward_primer_match,
       substring(c.sequence, length(c.sequence) - pr.rlen, pr.rlen + 1) AS reverse_primer_match,
       CAST(length(c.sequence) - (pr.flen + pr.rlen) AS INTEGER) AS length_without_primers
FROM crops c LEFT JOIN pr USING (primer_name)"""),
    ("fe0", """
SELECT m.*, CAST(CASE WHEN d <= flen THEN d END AS DOUBLE) AS forward_primer_errors FROM (
  SELECT m.*, list_min(list_transform(fd.fdict, lambda x: levenshtein(upper(m.forward_primer_match), x))) AS d
  FROM m LEFT JOIN fd USING (primer_name)) m"""),
    ("fe", """
SELECT * EXCLUDE (rn, d) FROM (
  SELECT *, row_number() OVER (PARTITION BY primer_name, accession
                               ORDER BY forward_primer_errors ASC NULLS LAST, beeid, sequence) AS rn FROM fe0)
WHERE rn = 1"""),
    ("re", """
SELECT * EXCLUDE (d) FROM (
  SELECT fe.*, CAST(CASE WHEN d <= rlen THEN d END AS DOUBLE) AS reverse_primer_errors FROM (
    SELECT fe.*, list_min(list_transform(rd.rdict, lambda x: levenshtein(upper(fe.reverse_primer_match), x))) AS d
    FROM fe LEFT JOIN rd USING (primer_name)) fe)"""),
    ("kept", """
SELECT * EXCLUDE (rn) FROM (
  SELECT re.*, pr.expected_length, row_number() OVER (PARTITION BY re.primer_name, re.accession
      ORDER BY reverse_primer_errors ASC NULLS LAST, forward_primer_errors ASC NULLS LAST, beeid, sequence) AS rn
  FROM re LEFT JOIN pr USING (primer_name)
  WHERE length_without_primers > expected_length - expected_length * 0.2
    AND length_without_primers < expected_length + expected_length * 0.2)
WHERE rn = 1"""),
    ("seeds", """
SELECT primer_name, accession, substring(sequence, flen + 1, greatest(sequence_length - rlen - flen, 0)) AS sequence,
       length_without_primers AS length, forward_primer_match, forward_primer_errors,
       reverse_primer_match, reverse_primer_errors
FROM kept"""),
]

_FIX = ["fx_primers", "fx_database"]


def _oracle(body: str, extra=()) -> str:
    return duckdb_sql(_FIX, body, ctes=PRIMER_CTES + list(extra), recursive=True)


@query("primer_exact_crop", _oracle("SELECT * FROM crops"))
def q_primer_exact_crop(spark, sf_dir):
    return exact_crops(spark, sf_dir)[0]


@query("primer_match_columns", _oracle("SELECT * FROM m"))
def q_primer_match_columns(spark, sf_dir):
    crops, pr = exact_crops(spark, sf_dir)
    return P.primer_matches(crops, pr)


@query("primer_errors_levenshtein", _oracle("SELECT * FROM re"))
def q_primer_errors_levenshtein(spark, sf_dir):
    crops, pr = exact_crops(spark, sf_dir)
    return P.score_primer_errors(P.primer_matches(crops, pr), pr, metric="levenshtein")


@query("seed_sequences_exact", _oracle("SELECT * FROM seeds"))
def q_seed_sequences_exact(spark, sf_dir):
    return exact_seeds(spark, sf_dir)[0]


@query("seed_dedup", _oracle("""
SELECT primer_name, accession, sequence FROM (
  SELECT *, row_number() OVER (PARTITION BY primer_name, sequence ORDER BY accession) AS rn FROM seeds)
WHERE rn = 1"""))
def q_seed_dedup(spark, sf_dir):
    return P.dedup_seeds(exact_seeds(spark, sf_dir)[0])


_CONTEXT_CTES = [
    ("recs", """
SELECT accession, family, replace(species, '_', ' ') AS species, replace(subspecies, '_', ' ') AS subspecies,
       beeid, sequence AS original_sequence, split_part(replace(species, '_', ' '), ' ', 1) AS genus
FROM seqs"""),
    ("ctx", """
SELECT * EXCLUDE (rn) FROM (
  SELECT s.*, CASE WHEN contains(s.accession, '-') THEN 'BOLD' ELSE 'NCBI' END AS source,
         pr.gene, pr.expected_length, r.family, r.species, r.subspecies, r.beeid, r.original_sequence, r.genus,
         row_number() OVER (PARTITION BY s.primer_name, s.accession, s.sequence ORDER BY r.beeid, r.family, r.species, r.subspecies, r.original_sequence) AS rn
  FROM seeds s LEFT JOIN pr USING (primer_name)
  LEFT JOIN recs r ON s.accession IS NOT DISTINCT FROM r.accession) WHERE rn = 1"""),
]


def _nd(c: str) -> str:
    return f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


def _na(fn: str, c: str) -> str:
    return f"CASE WHEN count({c}) = count(*) THEN {fn}({c}) END"


_SUMMARY = f"""
, stats AS (
  SELECT primer_name, gene, expected_length,
    {_nd('accession')} AS n_accession, {_nd('sequence')} AS n_seqs, {_nd('family')} AS n_families,
    {_nd('genus')} AS n_genera, {_nd('species')} AS n_species,
    {_na('min', 'length')} AS min_length, {_na('max', 'length')} AS max_length,
    round_even({_na('avg', 'length')}, 1) AS mean_length, {_na('median', 'length')} AS median_length,
    {_na('min', 'forward_primer_errors')} AS min_forward_errors, {_na('max', 'forward_primer_errors')} AS max_forward_errors,
    round_even({_na('avg', 'forward_primer_errors')}, 1) AS mean_forward_errors,
    round_even({_na('median', 'forward_primer_errors')}, 0) AS median_forward_errors,
    {_na('min', 'reverse_primer_errors')} AS min_reverse_errors, {_na('max', 'reverse_primer_errors')} AS max_reverse_errors,
    round_even({_na('avg', 'reverse_primer_errors')}, 1) AS mean_reverse_errors,
    round_even({_na('median', 'reverse_primer_errors')}, 0) AS median_reverse_errors,
    round_even(CASE WHEN count(forward_primer_errors + reverse_primer_errors) = count(*)
                    THEN avg(forward_primer_errors + reverse_primer_errors) END, 1) AS mean_primer_errors
  FROM ctx GROUP BY primer_name, gene, expected_length
), nmed AS (
  SELECT c.primer_name, CAST(sum(CASE WHEN c.length = s.median_length THEN 1 ELSE 0 END) AS BIGINT) AS n_median
  FROM ctx c LEFT JOIN stats s USING (primer_name) GROUP BY c.primer_name
)
SELECT s.primer_name, gene, expected_length, n_accession, n_seqs, n_families, n_genera, n_species,
       min_length, max_length, max_length - min_length AS length_diff, mean_length, median_length, n_median,
       round_even(n_median / n_seqs * 100, 1) AS percent_median, expected_length - median_length AS median_diff,
       n_seqs AS n_sequences, min_forward_errors, max_forward_errors, mean_forward_errors, median_forward_errors,
       min_reverse_errors, max_reverse_errors, mean_reverse_errors, median_reverse_errors, mean_primer_errors
FROM stats s LEFT JOIN nmed n USING (primer_name)"""


@query("primer_summary", _oracle(_SUMMARY, _CONTEXT_CTES))
def q_primer_summary(spark, sf_dir):
    db, pr, seqs = sequences(spark, sf_dir)
    seeds = P.seed_sequences(seqs, pr, max_error=0, metric="levenshtein")
    return P.primer_summary(materialize(P.seed_context(seeds, pr, seqs, with_original=False)))  # read twice: stage boundary


# --- default (fuzzy, OSA) path ------------------------------------------------------------

_SITES = (("GGTCAACAAATCATAAAGATATTGG", "GGTCTACAAATGATAAAGATTTTGG"),
          ("TGATTTTTTGGTCACCCTGAAGTTTA", "TGATTTTTAGGTCACCGTGAAGTTTA"))


def mutated_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record plus a twin whose primer sites carry substitutions (planted errors)."""
    _, pr, seqs = sequences(spark, sf_dir)
    twin = seqs.withColumn("accession", F.concat("accession", F.lit("-m")))
    for site, changed in _SITES:
        twin = twin.withColumn("sequence", F.regexp_replace("sequence", site, changed))
    return seqs.unionByName(twin), pr


_BASES = _values((k, v) for k, v in IUPAC_CODES.items() if k != "U")


def _sites(name: str, codes: str, length: str, after: str) -> list[tuple[str, str]]:
    """CTE ``name``: the best site of a primer in each distinct sequence (fewest mismatches, then
    leftmost; at most a fifth of the primer), ``pos`` counted from 0; ``after`` bounds it."""
    return [(f"{name}_all", f"""
SELECT sequence, primer_name, flen, rlen, {after}pos,
       list_sum(list_transform(range(1, {length} + 1),
                lambda k: CASE WHEN contains({codes}[k], substr(sequence, CAST(pos + k AS BIGINT), 1)) THEN 0 ELSE 1 END)) AS errors
FROM {name}_at"""),
            (name, f"""
SELECT * FROM {name}_all WHERE errors <= floor(0.2 * {length} + 1e-9)
QUALIFY row_number() OVER (PARTITION BY sequence, primer_name ORDER BY errors, pos) = 1""")]


def _osa(name: str, texts: str, pattern: str) -> list[tuple[str, str]]:
    """CTE ``name``: optimal string alignment distance of each (primer_name, a) of ``texts`` to the
    primer's ``pattern`` (list of base sets), one row of the recurrence per step. The insertions
    within a row are a running minimum of t[k] - k."""
    match = lambda i, j: f"contains({pattern}[{j}], substr(a, CAST({i} AS BIGINT), 1))"
    return [(f"{name}_t", f"""
SELECT t.primer_name, t.a, p.{pattern}, 0 AS i, CAST([] AS BIGINT[]) AS before, range(0, len(p.{pattern}) + 1) AS row
FROM (SELECT DISTINCT primer_name, upper({texts}) AS a FROM {"m" if name == "fo" else "fe"}) t JOIN bases_of p USING (primer_name)
UNION ALL
SELECT primer_name, a, {pattern}, i + 1, row,
       list_transform(range(0, len({pattern}) + 1), lambda j: list_min(list_transform(t[1:j + 1], lambda x, k: x + j - k + 1)))
FROM (
  SELECT *, list_transform(range(0, len({pattern}) + 1), lambda j: CASE WHEN j = 0 THEN i + 1 ELSE least(
      row[j + 1] + 1, row[j] + CASE WHEN {match("i + 1", "j")} THEN 0 ELSE 1 END,
      CASE WHEN i > 0 AND j > 1 AND {match("i + 1", "j - 1")} AND {match("i", "j")} THEN before[j - 1] + 1 ELSE 999 END) END) AS t
  FROM {name}_t WHERE i < length(a))"""),
            (name, f"SELECT primer_name, a, row[len(row)] AS d FROM {name}_t WHERE i = length(a)")]


def _fuzzy_ctes() -> list[tuple[str, str]]:
    given = dict(PRIMER_CTES)
    twin = "sequence"
    for site, changed in _SITES:
        twin = f"replace({twin}, '{site}', '{changed}')"
    out = [(n, given[n]) for n in ("classes", "pr", "fpos", "rpos", "hdr")]
    out += [("seqs0", given["seqs"]), ("seqs", f"""
SELECT * FROM seqs0 UNION ALL SELECT * REPLACE (accession || '-m' AS accession, {twin} AS sequence) FROM seqs0""")]
    out += [("scan", """
SELECT s.sequence, pr.*, fa, ra FROM (SELECT DISTINCT sequence FROM seqs) s CROSS JOIN pr
JOIN (SELECT primer_name, list(cls ORDER BY i) AS fa FROM fpos JOIN classes ON code = substring(f, i, 1) GROUP BY ALL) USING (primer_name)
JOIN (SELECT primer_name, list(cls ORDER BY i) AS ra FROM rpos JOIN classes ON code = substring(r, i, 1) GROUP BY ALL) USING (primer_name)"""),
            ("fs_at", "SELECT *, unnest(range(0, length(sequence) - flen + 1)) AS pos FROM scan")]
    out += _sites("fs", "fa", "flen", "")
    out += [("rs_at", """
SELECT scan.*, fs.pos AS f_at, unnest(range(fs.pos + scan.flen, length(scan.sequence) - scan.rlen + 1)) AS pos
FROM scan JOIN fs USING (sequence, primer_name)""")]
    out += _sites("rs", "ra", "rlen", "f_at, ")
    out += [("crops", """
SELECT rs.primer_name, s.accession, s.beeid, substr(s.sequence, CAST(f_at + 1 AS BIGINT), CAST(pos + rlen - f_at AS BIGINT)) AS sequence
FROM seqs s JOIN rs USING (sequence)"""), ("m", given["m"])]
    out += [("bases", f"SELECT * FROM (VALUES {_BASES}) AS t(code, bases)"), ("bases_of", """
SELECT pr.primer_name, fb, rb FROM pr
JOIN (SELECT primer_name, list(bases ORDER BY i) AS fb FROM fpos JOIN bases ON code = substring(f, i, 1) GROUP BY ALL) USING (primer_name)
JOIN (SELECT primer_name, list(bases ORDER BY i) AS rb FROM rpos JOIN bases ON code = substring(r, i, 1) GROUP BY ALL) USING (primer_name)""")]
    out += _osa("fo", "forward_primer_match", "fb")
    out += [("fe0", """
SELECT m.*, fo.d, CAST(CASE WHEN fo.d <= flen THEN fo.d END AS DOUBLE) AS forward_primer_errors
FROM m LEFT JOIN fo ON fo.primer_name = m.primer_name AND fo.a = upper(m.forward_primer_match)"""), ("fe", given["fe"])]
    out += _osa("ro", "reverse_primer_match", "rb")
    out += [("re", """
SELECT fe.*, CAST(CASE WHEN ro.d <= rlen THEN ro.d END AS DOUBLE) AS reverse_primer_errors
FROM fe LEFT JOIN ro ON ro.primer_name = fe.primer_name AND ro.a = upper(fe.reverse_primer_match)""")]
    return out + [(n, given[n]) for n in ("kept", "seeds")]


def _fuzzy_oracle(body: str, extra=()) -> str:
    return duckdb_sql(_FIX, body, ctes=_fuzzy_ctes() + list(extra), recursive=True)


@query("primer_fuzzy_crop", _fuzzy_oracle("SELECT * FROM crops"))
def q_primer_fuzzy_crop(spark, sf_dir):
    seqs, pr = mutated_sequences(spark, sf_dir)
    return P.crop_by_primers(seqs, pr, 0.2, keep=("accession", "beeid"))


@query("seed_sequences", _fuzzy_oracle("SELECT * FROM seeds"))
def q_seed_sequences(spark, sf_dir):
    seqs, pr = mutated_sequences(spark, sf_dir)
    return P.seed_sequences(seqs, pr)


@query("primer_summary_fuzzy", _fuzzy_oracle(_SUMMARY, _CONTEXT_CTES))
def q_primer_summary_fuzzy(spark, sf_dir):
    seqs, pr = mutated_sequences(spark, sf_dir)
    return P.primer_summary(materialize(P.seed_context(P.seed_sequences(seqs, pr), pr, seqs, with_original=False)))


# --- insertions and deletions ---------------------------------------------------------------

_GAPPED_SITES = (("GGTCAACAAATCATAAAGATATTGG", "GGTCAACAATCATAAAGCATATTGG"),
                 ("TGATTTTTTGGTCACCCTGAAGTTTA", "TGATTTTTGGTCCACCCTGAAGTA"))


def _edits(name: str, sets: str, source: str) -> list[tuple[str, str]]:
    """CTE ``name``: for each (sequence, primer_name) the fewest edits of the primer within ``a``, the
    first end with so many, and the leftmost begin that reaches it. A cell of the recurrence is
    edits * 1000000 + begin, so one minimum settles both; one letter of the text per step."""
    step = 1_000_000
    return [(f"{name}_t", f"""
SELECT sequence, primer_name, a, {sets}, 0 AS i, list_transform(range(0, len({sets}) + 1), lambda j: j * {step}) AS row FROM {source}
UNION ALL
SELECT sequence, primer_name, a, {sets}, i + 1,
       list_transform(range(0, len({sets}) + 1), lambda j: list_min(list_transform(t[1:j + 1], lambda x, k: x + (j - k + 1) * {step})))
FROM (
  SELECT *, list_transform(range(0, len({sets}) + 1), lambda j: CASE WHEN j = 0 THEN i + 1 ELSE least(
      row[j + 1] + {step}, row[j] + CASE WHEN contains({sets}[j], substr(a, CAST(i + 1 AS BIGINT), 1)) THEN 0 ELSE {step} END) END) AS t
  FROM {name}_t WHERE i < length(a))"""),
            (name, f"""
SELECT sequence, primer_name, i AS e, row[len(row)] % {step} AS b FROM {name}_t
WHERE i > 0 AND row[len(row)] // {step} <= floor(0.2 * len({sets}) + 1e-9)
QUALIFY row_number() OVER (PARTITION BY sequence, primer_name ORDER BY row[len(row)] // {step}, i) = 1""")]


def _gapped_ctes() -> list[tuple[str, str]]:
    given, ctes = dict(PRIMER_CTES), dict(_fuzzy_ctes())
    twin = "sequence"
    for site, changed in _GAPPED_SITES:
        twin = f"replace({twin}, '{site}', '{changed}')"
    out = [(n, given[n]) for n in ("classes", "pr", "fpos", "rpos", "hdr")]
    out += [("seqs0", given["seqs"]), ("seqs", f"""
SELECT * FROM seqs0 UNION ALL SELECT * REPLACE (accession || '-g' AS accession, {twin} AS sequence) FROM seqs0"""), ("scan", ctes["scan"])]
    out += _edits("fs", "fa", "(SELECT sequence, primer_name, sequence AS a, fa FROM scan)")
    out += _edits("rs", "ra", "(SELECT sequence, primer_name, substr(sequence, CAST(fs.e + 1 AS BIGINT)) AS a, ra FROM scan JOIN fs USING (sequence, primer_name))")
    return out


@query("primer_indel_crop", duckdb_sql(_FIX, """
SELECT primer_name, s.accession, s.beeid, substr(s.sequence, CAST(fs.b + 1 AS BIGINT), CAST(fs.e + rs.e - fs.b AS BIGINT)) AS sequence
FROM seqs s JOIN fs USING (sequence) JOIN rs USING (sequence, primer_name)""", ctes=_gapped_ctes(), recursive=True))
def q_primer_indel_crop(spark, sf_dir):
    """D2 with insertions and deletions: every record plus a twin whose primer sites lost and gained bases."""
    _, pr, seqs = sequences(spark, sf_dir)
    twin = seqs.withColumn("accession", F.concat("accession", F.lit("-g")))
    for site, changed in _GAPPED_SITES:
        twin = twin.withColumn("sequence", F.replace("sequence", F.lit(site), F.lit(changed)))
    return P.crop_by_primers(seqs.unionByName(twin), pr, 0.2, keep=("accession", "beeid"), indels=True)

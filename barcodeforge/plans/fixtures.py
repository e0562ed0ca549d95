"""Domain-shaped inputs derived from the driver tables.

The driver ships generic tables (part, customer, orders, lineitem, ...). The views below
turn them into checklists, taxonomies, sequences and search hits. Each view is one SQL
text that both Spark and DuckDB accept, so the Spark side (``spark.sql`` with DataFrame
arguments) and the DuckDB oracle (CTEs over the pre-registered views) read identical
inputs. DNA comes from md5 hex digits mapped onto A/C/G/T.

Placeholders ``{name}`` stand for a driver table or an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from barcodeforge.operators.partitioning import materialize, shuffled, spread

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# tables whose short rows the views make into long ones: a file of few row groups is read by few
# tasks, and filters on what is made of its rows would be pushed below a mere repartition
WIDENED_TABLES = ("part",)

FIXTURES: dict[str, str] = {}

FIXTURES["fx_primers"] = """
SELECT * FROM (VALUES
  ('P1', 'COX1', 'GGTCAACAAATCATAAAGATATTGG', 'TAAACTTCAGGGTGACCAAAAAATCA', 128),
  ('P2', 'COX1', 'GGNCAACARATCATAARGATATNGG', 'TAAACYTCAGGRTGNCCAAAAAAYCA', 128),
  ('P3', '16S',  'CGCCTGTTTATCAAAAACAT',      'CCGGTCTGAACTCAGATCACGT',     200)
) AS t(primer, gene, forward_sequence, reverse_sequence, length)
"""

# a third of the templates has a forward site that only the degenerate primer fits
FIXTURES["fx_sequences"] = """
WITH k AS (
  SELECT *, CASE WHEN n < 40 THEN split_part(p_name, ' ', 1) || CASE WHEN p_partkey % 2 = 0 THEN ' one' ELSE ' two' END
                 ELSE p_name END AS named
  FROM (SELECT *, CAST(floor(p_partkey / 7) AS INT) % 300 AS n, CAST(CAST(floor(p_partkey / 7) AS INT) AS STRING) AS g FROM {part})
), s AS (
  SELECT *,
    translate(md5(g || ':1') || md5(g || ':2'), '0123456789abcdef', 'ACGTACGTACGTACGT')
    || CASE WHEN n % 3 = 1 THEN 'GGACAACAGATCATAAGGATATAGG' ELSE 'GGTCAACAAATCATAAAGATATTGG' END
    || substring(translate(md5(g || ':3') || md5(g || ':4') || md5(g || ':5') || md5(g || ':6') || md5(g || ':8'),
                           '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 112 + n % 37)
    || reverse(translate('TAAACTTCAGGGTGACCAAAAAATCA', 'ACGT', 'TGCA'))
    || translate(md5(g || ':7'), '0123456789abcdef', 'ACGTACGTACGTACGT') AS fwd
  FROM k
)
SELECT 'ACC' || lpad(CAST(p_partkey AS STRING), 7, '0')
         || CASE WHEN p_partkey % 4 = 0 THEN '-25' ELSE '' END AS accession,
       p_type AS family,
       CASE WHEN n < 40 THEN CASE WHEN n % 3 = 0 THEN 'small ' WHEN n % 3 = 1 THEN 'red ' ELSE split_part(named, ' ', 1) || ' ' END
                             || split_part(named, ' ', 2) ELSE named END AS species,
       CASE WHEN p_size % 3 = 0 THEN named || ' sub' ELSE CAST(NULL AS STRING) END AS subspecies,
       'B' || lpad(CAST(p_size AS STRING), 5, '0') AS beeid,
       CASE WHEN p_partkey % 11 = 0 THEN reverse(translate(fwd, 'ACGT', 'TGCA')) ELSE fwd END AS sequence
FROM s
"""

# small hand-made table for the dedup quirk (tests only; never a registered query input alone)
FIXTURES["fx_dup_quirk"] = """
SELECT * FROM (VALUES
  ('a1', 'ACGT', 'sp one', 'g1', 'f1'), ('a2', 'ACGT', 'sp one', 'g1', 'f1'),
  ('a3', 'ACGT', 'sp two', 'g1', 'f1'), ('a4', 'ACGT', 'sp two', 'g1', 'f1'),
  ('a5', 'TTTT', 'sp one', 'g1', 'f1'), ('a6', 'TTTT', 'sp six', 'g2', 'f2')
) AS t(accession, sequence, species, genus, family)
"""

FIXTURES["fx_bold_raw"] = """
SELECT accession AS processid,
       CASE WHEN CAST(substring(beeid, 2, 5) AS INT) % 17 = 0 THEN CAST(NULL AS STRING)
            WHEN CAST(substring(beeid, 2, 5) AS INT) % 13 = 0 THEN ''
            ELSE species END AS species,
       subspecies,
       CASE WHEN CAST(substring(beeid, 2, 5) AS INT) % 7 = 0 THEN 'nnN' || lower(sequence)
            WHEN CAST(substring(beeid, 2, 5) AS INT) % 5 = 0 THEN '--' || substring(sequence, 1, 60) || '--'
            ELSE substring(sequence, 1, 50) || '---' || substring(sequence, 51, 500) END AS nuc
FROM {fx_sequences}
"""

FIXTURES["fx_species_list"] = """
SELECT '  ' || p_name || '  ' AS species_final,
       CASE WHEN p_partkey % 3 = 0 THEN p_name
            ELSE split_part(p_name, ' ', 1) || '   syn' || CAST(p_partkey % 5 AS STRING) END AS species_synonym,
       p_type AS family,
       'src' || CAST(p_partkey % 4 AS STRING) AS source,
       CASE length(p_name) % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'Canada'
            WHEN 2 THEN CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'Canada' ELSE CAST(NULL AS STRING) END
            ELSE CAST(NULL AS STRING) END AS country
FROM {part}
"""

# names as curators know them, and as others wrote them: a letter lost, doubled, changed or moved,
# a swap of neighbours, another case, two slips, or something else altogether
FIXTURES["fx_known_names"] = """
SELECT p_name || ' ' || translate(substring(md5(CAST(p_partkey AS STRING)), 1, 10), '0123456789', 'ghijklmnop') AS known_name, p_type AS family
FROM {part}
"""

FIXTURES["fx_written_names"] = """
SELECT p_partkey AS record, CASE p_partkey % 9
         WHEN 0 THEN known
         WHEN 1 THEN substring(known, 1, spot - 1) || substring(known, spot + 1, 99)
         WHEN 2 THEN substring(known, 1, spot) || substring(known, spot, 99)
         WHEN 3 THEN substring(known, 1, spot - 1) || 'x' || substring(known, spot + 1, 99)
         WHEN 4 THEN substring(known, 1, spot - 1) || substring(known, spot + 1, 1) || substring(known, spot, 1) || substring(known, spot + 2, 99)
         WHEN 5 THEN upper(known)
         WHEN 6 THEN substring(known, 2, spot - 1) || 'q' || substring(known, spot + 1, 99)
         WHEN 7 THEN reverse(known)
         ELSE CAST(NULL AS STRING) END AS written_name
FROM (SELECT p_partkey, CAST(2 + p_partkey % 17 AS INT) AS spot,
             p_name || ' ' || translate(substring(md5(CAST(p_partkey AS STRING)), 1, 10), '0123456789', 'ghijklmnop') AS known FROM {part})
"""

FIXTURES["fx_name_authority"] = """
SELECT DISTINCT p_name AS submitted_name, 3 AS data_source,
       CASE WHEN length(p_name) % 4 = 0 THEN 'Fuzzy' ELSE 'Exact' END AS match_type,
       'T' || substring(md5(p_name), 1, 6) AS current_record_id,
       p_name || ' Auth.' AS current_name,
       CASE WHEN length(p_name) % 3 = 0 THEN split_part(p_name, ' ', 2) || ' valid' ELSE p_name END AS current_canonical_simple,
       CASE WHEN length(p_name) % 3 = 0 THEN 'Synonym' ELSE 'Accepted' END AS taxonomic_status
FROM {part}
"""

# taxonomy tree: phylum > class and order (region) > family (nation) > genus > species (customer,
# and each part name) > subspecies (orders, and up to four of each part name). The phylum is its
# own parent, as the root of a taxonomy dump is.
FIXTURES["fx_taxa"] = """
SELECT DISTINCT CAST(100000 + r_regionkey % 2 AS BIGINT) AS taxid, CAST(100000 + r_regionkey % 2 AS BIGINT) AS parent_taxid,
       'phylum' AS rank, 'Phylum ' || CAST(r_regionkey % 2 AS STRING) AS name FROM {region}
UNION ALL SELECT CAST(500000 + r_regionkey AS BIGINT), CAST(100000 + r_regionkey % 2 AS BIGINT), 'class', 'Class ' || r_name FROM {region}
UNION ALL SELECT CAST(1000000 + r_regionkey AS BIGINT), CAST(500000 + r_regionkey AS BIGINT), 'order', r_name FROM {region}
UNION ALL SELECT CAST(2000000 + n_nationkey AS BIGINT), CAST(1000000 + n_regionkey AS BIGINT), 'family', n_name FROM {nation}
UNION ALL SELECT DISTINCT CAST(2500000 + c_custkey % 500 AS BIGINT), CAST(2000000 + (c_custkey % 500) % 25 AS BIGINT), 'genus',
                          'Genus ' || CAST(c_custkey % 500 AS STRING) FROM {customer}
UNION ALL SELECT CAST(3000000 + c_custkey AS BIGINT), CAST(2500000 + c_custkey % 500 AS BIGINT), 'species', c_name FROM {customer}
UNION ALL SELECT CAST(4000000 + o_orderkey AS BIGINT), CAST(3000000 + o_custkey AS BIGINT), 'subspecies',
                 'Customer sub' || CAST(o_orderkey AS STRING) FROM {orders}
UNION ALL SELECT CAST(60000000 + min(p_partkey) AS BIGINT), CAST(2500000 + min(p_partkey) % 500 AS BIGINT), 'species', p_name
          FROM {part} WHERE length(p_name) % 5 <> 0 GROUP BY p_name
UNION ALL SELECT CAST(70000000 + min(p_partkey) AS BIGINT),
                 CAST(60000000 + min(min(p_partkey)) OVER (PARTITION BY p_name) AS BIGINT), 'subspecies',
                 p_name || ' sub' || CAST(p_size % 4 AS STRING)
          FROM {part} WHERE length(p_name) % 5 <> 0 GROUP BY p_name, p_size % 4
"""

FIXTURES["fx_accessions"] = """
SELECT CASE o_orderkey % 10
         WHEN 0 THEN 'AB' WHEN 1 THEN 'NC_' WHEN 2 THEN 'BK' WHEN 3 THEN 'LJ' WHEN 4 THEN 'X'
         WHEN 5 THEN 'AN' WHEN 6 THEN 'KQ' WHEN 7 THEN 'ABCD' WHEN 8 THEN 'MN' ELSE 'TSA_' END
         || lpad(CAST(o_orderkey AS STRING), 6, '0') || '.1' AS accession,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(4000000 + o_orderkey AS BIGINT) ELSE CAST(3000000 + o_custkey AS BIGINT) END AS taxid
FROM {orders}
"""

# FASTA-like NCBI download: header "accession description"
FIXTURES["fx_ncbi_fasta"] = """
SELECT accession || ' ' || species || ' cytochrome oxidase subunit I gene' AS header, sequence
FROM {fx_sequences}
"""

# lineage of those accessions (stands in for the taxonomy lookup); one order is not the target
FIXTURES["fx_ncbi_lineage"] = """
SELECT accession,
       'Arthropoda' AS phylum, 'Insecta' AS class,
       CASE WHEN CAST(substring(beeid, 2, 5) AS INT) % 9 = 0 THEN 'Diptera' ELSE 'Hymenoptera' END AS taxon_order,
       family, split_part(species, ' ', 1) AS genus, species, subspecies
FROM {fx_sequences}
"""

# search database: FASTA header packed "accession;family;species;subspecies;beeid", spaces as _;
# some headers come twice, with another sequence
FIXTURES["fx_database"] = """
SELECT replace(accession || ';' || family || ';' || species || ';' || coalesce(subspecies, 'NA') || ';' || beeid,
               ' ', '_') AS header,
       accession, sequence
FROM {fx_sequences}
UNION ALL
SELECT replace(accession || ';' || family || ';' || species || ';' || coalesce(subspecies, 'NA') || ';' || beeid,
               ' ', '_') AS header,
       accession, 'TT' || substring(sequence, 3, 400) AS sequence
FROM {fx_sequences} WHERE accession LIKE '%7'
"""

# relatives: 13 variants of each base sequence (a base changed in all, one removed
# or two inserted in some, some on the other strand, some with unknown bases), between random ends
FIXTURES["fx_relatives"] = """
WITH b AS (
  SELECT *, CAST(p_partkey AS INT) AS n, CAST(CAST(floor(p_partkey / 13) AS INT) AS STRING) AS f FROM {part}
), v AS (
  SELECT *, translate(md5('r' || f || ':1') || md5('r' || f || ':2') || md5('r' || f || ':3') || md5('r' || f || ':4')
                      || CASE WHEN n % 2 = 1 THEN md5('r' || f || ':5') || md5('r' || f || ':6') ELSE '' END,
                      '0123456789abcdef', 'ACGTACGTACGTACGT') AS base
  FROM b
), m AS (
  SELECT *, substring(base, 1, n % 120) || CASE n % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END
            || substring(base, n % 120 + 2, 200) AS changed
  FROM v
), d AS (
  SELECT *, CASE WHEN n % 5 = 0 THEN substring(changed, 1, 49 + n % 30) || substring(changed, 51 + n % 30, 200)
                 WHEN n % 7 = 0 THEN substring(changed, 1, 60 + n % 20) || 'GT' || substring(changed, 61 + n % 20, 200)
                 WHEN n % 13 = 0 THEN substring(changed, 1, 100) || 'NNN' || substring(changed, 104, 200)
                 ELSE changed END AS core
  FROM m
), e AS (
  SELECT *, translate(md5('e' || CAST(n AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') || core
            || translate(md5('z' || CAST(n AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS whole
  FROM d
)
SELECT 'REL' || lpad(CAST(p_partkey AS STRING), 7, '0') AS accession,
       replace('REL' || lpad(CAST(p_partkey AS STRING), 7, '0') || ';' || p_type || ';' || p_name || ';NA;B'
               || lpad(CAST(p_size AS STRING), 5, '0'), ' ', '_') AS header,
       CASE WHEN n % 2 = 0 THEN 'P1' ELSE 'P3' END AS primer_name, p_size, core,
       CASE WHEN n % 11 = 0 THEN reverse(translate(whole, 'ACGT', 'TGCA')) ELSE whole END AS sequence
FROM e
"""

# what a primer pair found in the relatives: seeds of the search
FIXTURES["fx_relative_seeds"] = """
SELECT primer_name, accession AS qseqid, core AS sequence FROM {fx_relatives}
"""

# search hits against that database; subject id is the packed header
FIXTURES["fx_hits"] = """
SELECT 'Q' || CAST(l.l_orderkey AS STRING) AS qseqid,
       d.header AS sseqid,
       CASE WHEN l.l_linenumber % 2 = 0 THEN 20 + l.l_linenumber
            ELSE 140 + CAST(l.l_quantity AS INT) + CASE WHEN l.l_orderkey % 2 = 0 THEN 0 ELSE 50 END END AS sstart,
       CASE WHEN l.l_linenumber % 2 = 0 THEN 140 + CAST(l.l_quantity AS INT) + CASE WHEN l.l_orderkey % 2 = 0 THEN 0 ELSE 50 END
            ELSE 20 + l.l_linenumber END AS send,
       121 + CAST(l.l_quantity AS INT) - l.l_linenumber + CASE WHEN l.l_orderkey % 2 = 0 THEN 0 ELSE 50 END AS length,
       l.l_discount * 100 AS qcovs,
       l.l_extendedprice AS bitscore,
       CASE WHEN l.l_orderkey % 2 = 0 THEN 'P1' ELSE 'P3' END AS primer_name
FROM {lineitem} l
JOIN {fx_database} d
  ON d.accession = 'ACC' || lpad(CAST(l.l_partkey AS STRING), 7, '0')
                   || CASE WHEN l.l_partkey % 4 = 0 THEN '-25' ELSE '' END
"""

_PLACEHOLDER = re.compile(r"\{([a-z_]+)\}")


def deps(name: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(FIXTURES[name])))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, _memo: dict | None = None) -> DataFrame:
    """The named view as a Spark DataFrame over the driver tables in ``sf_dir``."""
    memo = {} if _memo is None else _memo
    if name in memo:
        return memo[name]
    if name in DRIVER_TABLES:
        df = read_table(spark, sf_dir, name)
        if name in WIDENED_TABLES:
            df = materialize(spread(df))
    else:
        args = {d: fixture(spark, sf_dir, d, memo) for d in deps(name)}
        if "JOIN" in FIXTURES[name]:
            args = {d: shuffled(df) for d, df in args.items()}
        df = spark.sql(FIXTURES[name], **args)
    memo[name] = df
    return df


def fixtures(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    memo: dict = {}
    return [fixture(spark, sf_dir, n, memo) for n in names]


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in DRIVER_TABLES or n in out:
            return
        for d in deps(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duckdb_sql(fixture_names, body: str, ctes: list[tuple[str, str]] | None = None,
               recursive: bool = False) -> str:
    """Oracle text: the fixture views (plus ``ctes``) as CTEs in front of ``body``."""
    parts = []
    for n in _order(fixture_names):
        text = _PLACEHOLDER.sub(lambda m: m.group(1), FIXTURES[n]).strip()
        parts.append(f"{n} AS (\n{text}\n)")
    for n, text in ctes or []:
        parts.append(f"{n} AS (\n{text.strip()}\n)")
    if not parts:
        return body.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()

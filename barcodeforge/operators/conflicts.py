"""Duplicate removal and taxonomic-conflict flags on a sequence database.

Input rows carry at least ``accession, sequence, species, genus, family``. A slim table
without sequence text (a digest stands for it) is written once; all counting, picking and
flagging works on that, with partial (map-side) aggregation, so a sequence shared by a third
of all rows is met by a few rows per task. The input itself is read twice: for the slim table
and for the result, where only the removed accessions and the shared sequences are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.functions.nulls import anti_null_safe, join_null_safe
from barcodeforge.operators.partitioning import materialize, shuffled
from barcodeforge.operators.rowpick import asc, desc, keep_first


_DIGEST = "_sequence_digest"


def _digest():
    """Text that stands for a sequence in keys: NULL sequences are equal, and never to another."""
    return F.coalesce(F.sha2("sequence", 256), F.lit("null"))


def _slim(df: DataFrame, by: list[str], *columns: str) -> DataFrame:
    return materialize(df.select(*by, *columns, _digest().alias(_DIGEST)))


def pick_representatives(dups: DataFrame, group_keys=("sequence",), by=()) -> DataFrame:
    """First accession of each duplicate group (order: dupe_count desc, species, accession)."""
    cols = list(dict.fromkeys([*group_keys, "dupe_count", "species", "accession"]))
    first = keep_first(dups.select(*cols), list(group_keys),
                       [desc("dupe_count"), asc("species"), asc("accession")])
    return first.select(*by, "accession")


def _removed(slim: DataFrame, scope: str, by: list[str]) -> DataFrame:
    """Accessions that ``dedup_taxa`` removes, from the slim table."""
    if scope not in ("sequence", "sequence_species"):
        raise ValueError("scope must be 'sequence' or 'sequence_species'")
    pair = [*by, _DIGEST, "species"]
    first = F.min(F.struct(F.col("accession").isNull().alias("none"), "accession")).alias("first")
    pairs = slim.groupBy(*pair).agg(F.count(F.lit(1)).alias("dupe_count"), first).filter(F.col("dupe_count") > 1)
    pairs = pairs.select(*pair, "dupe_count", F.col("first.accession").alias("accession"))
    group = (*by, _DIGEST) if scope == "sequence" else tuple(pair)
    keep = pick_representatives(pairs, group, by)
    repeated = join_null_safe(slim.select(*pair, "accession"), shuffled(pairs.select(*pair)), pair, how="left_semi")
    return anti_null_safe(repeated.select(*by, "accession").distinct(), shuffled(keep), [*by, "accession"])


def dedup_taxa(df: DataFrame, scope: str = "sequence", by: tuple[str, ...] = ()) -> DataFrame:
    """Remove repeated (sequence, species) rows.

    ``scope='sequence'`` reproduces the original rule: among rows whose (sequence, species)
    pair is duplicated, one accession is kept *per sequence*, every other accession of those
    rows is removed everywhere (by accession). ``scope='sequence_species'`` keeps one per
    (sequence, species) pair instead. ``by`` adds grouping columns (e.g. ``primer_name``) to
    every key, so independent databases are processed in one pass.
    """
    by = list(by)
    return anti_null_safe(df, shuffled(_removed(_slim(df, by, "accession", "species"), scope, by)), [*by, "accession"])


def _conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key with several rows: their count, the level of the highest conflict, the names.

    Rows are first counted per distinct taxon, so what a key gathers is its distinct names.
    """
    taxa = rows.groupBy(*keys, "species", "genus", "family").agg(F.count(F.lit(1)).alias("_n"))
    agg = (taxa.groupBy(*keys)
           .agg(F.sum("_n").alias("conflict_count"),
                F.collect_set("species").alias("_sp"),
                F.collect_set("genus").alias("_ge"),
                F.collect_set("family").alias("_fa"))
           .filter(F.col("conflict_count") > 1))
    level = (F.when(F.size("_fa") > 1, F.lit("family"))
             .when(F.size("_ge") > 1, F.lit("genus"))
             .when(F.size("_sp") > 1, F.lit("species")))

    def names(c):
        return F.array_join(F.array_sort(F.filter(F.col(c), lambda x: x != F.lit(""))), ", ")

    named = (F.when(level == "species", names("_sp"))
             .when(level == "genus", names("_ge"))
             .when(level == "family", names("_fa")))
    return agg.select(*keys, "conflict_count", level.alias("conflict_level"), named.alias("conflict_taxa"))


def conflict_table(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per shared sequence: row count, level of the highest taxonomic conflict, names."""
    return _conflicts(df, [*by, "sequence"])


def _flagged(df: DataFrame, conflicts: DataFrame, by: list[str]) -> DataFrame:
    flagged = df.withColumn(_DIGEST, _digest())
    conflicts = shuffled(conflicts)
    if by:
        return join_null_safe(flagged, conflicts, [*by, _DIGEST], how="left").drop(_DIGEST)
    return flagged.join(conflicts, _DIGEST, "left").drop(_DIGEST)


def flag_conflicts(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``df`` plus ``conflict_count, conflict_level, conflict_taxa``.

    Rows whose sequence occurs once get NULLs. A count without a level means the rows share
    the sequence but differ in no taxon.
    """
    by = list(by)
    return _flagged(df, _conflicts(_slim(df, by, "species", "genus", "family"), [*by, _DIGEST]), by)


def sequence_database(df: DataFrame, scope: str = "sequence", by: tuple[str, ...] = ()) -> DataFrame:
    """``dedup_taxa`` then ``flag_conflicts``, over one slim table."""
    by = list(by)
    slim = _slim(df, by, "accession", "species", "genus", "family")
    removed = shuffled(materialize(_removed(slim, scope, by)))
    conflicts = _conflicts(anti_null_safe(slim, removed, [*by, "accession"]), [*by, _DIGEST])
    return _flagged(anti_null_safe(df, removed, [*by, "accession"]), conflicts, by)

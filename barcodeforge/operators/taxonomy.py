"""Checklist harmonisation and taxonomy walks.

Taxonomy tables (the dump of a local taxonomy store):

* ``names``: taxid long, name string, name_class string
* ``nodes``: taxid long, parent_taxid long, rank string
* ``accession_taxa``: accession string, taxid long

Trees are walked by pointer doubling: every node learns its path to the root in about log2(depth)
joins, each written to the shared folder. Descendants are read off interval labels made from
the paths once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barcodeforge.functions import columns as C
from barcodeforge.functions.nulls import join_null_safe, n_distinct_na
from barcodeforge.operators.partitioning import materialize
from barcodeforge.operators.rowpick import collapse_in_order

# --- fixed values -----------------------------------------------------------------------
# ranks reported by the lineage lookup, outermost first
LINEAGE_RANKS = ("phylum", "class", "order", "family", "genus", "species", "subspecies")
# accession classes (GenBank prefix rules)
ACCESSION_KEEP_PATTERNS = (r"^[A-Za-z]{1}\d{4,}", r"^[A-Za-z]{2}\d{4,}", r"^[A-Za-z]{2}_\d{6,}")
WGS_PREFIXES = ("AN|BA|CH|CM|DF|DG|DS|EM|EN|EP|EQ|GG|GL|JH|KB|KD|KE|KI|KK|KL|KN|KQ|KV|KZ|LD|ML|MU|PS|FA")
TPA_TSA_PREFIXES = ("BK|BN|BR|BL|GJ|HT|HU|GK|EZ|FX|HP|JI|JL|JO|JP|JR|JT|JU|JV|JW|KA|LA|LE|LH|LI|LJ]")
# name-authority data sources: 3 = ITIS, 4 = NCBI, 11 = GBIF
DATA_SOURCE_ITIS = 3
# --- end of fixed values ------------------------------------------------------------------


# ------------------------------------------------------------------------------------------
# checklist
# ------------------------------------------------------------------------------------------

def clean_checklist(checklist: DataFrame) -> DataFrame:
    """Squish white space in the two name columns."""
    return checklist.withColumns({"species_final": C.squish("species_final"),
                                  "species_synonym": C.squish("species_synonym")})


def authority_matches(authority: DataFrame, data_source: int = DATA_SOURCE_ITIS) -> DataFrame:
    """Exact matches of one data source, renamed to the checklist's vocabulary."""
    return (authority.filter((F.col("data_source") == data_source) & (F.col("match_type") == "Exact"))
            .select(F.col("submitted_name").alias("species_final"),
                    F.col("current_record_id").alias("taxid_TSN"),
                    F.col("current_name").alias("valid_authority_ITIS"),
                    F.col("current_canonical_simple").alias("valid_species_ITIS"),
                    F.col("taxonomic_status").alias("_authority_status")))


def resolve_names(checklist: DataFrame, authority: DataFrame, data_source: int = DATA_SOURCE_ITIS) -> DataFrame:
    """Join the authority's exact matches, replace synonyms by the valid name, and label
    each row ``accepted`` (final name equals the synonym column) or ``synonym``."""
    cl = clean_checklist(checklist)
    joined = join_null_safe(cl, authority_matches(authority, data_source), ["species_final"], how="left")
    final = (F.when(F.col("_authority_status") == "Synonym", F.col("valid_species_ITIS"))
             .otherwise(F.col("species_final")))
    out = joined.withColumn("species_final", final)
    out = out.withColumn("taxonomic_status", status_of("species_final", "species_synonym"))
    return out.drop("_authority_status")


def status_of(final: str, synonym: str) -> Column:
    return F.when(F.col(final) == F.col(synonym), F.lit("accepted")).otherwise(F.lit("synonym"))


def dense_ids(df: DataFrame, key: str, id_col: str, prefix: str = "B", width: int = 5) -> DataFrame:
    """Number the distinct values of ``key`` 1..n in ascending byte order (NULL last)
    and attach ``prefix`` + zero-padded number to every row.

    Distributed dense rank: the distinct keys are range-partitioned and sorted, each row gets
    (partition, position) from ``monotonically_increasing_id``; the sorted, indexed keys are
    checkpointed so both uses see the same numbering, and per-partition counts (one row per
    partition) give the offsets. No single task ever holds all keys.
    """
    keys = df.select(key).distinct().orderBy(F.col(key).asc_nulls_last())
    indexed = materialize(keys.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    counts = indexed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_pid").collect()
    offsets, running = [], 0
    for r in counts:  # bounded by the number of partitions
        offsets.append((int(r["_pid"]), running))
        running += int(r["_n"])
    spark = df.sparkSession
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = (indexed.join(F.broadcast(off_df), pid == off_df["_pid"])
              .select(F.col(key), (F.col("_off") + local + 1).alias("_rank")))
    ids = ranked.select(F.col(key), C.zero_pad_id(prefix, "_rank", width).alias(id_col))
    return join_null_safe(df, ids, [key], how="left")


def assign_ids(checklist: DataFrame) -> DataFrame:
    """``beeid`` per final species name."""
    return dense_ids(checklist, "species_final", "beeid")


def summarise_checklist(checklist: DataFrame, order_by: Column | None = None) -> DataFrame:
    """One row per beeid; every column collapsed to its distinct values joined by ', ' ('' when
    all missing), plus ``n_synonyms`` (distinct synonyms, NULL counted, - 1). Values are sorted,
    or with ``order_by`` (a row's position) in the order of their first appearance."""
    cl = checklist.withColumn("taxonomic_status", status_of("species_final", "species_synonym"))
    cols = ["family", "species_final", "species_synonym", "source", "country"]
    synonyms = (n_distinct_na("species_synonym") - 1).cast("string").alias("n_synonyms")
    if order_by is None:
        out = cl.groupBy("beeid").agg(*[C.collapse_distinct(c).alias(c) for c in cols], synonyms)
    else:
        out = join_null_safe(collapse_in_order(cl, ["beeid"], cols, order_by), cl.groupBy("beeid").agg(synonyms), ["beeid"], how="left")
    return out.select("beeid", "family", "species_final", "species_synonym", "n_synonyms", "source", "country")


def count_species_by(summary: DataFrame, key: str = "family") -> DataFrame:
    """T4: distinct final names per family or per country (a country list becomes 'both')."""
    if key not in ("family", "country"):
        raise ValueError("key must be 'family' or 'country'")
    s = summary.withColumn("country", F.when(F.col("country").contains(","), F.lit("both"))
                           .otherwise(F.col("country")))
    return s.groupBy(key).agg(n_distinct_na("species_final").alias("n_species"))


def all_names(checklist: DataFrame) -> DataFrame:
    """Distinct union of final and synonym names, missing names dropped."""
    return (checklist.select(F.col("species_final").alias("name"))
            .union(checklist.select(F.col("species_synonym").alias("name")))
            .filter(F.col("name").isNotNull()).distinct())


# ------------------------------------------------------------------------------------------
# Taxonomy lookups and walks
# ------------------------------------------------------------------------------------------

def names_to_taxids(names: DataFrame, taxa_names: DataFrame, name_col: str = "name",
                    only_scientific: bool = True) -> DataFrame:
    """T5: ``name -> taxid``; names without a match keep a NULL taxid. A name with several
    taxids yields one row per taxid."""
    tn = taxa_names
    if only_scientific:
        tn = tn.filter(F.col("name_class") == "scientific name")
    tn = tn.select(F.col("name").alias(name_col), "taxid").distinct()
    return names.join(tn, on=name_col, how="left")


LOOP_ROUNDS = 6  # paths of up to 64 nodes; taxonomies are less deep, and only longer paths are looked at for loops


def node_paths(nodes: DataFrame) -> DataFrame:
    """``taxid, rank, path, looped``: every node with the taxids from its root down to itself.

    Pointer doubling: after round k a node knows the 2^k nodes above it and where to go on, so a
    tree of depth d takes about log2(d) rounds of one join. A root has no parent, is its own, or
    has one that is no node (which then begins the path). Of nodes that lead into a loop, ``looped``
    is set and the path has each node once; a node with several parents has a row for each path.
    """
    parent = F.when(F.col("taxid") != F.col("parent_taxid"), F.col("parent_taxid"))
    paths = materialize(nodes.select("taxid", "rank", parent.alias("up"), F.array("taxid").alias("path"), F.lit(False).alias("looped"))
                        .filter(F.col("taxid").isNotNull()).distinct())
    rounds = 0
    while not paths.filter(F.col("up").isNotNull()).isEmpty():
        above = paths.select(F.col("taxid").alias("_node"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        longer = F.when(F.col("up").isNull(), F.col("path")).otherwise(
            F.concat(F.coalesce("_path", F.array("up")), F.col("path")))
        paths = paths.join(above, F.col("up") == F.col("_node"), "left").select("taxid", "rank", F.col("_up").alias("up"), longer.alias("path"), "looped")
        rounds += 1
        if rounds > LOOP_ROUNDS:
            once = F.array_distinct("path")
            loop = F.col("looped") | (F.size(once) < F.size("path"))
            paths = paths.select("taxid", "rank", F.when(~loop, F.col("up")).alias("up"), once.alias("path"), loop.alias("looped")).distinct()
        paths = materialize(paths)
    return paths.drop("up")


@dataclass(frozen=True)
class TreeLabels:
    """Written interval labels of a taxonomy: a node's descendants are the rows whose ``first`` lies
    above its own, up to its ``last``. Nodes that lead into loops have none; ``looped`` holds
    their paths."""

    rows: DataFrame
    looped: DataFrame


INTERVAL_BITS = 12  # places that a range join meets in one bin: 2^12


def tree_labels(nodes: DataFrame) -> TreeLabels:
    """Numbers the nodes in depth-first order, once for any number of :func:`descendants`.

    Sorting by path is that order. The sort is by ranges, so no task holds all nodes; places are
    made dense by the row counts of the sorted partitions. A subtree's last place is the largest
    under its path.
    """
    paths = node_paths(nodes)
    tree = paths.filter(~F.col("looped")).select("taxid", "rank", "path")
    # parents that are no nodes begin paths, and may be asked for
    roots = tree.select(F.element_at("path", 1).alias("taxid")).distinct().join(tree.select("taxid"), "taxid", "left_anti")
    every = tree.unionByName(roots.select("taxid", F.lit(None).cast(tree.schema["rank"].dataType).alias("rank"), F.array("taxid").alias("path")))
    placed = materialize(every.orderBy("path").withColumn("_at", F.monotonically_increasing_id()))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.max(place).alias("_n")).orderBy("_part").collect()
    starts, running = [], 0
    for r in sizes:  # bounded by the number of partitions
        starts.append((int(r["_part"]), running))
        running += int(r["_n"]) + 1
    offsets = placed.sparkSession.createDataFrame(starts or [(0, 0)], "_part long, _first long")
    placed = placed.join(F.broadcast(offsets), F.shiftright("_at", 33) == F.col("_part")).select(
        "taxid", "rank", "path", (F.col("_first") + place).alias("first"))
    prefixes = F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n)))
    last = placed.select("first", prefixes.alias("path")).groupBy("path").agg(F.max("first").alias("last"))
    rows = materialize(placed.join(last, "path").select("taxid", "rank", "first", "last"))
    return TreeLabels(rows, paths.filter("looped"))


def descendants(nodes: DataFrame | TreeLabels, start: DataFrame, rank: str | None = None) -> DataFrame:
    """Every descendant of the ``start`` taxids (column ``taxid``), with its rank and
    the start taxid it descends from (``ancestor_taxid``); optionally only one rank.

    ``nodes`` is the node table or its labels. The nodes below one are an interval of places;
    intervals meet places bin by bin, so only what is found is read in full, whatever the depth.
    Nodes that lead into a loop are found by their paths.
    """
    labels = nodes if isinstance(nodes, TreeLabels) else tree_labels(nodes)
    asked = start.select(F.col("taxid").alias("ancestor_taxid")).filter(F.col("ancestor_taxid").isNotNull()).distinct()
    own = labels.rows.select(F.col("taxid").alias("ancestor_taxid"), F.col("first").alias("_low"), "last").filter("last > _low")
    ranges = asked.join(own, "ancestor_taxid")
    bin_of = lambda c: F.shiftright(c, INTERVAL_BITS)
    ranges = ranges.withColumn("_bin", F.explode(F.sequence(bin_of("_low"), bin_of("last"))))
    below = labels.rows if rank is None else labels.rows.filter(F.col("rank") == rank)
    below = below.select("taxid", "rank", "first", bin_of("first").alias("_bin"))
    found = ranges.join(below, "_bin").filter((F.col("first") > F.col("_low")) & (F.col("first") <= F.col("last")))
    looped = labels.looped if rank is None else labels.looped.filter(F.col("rank") == rank)
    looped = looped.select("taxid", "rank", F.explode("path").alias("ancestor_taxid")).filter("taxid <> ancestor_taxid")
    return (found.select("ancestor_taxid", "taxid", "rank")
            .unionByName(looped.join(asked, "ancestor_taxid").select("ancestor_taxid", "taxid", "rank")).distinct())


def ancestors(nodes: DataFrame, start: DataFrame) -> DataFrame:
    """Every ancestor (and the node itself) of the ``start`` taxids: (taxid, ancestor, rank)."""
    asked = start.select("taxid").filter(F.col("taxid").isNotNull()).distinct()
    up = node_paths(nodes).join(asked, "taxid", "left_semi").select("taxid", F.explode("path").alias("ancestor")).distinct()
    return up.join(nodes.select(F.col("taxid").alias("ancestor"), "rank").distinct(), "ancestor").select("taxid", "ancestor", "rank")


def lineage(accession_taxa: DataFrame, nodes: DataFrame, taxa_names: DataFrame,
            ranks: Sequence[str] = LINEAGE_RANKS) -> DataFrame:
    """Accession -> taxid -> the scientific name at each of ``ranks`` (wide)."""
    start = accession_taxa.select("taxid").filter(F.col("taxid").isNotNull()).distinct()
    anc = ancestors(nodes, start).filter(F.col("rank").isin(*ranks))
    sci = taxa_names.filter(F.col("name_class") == "scientific name").select(
        F.col("taxid").alias("ancestor"), "name")
    named = anc.join(sci, on="ancestor", how="left")
    wide = named.groupBy("taxid").pivot("rank", list(ranks)).agg(F.max("name"))
    return accession_taxa.select("accession", "taxid").join(wide, on="taxid", how="left") \
        .select("accession", "taxid", *ranks)


def accessions_for(taxids: DataFrame, accession_taxa: DataFrame) -> DataFrame:
    """Versioned accessions of the given taxids."""
    t = taxids.select("taxid").filter(F.col("taxid").isNotNull()).distinct()
    return accession_taxa.join(t, on="taxid", how="left_semi").select("accession", "taxid")


def filter_accessions(df: DataFrame, col: str = "accession", anchored: bool = False) -> DataFrame:
    """Keep nucleotide accessions; drop WGS/scaffold, TPA/TSA and RefSeq ones.

    ``anchored=False`` applies the prefix lists as originally written: ``^`` binds only the
    first alternative (the rest match anywhere) and the TPA list's stray ``]`` means ``LJ``
    accessions are kept. ``anchored=True`` anchors every alternative and drops the ``]``.
    """
    a = F.col(col)
    keep = a.rlike(ACCESSION_KEEP_PATTERNS[0]) | a.rlike(ACCESSION_KEEP_PATTERNS[1]) | a.rlike(ACCESSION_KEEP_PATTERNS[2])
    if anchored:
        wgs = "^(?:" + WGS_PREFIXES + ")"
        tpa = "^(?:" + TPA_TSA_PREFIXES.rstrip("]") + ")"
    else:
        wgs = "^" + WGS_PREFIXES
        tpa = "^" + TPA_TSA_PREFIXES
    return df.filter(keep & ~a.rlike(wgs) & ~a.rlike(tpa) & ~a.contains("_"))

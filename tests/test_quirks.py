"""Each documented quirk of the original pipeline, under both settings of its flag."""

from pyspark.sql import functions as F

from barcodeforge.operators import conflicts as G
from barcodeforge.operators import primers as P
from barcodeforge.operators import taxonomy as T
from barcodeforge.plans.fixtures import FIXTURES


def test_dedup_quirk_reference_rule(spark):
    df = spark.sql(FIXTURES["fx_dup_quirk"])
    kept = sorted(r["accession"] for r in G.dedup_taxa(df).collect())
    assert kept == ["a1", "a5", "a6"]


def test_dedup_quirk_per_species_rule(spark):
    df = spark.sql(FIXTURES["fx_dup_quirk"])
    kept = sorted(r["accession"] for r in G.dedup_taxa(df, scope="sequence_species").collect())
    assert kept == ["a1", "a3", "a5", "a6"]


def test_dedup_is_idempotent(spark):
    df = spark.sql(FIXTURES["fx_dup_quirk"])
    once = G.dedup_taxa(df, scope="sequence_species")
    twice = G.dedup_taxa(once, scope="sequence_species")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_conflict_levels(spark):
    df = spark.createDataFrame([
        ("x1", "AAA", "Apis mellifera", "Apis", "Apidae"),
        ("x2", "AAA", "Apis cerana", "Apis", "Apidae"),
        ("x3", "CCC", "Bombus a", "Bombus", "Apidae"),
        ("x4", "CCC", "Osmia b", "Osmia", "Megachilidae"),
        ("x5", "GGG", "Osmia b", "Osmia", "Megachilidae"),
        ("x6", "GGG", "Osmia b", "Osmia", "Megachilidae"),
        ("x7", "TTT", "Osmia c", "Osmia", "Megachilidae"),
    ], "accession string, sequence string, species string, genus string, family string")
    out = {r["accession"]: (r["conflict_count"], r["conflict_level"], r["conflict_taxa"])
           for r in G.flag_conflicts(df).collect()}
    assert out["x1"] == (2, "species", "Apis cerana, Apis mellifera")
    assert out["x3"] == (2, "family", "Apidae, Megachilidae")
    assert out["x5"] == (2, None, None)          # shared, but no taxon differs
    assert out["x7"] == (None, None, None)       # not shared
    # conflict_level null <=> no rank has more than one name
    for cnt, level, _ in out.values():
        if cnt is None:
            assert level is None


def test_accession_filter_as_written_and_anchored(spark):
    df = spark.createDataFrame([(a,) for a in (
        "AB123456.1", "XY99999.1", "LJ123456.1", "BK123456.1", "QQBA1234", "KQ123456.1", "NC_123456.1",
        "A1234.1", "ZZ12.1", "MN123456.1")], "accession string")
    as_written = {r["accession"] for r in T.filter_accessions(df).collect()}
    anchored = {r["accession"] for r in T.filter_accessions(df, anchored=True).collect()}
    # '^' binds only the first alternative: KQ is dropped anywhere (here at the start)
    assert "KQ123456.1" not in as_written and "KQ123456.1" not in anchored
    # the stray ']' keeps LJ accessions in the as-written form; anchored drops them
    assert "LJ123456.1" in as_written and "LJ123456.1" not in anchored
    assert "BK123456.1" not in as_written
    assert "NC_123456.1" not in as_written and "ZZ12.1" not in as_written
    assert {"AB123456.1", "XY99999.1", "A1234.1", "MN123456.1"} <= as_written
    # 'QQBA1234' does not pass the nucleotide-class patterns at all
    assert "QQBA1234" not in as_written


def test_reverse_match_off_by_one(spark):
    crops = spark.createDataFrame([("P", "acc", "AAAAAGGGGGCCCCC")], "primer_name string, accession string, sequence string")
    primers = spark.createDataFrame([("P", "G", "AAAAA", "GGGGG", 5)], "primer string, gene string, "
                                    "forward_sequence string, reverse_sequence string, length int")
    loose = P.primer_matches(crops, primers).first()
    exact = P.primer_matches(crops, primers, exact_bounds=True).first()
    assert loose["reverse_primer_match"] == "GCCCCC"          # rlen + 1 characters
    assert exact["reverse_primer_match"] == "CCCCC"
    assert loose["length_without_primers"] == 5
    assert loose["forward_primer_match"] == "AAAAA"


def test_resolve_uses_replaced_name_for_status(spark):
    cl = spark.createDataFrame([("Apidae", " Apis  old ", "Apis new", "s", "US")],
                               "family string, species_final string, species_synonym string, source string, country string")
    au = spark.createDataFrame([("Apis old", 3, "Exact", "T1", "Apis new Auth.", "Apis new", "Synonym")],
                               "submitted_name string, data_source int, match_type string, current_record_id string, "
                               "current_name string, current_canonical_simple string, taxonomic_status string")
    r = T.resolve_names(cl, au).first()
    assert r["species_final"] == "Apis new"
    assert r["taxonomic_status"] == "accepted"
    assert "_authority_status" not in T.resolve_names(cl, au).columns


def test_dense_ids_match_global_rank(spark):
    names = [f"sp{i % 137:04d}" for i in range(1000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "species_final string").repartition(7)
    out = {r["species_final"]: r["beeid"] for r in T.assign_ids(df).distinct().collect()}
    distinct = sorted(n for n in set(names) if n is not None)
    for i, n in enumerate(distinct):
        assert out[n] == f"B{i + 1:05d}"
    assert out[None] == f"B{len(distinct) + 1:05d}"
    big = T.dense_ids(spark.range(120000).select(F.col("id").alias("k")), "k", "id", "B", 5)
    assert big.filter(F.col("k") == 119999).first()["id"] == "B120000"   # never truncates


def test_values_collapse_in_order_of_appearance(spark):
    from pyspark.sql import functions as F

    from barcodeforge.operators.rowpick import collapse_in_order

    rows = [(1, "g", "b", None), (2, "g", "a", None), (3, "g", "b", None), (4, "g", None, None), (5, "h", "", None), (6, None, "z", "y"),
            (0, "h", "q", None), (7, "h", "a", None)]
    df = spark.createDataFrame(rows, "n int, k string, v string, w string")
    for parts in (1, 5):
        out = {r["k"]: (r["v"], r["w"]) for r in collapse_in_order(df.repartition(parts), ["k"], ["v", "w"], F.col("n")).collect()}
        assert out == {"g": ("b, a", ""), "h": ("q, , a", ""), None: ("z", "y")}
    out = {r["k"]: r["v"] for r in collapse_in_order(df, ["k"], ["v"], -F.col("n"), "; ", drop_empty=True).collect()}
    assert out == {"g": "b; a", "h": "a; q", None: "z"}

"""Scalar helpers and NULL semantics."""

from pyspark.sql import functions as F

from barcodeforge.functions import columns as C
from barcodeforge.functions.iupac import expand_iupac_str, expansion_size, iupac_member, revcomp, revcomp_str
from barcodeforge.functions.nulls import anti_null_safe, join_null_safe, n_distinct_na, na_propagate


def test_revcomp_twice_is_identity(spark):
    df = spark.createDataFrame([("ACGTRYSWKMBDHVNacgtn",), ("GGTCAACAAATC",)], "s string")
    out = df.select(revcomp(revcomp("s")).alias("r"), "s").collect()
    assert all(r["r"] == r["s"] for r in out)
    assert revcomp_str("AACG") == "CGTT"
    assert df.select(revcomp("s").alias("r")).first()["r"] == revcomp_str("ACGTRYSWKMBDHVNacgtn")


def test_iupac_expansion_native_matches_python(spark):
    df = spark.createDataFrame([("ARN",), ("GGNCAACAR",), ("ACGT",)], "p string")
    numbered = df.withColumn("n", expansion_size("p").cast("bigint")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = numbered.select("p", "n", iupac_member("p", "i").alias("s")).groupBy("p", "n").agg(F.collect_list("s").alias("e")).collect()
    assert len(rows) == 3
    for r in rows:
        assert sorted(r["e"]) == sorted(expand_iupac_str(r["p"]))
        assert r["n"] == len(r["e"])
    assert len(expand_iupac_str("ARN")) == 8


def test_squish_takes_unicode_spaces(spark):
    assert spark.createDataFrame([("\u00a0Apis\u00a0\u2003mellifera\u00a0",)], "x string").select(C.squish("x")).first()[0] == "Apis mellifera"


def test_squish_split_pack(spark):
    df = spark.createDataFrame([("  Apis   mellifera\t ligustica ", "a;b", None)], "x string, h string, n string")
    r = df.select(C.squish("x").alias("sq"), C.split_part("h", ";", 3).alias("past"),
                  C.pack([F.col("h"), F.col("n")], ";", "NA").alias("pk"),
                  C.parent_binomial(F.lit("Apis")).alias("pb"),
                  C.genus_of(F.lit("Apis mellifera")).alias("g")).first()
    assert r["sq"] == "Apis mellifera ligustica"
    assert r["past"] is None
    assert r["pk"] == "a;b;NA"
    assert r["pb"] == "Apis NA"
    assert r["g"] == "Apis"


def test_half_even_rounding(spark):
    r = spark.range(1).select(F.bround(F.lit(0.25), 1).alias("b"), F.bround(F.lit(2.5), 0).alias("c")).first()
    assert r["b"] == 0.2 and r["c"] == 2.0


def test_n_distinct_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "x string")
    assert df.agg(n_distinct_na("x").alias("n")).first()["n"] == 3


def test_na_propagating_min(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 3)], "g int, x int")
    out = {r["g"]: r["m"] for r in df.groupBy("g").agg(na_propagate(F.min("x"), "x").alias("m")).collect()}
    assert out == {1: None, 2: 3}


def test_null_safe_join_and_anti(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    j = {(r["v"], r["w"]) for r in join_null_safe(left, right, ["k"]).collect()}
    assert j == {(1, 10), (2, 20)}
    anti = anti_null_safe(left, right.filter(F.col("k").isNull()), ["k"]).collect()
    assert [r["v"] for r in anti] == [1]


def test_substr_inclusive_and_blank(spark):
    df = spark.createDataFrame([("ABCDEFG", 2, 4), ("ABC", 3, 2)], "s string, a int, b int")
    out = [r["x"] for r in df.select(C.substr_inclusive("s", "a", "b").alias("x")).collect()]
    assert out == ["BCD", ""]
    r = spark.range(1).select(C.blank_to_null(F.lit("NA")).alias("a"), C.blank_to_null(F.lit("x")).alias("b")).first()
    assert r["a"] is None and r["b"] == "x"

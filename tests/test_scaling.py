"""Nothing that grows with the tables is broadcast or made in one task."""

import pytest
from pyspark.sql import functions as F

from barcodeforge.operators import conflicts as G
from barcodeforge.operators import homology as H
from barcodeforge.plans.fixtures import fixture
from barcodeforge.plans.q_homology import hit_inputs
from barcodeforge.plans.q_sources import bold_clean, ncbi_clean


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    part = spark.range(300).selectExpr("id AS p_partkey", "'red widget' AS p_name", "'b' AS p_brand", "'small type' AS p_type",
                                       "CAST(id % 50 AS INT) AS p_size", "1.5D AS p_retailprice")
    line = spark.range(900).selectExpr(
        "id AS l_orderkey", "id % 300 AS l_partkey", "CAST(id % 7 AS INT) AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "0.1D AS l_discount")
    part.coalesce(1).write.parquet(f"{path}/part.parquet")
    line.coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_records_of_one_file_are_made_by_all_tasks(spark, tables):
    raw = fixture(spark, tables, "fx_bold_raw").filter(F.length("nuc") > 100)
    assert raw.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert raw.count() > 0


def test_hits_and_their_subjects_are_not_broadcast(spark, tables):
    hits, db, _ = hit_inputs(spark, tables)
    found = H.attach_taxonomy(H.best_hit_per_subject(hits), db)
    assert "Broadcast" not in plan(found)
    assert found.count() == 300 and found.filter("sequence IS NULL").count() == 0


def test_records_and_conflicts_are_not_broadcast(spark, tables):
    checklist = spark.createDataFrame([("red widget", "red widget", "f", "s", "c", "B1")],
                                      "species_final string, species_synonym string, family string, source string, country string, beeid string")
    for clean in (ncbi_clean, bold_clean):
        rows = clean(spark, tables, checklist)
        assert "Broadcast" not in plan(rows)
        assert rows.count() > 0
    db = fixture(spark, tables, "fx_sequences").withColumn("genus", F.lit("g"))
    assert "Broadcast" not in plan(G.sequence_database(db))

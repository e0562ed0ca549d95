"""Results do not depend on partitioning, also with one key holding a third of all rows."""

import random

from pyspark.sql import functions as F

from barcodeforge.operators import conflicts as G
from barcodeforge.operators.rowpick import keep_first


def skewed_rows(n=3000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:                       # a third of all rows share one sequence
            seq = "HOT"
        else:
            seq = f"S{rng.randrange(n // 4)}"
        sp = rng.choice(["Apis mellifera", "Apis cerana", "Bombus terrestris", None])
        genus = sp.split(" ")[0] if sp else None
        fam = {"Apis": "Apidae", "Bombus": "Apidae", None: None}[genus]
        rows.append((f"A{i:05d}", seq, sp, genus, fam))
    return rows


SCHEMA = "accession string, sequence string, species string, genus string, family string"


def test_sequence_database_is_partitioning_independent(spark):
    rows = skewed_rows()
    a = spark.createDataFrame(rows, SCHEMA).repartition(1)
    b = spark.createDataFrame(rows, SCHEMA).repartition(11, "accession")
    ra = sorted(map(tuple, G.sequence_database(a).collect()), key=str)
    rb = sorted(map(tuple, G.sequence_database(b).collect()), key=str)
    assert ra == rb
    hot = [r for r in G.conflict_table(a).collect() if r["sequence"] == "HOT"]
    assert hot and hot[0]["conflict_level"] == "genus"


def test_keep_first_is_partitioning_independent(spark):
    rows = skewed_rows(seed=2)
    outs = []
    for parts in (1, 5, 13):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        outs.append(sorted(map(tuple, keep_first(df, ["sequence"], ["species"]).collect()), key=str))
    assert outs[0] == outs[1] == outs[2]


def test_hot_key_is_pre_aggregated(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA)
    plan = G.conflict_table(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan and "partial_count" in plan
    first = keep_first(df, ["sequence"], ["accession"])._jdf.queryExecution().executedPlan().toString()
    assert first.count("WindowGroupLimit") >= 2        # partial limit before the exchange
    assert F is not None

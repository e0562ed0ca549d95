"""Broadcast only behind a size check; spread only small inputs."""

from barcodeforge.operators.partitioning import checked_broadcast, estimated_bytes, spread


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_falls_back_beyond_limit(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(checked_broadcast(small, max_bytes=100), "k")
        plain = big.join(checked_broadcast(small, max_bytes=5), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        assert "BroadcastHashJoin" not in _plan(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_only_small_inputs(spark):
    df = spark.range(100).coalesce(1)
    assert estimated_bytes(df) > 0
    assert "RoundRobinPartitioning" in _plan(spread(df, 4))
    assert "RoundRobinPartitioning" not in _plan(spread(df, 4, max_bytes=0))

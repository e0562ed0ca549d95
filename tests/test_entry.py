"""Driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as E
from bf_testdata import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"accession", "sequence", "species", "genus", "conflict_count", "conflict_level",
            "conflict_taxa"} <= set(df.columns)


def test_oracles_name_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_every_query_builds_at_smallest_scale(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF_SMALL)
        assert df.columns, name

"""Taxonomy walks on a small hand-made tree."""


import random

from barcodeforge.operators import taxonomy as T
from barcodeforge.operators.partitioning import materialize

NODES = [(1, None, "order"), (2, 1, "family"), (3, 2, "genus"), (4, 3, "species"), (5, 3, "species"),
         (6, 4, "subspecies"), (7, 4, "subspecies"), (8, 5, "subspecies")]
NAMES = [(1, "Hymenoptera"), (2, "Apidae"), (3, "Apis"), (4, "Apis mellifera"), (5, "Apis cerana"),
         (6, "Apis mellifera ligustica"), (7, "Apis mellifera carnica"), (8, "Apis cerana japonica")]


def frames(spark):
    nodes = spark.createDataFrame(NODES, "taxid long, parent_taxid long, rank string")
    names = spark.createDataFrame([(t, n, "scientific name") for t, n in NAMES],
                                  "taxid long, name string, name_class string")
    return nodes, names


def test_descendants_by_rank(spark):
    nodes, _ = frames(spark)
    start = spark.createDataFrame([(4,), (3,)], "taxid long")
    got = {(r["ancestor_taxid"], r["taxid"]) for r in T.descendants(nodes, start, rank="subspecies").collect()}
    assert got == {(4, 6), (4, 7), (3, 6), (3, 7), (3, 8)}


def test_lineage_wide(spark):
    nodes, names = frames(spark)
    acc = spark.createDataFrame([("A1.1", 6), ("A2.1", 5), ("A3.1", 99)], "accession string, taxid long")
    rows = {r["accession"]: r for r in T.lineage(acc, nodes, names).collect()}
    assert rows["A1.1"]["order"] == "Hymenoptera" and rows["A1.1"]["subspecies"] == "Apis mellifera ligustica"
    assert rows["A1.1"]["species"] == "Apis mellifera" and rows["A1.1"]["genus"] == "Apis"
    assert rows["A2.1"]["subspecies"] is None and rows["A2.1"]["family"] == "Apidae"
    assert all(rows["A3.1"][r] is None for r in T.LINEAGE_RANKS)


def test_cycles_and_self_parented_roots_end(spark):
    nodes = spark.createDataFrame([(1, 1, "root"), (2, 1, "a"), (3, 2, "b"), (8, 9, "c"), (9, 8, "d")],
                                  "taxid long, parent_taxid long, rank string")
    start = spark.createDataFrame([(1,), (8,)], "taxid long")
    down = {(r["ancestor_taxid"], r["taxid"]) for r in T.descendants(nodes, start).collect()}
    assert down == {(1, 2), (1, 3), (8, 9)}
    up = sorted((r["taxid"], r["ancestor"]) for r in T.ancestors(nodes, spark.createDataFrame([(3,), (9,)], "taxid long")).collect())
    assert up == [(3, 1), (3, 2), (3, 3), (9, 8), (9, 9)]


def test_deep_chain(spark):
    nodes = spark.createDataFrame([(k, k - 1, "x") for k in range(1, 12)], "taxid long, parent_taxid long, rank string")
    start = spark.createDataFrame([(0,)], "taxid long")
    assert T.descendants(nodes, start).count() == 11


def test_a_chain_of_1000_takes_ten_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(T, "materialize", lambda df: rounds.append(1) or materialize(df))
    nodes = spark.createDataFrame([(k, k - 1, "x") for k in range(1, 1001)], "taxid long, parent_taxid long, rank string")
    paths = T.node_paths(nodes)
    assert len(rounds) <= 11
    assert {r["taxid"]: r["path"] for r in paths.collect()} == {k: list(range(k + 1)) for k in range(1, 1001)}


def test_random_forests_with_loops_and_several_parents(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, k, rng.randrange(-3, k)]), rng.choice("ab")) for k in range(1, 300)]
    rows += [(400, 402, "a"), (401, 400, "b"), (402, 401, "a"), (403, 402, "b"), (404, 403, "a")]
    rows += [(290, 5, rows[289][2]), (500, 290, "a")]
    parents = {}
    for k, p, _ in rows:
        parents.setdefault(k, set()).update({p} - {None, k})
    above = {}
    for k in parents:
        seen, todo = set(), [k]
        while todo:
            for p in parents.get(todo.pop(), ()):
                if p not in seen:
                    seen.add(p)
                    todo.append(p)
        above[k] = seen
    rank = {k: r for k, _, r in rows}
    nodes = spark.createDataFrame(rows, "taxid long, parent_taxid long, rank string")
    start = spark.createDataFrame([(k,) for k in [*parents, 0, -1, -2, -3, 999, None]], "taxid long")
    labels = T.tree_labels(nodes)
    for wanted in (None, "a"):
        down = [(r["ancestor_taxid"], r["taxid"], r["rank"]) for r in T.descendants(labels, start, wanted).collect()]
        assert len(down) == len(set(down))
        assert set(down) == {(p, k, rank[k]) for k in above for p in above[k] - {k} if wanted in (None, rank[k])}
    up = sorted((r["taxid"], r["ancestor"], r["rank"]) for r in T.ancestors(nodes, start).collect())
    assert up == sorted((k, p, rank[p]) for k in above for p in above[k] | {k} if p in rank)

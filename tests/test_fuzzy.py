"""Fuzzy joins against every pair compared by a plain recurrence."""

import random

import pytest

from barcodeforge.operators import fuzzy as Z


def distance(a, b, swaps):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if swaps and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def words(rng, n):
    base = ["".join(rng.choice("abcÀ") for _ in range(rng.randrange(0, 13))) for _ in range(n // 4)]
    out = list(base)
    while len(out) < n:
        w = list(rng.choice(base))
        for _ in range(rng.randrange(1, 4)):
            at, kind = rng.randrange(len(w) + 1), rng.randrange(4)
            if kind == 0:
                w.insert(at, rng.choice("abC"))
            elif kind == 1 and w:
                w.pop(at - 1)
            elif kind == 2 and w:
                w[at - 1] = rng.choice("abC")
            elif len(w) > 1:
                at = rng.randrange(len(w) - 1)
                w[at], w[at + 1] = w[at + 1], w[at]
        out.append("".join(w))
    return [*out, None, out[0], out[-1]]


@pytest.mark.parametrize(("limit", "metric", "fold"), [(0, "osa", True), (1, "osa", True), (2, "osa", False), (3, "osa", True), (1, "levenshtein", False), (3, "levenshtein", True)])
def test_all_pairs(spark, limit, metric, fold):
    rng = random.Random(limit)
    left, right = words(rng, 70), words(rng, 60)
    ldf = spark.createDataFrame(list(enumerate(left)), "i long, a string")
    rdf = spark.createDataFrame(list(enumerate(right)), "j long, b string")
    found = Z.fuzzy_join(ldf, rdf, "a", "b", limit, metric, fold, "full", "d")
    low = str.lower if fold else str
    pairs = {(i, j): distance(low(x), low(y), metric == "osa") for i, x in enumerate(left) for j, y in enumerate(right)
             if x is not None and y is not None}
    pairs = {k: d for k, d in pairs.items() if d <= limit}
    wanted = {(i, j, d) for (i, j), d in pairs.items()}
    wanted |= {(i, None, None) for i in range(len(left)) if i not in {k[0] for k in pairs}}
    wanted |= {(None, j, None) for j in range(len(right)) if j not in {k[1] for k in pairs}}
    rows = [(r["i"], r["j"], r["d"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == wanted


def test_no_nested_loop(spark):
    ldf, rdf = spark.createDataFrame([("abc",)], "a string"), spark.createDataFrame([("abd",)], "b string")
    plan = Z.fuzzy_pairs(ldf, rdf, "a", "b", 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="both sides have a"):
        Z.fuzzy_join(ldf, ldf, "a", "a", 1)
    assert Z.fuzzy_join(ldf.limit(0), rdf, "a", "b", 1, how="right").count() == 1


@pytest.mark.parametrize("metric", ["levenshtein", "osa"])
def test_common_words_do_not_make_all_pairs(spark, metric, monkeypatch):
    """Texts that differ in their last letters only: what they have in common fills one piece."""
    rng = random.Random(7)
    texts = sorted({"a rather long common name " + "".join(rng.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(600)})
    ldf = spark.createDataFrame([(t,) for t in texts], "a string")
    rdf = spark.createDataFrame([(t[:-1] + "x",) for t in texts], "b string")
    made = {}
    keys = Z._keys

    def kept(rows, col, *rest):
        made[col] = keys(rows, col, *rest)
        return made[col]

    monkeypatch.setattr(Z, "_keys", kept)
    found = Z.fuzzy_pairs(ldf, rdf, "a", "b", 1, metric)
    assert {(r[0], r[1]) for r in found.collect()} == {(t, t[:-1] + "x") for t in texts}
    met = made["left_text"].join(made["right_text"], "key").select("left_text", "right_text").distinct().count()
    assert met < 10 * len(texts)

import random

import pytest


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a DataFrame with further columns whose names the operators use themselves."""
    def make(rows, schema="doc_id bigint, text string", clash=("score", "fp", "anchor", "row", "part", "key", "_spans2", "length")):
        df = spark.createDataFrame(rows, schema).repartition(3)
        for c in clash:
            if c not in df.columns:
                df = df.selectExpr("*", f"'clash' AS `{c}`")
        return df
    return make


@pytest.fixture(scope="session")
def odd_documents():
    """Nulls, empty and white-space texts, one very long text, copies, near copies, ties."""
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma", "Délta", "epsilon", "zeta", "eta", "Theta", "iota", "kappa", "lambda", "mu"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = text(9000)
    base = text(120)
    near = base.replace("gamma", "gamma", 1).rsplit(" ", 1)[0] + " omega"
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "two words"), (6, long), (7, base), (8, base), (9, near),
            (9, near), (10, base.upper()), (None, base), (None, None), (11, long + " tail"), (12, "x" * 40000),
            (13, "日本語 テキスト 😀 mixed ascii"), (14, base[:200] + "\n" + text(30)), (50, text(60)), (100, text(61))]
    rows += [(200 + k, text(rng.randint(1, 90))) for k in range(40)]
    rows += [(300 + k, base[:150] + " " + text(10)) for k in range(12)]
    return rows

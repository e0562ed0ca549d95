"""Every stage of the corpus pipeline against a brute-force version on its own input."""

import corpus_pipeline
import pytest
import test_histogram_packing
import test_simhash_hamming
import test_string_tiling
from barcodeforge.llm import dictionary_quality as Q

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text, r.n_chars) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, "en", "x", None), (900_001, None, "en", "x", None), (900_002, "", "en", "x", 0),
                                 (900_003, docs.first().text, "en", "x", 1)], docs.schema)
    docs = docs.union(odd).union(docs.limit(2)).selectExpr("*", "'clash' AS score", "1 AS fp")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_quality_keeps_what_scores_enough(spark, stages):
    model = Q.train_quality_model(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.scorer()
    expect = [r for r in rows(stages[0]) if score([(r[1] or "").encode()])[1][0] >= 0.3]
    assert sorted(rows(stages[1]), key=str) == sorted(expect, key=str) and 0 < len(expect) < stages[0].count()


def test_one_document_of_each_near_copy_group_stays(stages):
    given = list(dict.fromkeys(rows(stages[1])))
    prints = [(i, test_simhash_hamming.fingerprint(t)) for i, t, _ in given]
    order = sorted(range(len(given)), key=lambda k: (given[k][0] is None, given[k][0] or 0))
    group = test_simhash_hamming.components([(place, prints[k][1]) for place, k in enumerate(order)])
    expect = [given[k] for place, k in enumerate(order) if group[place] == place]
    assert sorted(rows(stages[2]), key=str) == sorted(expect, key=str)


def test_repeats_are_cut_at_whole_code_points(stages):
    given = rows(stages[2])
    first = {}
    for i, t, _ in sorted((r for r in given if r[0] is not None), key=lambda r: r[0]):
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            first.setdefault(raw[p:p + 50], i)
    expect = []
    for i, t, n in given:
        raw = (t or "").encode()
        cover = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if i is not None and first[raw[p:p + 50]] < i:
                cover[p:p + 50] = b"\1" * 50
        if not any(cover):
            expect.append((i, t, n))
            continue
        kept, at = "", 0
        for c in t:
            size = len(c.encode())
            kept += c if not all(cover[at:at + size]) else ""
            at += size
        if kept:
            expect.append((i, kept, len(kept)))
    assert sorted(rows(stages[3]), key=str) == sorted(expect, key=str)


def test_benchmark_passages_go(spark, stages):
    items = [test_string_tiling.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # an item's words all occur in a document that holds four fifths of it
    def holds(text):
        own = test_string_tiling.words(text)
        has = set(own)
        return any(sum(w in has for w in x) >= 0.8 * len(x) and
                   sum(n for n, *_ in test_string_tiling.tiling(x, own, 5)) >= 0.8 * len(x) - 1e-9 for x in items)

    expect = [r for r in rows(stages[3]) if not holds(r[1])]
    assert sorted(rows(stages[4]), key=str) == sorted(expect, key=str)


def test_everything_left_is_packed(stages):
    test_histogram_packing.check([(i, t) for i, t, _ in rows(stages[4])], stages[5].collect(), 2048)


def test_run_is_the_stages_in_a_row(spark, stages):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == stages[5].columns and out.count() > 0

import zlib

from barcodeforge.llm import dictionary_quality as Q


def test_held_out_accuracy_and_columns(spark):
    rows = Q.op1(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.93
    good = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.97


def test_held_out_labels_and_other_columns_do_not_change_a_score(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one = Q.train_quality_model(docs, labels)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert one == Q.train_quality_model(docs.selectExpr("text", "doc_id", "'x' AS lang", "0 AS score"), other)


def test_odd_rows(spark, table, odd_documents):
    model = Q.train_quality_model(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"),
                                  spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    docs = table(odd_documents)
    rows = Q.quality_scores(docs, model).collect()
    assert len(rows) == len(odd_documents)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[1] == by[2] == {model.prior} and by[7] == by[8] and len(by[9]) == 1
    kept = Q.keep_quality(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(odd_documents)
    assert Q.quality_scores(table([]), model).count() == 0


def test_without_both_classes(table):
    docs = table([(k, f"text {k}") for k in range(20)])
    none = table([], "doc_id bigint, quality int")
    good = table([(k, 1) for k in range(20)] + [(3, None)], "doc_id bigint, quality int")
    assert {r.score for r in Q.quality_scores(docs, Q.train_quality_model(docs, none)).collect()} == {0.5}
    assert all(r.score > 0.99 for r in Q.quality_scores(docs, Q.train_quality_model(docs, good)).collect())
    assert Q.train_quality_model(table([]), good).slope == 0.0

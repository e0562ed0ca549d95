import base64
import hashlib
import uuid

import pytest
from barcodeforge.llm import warc_store as W

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>\r\n\r\nWARC/1.1\r\n"), (3, "http://a\r\nX: y", "<p>one</p>"),
         (4, None, None), (5, "u", ""), (6, "u", "é" * 50_000), (7, "u", "é" * 50_000), (7, "u", "é" * 50_000), (None, "u", "<p>one</p>"),
         (9, "u", "\r\n\r\n"), (10, "u", "tail\n")]


def restored(spark, table, pages, scratch, least=0):
    path = f"{scratch}/{uuid.uuid4().hex}"
    records = W.archive_records(table(pages, "page_id bigint, url string, html string", ("digest", "payload", "sha1", "head")), min_payload=least)
    W.write_archive(records, path)
    return W.restore(spark.read.parquet(f"{path}/headers"), W.payloads(W.read_archive(spark, f"{path}/warc"))).collect(), path


def test_round_trip(spark, table, scratch):
    rows, path = restored(spark, table, PAGES, scratch)
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    expect = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        source = first.get(h or "")
        revisit = i is not None and i > source
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        head = "\r\n".join(["WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: <urn:page:{'none' if i is None else i}>", f"WARC-Date: {W.DATE}",
                            "WARC-Target-URI: " + (u or "").replace("\r", " ").replace("\n", " "), f"WARC-Payload-Digest: sha1:{digest}",
                            f"X-Payload-Check: sha256:{hashlib.sha256(raw).hexdigest()}", "Content-Type: text/html", f"Content-Length: {len(raw)}", "", ""])
        expect.append((i, "revisit" if revisit else "response", source if revisit else None, digest, head, raw))
    got = [(r.page_id, r.record_type, r.refers_to, r.digest, r.head, bytes(r.payload)) for r in rows]
    assert sorted(got, key=str) == sorted(expect, key=str)
    stored = W.read_archive(spark, f"{path}/warc")
    assert stored.where("record_type = 'revisit' and octet_length(payload) > 0").count() == 0


def test_small_payloads_are_all_responses(spark, table, scratch):
    rows, _ = restored(spark, table, PAGES, scratch, least=11)
    assert {r.page_id for r in rows if r.record_type == "revisit"} == {7}
    rows, _ = restored(spark, table, [(k, "u", "x" * (10 + k // 2)) for k in range(6)], scratch, least=11)
    assert sorted((r.page_id, r.refers_to) for r in rows if r.record_type == "revisit") == [(3, 2), (5, 4)]


def test_a_changed_payload_is_found(spark, table, scratch):
    records = W.archive_records(table(PAGES[:2], "page_id bigint, url string, html string"))
    W.write_archive(records.selectExpr("page_id", "record_type", "refers_to", "digest", "check", "original", "head", "translate(payload, 'n', 'm') AS payload"),
                    f"{scratch}/bad")
    with pytest.raises(Exception, match="does not have its digest"):
        W.read_archive(spark, f"{scratch}/bad/warc").count()


def test_empty_table(spark, table, scratch):
    path = f"{scratch}/none"
    W.write_archive(W.archive_records(table([], "page_id bigint, url string, html string")), path)
    assert spark.read.parquet(f"{path}/headers").count() == 0


def test_a_missing_payload_is_found(spark, table, scratch):
    path = f"{scratch}/lost"
    W.write_archive(W.archive_records(table(PAGES, "page_id bigint, url string, html string")), path)
    stored = W.payloads(W.read_archive(spark, f"{path}/warc")).where("octet_length(payload) <> 10")
    with pytest.raises(Exception, match="no payload is stored"):
        W.restore(spark.read.parquet(f"{path}/headers"), stored).collect()


def test_files_are_unpacked_a_record_at_a_time():
    import gzip

    records = [(f"WARC/1.1\r\nX: {k}\r\nContent-Length: {n}\r\n\r\n", bytes([k % 251]) * n) for k, n in enumerate([0, 1, 300_000, 7, 0, 70_000])]
    raw = [h.encode() + b + b"\r\n\r\n" for h, b in records]
    for packed in (gzip.compress(b"".join(raw)), b"".join(map(gzip.compress, raw))):
        assert [(h, b) for h, _, b in W._stream(memoryview(packed))] == records
    with pytest.raises(ValueError, match="within a record|does not end"):
        list(W._stream(memoryview(gzip.compress(b"".join(raw)[:-9]))))

"""Content-addressed WARC archive: payload bytes once under a verified digest, exact record
headers beside them, original records rebuilt by joins."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C
from barcodeforge.operators.partitioning import scratch_path

CRLF = "\r\n"
END = "\r\n\r\n"
#: payloads of at least so many bytes are stored once
MIN_PAYLOAD = 0
#: records of one archive file; a file is read by one task
FILE_RECORDS = 2000
#: packed bytes that are unpacked at once
INFLATE_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"


def digests(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, sha1, check``: SHA-1 names the payload; SHA-256
    verifies that equal names are equal bytes. A null payload is empty, a null url empty."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    raw = F.col("payload").cast("binary")
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "sha1": F.sha1(raw),
                             "check": F.sha2(raw, 256)})


def base32_sha1(col) -> F.Column:
    """Bare upper-case base32 of a hexadecimal SHA-1: 160 bits in 32 letters of 5."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for block in range(4):  # 10 hexadecimal digits are 8 letters
        value = F.conv(F.substring(col, 10 * block + 1, 10), 16, 10).cast("bigint")
        out += [F.substring(F.lit(letters), (F.shiftright(value, 35 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
                for k in range(8)]
    return F.concat(*out)


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                    min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``page_id, record_type, refers_to, digest, check, payload_bytes, original, head, payload`` of every
    page: ``original`` is the exact header of the page's own record with its whole payload,
    ``head`` and ``payload`` are what the archive holds of it. Of equal payloads of at
    least ``min_payload`` bytes the smallest id is the response, the others are revisits
    without payload that refer to it; smaller payloads are all responses.

    Payloads are equal when SHA-1, SHA-256 and length agree. The first of each is found from
    digests alone, by a partial minimum, so a payload that a third of all pages share moves
    one row per task; repeated rows of the first id are told apart by a record number. A page
    without id is a response and no revisit refers to it.
    """
    rows = digests(pages, id_col, url_col, payload_col)
    key = ["sha1", "check", "payload_bytes"]
    first = (rows.where((F.col("payload_bytes") >= min_payload) & F.col("page_id").isNotNull()).groupBy(*key)
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    rows = rows.join(first, key, "left")
    revisit = F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(False))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    rows = rows.withColumns({"record_type": kind, "refers_to": F.when(revisit, F.col("first_id"))})
    return rows.withColumn("digest", base32_sha1(F.col("sha1"))).withColumns({"original": _head(False), "head": _head(True)}).select(
        "page_id", "record_type", "refers_to", "digest", "payload_bytes", "check", "original", "head",
        F.when(~revisit, F.col("payload")).otherwise(F.lit("")).alias("payload"))


def _line(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _head(stored: bool) -> F.Column:
    """WARC/1.1 header of a record, up to and with its empty line: of the page's own record, or of
    the one that is ``stored``, which may be a revisit. The id is in the record's URN."""
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    url = F.regexp_replace("url", r"[\r\n]", " ")  # a header is one line
    revisit = (F.col("record_type") == "revisit") & F.lit(stored)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Check", F.concat(F.lit("sha256:"), F.col("check"))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))))
        .otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF))


def write_archive(records: DataFrame, path: str) -> None:
    """Write the records as gzip WARC files and the exact headers of the original records as a table.

    ``path/warc``: standard record streams (``head payload CRLF CRLF``), through Spark's own
    text writer, so a lost executor's half-written file is never seen. ``path/headers``:
    ``page_id, record_type, refers_to, digest, check, original`` without any payload.
    """
    (records.select(F.concat("head", "payload").alias("value")).write
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .text(f"{path}/warc"))
    records.select("page_id", "record_type", "refers_to", "digest", "check", "original").write.parquet(f"{path}/headers")


def _stream(content: memoryview) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """``(head, fields, block)`` of the records of a gzip file, one after another: the header is read to
    its empty line, the block by its length. Only the record at hand is unpacked."""
    inflate, at, held = zlib.decompressobj(wbits=31), 0, bytearray()

    def more() -> bool:
        nonlocal inflate, at
        if inflate.eof:  # a file may have several members
            at -= len(inflate.unused_data)
            inflate = zlib.decompressobj(wbits=31)
        if at >= len(content):
            return False
        part = content[at:at + INFLATE_BYTES]
        at += len(part)
        held.extend(inflate.decompress(part))
        return True

    while True:
        while (stop := held.find(END.encode())) < 0 and more():
            pass
        if stop < 0:
            if held:
                raise ValueError("the archive ends within a record")
            return
        head = held[:stop + 4].decode()
        fields = dict(x.split(": ", 1) for x in head.split(CRLF)[1:] if x)
        size = int(fields["Content-Length"])
        end = stop + 4 + size
        while len(held) < end + 4 and more():
            pass
        if held[end:end + 4] != END.encode():
            raise ValueError("a record does not end where its length says")
        yield head, fields, bytes(held[stop + 4:end])
        del held[:end + 4]


def read_archive(spark, path: str) -> DataFrame:
    """``record_id, record_type, refers_to, uri, digest, check, head, payload`` of every record in the
    WARC files below ``path``. The block's own SHA-1 and SHA-256 must equal the header's for a
    response, or it fails."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches):
        names = ["record_id", "record_type", "refers_to", "uri", "digest", "check", "head", "payload"]
        for batch in batches:
            for content in batch.column("content"):
                size, out = 0, []
                for head, field, block in _stream(memoryview(content.as_buffer())):
                    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
                    check = field["X-Payload-Check"].removeprefix("sha256:")
                    if field["WARC-Type"] == "response" and (
                            base64.b32encode(hashlib.sha1(block).digest()).decode() != digest
                            or hashlib.sha256(block).hexdigest() != check):
                        raise ValueError(f"payload of {field['WARC-Record-ID']} does not have its digest")
                    out.append((_page(field["WARC-Record-ID"]), field["WARC-Type"], _page(field.get("WARC-Refers-To")),
                                field["WARC-Target-URI"], digest, check, head, block))
                    size += len(block)
                    if size >= C.PASS_BYTES:
                        yield _batch(out, names)
                        size, out = 0, []
                if out:
                    yield _batch(out, names)

    return files.mapInArrow(run, "record_id string, record_type string, refers_to string, uri string, digest string, "
                                 "check string, head string, payload binary")


def _page(urn: str | None) -> str | None:
    return None if urn is None or urn == "<urn:page:none>" else urn[len("<urn:page:"):-1]


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def restore(headers: DataFrame, stored: DataFrame) -> DataFrame:
    """The original records: every row of the header table joined to the payload that is stored under
    its digests, as ``page_id, record_type, refers_to, digest, head`` and the columns of
    ``stored`` beside ``digest, check`` (of :func:`payloads`: ``payload``).

    A payload that very many pages share is one row on its side of the join, whose other side
    Spark can split. A header whose payload is not stored is an error.
    """
    held = stored.dropDuplicates(["digest", "check"]).withColumn("_held", F.lit(True))
    joined = headers.join(held, ["digest", "check"], "left")
    there = F.when(F.col("_held"), F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("no payload is stored as "), F.col("digest"))))
    rest = [c for c in stored.columns if c not in ("digest", "check")]
    return joined.select("page_id", "record_type", "refers_to", there.cast("string").alias("digest"), F.col("original").alias("head"), *rest)


def payloads(records: DataFrame) -> DataFrame:
    """``digest, check, payload`` of the records of an archive that hold their payload."""
    return records.where("record_type = 'response'").select("digest", "check", "payload")


def op3(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(archive_records(C.table(spark, sf_dir, "pages")), path)
    # what is asked of a payload is taken from its bytes where they are read; the join moves that
    stored = payloads(read_archive(spark, f"{path}/warc")).select(
        "digest", "check", F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.sha1("payload")).alias("payload_digest"))
    full = restore(spark.read.parquet(f"{path}/headers"), stored)
    return full.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST((k // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d
"""

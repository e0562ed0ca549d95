"""Long FASTA records in chunks against plain parsing, over file blocks of every size."""

import os
import random

import pytest

from barcodeforge.sources.long_fasta import read_fasta_chunks


def expected(text, chunk, overlap):
    out, record, header, body = [], 0, None, []

    def close():
        if header is not None:
            s = "".join("".join(x.split()) for x in body)
            out.extend((record, header, a, s[a:a + chunk + overlap]) for a in range(0, max(1, len(s)), chunk) if a == 0 or len(s) > a + overlap)

    for line in text.split("\n"):
        if line.startswith(">"):
            close()
            record, header, body = record + 1, line[1:].removesuffix("\r"), []
        elif header is not None:
            body.append(line)
    close()
    return out


@pytest.mark.parametrize(("block", "chunk", "overlap"), [(300, 7, 3), (170, 20, 0), (4096, 50, 49), (600, 5, 12)])
def test_chunks(spark, scratch, block, chunk, overlap):
    rng = random.Random(block)
    texts = {}
    for name in ("a.fa", "b.fa"):
        lines = ["no header yet"] if name == "a.fa" else []
        for k in range(12):
            lines.append(f">r{k} of > {name}" + "\r" * (k % 2))
            body = "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 5, 90, 700])))
            width = rng.choice([4, 60, 1000])
            lines += [body[a:a + width] + rng.choice(["", " ", "\r"]) for a in range(0, len(body), width)]
        texts[name] = "\n".join(lines) + rng.choice(["", "\n", "\n\n"])
        with open(os.path.join(scratch, name), "w", newline="") as f:
            f.write(texts[name])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_fasta_chunks(spark, scratch, chunk, overlap, glob="*.fa").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    found = sorted((r["file"].split("/")[-1], r["record"], r["header"], r["start"], r["sequence"]) for r in rows)
    assert found == sorted((name, *x) for name, text in texts.items() for x in expected(text, chunk, overlap))


def test_a_long_record_is_many_rows(spark, scratch):
    with open(os.path.join(scratch, "long.fa"), "w") as f:
        f.write(">one\n" + ("ACGT" * 15 + "\n") * 20000)
    rows = read_fasta_chunks(spark, scratch, 100_000, 1000).collect()
    assert len(rows) == 12
    assert max(len(r["sequence"]) for r in rows) == 101_000
    assert "".join(r["sequence"][:100_000] for r in sorted(rows, key=lambda r: r["start"])) == "ACGT" * 300_000

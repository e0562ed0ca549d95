import hashlib
import random
import re

import xxhash
from barcodeforge.llm import signed_fingerprints as G


def digest(*parts, seed=42):
    for p in parts:
        if p is not None:
            raw = p if isinstance(p, bytes) else p.encode()
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", text)
    votes, total = [0] * 128, 0
    for a, b in zip(w, [*w[1:], None]):
        weight = len(a) + len(b or "")
        total += weight
        h = digest(a, b) | digest((7).to_bytes(4, "little"), a, b) << 64
        for k in range(128):
            votes[k] += weight if h >> k & 1 else -weight
    f = sum(1 << k for k in range(128) if votes[k] > 0)
    return f"{f & (1 << 64) - 1:016x}{f >> 64:016x}"


def bits(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_documents_against_brute_force(table, odd_documents, monkeypatch):
    monkeypatch.setattr(G, "RANGE_ROWS", 7)
    rows = G.edited_fingerprints(table(odd_documents)).collect()
    docs = sorted(((i is not None, i or 0, t or "") for i, t in odd_documents))
    expect = []
    prints = [fingerprint(t) for *_, t in docs]
    for k, (known, i, t) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][2]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        near = sum(bits(prints[k], p) <= 3 for p in prints) - 1 if known and i % 50 == 0 else None
        e = fingerprint(edited)
        expect.append((i if known else None, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[k], e,
                       1 - bits(prints[k], e) / 128, 1 - bits(prints[k], prints[(k + 1) % len(docs)]) / 128, near))
    assert sorted((tuple(r) for r in rows), key=str) == sorted(expect, key=str)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(9)
    prints = [rng.getrandbits(128) for _ in range(30)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(128), k)) for p in prints[:20] for k in (0, 1, 2, 3, 4)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p & (1 << 64) - 1), signed(p >> 64)) for p in prints]
    df = spark.createDataFrame(rows, "f1 bigint, f2 bigint")
    got = {(r.f1, r.f2): r.n for r in G.near_fingerprints(df, df).collect()}
    assert got == {row: sum((p ^ q).bit_count() <= 3 for q in prints) for p, row in zip(prints, rows)}


def test_small_tables(table):
    assert G.edited_fingerprints(table([])).count() == 0
    one = G.edited_fingerprints(table([(5, "abcdef gh")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdeabcd").hexdigest()


def test_no_python_in_the_plan(spark):
    df = G.op9(spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    rows = df.collect()
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)

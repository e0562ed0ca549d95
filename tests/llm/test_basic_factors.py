"""Runs against trying every period at every place."""

import random
import re

import numpy as np
import pytest

from barcodeforge.llm import basic_factors as B


def brute(words, min_words=6, min_times=4):
    n, runs = len(words), {}
    for q in range(1, n // min_times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q if j > i else 0
            if length >= max(min_words, min_times * q):
                runs.setdefault((i, length), q)
            i = max(j, i + 1)
    found = sorted((s, n, q) for (s, n), q in runs.items())
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in found)]
    return found, " ".join(map(str, kept))


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


@pytest.mark.parametrize("kinds", [1, 2, 3, 8])
def test_random_sequences(kinds):
    rng = random.Random(kinds)
    rows, symbols, wanted = [], [], []
    for row in range(200):
        word = [rng.randrange(kinds) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):  # repetitions, nested and broken
            part = [rng.randrange(kinds) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 8)
            at = rng.randrange(len(word) + 1)
            word[at:at] = part
        base = len(symbols)
        wanted += [(base + s, base + s + n, q) for s, n, q in brute(word)[0]]
        symbols += word
        rows += [row] * len(word)
    start, end, period = B.periodic_runs(np.array(symbols), np.array(rows))
    assert list(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)) == sorted(wanted, key=lambda r: (r[0], r[2]))


def test_documents(table, odd_documents):
    rows = odd_documents + [(700, "a b " * 3000), (701, "x x x x x"), (702, "x x x x x x"), (703, "a b a b a b a"), (704, "a b c d " * 4),
                            (705, " ".join(["u v u w"] * 9)), (706, "é é É é é é é é é")]
    found = sorted(((r.doc_id is None, r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in B.collapse_runs(table(rows)).collect()), key=str)
    wanted = sorted(((i is None, i, len(split(t)), *brute(split(t))) for i, t in rows), key=str)
    assert found == wanted


def test_planted_periods(spark, table):
    import zlib

    rows = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in zip(range(120), [0, 1, 2, 7, 30, 31] * 20, strict=True)] + [(None, "a b"), (3, None)]
    df = table(rows)
    out = df.select("doc_id", B.with_planted_period(df["doc_id"], df["text"]).alias("text")).collect()
    wanted = []
    for i, text in rows:
        w, h = split(text), zlib.crc32(str(i).encode())
        if i is not None and text is not None and h % 10 == 0:
            n, g = len(w), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            text = " ".join(w)
        wanted.append((i, split(text)))
    assert sorted(((r.doc_id, split(r.text)) for r in out), key=str) == sorted(wanted, key=str)


def test_a_very_long_text_and_an_empty_table(table):
    found = B.collapse_runs(table([(1, "ab " * 400000 + "c")])).first()
    assert [tuple(x) for x in found.runs] == [(0, 400000, 1)]
    assert found.collapsed == "ab c"
    assert B.collapse_runs(table([])).count() == 0
    with pytest.raises(ValueError, match="four periods"):
        B.collapse_runs(table([]), min_times=2)

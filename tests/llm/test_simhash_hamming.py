import random
import re

import xxhash
from barcodeforge.llm import simhash_hamming as S
from conftest_llm import low


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", low(text))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """Brute force over (id, fingerprint) rows; null ids name nothing."""
    group = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, prints):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [least.get(g) for g in group]


def test_documents_against_brute_force(table, odd_documents):
    got = S.simhash_near_duplicates(table(odd_documents)).collect()
    prints = [(i, fingerprint(t)) for i, t in odd_documents]
    expect = sorted(((i, f, c) for (i, f), c in zip(prints, components(prints))), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == expect


def test_dense_and_chained_fingerprints(spark):
    """Groups within a few bits of each other, chains of 3-bit steps, and pairs at 4 bits."""
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
        walk = rng.getrandbits(64)
        for _ in range(10):
            walk ^= sum(1 << b for b in rng.sample(range(64), rng.choice((3, 3, 4))))
            prints.add(walk)
    prints |= {0, 7, (1 << 64) - 1, (1 << 63)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = S.hamming_components(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()
    first = {}
    for p, c in zip(prints, components([(k, p) for k, p in enumerate(prints)])):
        first.setdefault(c, set()).add(p)
    found = {}
    for r in got:
        found.setdefault(r.component, set()).add(r.node % (1 << 64))
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, first.values()))


def test_empty_table(table):
    assert S.simhash_near_duplicates(table([])).count() == 0

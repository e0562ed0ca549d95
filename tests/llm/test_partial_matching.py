import collections
import math
import random
import re
import zlib

import numpy as np
from barcodeforge.llm import partial_matching as P
from conftest_llm import low


def tokens(text):
    return re.findall("[^\x20\x09-\x0D]+", low(text))


def spelt(text):
    return b" ".join(w.encode() for w in tokens(text)) + b"\n"


class Trie:
    """The model as nested dictionaries, one symbol at a time."""

    def __init__(self, texts, order):
        self.order = order
        grams = collections.Counter()
        for t in texts:
            s = b"\n" * order + spelt(t)
            grams.update(s[p - order:p + 1] for p in range(order, len(s)))
        self.seen = [collections.defaultdict(dict) for _ in range(order + 1)]
        for depth in range(order, -1, -1):
            for g, n in grams.items():
                self.seen[depth][g[:-1]][g[-1]] = n
            grams = collections.Counter(g[1:] for g in grams)

    def log10(self, history, symbol):
        out, excluded = 0.0, set()
        for depth in range(self.order, -1, -1):
            known = self.seen[depth].get(history[len(history) - depth:])
            if known is None:
                continue
            live = {a: n for a, n in known.items() if a not in excluded}
            if live:
                total = sum(live.values())
                if symbol in live:
                    return out + math.log10((live[symbol] - 0.5) / total)
                out += math.log10(len(live) / 2 / total)
            excluded |= set(known)
        return out - math.log10(256 - len(excluded))

    def score(self, text):
        s = b"\n" * self.order + spelt(text)
        return sum(self.log10(s[p - self.order:p], s[p]) for p in range(self.order, len(s)))


def base(texts, train):
    c = collections.Counter()
    for t in train:
        c.update(tokens(t))
        c["\n"] += 1
    n, size = sum(c.values()), math.log10(sum(c.values()) + 0.5 * (len(c) + 1))
    return n, [(len(tokens(t)) + 1, sum(c[w] > 0 for w in [*tokens(t), "\n"]),
                sum(math.log10(c[w] + 0.5) - size for w in [*tokens(t), "\n"])) for t in texts]


def check(rows, docs, train, order):
    trie, (n, expect) = Trie(train, order), base([t for _, t in docs], train)
    want = sorted((str(i), a, b, round(x, 5), round(trie.score(t), 2)) for (i, t), (a, b, x) in zip(docs, expect))
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 2)) for r in rows)
    assert all(r.train_tokens == n for r in rows)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-3 and abs(g[4] - w[4]) <= 0.02 + 1e-6 * abs(w[4]), (g, w)
    assert len(got) == len(want)


def test_documents_against_a_trie_of_dictionaries(table, odd_documents):
    train = [t for i, t in odd_documents if i is None or i % 3]
    docs, training = table(odd_documents), table(odd_documents).where("doc_id is null or doc_id % 3 <> 0")
    check(P.score_documents(docs, training).collect(), odd_documents, train, P.ORDER)
    parts = P.score_documents(docs, training, order=3, shard_entries=20, frequent=5).collect()
    check(parts, odd_documents, train, 3)


def test_parts_share_one_scoring_node_and_stay_off_the_driver(table, odd_documents, monkeypatch):
    nodes, collected, stage, columns = [], [], P.C.stage_table, P._columns

    def staged(df):
        nodes.append(df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        return stage(df)

    def fetched(df):
        found = columns(df)
        collected.append(len(found[0]))
        return found

    monkeypatch.setattr(P.C, "stage_table", staged)
    monkeypatch.setattr(P, "_columns", fetched)
    monkeypatch.setattr(P, "WAITING", 50, raising=False)
    docs = table(odd_documents)
    rows = P.score_documents(docs, docs, order=3, shard_entries=20).collect()
    check(rows, odd_documents, [t for _, t in odd_documents], 3)
    assert max(nodes) == 1 and len(collected) == 4  # the two shortest lengths, entries and contexts


def test_probabilities_of_all_symbols_add_up(table):
    rng = random.Random(1)
    docs = [(k, " ".join(rng.choice(["ab", "ba", "abc", "cab"]) for _ in range(9))) for k in range(8)]
    entries, contexts = P.context_trie(P.corpus_counts(table(docs), order=2).where("kind = 0").select("key", "n"), 2)
    trie = next(iter(P.load_tries(entries, contexts, 2)))
    for history in (b"ab", b"zz", b"b ", b"\n\n", b"za"):
        keys = np.array([history[0] << 16 | history[1] << 8 | s for s in range(256)], np.uint64)
        assert abs((10.0 ** trie.log10(keys)).sum() - 1) < 1e-4


def test_empty_tables(table):
    docs = [(1, "some words here"), (2, None)]
    assert P.score_documents(table([]), table(docs)).count() == 0
    rows = {r.doc_id: r for r in P.score_documents(table(docs), table([])).collect()}
    assert abs(rows[1].score + 16 * math.log10(256)) < 1e-6 and rows[1].n_known == 0 and rows[1].train_tokens == 0


def test_query(spark):
    rows = P.op4(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)

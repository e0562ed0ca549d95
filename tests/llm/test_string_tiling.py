import random
import re

from barcodeforge.llm import string_tiling as T


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def tiling(pattern, text, least):
    """Greedy string tiling by comparing everything at every step."""
    p_free, t_free, tiles = [True] * len(pattern), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and p_free[p + n] and t_free[t + n] and pattern[p + n] == text[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        p_free[p:p + n] = t_free[t:t + n] = [False] * n
        tiles.append(best)


def test_tiles_against_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        pattern = [rng.randint(1, 4) for _ in range(rng.randint(0, 30))]
        text = [rng.randint(1, 4) for _ in range(rng.randint(0, 40))]
        least = rng.choice((2, 3, 5))
        assert T.tile(pattern, text, least) == tiling(pattern, text, least)


def test_documents_against_brute_force(table):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    item = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [item(n) for n in (30, 24, 41, 12, 7, 4, 1, 50)] + [[]]
    common = ["the", "same", "old", "phrase", "again", "and", "again"]
    items = [x if k % 3 else common + x for k, x in enumerate(items)]
    docs = []
    for k in range(60):
        body = item(rng.randint(5, 120)) + (common if k % 2 else [])
        x = list(rng.choice(items))
        kind = k % 6
        if kind == 1:
            body[3:3] = x
        elif kind == 2:  # reordered halves
            body[2:2] = x[len(x) // 2:] + item(4) + x[:len(x) // 2]
        elif kind == 3:  # near the threshold
            for _ in range(rng.randint(1, 4)):
                if x:
                    x[rng.randrange(len(x))] = "changed"
            body += x
        docs.append((k, (" ".join(body)).upper() if k % 5 == 0 else ", ".join(body)))
    docs += [(None, docs[1][1]), (70, None), (71, ""), (1, docs[1][1])]
    benchmark = [(k, " ".join(x)) for k, x in enumerate(items)] + [(90, None), (91, " ".join(items[0]))]
    got = T.benchmark_overlaps(table(docs), table(benchmark, "item_id bigint, text string")).collect()
    expect = set()
    for i, text in docs:
        for k, x in benchmark:
            x, own = words(x), words(text)
            if x:
                covered = sum(n for n, *_ in tiling(x, own, min(5, len(x))))
                if covered >= 0.8 * len(x) - 1e-9:
                    expect.add((i, k, len(x), covered))
    assert {(r.doc_id, r.item_id, r.item_words, r.covered_words) for r in got} == expect
    assert len(got) == len(expect) and any(r.n_tiles > 1 for r in got)
    kept = T.drop_contaminated(table(docs), table(benchmark, "item_id bigint, text string"))
    bad = {i for i, *_ in expect}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in bad), key=str)
    assert kept.columns == table(docs).columns


def test_words_do_not_depend_on_punctuation_or_case(table):
    item = [(1, "Élan vital, the “driving force” of life\u2014as he said\u00a0then: «yes» it is")]
    docs = [(5, "x élan vital the driving force of life as he said then yes it is y"), (6, "ÉLAN VITAL THE DRIVING FORCE OF LIFE"),
            (7, "élan vital the driving force; as he said then yes it is; of life")]
    got = T.benchmark_overlaps(table(docs), table(item, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.coverage) for r in got} == {(5, 1.0), (7, 12 / 14)}


def test_empty_tables(table):
    items = [(1, "one two three four five six")]
    assert T.benchmark_overlaps(table([]), table(items, "item_id bigint, text string")).count() == 0
    assert T.benchmark_overlaps(table(items), table([], "item_id bigint, text string")).count() == 0
    assert T.drop_contaminated(table(items), table([], "item_id bigint, text string")).count() == 1

"""Homology search: minimizer guarantee, segment scoring, planted hits on both strands."""

import random

import numpy as np

from barcodeforge.functions.iupac import revcomp_str
from barcodeforge.operators import homology as H


def test_shared_run_shares_a_minimizer():
    rng = random.Random(5)
    k, w = 12, 6
    for _ in range(200):
        core = "".join(rng.choice("ACGT") for _ in range(k + w - 1))
        a = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 40))) + core + "".join(rng.choice("ACGT") for _ in range(9))
        b = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 40))) + core
        ka = {a[p - 1:p - 1 + k] for p in H.minimizer_positions(a, k, w)}
        kb = {b[p - 1:p - 1 + k] for p in H.minimizer_positions(b, k, w)}
        assert ka & kb


def test_batch_minimizers_equal_per_sequence():
    rng = random.Random(13)
    seqs = ["".join(rng.choice("ACGTN" if i % 4 == 0 else "ACGT") for _ in range(rng.randint(0, 70)))
            for i in range(150)] + [None, "ACG"]
    for k, w in ((5, 3), (12, 6), (20, 9)):
        row, pos, kmer = H.minimizer_batch(seqs, k, w)
        for r, s in enumerate(seqs):
            got = sorted(int(p) for p, rr in zip(pos, row) if rr == r)
            assert got == H.minimizer_positions(s, k, w), (k, w, r)
        for r, p, km in zip(row, pos, kmer):
            word = seqs[r][p - 1:p - 1 + k]
            packed = 0
            for ch in word:
                packed = packed * 4 + "ACGT".index(ch)
            assert packed == km


def test_minimizers_skip_ambiguous_words():
    s = "ACGTN" * 10
    assert H.minimizer_positions(s, 5, 3) == []
    assert H.minimizer_positions("ACG", 5, 3) == []


def brute_best(q, s, d, reward=1, penalty=2):
    """(score, first, last, longest exact run) of one diagonal: ends first, then longest."""
    lo, hi = max(0, -d), min(len(q), len(s) - d)
    value = [reward if q[i] == s[i + d] and q[i] in "ACGT" else -penalty for i in range(lo, hi)]
    best = None
    for j in range(len(value)):
        for i in range(j + 1):
            cand = (sum(value[i:j + 1]), -j, -i)
            if best is None or cand > best:
                best = cand
    run = max(len(x) for x in "".join("1" if v > 0 else "0" for v in value).split("0"))
    return best[0], lo - best[2], lo - best[1], run


def test_diagonals_match_brute_force():
    rng = random.Random(9)
    q = ["".join(rng.choice("ACGTN") for _ in range(rng.randint(3, 14))) for _ in range(30)]
    s = ["".join(rng.choice("ACGTN") for _ in range(rng.randint(3, 14))) for _ in range(30)]
    cand = [(a, b, d) for a in range(30) for b in rng.sample(range(30), 6)
            for d in rng.sample(range(-len(q[a]) + 1, len(s[b])), 3)]
    ql, sl = np.array([len(x) for x in q]), np.array([len(x) for x in s])
    qs, ss = np.cumsum(ql) - ql, np.cumsum(sl) - sl
    a, b, d = np.array(cand).T
    got = H.score_diagonals(H._codes("".join(q)), qs[a], ql[a], H._codes("".join(s)), ss[b], sl[b], d, 1, 2)
    for k, (x, y, z) in enumerate(cand):
        assert tuple(int(g[k]) for g in got) == brute_best(q[x], s[y], z), (q[x], s[y], z)


def search(spark, seeds, subjects, **more):
    sdf = spark.createDataFrame(seeds, "primer_name string, qseqid string, sequence string")
    ddf = subjects if isinstance(subjects, H.SearchIndex) else spark.createDataFrame(subjects, "sseqid string, sequence string")
    return {(r["primer_name"], r["sseqid"]): r for r in H.homology_search(sdf, ddf, **more).collect()}


def test_a_gap_does_not_end_a_hit_and_unknown_bases_earn_nothing(spark):
    rng = random.Random(3)
    seed = "".join(rng.choice("ACGT") for _ in range(200))
    subjects = [("whole", seed), ("less", seed[:100] + seed[101:]), ("more", seed[:120] + "GATTACA" + seed[120:]),
                ("minus", revcomp_str(seed[:70] + seed[73:])), ("n", seed[:60] + "N" * 8), ("none", "ACGT" * 30)]
    hits = search(spark, [("P", "q", seed)], subjects)
    assert (hits["P", "less"]["sstart"], hits["P", "less"]["send"], hits["P", "less"]["length"], hits["P", "less"]["qcovs"]) == (1, 199, 200, 100.0)
    assert hits["P", "more"]["length"] == 207 and hits["P", "more"]["qcovs"] == 100.0
    assert (hits["P", "minus"]["sstart"], hits["P", "minus"]["send"]) == (197, 1)
    assert hits["P", "whole"]["bitscore"] > hits["P", "less"]["bitscore"] > hits["P", "more"]["bitscore"]
    assert hits["P", "n"]["length"] == 60 and ("P", "none") not in hits
    ns = search(spark, [("P", "q", seed[:40] + "N" * 60)], [("s", seed[:40] + "N" * 60)])
    assert ns["P", "s"]["length"] == 40


def test_output_is_linear_in_related_sequences(spark):
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(150))

    def variant():
        x = list(base)
        for _ in range(6):
            x[rng.randrange(len(x))] = rng.choice("ACGT")
        return "".join(x)

    seeds = [(f"P{k % 2}", f"q{k:02d}", variant()) for k in range(30)]
    subjects = [(f"s{k}", variant()) for k in range(40)]
    hits = search(spark, seeds, subjects)
    assert len(hits) == 80
    one = {k: tuple(v) for k, v in hits.items()}
    index = H.search_index(spark.createDataFrame(subjects, "sseqid string, sequence string"), split=3)
    assert one == {k: tuple(v) for k, v in search(spark, seeds, index).items()}
    assert one == {k: tuple(v) for k, v in search(spark, seeds, subjects * 2).items()}


def test_planted_hits_on_both_strands(spark):
    rng = random.Random(21)
    seeds, subjects, expect = [], [], {}
    for n in range(12):
        seed = "".join(rng.choice("ACGT") for _ in range(120))
        seeds.append(("PX", f"q{n}", seed))
        left = "".join(rng.choice("ACGT") for _ in range(rng.randint(10, 60)))
        right = "".join(rng.choice("ACGT") for _ in range(30))
        if n % 3 == 0:
            subj = left + revcomp_str(seed) + right
            expect[f"s{n}"] = (f"q{n}", len(left) + 120, len(left) + 1)
        else:
            subj = left + seed + right
            expect[f"s{n}"] = (f"q{n}", len(left) + 1, len(left) + 120)
        subjects.append((f"s{n}", subj))
    sdf = spark.createDataFrame(seeds, "primer_name string, qseqid string, sequence string")
    ddf = spark.createDataFrame(subjects, "sseqid string, sequence string")
    hits = H.homology_search(sdf, ddf).collect()
    by_subject = {}
    for h in hits:
        by_subject.setdefault(h["sseqid"], []).append(h)
    for s, (q, a, b) in expect.items():
        mine = [h for h in by_subject[s] if h["qseqid"] == q]
        assert len(mine) == 1
        h = mine[0]
        assert (h["sstart"], h["send"], h["length"], h["qcovs"]) == (a, b, 120, 100.0)
        assert h["bitscore"] > 200


def test_hit_post_processing(spark):
    hits = spark.createDataFrame([
        ("PX", "q1", "a1;Fam;Apis_mellifera;NA;B1", 5, 14, 10, 100.0, 50.0),
        ("PX", "q2", "a1;Fam;Apis_mellifera;NA;B1", 5, 14, 10, 100.0, 40.0),
        ("PX", "q1", "a2;Fam;Bombus_x;Bombus_x_y;B2", 14, 5, 10, 100.0, 30.0),
    ], "primer_name string, qseqid string, sseqid string, sstart int, send int, length int, qcovs double, bitscore double")
    db = spark.createDataFrame([("a1;Fam;Apis_mellifera;NA;B1", "a1", "AAAAACCCCCGGGGGTTTTT"),
                                ("a2;Fam;Bombus_x;Bombus_x_y;B2", "a2", "AAAAACCCCCGGGGGTTTTT")],
                               "header string, accession string, sequence string")
    primers = spark.createDataFrame([("PX", "16S", "A", "A", 10)], "primer string, gene string, "
                                    "forward_sequence string, reverse_sequence string, length int")
    best = H.best_hit_per_subject(hits)
    assert best.count() == 2 and best.filter("sseqid like 'a1%'").first()["bitscore"] == 50.0
    out = {r["accession"]: r for r in H.hits_to_database(hits, db, primers).collect()}
    assert out["a1"]["sequence"] == "ACCCCCGGGG" and out["a1"]["subspecies"] is None
    assert out["a1"]["species"] == "Apis mellifera" and out["a1"]["genus"] == "Apis"
    assert out["a2"]["reversed"] and out["a2"]["sequence"] == revcomp_str("ACCCCCGGGG")
    assert out["a2"]["subspecies"] == "Bombus x y" and out["a2"]["gene"] == "16S"


def test_repeated_headers_do_not_multiply_hits(spark):
    hits = spark.createDataFrame([("PX", "q1", "a1;Fam;Apis_mellifera;NA;B1", 1, 4, 4, 100.0, 50.0)],
                                 "primer_name string, qseqid string, sseqid string, sstart int, send int, length int, qcovs double, bitscore double")
    db = spark.createDataFrame([("a1;Fam;Apis_mellifera;NA;B1", "a1", "CCCC"), ("a1;Fam;Apis_mellifera;NA;B1", "a1", "AAAA")],
                               "header string, accession string, sequence string")
    rows = H.attach_taxonomy(hits, db).collect()
    assert [r["sequence"] for r in rows] == ["AAAA"]


def test_stage_counts_name_every_primer(spark):
    one = spark.createDataFrame([("PX",), ("PX",)], "primer_name string")
    none = spark.createDataFrame([], "primer_name string")
    primers = spark.createDataFrame([("PX",), ("PY",)], "primer string")
    rows = {(r["primer_name"], r["stage"]): r["n_rows"] for r in H.stage_counts(one, none, one, primers).collect()}
    assert rows == {("PX", "seeds"): 2, ("PY", "seeds"): 0, ("PX", "candidates"): 2, ("PY", "candidates"): 0,
                    ("PX", "filtered"): 0, ("PY", "filtered"): 0}


def test_the_bound_holds_and_prunes_nothing_that_wins(spark):
    """Every pair's best chain, found without pruning, is within the bound, and the search returns the best."""
    rng = random.Random(31)
    base = "".join(rng.choice("ACGT") for _ in range(220))

    def variant(edits):
        x = list(base[rng.randint(0, 25):len(base) - rng.randint(0, 25)])
        for _ in range(edits):
            at = rng.randrange(len(x))
            x[at:at + rng.choice([0, 1, 1, 1, 2])] = rng.choice(["", "A", "CC", "G", "T", "N"])
        return "".join(x)

    seeds = [(rng.choice(["P", None]), f"q{n:02d}", variant(n % 9)) for n in range(24)]
    subjects = [(f"s{n}", variant(n % 12) if n % 5 else revcomp_str(variant(n % 7))) for n in range(25)]
    hits = search(spark, seeds, subjects)
    best = {}
    for primer, qid, seed in seeds:
        for sid, text in subjects:
            for minus, q in ((False, seed), (True, revcomp_str(seed))):
                words = [{t[p - 1:p + 19] for p in H.minimizer_positions(t, 20, 9)} for t in (q, text)]
                lacking = sum(not ({q[a + p - 1:a + p + 19] for p in H.minimizer_positions(q[a:a + 28], 20, 9)} & words[1])
                              for a in range(0, len(q) - 27, 28))
                runs = {p - i for i in range(len(q) - 27) for p in range(len(text) - 27)
                        if q[i:i + 28] == text[p:p + 28] and set(q[i:i + 28]) <= set("ACGT")}
                segments = [(x[0], d, x[1], x[2]) for d in sorted(runs) for x in [brute_best(q, text, d)]]
                for chain in H.chain_segments(segments, 1, 2, H.GAP_OPEN, H.GAP_EXTEND):
                    bound = min(len(q) - 3 * max(0, lacking - 2), len(text))
                    assert chain[0] <= bound
                    ends = (chain[4], chain[2]) if minus else (chain[2], chain[4])
                    spans = max(chain[3] - chain[1], chain[4] - chain[2])
                    qcovs = round((chain[3] - chain[1] + 1) / len(q) * 100)
                    rank = (-chain[0], -spans, *ends, -qcovs, qid)
                    if chain[0] >= 0:
                        best[primer, sid] = min(best.get((primer, sid), rank), rank)
    assert {k: (-v[1] + 1, v[2] + 1, v[3] + 1, v[5]) for k, v in best.items()} == {
        k: (r["length"], r["sstart"], r["send"], r["qseqid"]) for k, r in hits.items()}
    assert len(best) > 30


def test_nothing_passes_the_driver_and_the_database_is_read_once(spark, monkeypatch):
    from pyspark import SparkContext

    seeds = spark.createDataFrame([("P", "q1", "ACGT" * 30)], "primer_name string, qseqid string, sequence string")
    db = spark.createDataFrame([("s1", "TT" + "ACGT" * 30), ("s2", None)], "sseqid string, sequence string")
    monkeypatch.setattr(SparkContext, "broadcast", lambda *a: 1 / 0)
    monkeypatch.setattr(type(seeds), "collect", lambda *a: 1 / 0)
    found = H.homology_search(seeds, db)
    monkeypatch.undo()
    assert [r["sseqid"] for r in found.collect()] == ["s1"]
    assert H.homology_search(seeds.limit(0), db).count() == 0
    assert H.homology_search(seeds, db.limit(0)).count() == 0


def test_packed_seeds_and_small_blocks(spark, monkeypatch):
    rng = random.Random(3)
    for size in (0, 1, 2, 7, 8):
        text = "".join(rng.choice("ACGTNRY") for _ in range(size))
        packed = spark.sql(f"SELECT unhex(translate(regexp_replace('{text}', '[^ACGT]', 'N'), 'ACGTN', '01234'))").first()[0]
        assert H._unpacked(bytes(packed), size, False).tolist() == H._codes(text).tolist()
        assert H._unpacked(bytes(packed), size, True).tolist() == H._codes(revcomp_str(text)).tolist()
    # a task looks at no more letters at a time than a block holds, whatever a batch brings
    import pyarrow as pa

    seen = []
    batch_of = H.minimizer_batch
    monkeypatch.setattr(H, "minimizer_batch", lambda seqs, k, w: seen.append(sum(map(len, seqs))) or batch_of(seqs, k, w))
    rows = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(["".join(rng.choice("ACGT") for _ in range(1000)) for _ in range(900)])], ["id", "text"])
    assert sum(b.num_rows for b in H._postings(iter([rows]), 20, 9, False)) > 900 * 100
    assert max(seen) <= H.BASE_BLOCK < sum(seen)


def test_seeds_of_a_word_are_dealt_to_rows(spark, monkeypatch):
    rng = random.Random(8)
    word = "".join(rng.choice("ACGT") for _ in range(40))
    seeds = [("P", f"q{n:03d}", word + "".join(rng.choice("ACGT") for _ in range(30))) for n in range(40)]
    subjects = [(f"s{n}", seeds[n][2]) for n in range(0, 40, 5)]
    whole = search(spark, seeds, subjects)
    monkeypatch.setattr(H, "SEEDS_A_ROW", 3)
    assert search(spark, seeds, subjects) == whole
    assert {k: r["qseqid"] for k, r in whole.items()} == {("P", f"s{n}"): f"q{n:03d}" for n in range(0, 40, 5)}

"""Primer scan and error scoring against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barcodeforge.functions.iupac import code_mask, expand_iupac_str, revcomp_str
from barcodeforge.operators import primers as P


def osa(a: str, b: str) -> int:
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        d[i][0] = i
    for j in range(len(b) + 1):
        d[0][j] = j
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            c = 0 if a[i - 1] == b[j - 1] else 1
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + c)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def lev(a, b):
    d = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        prev, d[0] = d[0], i
        for j in range(1, len(b) + 1):
            cur = d[j]
            d[j] = min(d[j] + 1, d[j - 1] + 1, prev + (a[i - 1] != b[j - 1]))
            prev = cur
    return d[len(b)]


def test_osa_reference_values():
    assert osa("CA", "ABC") == 3
    assert osa("CA", "AC") == 1 and lev("CA", "AC") == 2
    import numpy as np
    assert int(P._set_distance(["CA"], "AC", True)[0]) == 1
    assert int(P._set_distance(["CA"], "AC", False)[0]) == 2


@pytest.mark.parametrize("transpositions", [True, False])
def test_set_distance_equals_min_over_disambiguations(transpositions):
    rng = random.Random(7)
    codes = "ACGTRYN"
    for _ in range(60):
        pat = "".join(rng.choice(codes) for _ in range(rng.randint(3, 7)))
        m = "".join(rng.choice("ACGTN") for _ in range(len(pat) + rng.choice([0, 1])))
        f = osa if transpositions else lev
        want = min(f(m, d) for d in expand_iupac_str(pat))
        got = int(P._set_distance([m], pat, transpositions)[0])
        assert got == want, (m, pat)


def brute_crop(seq: str, fwd: str, rev: str, max_error: float):
    rc = revcomp_str(rev)

    def mism(window, p):
        return sum(1 for a, b in zip(window, p) if code_mask(a) & code_mask(b) == 0)

    def best(start, p, k):
        cands = [(mism(seq[i:i + len(p)], p), i) for i in range(start, len(seq) - len(p) + 1)]
        if not cands:
            return -1
        e, i = min(cands)
        return i if e <= k else -1

    kf, kr = math.floor(max_error * len(fwd) + 1e-9), math.floor(max_error * len(rc) + 1e-9)
    i = best(0, fwd, kf)
    if i < 0:
        return None
    j = best(i + len(fwd), rc, kr)
    if j < 0:
        return None
    return seq[i:j + len(rc)]


def test_fuzzy_crop_matches_brute_force(spark):
    rng = random.Random(11)
    fwd, rev = "GGTCAACARATCATAAAGAT", "TAAACTTCAGGGTGACCAAA"
    rc = revcomp_str(rev)
    rows = []
    for n in range(120):
        body = "".join(rng.choice("ACGT") for _ in range(rng.randint(30, 90)))
        f = list(fwd.replace("R", rng.choice("AG")))
        r = list(rc)
        for _ in range(rng.randint(0, 6)):
            f[rng.randrange(len(f))] = rng.choice("ACGTN")
        for _ in range(rng.randint(0, 6)):
            r[rng.randrange(len(r))] = rng.choice("ACGT")
        pre = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 25)))
        rows.append((f"s{n}", pre + "".join(f) + body + "".join(r) + "TTG"))
    seqs = spark.createDataFrame(rows, "accession string, sequence string")
    primers = spark.createDataFrame([("PX", "COX1", fwd, rev, 60)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    got = {r["accession"]: r["sequence"] for r in P.crop_by_primers(seqs, primers, 0.2).collect()}
    want = {a: brute_crop(s, fwd, rev, 0.2) for a, s in rows}
    want = {a: c for a, c in want.items() if c is not None}
    assert got == want
    assert 10 < len(want) < 120


def test_exact_scan_equals_fuzzy_scan_at_zero_errors(spark):
    rng = random.Random(3)
    fwd, rev = "ACGRT", "TTGCA"
    rows = [(f"s{n}", "".join(rng.choice("ACGTN") for _ in range(80))) for n in range(300)]
    rows += [("planted", "CC" + "ACGAT" + "GGGG" + revcomp_str(rev) + "CC")]
    seqs = spark.createDataFrame(rows, "accession string, sequence string")
    primers = spark.createDataFrame([("PX", "G", fwd, rev, 10)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    exact = {(r["accession"], r["sequence"]) for r in P.crop_by_primers(seqs, primers, 0).collect()}
    want = {(a, brute_crop(s, fwd, rev, 0)) for a, s in rows if brute_crop(s, fwd, rev, 0) is not None}
    assert exact == want
    assert ("planted", "ACGAT" + "GGGG" + revcomp_str(rev)) in exact


def test_dictionary_and_guard(spark):
    primers = spark.createDataFrame([("PX", "G", "ARN", "YA", 10)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    d = P.primer_dictionary(primers).collect()
    fwd = sorted(r["disambiguated"] for r in d if r["direction"] == "forward")
    rev = sorted(r["disambiguated"] for r in d if r["direction"] == "reverse")
    assert fwd == sorted(expand_iupac_str("ARN")) and len(fwd) == 8
    assert rev == sorted(expand_iupac_str(revcomp_str("YA")))
    wide = spark.createDataFrame([("PH", "G", "N" * 7, "A", 10)],
                                 "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    strings = [r["disambiguated"] for r in P.primer_dictionary(wide).filter("direction = 'forward'").collect()]
    assert len(strings) == len(set(strings)) == 4 ** 7


def test_very_degenerate_primers_are_scored(spark):
    crops = spark.createDataFrame([("PH", "a1", "ACGTACGTTTTTCCCCT")], "primer_name string, accession string, sequence string")
    primers = spark.createDataFrame([("PH", "G", "NNNNNNNA", "NNNNNNNN", 3)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    for metric in ("osa", "levenshtein"):
        r = P.score_primer_errors(P.primer_matches(crops, primers), primers, metric).first()
        assert (r["forward_primer_errors"], r["reverse_primer_errors"]) == (1.0, 1.0)


def test_inosine_pairs_with_every_base_and_other_letters_are_named(spark):
    seqs = spark.createDataFrame([("a", "AAGCTAGGGGTTCAA"), ("b", "AAGCAGGGGTTCAA")], "accession string, sequence string")
    schema = "primer string, gene string, forward_sequence string, reverse_sequence string, length int"
    primers = spark.createDataFrame([("PI", "G", "GCIA", "TGIA", 4)], schema)
    for max_error in (0, 0.2):
        got = {r["accession"]: r["sequence"] for r in P.crop_by_primers(seqs, primers, max_error).collect()}
        assert got == {"a": "GCTAGGGGTTCA"}
    bad = spark.createDataFrame([("PB", "G", "GC1A", "TGNA", 4)], schema)
    with pytest.raises(ValueError, match="'1'"):
        P.crop_by_primers(seqs, bad, 0)


def test_osa_and_levenshtein_paths_agree_without_transpositions(spark):
    crops = spark.createDataFrame([("PX", "a1", "ACGATTTTTTTTTTGCAA"), ("PX", "a2", "ACGTATTTTTTTTTTGCAA")],
                                  "primer_name string, accession string, sequence string")
    primers = spark.createDataFrame([("PX", "G", "ACGRT", "TTGCA", 8)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    m = P.primer_matches(crops, primers)
    lev_ = {r["accession"]: (r["forward_primer_errors"], r["reverse_primer_errors"])
            for r in P.score_primer_errors(m, primers, "levenshtein").collect()}
    osa_ = {r["accession"]: (r["forward_primer_errors"], r["reverse_primer_errors"])
            for r in P.score_primer_errors(m, primers, "osa").collect()}
    assert lev_["a1"] == osa_["a1"] == (0.0, 1.0)
    # 'ACGTA' vs ACGRT: one transposition (OSA 1) or two substitutions (Levenshtein 2)
    assert osa_["a2"][0] == 1.0 and lev_["a2"][0] == 2.0


def test_seed_sequences_cut_primers(spark):
    body = "C" * 100
    seq = "GG" + "ACGAT" + body + revcomp_str("TTGCA") + "GG"
    seqs = spark.createDataFrame([("a1", "B1", seq)], "accession string, beeid string, sequence string")
    primers = spark.createDataFrame([("PX", "G", "ACGRT", "TTGCA", 100)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    s = P.seed_sequences(seqs, primers).first()
    assert s["sequence"] == body and s["length"] == 100
    assert s["forward_primer_errors"] == 0.0
    # outside expected ± 20 % -> dropped
    primers2 = primers.withColumn("length", F.lit(200))
    assert P.seed_sequences(seqs, primers2).count() == 0


def semi_global(text, pat):
    """Brute force: min edit distance of pat to any substring of text, with (start, end)."""
    best = None
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            d = [[0] * (b - a + 1) for _ in range(len(pat) + 1)]
            for i in range(len(pat) + 1):
                d[i][0] = i
            for j in range(b - a + 1):
                d[0][j] = j
            for i in range(1, len(pat) + 1):
                for j in range(1, b - a + 1):
                    c = 0 if code_mask(pat[i - 1]) & code_mask(text[a + j - 1]) else 1
                    d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + c)
            cand = (d[len(pat)][b - a], b, a)
            if best is None or cand < best:
                best = cand
    return best


@pytest.mark.parametrize("chunk", [1024, 3, 7])
@pytest.mark.parametrize("letters", [64, 2])
def test_sites_with_indels_match_brute_force(monkeypatch, chunk, letters):
    """Automata and, for patterns beyond a machine word, rows of the recurrence; texts cut into chunks."""
    import numpy as np
    from barcodeforge.functions.iupac import mask_table
    monkeypatch.setattr(P, "CHUNK_LETTERS", chunk)
    monkeypatch.setattr(P, "AUTOMATON_LETTERS", letters)
    monkeypatch.setattr(P, "CELLS", 200)
    rng = random.Random(17)
    for size in range(3, 9):
        pat = "".join(rng.choice("ACGTRN") for _ in range(size))
        texts = ["".join(rng.choice("ACGTN") for _ in range(rng.randint(0, 25))) for _ in range(30)]
        lens = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.cumsum(lens) - lens
        codes = mask_table()[np.frombuffer("".join(texts).encode(), dtype=np.uint8)]
        p = np.array([code_mask(c) for c in pat], dtype=np.uint8)
        for k in (0, 1, 3):
            least, end = P._best_ends(codes, start, lens, p, k)
            rows = np.flatnonzero(end >= 0)
            begin = dict(zip(rows.tolist(), P._begins(codes, start[rows], end[rows], least[rows], p, k).tolist()))
            for row, text in enumerate(texts):
                best = semi_global(text, pat) if text else None
                if best is None or best[0] > k:
                    assert end[row] == -1
                else:
                    assert (least[row], end[row], begin[row]) == best, (text, pat, k)


def test_indel_scan_finds_site_with_deletion(spark):
    fwd, rev = "GGTCAACAAATCATAAAGATATTGG", "TAAACTTCAGGGTGACCAAAAAATCA"
    site = fwd[:10] + fwd[12:]                  # two bases deleted from the forward site
    body = "C" * 60
    seq = "TT" + site + body + revcomp_str(rev) + "AA"
    seqs = spark.createDataFrame([("a1", seq)], "accession string, sequence string")
    primers = spark.createDataFrame([("PX", "COX1", fwd, rev, 60)],
                                    "primer string, gene string, forward_sequence string, reverse_sequence string, length int")
    with_indels = P.crop_by_primers(seqs, primers, 0.2, indels=True).collect()
    assert [r["sequence"] for r in with_indels] == [site + body + revcomp_str(rev)]


def test_every_crop_is_a_substring_of_its_source(spark):
    from bf_testdata import SF_SMALL
    from barcodeforge.plans import q_primers as QP

    seqs, pr = QP.mutated_sequences(spark, SF_SMALL)
    for indels in (False, True):
        crops = P.crop_by_primers(seqs, pr, 0.2, keep=("accession", "beeid"), indels=indels)
        j = crops.alias("c").join(seqs.alias("s"), ["accession", "beeid"])
        bad = j.filter(F.instr(F.col("s.sequence"), F.col("c.sequence")) == 0).count()
        assert crops.count() > 0 and bad == 0

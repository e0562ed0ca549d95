import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from barcodeforge.llm import histogram_packing as H
from barcodeforge.llm.distinct_chunks import ChunkEncoder, byte_bpe
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer


def test_chunks_have_the_ids_of_the_whole_below_u0250():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = ChunkEncoder(byte_bpe(public_tokenizers.path("byte_bpe_50k.json")))
    texts = ["a<|endoftext|>b <|endoftext|> c"]
    for c in [*map(chr, range(0x250)), "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u0301", "日", "😀"]:
        texts += [f"a{c}b {c} {c}{c}1{c}\n{c}  {c}x", c, f"  {c}  ", f"'{c}s 9{c}9{c}{c}{c}.", f"x {c}y {c} z{c} w {c} {c}"]
    raw = [t.encode() for t in texts]
    ((ids, cuts),), _ = encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for k, text in enumerate(texts):
        assert ids[cuts[k]:cuts[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert 50256 in ids


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_patterns_use_every_piece_once(histogram):
    patterns = H.shortest_pack_first(histogram.items(), 64)
    used = Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 64 and count > 0
        for n in lengths:
            used[n] += count
    assert used == Counter(histogram)
    slots = defaultdict(list)
    for n, a, b, *_ in H.slot_table(patterns):
        slots[n].append((a, b))
    for n, parts in slots.items():
        assert sorted(parts)[0][0] == 0 and max(b for _, b in parts) == histogram[n]


def encoded(encode, texts):
    raw = [t.encode() for t in texts]
    ((ids, cuts),), sound = encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert sound.all()
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FINE = ChunkEncoder(byte_bpe(public_tokenizers.path("byte_bpe_50k.json")), remembered=50, fine=True)
PARTS = ["a", "word", "é", "ñ", "×", "÷", "\u0301", "\u00a0", "日", "😀", "9", " ", "  ", "\n", "\n\n", "\r", "\t", "'s", "'", "<|endoftext|>", "|>",
         *".,;:!?)\"#*$%&", "...", " b", "\nB", "x" * 300]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=8))
def test_chunks_cut_at_marks_and_line_feeds_have_the_ids_of_the_whole(texts):
    assert encoded(FINE, texts) == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_is_encoded_once_whatever_mark_follows_and_met_words_are_kept():
    given_out = []
    encode, vocabulary = byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    chunks = ChunkEncoder((lambda t: given_out.append(t) or encode(t), vocabulary), remembered=20, fine=True)
    first = encoded(chunks, ["x lorem. x lorem, x lorem!! x lorem*** x lorem\nx lorem"])
    assert "".join(given_out).count("lorem") == 1
    assert first == [encode("x lorem. x lorem, x lorem!! x lorem*** x lorem\nx lorem")]
    encoded(chunks, ["x lorem"])
    for k in range(30):  # the limit of remembered chunks is passed every second time
        encoded(chunks, [" ".join(f"w{k}v{j}" for j in range(10)) + " lorem"])
    assert "".join(given_out).count("lorem") == 1
    assert len(chunks.known) <= 50
    encoded(chunks, ["y" * 1000])
    assert len(chunks.known) <= 50 and sum(len(side.ids) for side in chunks.sides) < 500


def check(docs, rows, max_tokens):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(i, np.array([*exact.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t in docs]
    expect = sorted(((i, a, len(x[a:a + max_tokens]), zlib.crc32(x[a:a + max_tokens].tobytes()), len(x))
                     for i, x in ids for a in range(0, len(x), max_tokens)), key=str)
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows), key=str) == expect
    place = defaultdict(list)
    for r in rows:
        place[r.sequence_id].append((r.offset, r.length))
    for parts in place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_tokens


def test_documents(table, odd_documents):
    check(odd_documents, H.pack_documents(table(odd_documents)).collect(), 2048)
    rows = H.pack_documents(table(odd_documents), max_tokens=64, with_ids=True).collect()
    check(odd_documents, rows, 64)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_a_very_long_run_of_white_space(table):
    docs = [(1, "a" + " " * 2_000_000 + "word"), (2, "\u00a0\n" * 600_000 + "word"), (3, "one two")]
    check(docs, H.pack_documents(table(docs)).collect(), 2048)


def test_a_frequent_length_is_ranked_in_parts(table, odd_documents, monkeypatch):
    monkeypatch.setattr(H, "RANK_ROWS", 3)
    check(odd_documents, H.pack_documents(table(odd_documents), max_tokens=64).collect(), 64)


def test_little_padding(spark):
    rows = H.op10(spark, "/root/testdata/sf0.01").collect()
    used, total = Counter(), 0
    for r in rows:
        used[r.sequence_id] += r.length
    total = sum(n if n & (n - 1) == 0 else 2048 for n in used.values())
    assert 1 - sum(used.values()) / total < 0.01


def test_empty_table(table):
    assert H.pack_documents(table([])).count() == 0

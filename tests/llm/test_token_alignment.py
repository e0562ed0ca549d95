"""Alignment against whole-text encodings and token-by-token overlaps."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barcodeforge.llm import queries
from barcodeforge.llm import token_alignment as T
from barcodeforge.llm.distinct_chunks import ChunkEncoder, byte_bpe, byte_level_alphabet, chunk_starts

SPECIAL = [(600, "before <|endoftext|> after"), (601, "a ▁ lower block"), (602, "<s> </s> <unk> <0x41>"), (603, "  two  spaces \n\n and\ttabs "),
           (604, "x y   z 　 w"), (605, "don't we'll I'm 's x 't"), (606, "emoji 😀😀 é ́"), (607, "\x00\x01 \x7f"),
           (608, " " * 3000 + "end"), (609, "日本語のテキスト。" * 50)]


def brute(rows):
    a = Tokenizer.from_file(public_tokenizers.path(T.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.PIECE_BPE))
    alphabet = byte_level_alphabet()
    docs, held = [], Counter()
    for doc_id, text in rows:
        tokens = [[], []]
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            tokens[0] = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
            for i in b.encode(text):
                piece = b.id_to_piece(i)
                tokens[1].append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
            if any(b"".join(x for _, x in side) != (" " + text).encode() for side in tokens):
                tokens = [[], []]
        spans = []
        for side in tokens:
            at, out = 0, []
            for i, raw in side:
                out.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in spans))
            low = cut
        links, j = [], 0
        for s, e, x in spans[0]:
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((x, spans[1][j][2]))
                j += 1
        docs.append((doc_id, len(spans[0]), len(spans[1]), len(groups), links, ";".join(groups)))
        held.update(set(links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, groups in docs:
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), digest))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def statistics(df, shared):
    aligned = T.C.stage_table(T.align_tokenizers(df))
    found = T.link_statistics(aligned, T.pair_counts(aligned), shared)
    rows = aligned.join(found, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    return [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in rows]


@pytest.mark.parametrize("shared", [T.SHARED_PAIRS, 200, 0])
def test_odd_documents(table, odd_documents, shared):
    rows = odd_documents + SPECIAL
    assert ordered(statistics(table(rows), shared)) == ordered(brute(rows))


def test_registered_query(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = queries.QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert ordered(found.collect()) == ordered(brute(rows))


def test_a_very_long_text(table):
    rows = [(1, "lorem ipsum dolor " * 30000 + "z" * 5000), (2, "lorem")]
    found = {r.doc_id: r for r in T.align_tokenizers(table(rows)).collect()}
    assert found[1].n_links == sum(found[1].times) == found[1].n_a + found[1].n_b - found[1].n_groups
    assert found[1].n_a > 90000


def test_empty_table(table):
    df = table([])
    aligned = T.align_tokenizers(df)
    assert aligned.count() == 0
    assert T.link_statistics(aligned, T.pair_counts(aligned)).count() == 0


def test_chunks_are_encoded_as_the_whole(odd_documents):
    whole = Tokenizer.from_file(public_tokenizers.path(T.BYTE_BPE))
    texts = [t or "" for _, t in odd_documents + SPECIAL]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    few = ChunkEncoder(byte_bpe(public_tokenizers.path(T.BYTE_BPE)), remembered=3)
    for _ in range(2):  # once learnt, once remembered or forgotten
        ((ids, cuts),), sound = few(data, offsets)
        assert sound.all()
        for k, text in enumerate(texts):
            assert ids[cuts[k]:cuts[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(chunk_starts(data, offsets)) > 1000

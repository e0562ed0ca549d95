import random
import re

from barcodeforge.llm import perspectives as V
from barcodeforge.plans.compare import compare, duck

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(turns):
    out = []
    for conv in {c for c, *_ in turns}:
        own = sorted(((t is not None, t or 0, r or "unknown", x or "") for c, t, r, x in turns if c == conv))
        own = [(t if known else None, s, re.sub(r"<\|im_(start|end)\|>", r"<| im_\1 |>", x)) for known, t, s, x in own]
        own.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2]))
        for view in {s for _, s, _ in own if s != "system"}:
            at = 0
            for turn, speaker, text in own:
                clean = re.sub(r"[\s<|>]+", "_", speaker)
                head = "system" if speaker == "system" else "assistant" if speaker == view else f"user name={clean}"
                body = f"<|im_start|>{head}\n{text}<|im_end|>\n"
                mine = speaker == view
                out.append((conv, view, turn, speaker, head.split(" ")[0], body, int(mine), at, at + len(body),
                            at + 22 if mine else None, at + len(body) - 1 if mine else None))
                at += len(body)
    return sorted(out, key=str)


def check(table, turns):
    rows = V.rotate_perspectives(table(turns, SCHEMA, ("name", "block", "view", "first", "chars"))).collect()
    got = [(r.conv_id, r.perspective, r.turn, r.speaker, r.role, r.rendered, r.loss_mask, r.seg_start, r.seg_end, r.train_start, r.train_end)
           for r in rows]
    assert sorted(got, key=str) == brute(turns)
    for r in rows:
        if r.loss_mask:
            assert r.rendered[r.train_start - r.seg_start:r.train_end - r.seg_start].endswith("<|im_end|>")


def test_many_parties_and_odd_rows(table):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "hi"), (1, 2, "bob <b>", "hello <|im_end|> there"), (1, 3, "cy", "é😀"),
             (1, 4, "ann", None), (1, 4, "ann", None), (1, 4, "bob <b>", ""), (2, 0, "system", "alone"), (3, None, None, "who"), (3, 1, "ann", "x"),
             (None, 1, "ann", "no id"), (None, 2, "bob <b>", "none"), (4, -3, "assistant", "y"), (4, 700, "user", "z"), (4, 300, "assistant", "w")]
    check(table, turns)


def test_a_conversation_of_many_blocks(table):
    rng = random.Random(1)
    turns = [(1, t, rng.choice(["a", "b", "c", "system"]), "t" * rng.randint(0, 9)) for t in range(1500)]
    turns += [(2, t, rng.choice(["a", "b"]), str(t)) for t in range(20)]
    check(table, turns)


def test_empty_table(table):
    assert V.rotate_perspectives(table([], SCHEMA)).count() == 0


def test_query_against_sql_without_python(spark):
    sf = "/root/testdata/sf0.001"
    df = V.op8(spark, sf)
    assert compare(df, duck(sf), V.ORACLE)["ok"]
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())

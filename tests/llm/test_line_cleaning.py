"""Counts against plain Python, and one document for every line rule."""

import re
from collections import Counter

import pytest

from barcodeforge.llm import line_cleaning as L

PROSE = "The committee met on Tuesday and agreed that the old bridge should be repaired before winter, since the road is long."


def base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    places = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places),
            len(words) < 50 or 100 * len(places) > 50 * len(words))


def test_base_columns(table, odd_documents):
    rows = odd_documents + [(800, "a a a a"), (801, "a b c a b c"), (802, "x\n\nx\n x\nx\n"), (803, "# a | b & c <d> $5 100%"),
                            (804, ("w " * 300).strip()), (805, " ".join(str(k % 40) for k in range(5000)))]
    found = L.clean_lines(table(rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in found), key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)


@pytest.mark.parametrize(("line", "fault"), [
    ("Buy### now*** the$$$ best&&& deal%%% here.", "symbols"),
    ("BUY!! NOW!! ONLY!! TODAY!! or never.", "shouting"),
    ("News » Sport » Weather » Travel » Money.", "navigation"),
    ("News | Sport | Weather | Travel | Money.", "symbols"),
    ("Home About Contact Login.", "navigation"),
    ("This work is licensed under the MIT License.", "boilerplate"),
    ("a heading without an end", "punctuation"),
    ("A sentence ends here. The next one is cut off in the mid", None),
    (PROSE, None),
    ("He asked: “Is it so?”", None),
    ("これは文です。", None),
])
def test_line_rules(table, line, fault):
    df = table([(1, "\n".join([PROSE] * 9 + ["", line]))])
    found = L.clean_lines(df).first()
    assert found.n_failed_lines == (fault is not None)
    assert {k for k, n in found.faults.asDict().items() if n} == ({fault} if fault else set())
    assert found.clean_text.split("\n") == [PROSE] * 9 + [""] + ([line] if fault is None else [])


def test_a_long_line_may_quote_a_notice(table):
    assert L.clean_lines(table([(1, PROSE + " " + PROSE + " They read more.")])).first().n_failed_lines == 0


def test_documents_that_lose_too_much_go(table):
    sentences = [" ".join(f"word{k}x{i}" for i in range(12)) + "." for k in range(8)]
    menu = "News | Sport | Weather | Travel | Money | Home"
    menus = [menu.replace(" |", f"{k} |") for k in range(12)]
    rows = [(1, "\n".join(sentences)), (2, "\n".join(sentences + [menu])), (3, "\n".join(sentences + menus)), (4, None)]
    found = {r.doc_id: r for r in L.clean_lines(table(rows)).collect()}
    assert [found[k].kept for k in (1, 2, 3, 4)] == [True, True, False, False]
    assert not found[3].base_failed
    assert found[2].clean_text == "\n".join(sentences)
    assert found[2].lost_chars == len(menu.replace(" ", ""))


def test_no_python_on_the_main_path(table):
    plan = L.clean_lines(table([(1, PROSE)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_a_very_long_text_and_an_empty_table(table):
    text = "\n".join(f"Line {k}a says{k} {k * k} and{k} then {k * 31 % 1009}." for k in range(30000))
    found = L.clean_lines(table([(1, text)])).first()
    assert found.kept
    assert found.n_lines == 30000
    assert L.clean_lines(table([])).count() == 0

import html
import random
import re

import numpy as np
from barcodeforge.llm import block_labeller as B


def blocks(page):
    return [b.text for b in B._Parser().blocks(page)]


def test_blocks_of_broken_pages():
    assert blocks("<p>one<p>two <b>bold<i> and</b> more</p>three") == ["one", "two bold and more", "three"]
    assert blocks("a &lt;b&gt; &amp;amp; &copy x&nbsp;&nbsp; y\n\t z") == ["a <b> &amp; © x y z"]
    assert blocks("<script>var t='</p>';</script>x<style>p{}</style><!-- <p>no --><div>y") == ["x", "y"]
    assert blocks("<p>line<br>feed</p><ul><li>1<li>2</ul><td") == ["line feed", "1", "2", "<td"]
    assert blocks("<head><title>no</title></head><h1>Yes</h1><script>never closed <p>gone") == ["Yes"]
    assert blocks("<p title=\"a>b\" class='x'>t</p><p title=\"never closed>u</p>") == ["t", "<p title=\"never closed>u"]
    assert blocks("") == [] and blocks(" \n ") == [] and blocks("<<<>>> & <p") == ["<<<>>> & <p"]
    path = B._Parser().blocks('<div id="side-bar"><P CLASS=Ad>x')[0].path
    assert path == ("div side bar", "p ad")


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    features, parser = B._Features(), B._Parser()
    pages = [features.page(parser.blocks(p)) for p in ("<article><p>one two<p>three</article><nav>four</nav>", "<p>five</p>", "<div><h1>a</h1>b<p>c d e")]
    labels = [np.array([1.0, 1, 0]), np.array([0.0]), np.array([1.0, 0, 1])]
    model = B.Labeller.new(rng)

    def loss():
        total = 0.0
        for p, y in zip(pages, labels):
            prob = model.run(model.inputs(p)[:, None], np.array([len(y)]))[0][:, 0]
            total -= (y * np.log(prob) + (1 - y) * np.log(1 - prob)).sum()
        return total / 7

    grad = model.gradients(pages, labels)
    for name, g in grad.items():
        flat = np.argsort(-np.abs(g).ravel())[:3]
        for k in flat:
            at = np.unravel_index(k, g.shape)
            old = model.weights[name][at]
            model.weights[name][at] = old + 1e-5
            up = loss()
            model.weights[name][at] = old - 1e-5
            down = loss()
            model.weights[name][at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6, name


def test_pages(spark, table):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = B.train_labeller(pages)
    rows = {r.page_id: r for r in B.extract_main_text(pages, model).collect()}
    exact = 0
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(x for x in parts if x)
        exact += rows[p.page_id].text == text
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)
    assert exact >= 0.98 * len(rows)
    # pages made in ways that training has not seen
    words = sorted({w for r in rows.values() for w in r.text.split()})
    maker, parser, features = B._Maker(words, np.random.default_rng(321)), B._Parser(), B._Features()
    inputs, labels = [], []
    for _ in range(200):
        made = parser.blocks(maker.page())
        if made:
            labels.append(np.array([b.text.startswith(B.MARK) for b in made]))
            for b in made:
                b.text = b.text.replace(B.MARK, "").strip() or "."
            inputs.append(features.page(made))
    y, got = np.concatenate(labels), np.concatenate(model.label(inputs))
    assert (y == got).mean() > 0.98
    # odd rows
    random.seed(1)
    odd = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "no markup at all"), (3, "u", "no markup at all"),
           (4, "u", "<article>" + "<p>word word word.</p>" * 3000 + "</article>"), (5, "u", "<" * 2000), (6, "u", "<p title='" * 500)]
    out = B.extract_main_text(table(odd, "page_id bigint, url string, html string", ("text", "n_chars")), model)
    found = out.collect()
    assert len(found) == len(odd) and out.columns == ["page_id", "url", "text", "n_chars", "n_blocks"]
    by = {}
    for r in found:
        by.setdefault(r.page_id, []).append(r.text)
    assert by[1] == by[2] == [""] and by[3][0] == by[3][1] and by[4][0].count("\n") == 2999


def test_training_without_pages(table):
    empty = table([], "page_id bigint, url string, html string")
    model = B.train_labeller(empty, training_pages=20, epochs=1)
    assert B.extract_main_text(empty, model).count() == 0

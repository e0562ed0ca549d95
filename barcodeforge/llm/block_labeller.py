"""Main-text extraction: a bidirectional LSTM in numpy reads the leaf blocks of a page (tag path
and hashed words) and labels each in the context of the whole page."""

from __future__ import annotations

import html as html_lib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

#: hash buckets of path elements and of words, and the size of their vectors
BUCKETS = 4096
VECTOR = 16
HIDDEN = 24
NUMBERS = 8
#: pages whose words fill the training pages, and how many of those are made
SAMPLE_PAGES = 200
TRAINING_PAGES = 1000
EPOCHS = 14
BATCH_PAGES = 32
WORD_DECAY = 4.0
#: block rows (padding included) that one pass through the network holds
PASS_ROWS = 20_000

#: elements inside a line of text; every other element starts and ends a block
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: elements without content
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no text of the page: up to their end or that of the page; and up to
#: their end only, if they have one
RAW = re.compile(r"(?:script|style)\b", re.I)
HIDDEN_PARTS = re.compile(r"(?:noscript|template|svg|head|iframe|object|select|textarea)\b", re.I)
BODY = re.compile(r"<body\b", re.I)
START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)|[!?/])")
REST = re.compile(r"((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>")
QUOTES = re.compile(r"[\"'>]")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class _Scanner:
    """Text and tags of one page, in one pass forward. What is looked for in vain is not looked for
    again, so broken pages take no longer than others of their length."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()
        self.ends: tuple[list[int], list[int]] | None = None

    def _find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def _after(self, pattern: str, at: int) -> re.Match | None:
        """The next match; the pattern begins with a name that ends elements or begins the body."""
        if pattern in self.missing:
            return None
        found = re.compile(pattern, re.I).search(self.page, at)
        if found is None:
            self.missing.add(pattern)
        return found

    def _tag_end(self, at: int) -> int:
        """Where a tag whose attributes begin at ``at`` is closed, or -1. The first time that takes
        the pattern to the page's end, all quotes are paired from the back, once."""
        if self.ends is None:
            found = REST.match(self.page, at)
            if found:
                return found.end() - 1
            marks = [m.start() for m in QUOTES.finditer(self.page)]
            ends, following = [-1] * (len(marks) + 1), {}
            for k in range(len(marks) - 1, -1, -1):
                mark = self.page[marks[k]]
                if mark == ">":
                    ends[k] = marks[k]
                else:
                    ends[k] = ends[following[mark] + 1] if mark in following else -1
                    following[mark] = k
            self.ends = marks, ends
        marks, ends = self.ends
        return ends[bisect_left(marks, at)]

    def _hidden_end(self, name: str, at: int) -> int:
        """Where what an element hides ends, or -1 if it hides nothing."""
        if RAW.fullmatch(name):
            close = self._after(rf"</{name.lower()}\s*>", at)
            return close.end() if close else len(self.page)
        opened = self._find(">", at)
        close = self._after(rf"</{name.lower()}\s*>", opened) if opened >= 0 else None
        if close:
            return close.end()
        if name.lower() == "head":  # never closed: it ends where the body begins
            body = self._after(BODY.pattern, at)
            return body.start() if body else -1
        return -1

    def tokens(self) -> Iterator[tuple[str, str | None, str, str]]:
        """``(text, closing, name, attributes)``: the text before each tag; closing is None for what is
        no element, and for the last text."""
        page, at, begin, text = self.page, 0, 0, []
        while True:
            m = START.search(page, at)
            if m is None:
                break
            if m[1]:
                close = self._find("-->", m.end())
                end = close + 3 if close >= 0 else len(page)
                text += [page[begin:m.start()], " "]
                at = begin = end
                continue
            name, end = m[3], -1
            if name and not m[2]:
                part = RAW.match(name) or HIDDEN_PARTS.match(name)
                if part:
                    end = self._hidden_end(part[0], m.end())
                    if end >= 0:
                        text += [page[begin:m.start()], " "]
                        at = begin = end
                        continue
            if name:
                end = self._tag_end(m.end())
            if end >= 0:
                text.append(page[begin:m.start()])
                yield "".join(text), m[2], name.lower(), page[m.end():end]
            elif not name or m[2]:
                end = self._find(">", m.end())
                if end < 0:
                    at = m.end()
                    continue
                text.append(page[begin:m.start()])
                yield "".join(text), None, "", ""
            else:
                at = m.end()  # no tag after all
                continue
            text = []
            at = begin = end + 1
        text.append(page[begin:])
        yield "".join(text), None, "", ""


class Node:
    """An open element below others. Equal places of a task's pages share one."""

    __slots__ = ("name", "element", "parent", "below", "tokens")

    def __init__(self, name: str, element: str, parent: Node | None):
        self.name, self.element, self.parent = name, element, parent
        self.below: dict[str, Node] = {}
        self.tokens: frozenset[int] | None = None


@dataclass
class Block:
    text: str
    node: Node | None
    linked: float

    @property
    def leaf(self) -> str:
        return self.node.name if self.node else ""

    @property
    def path(self) -> tuple[str, ...]:
        out, node = [], self.node
        while node and node.parent is not None:
            out.append(node.element)
            node = node.parent
        return tuple(reversed(out))


#: shared places that a task remembers; then it starts again
REMEMBERED_NODES = 100_000


class _Parser:
    """Blocks of pages. Places and elements are shared between pages of a task."""

    def __init__(self):
        self.elements: dict[tuple[str, str], str] = {}
        self.root, self.known = Node("", "", None), 0

    def element(self, name: str, attributes: str) -> str:
        key = (name, attributes)
        known = self.elements.get(key)
        if known is None:
            words = [w for m in NAMES.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower())]
            known = " ".join([name, *dict.fromkeys(w for w in words if w)])
            if len(self.elements) < 100_000:  # a memo only
                self.elements[key] = known
        return known

    def blocks(self, page: str) -> list[Block]:
        """The page's blocks in order: text between block-level tags, character references
        decoded, white space turned into one space; blocks without text are left out. Elements
        may be nested to any depth; a closing tag without an open element closes nothing."""
        if self.known > REMEMBERED_NODES:
            self.root, self.known = Node("", "", None), 0
        out: list[Block] = []
        node, opened = self.root, Counter()
        buffer: list[str] = []
        in_link = linked = 0

        def flush() -> None:
            nonlocal linked
            if buffer:
                text = " ".join(html_lib.unescape("".join(buffer)).split())
                if text:
                    out.append(Block(text, node, min(1.0, linked / len(text))))
                buffer.clear()
            linked = 0

        for text, closing, name, attributes in _Scanner(page).tokens():
            if text and not text.isspace():
                buffer.append(text)
                if in_link:
                    linked += len(text)
            elif text and buffer:
                buffer.append(" ")
            if closing is None:
                continue
            if name in INLINE:
                if name == "a":
                    in_link = 0 if closing else 1
                elif name in ("br", "img") and buffer:
                    buffer.append(" ")
                continue
            flush()
            in_link = 0
            if name in VOID:
                continue
            if closing:
                if opened[name]:
                    while node.name != name:
                        opened[node.name] -= 1
                        node = node.parent
                    opened[name] -= 1
                    node = node.parent
                continue
            if node.name == "p" or (node.name == name and name in ("li", "dt", "dd", "td", "th", "tr", "option", "h1", "h2", "h3")):
                opened[node.name] -= 1
                node = node.parent
            element = self.element(name, attributes)
            child = node.below.get(element)
            if child is None:
                child = node.below[element] = Node(name, element, node)
                self.known += 1
            node = child
            opened[name] += 1
        flush()
        return out


def _bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


class _Features:
    """Network input of pages: bucket lists of paths and words, and a few numbers a block."""

    def path(self, node: Node) -> np.ndarray:
        """Buckets of the elements from the page down to a place, and of its own name. A place whose
        names are all known above it shares the set of its parent."""
        above = []
        while node.tokens is None:
            above.append(node)
            if node.parent is None:
                break
            node = node.parent
        for own in reversed(above):
            if own.parent is None:
                own.tokens = frozenset()
                continue
            name, *words = own.element.split(" ")
            tokens = {_bucket(f"tag {name}"), *(_bucket(f"name {w}") for w in words)}
            known = own.parent.tokens
            own.tokens = known if tokens <= known else known | tokens
        last = above[0] if above else node
        return np.array(sorted(last.tokens | {_bucket(f"leaf {last.name}")}), dtype=np.int64)

    def page(self, blocks: list[Block]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Path buckets of every block; word buckets of all blocks with their offsets; numbers."""
        n = len(blocks)
        found: dict[Node, np.ndarray] = {}
        for b in blocks:
            if b.node not in found:
                found[b.node] = self.path(b.node)
        paths = [found[b.node] for b in blocks]
        data, offsets = C.text_bytes(pa.array([b.text for b in blocks], pa.string()))
        data = C.folded(data)
        starts, ends, rows = C.spans(~C.IS_SPACE[data], offsets)
        words = (C.SpanHasher(data)(starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
        cuts = np.searchsorted(rows, np.arange(n + 1))
        count = np.diff(cuts)
        place = np.arange(n) / max(1, n - 1)
        numbers = np.zeros((n, NUMBERS))
        numbers[:, 0] = np.log1p(count) / 4
        numbers[:, 1] = [b.linked for b in blocks]
        numbers[:, 2] = [b.text[-1] in ".!?:;…\"'»”" for b in blocks]
        numbers[:, 3] = [b.leaf in ("h1", "h2", "h3", "h4", "h5", "h6") for b in blocks]
        numbers[:, 4] = [b.leaf in ("li", "td", "dt", "dd") for b in blocks]
        numbers[:, 5], numbers[:, 6] = place, 1 / (1 + n)
        numbers[:, 7] = 1
        return paths, words, cuts, numbers


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights: vectors of path and word buckets, one LSTM each way, and the output layer."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def new(rng: np.random.Generator) -> Labeller:
        width = 2 * VECTOR + NUMBERS
        w = {"path": rng.normal(0, 0.05, (BUCKETS, VECTOR)), "word": rng.normal(0, 0.02, (BUCKETS, VECTOR)),
             "out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
        for way in "fb":
            w[f"x{way}"] = rng.normal(0, 1 / np.sqrt(width), (width, 4 * HIDDEN))
            w[f"h{way}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"b{way}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return Labeller(w)

    def inputs(self, page) -> np.ndarray:
        paths, words, cuts, numbers = page
        n = len(paths)
        out = np.zeros((n, 2 * VECTOR + NUMBERS))
        for k, p in enumerate(paths):
            out[k, :VECTOR] = self.weights["path"][p].sum(axis=0)
        sums = np.concatenate([np.zeros((1, VECTOR)), np.cumsum(self.weights["word"][words], axis=0)])
        out[:, VECTOR:2 * VECTOR] = (sums[cuts[1:]] - sums[cuts[:-1]]) / np.maximum(1, np.diff(cuts))[:, None]
        out[:, 2 * VECTOR:] = numbers
        return out

    def run(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Probability of main text, ``(time, page)``, for padded inputs ``(time, page, width)``.
        The backward way starts at each page's own last block."""
        steps, pages, _ = x.shape
        live = np.arange(steps)[:, None] < lengths[None, :]
        states, trace = {}, {}
        for way in "fb":
            w_h, gates = self.weights[f"h{way}"], x @ self.weights[f"x{way}"] + self.weights[f"b{way}"]
            h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            all_h = np.zeros((steps, pages, HIDDEN))
            log = []
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                z = gates[t] + h @ w_h
                i, f, o = (_sigmoid(z[:, a * HIDDEN:(a + 1) * HIDDEN]) for a in range(3))
                g = np.tanh(z[:, 3 * HIDDEN:])
                on = live[t][:, None]
                new_c = f * c + i * g
                tanh_c = np.tanh(new_c)
                if keep:
                    log.append((t, h, c, i, f, o, g, tanh_c))
                c = np.where(on, new_c, c)
                h = np.where(on, o * tanh_c, h)
                all_h[t] = h
            states[way], trace[way] = all_h, log
        both = np.concatenate([states["f"], states["b"]], axis=2)
        return _sigmoid(both @ self.weights["out"] + self.weights["bias"][0]), live, both, trace

    def gradients(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradient of the mean cross-entropy of a batch, by backpropagation through time."""
        lengths = np.array([len(p[0]) for p in pages])
        x = np.zeros((lengths.max(), len(pages), 2 * VECTOR + NUMBERS))
        y = np.zeros((lengths.max(), len(pages)))
        for k, p in enumerate(pages):
            x[:lengths[k], k] = self.inputs(p)
            y[:lengths[k], k] = labels[k]
        prob, live, both, trace = self.run(x, lengths, keep=True)
        error = np.where(live, prob - y, 0) / lengths.sum()
        grad = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grad["out"] = np.einsum("tp,tph->h", error, both)
        grad["bias"] = np.array([error.sum()])
        d_both = error[:, :, None] * self.weights["out"]
        d_x = np.zeros_like(x)
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            d_h, d_c = np.zeros((len(pages), HIDDEN)), np.zeros((len(pages), HIDDEN))
            w_x, w_h = self.weights[f"x{way}"], self.weights[f"h{way}"]
            for t, h, c, i, f, o, g, tanh_c in reversed(trace[way]):
                on = live[t][:, None]
                d_h = d_h + d_both[t][:, part]
                own_h = np.where(on, d_h, 0)
                own_c = np.where(on, d_c, 0) + own_h * o * (1 - tanh_c ** 2)
                d_z = np.concatenate([own_c * g * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o),
                                      own_c * i * (1 - g ** 2)], axis=1)
                grad[f"x{way}"] += x[t].T @ d_z
                grad[f"h{way}"] += h.T @ d_z
                grad[f"b{way}"] += d_z.sum(axis=0)
                d_x[t] += d_z @ w_x.T
                d_h = np.where(on, 0, d_h) + d_z @ w_h.T
                d_c = np.where(on, own_c * f, d_c)
        for k, (paths, words, cuts, _) in enumerate(pages):
            d = d_x[:lengths[k], k]
            for row, p in enumerate(paths):
                grad["path"][p] += d[row, :VECTOR]
            count = np.diff(cuts)
            np.add.at(grad["word"], words, np.repeat(d[:, VECTOR:2 * VECTOR] / np.maximum(1, count)[:, None], count, axis=0))
        return grad

    def fit(self, pages: list, labels: list[np.ndarray], rng: np.random.Generator, epochs: int = EPOCHS) -> None:
        """Adam over shuffled batches of pages of about the same length."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = sorted(range(len(pages)), key=lambda k: (len(pages[k][0]) // 8, rng.random()))
            batches = [order[a:a + BATCH_PAGES] for a in range(0, len(order), BATCH_PAGES)]
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for b in rng.permutation(len(batches)):
                step += 1
                grad = self.gradients([pages[k] for k in batches[b]], [labels[k] for k in batches[b]])
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                # a word alone must not decide what its few training blocks happened to be
                self.weights["word"] *= 1 - WORD_DECAY * rate

    def label(self, pages: list) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length run together."""
        out: list = [np.zeros(0, dtype=bool)] * len(pages)
        order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k][0])) if pages[k][0]]
        at = len(order)
        while at:
            longest = len(pages[order[at - 1]][0])
            take = order[max(0, at - max(1, PASS_ROWS // longest)):at]
            at -= len(take)
            lengths = np.array([len(pages[k][0]) for k in take])
            x = np.zeros((longest, len(take), 2 * VECTOR + NUMBERS))
            for k, page in enumerate(take):
                x[:lengths[k], k] = self.inputs(pages[page])
            prob = self.run(x, lengths)[0]
            for k, page in enumerate(take):
                out[page] = prob[:lengths[k], k] >= 0.5
        return out


#: Training pages are made from parts under many names, so that the network learns what parts
#: are called, how they look and where they stand. Class and id words in use.
MAIN_NAMES = ("content", "post", "article-body", "entry-content", "story", "main-content", "post-body", "text", "body-copy",
              "page-content", "article", "entry")
PARTS = {
    "menu": (("nav", "ul", "div"), ("nav", "menu", "navbar", "topnav", "main-menu", "navigation", "breadcrumb", "tabs")),
    "header": (("header", "div"), ("header", "masthead", "site-header", "banner", "topbar", "branding", "logo")),
    "footer": (("footer", "div"), ("footer", "site-footer", "colophon", "bottom", "copyright", "legal")),
    "sidebar": (("aside", "div"), ("sidebar", "aside", "widget", "related", "rail", "recommended", "popular", "tags")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "teaser")),
    "notice": (("div", "section"), ("cookie-notice", "cookie", "consent", "gdpr", "alert", "notice", "newsletter", "popup", "modal",
                                    "subscribe", "disclaimer")),
    "form": (("form",), ("search", "login", "contact-form", "signup", "form")),
    "comments": (("section", "div", "ol"), ("comments", "comment-list", "discussion", "replies", "responses", "disqus", "comment")),
    "share": (("div", "ul"), ("share", "social", "byline-share", "toolbar")),
}
MARK = "\ue000"


class _Maker:
    """Training pages: random layouts of named parts filled with words of real pages. Main
    blocks carry a mark, which is taken off after parsing."""

    def __init__(self, words: list[str], rng: np.random.Generator):
        self.words, self.rng = words or ["text"], rng

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def sentence(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high))
        words = [self.words[int(k)] for k in self.rng.integers(len(self.words), size=n)]
        return html_lib.escape(" ".join(words)) + self.pick((".", ".", "", "!", "?"))

    def paragraph(self) -> str:
        return " ".join(self.sentence(4, 16) for _ in range(int(self.rng.integers(1, 7))))

    def opened(self, tag: str, names, always: bool = False) -> str:
        if always or self.chance(0.75) or tag in ("div", "section", "ul", "ol"):
            return f'<{tag} {self.pick(("class", "class", "id"))}="{self.pick(names)}">'
        return f"<{tag}>"

    def main(self) -> str:
        tag = self.pick(("article", "article", "main", "div", "div", "section"))
        out = [self.opened(tag, MAIN_NAMES) if tag in ("div", "section") or self.chance(0.3) else f"<{tag}>"]
        if self.chance(0.75):
            out.append(f"<h1>{MARK}{self.sentence(2, 9)}</h1>")
        broken = self.chance(0.4)
        for _ in range(int(self.rng.integers(1, 14))):
            kind = self.rng.random()
            if kind < 0.72:
                inner = self.paragraph() if self.chance(0.7) else self.sentence(1, 4)
                if self.chance(0.15):
                    inner = f"<b>{inner}" + ("" if broken else "</b>")
                if self.chance(0.15):
                    inner += f' <a href="/x">{self.sentence(1, 4)}</a>'
                out.append(f"<p>{MARK}{inner}" + ("<br>" if broken and self.chance(0.3) else "" if broken and self.chance(0.3) else "</p>"))
            elif kind < 0.8:
                out.append(f"<{(h := self.pick(('h2', 'h3')))}>{MARK}{self.sentence(1, 7)}</{h}>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.sentence(2, 14)}</li>" for _ in range(int(self.rng.integers(2, 6)))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{MARK}{self.paragraph()}</blockquote>")
            elif kind < 0.93:
                out.append(f"<pre>{MARK}{self.sentence(3, 20)}</pre>")
            elif kind < 0.96:
                out.append("<table><tr>" + "".join(f"<td>{MARK}{self.sentence(1, 4)}</td>" for _ in range(4)) + "</tr></table>")
            else:
                out.append(self.part(self.pick(("advert", "notice", "share", "sidebar", "form"))))
        if self.chance(0.1):
            out.append(self.part("comments"))
        return "".join(out) + f"</{tag}>"

    def part(self, kind: str) -> str:
        tags, names = PARTS[kind]
        tag = self.pick(tags)
        body: list[str] = []
        link = lambda: f'<a href="/y">{self.sentence(1, 3)}</a>'
        if kind in ("menu", "share") or kind in ("sidebar", "footer", "header") and self.chance(0.5):
            items = "".join(f"<li>{link()}</li>" for _ in range(int(self.rng.integers(2, 9))))
            body.append(items if tag in ("ul", "ol") else f"<ul>{items}</ul>")
        if kind == "header":
            body.append(self.pick((f"<h1>{self.sentence(1, 4)}</h1>", f"<div>{self.sentence(1, 6)}</div>", f"<p>{self.sentence(2, 8)}</p>")))
        if kind in ("footer", "advert", "notice"):
            text = self.sentence(3, 14) if self.chance(0.7) else self.paragraph()
            text = ("&copy; " if kind == "footer" and self.chance(0.6) else "") + text
            body.append(text if self.chance(0.6) else f"<p>{text}</p>")
            if kind == "notice" and self.chance(0.6):
                body.append(f"<button>{self.sentence(1, 3)}</button>")
        if kind == "sidebar":
            body.append(f"<h3>{self.sentence(1, 4)}</h3>" + "".join(f"<p>{self.sentence(3, 20)}</p>" for _ in range(int(self.rng.integers(0, 4)))))
        if kind == "form":
            body += [f"<label>{self.sentence(1, 3)}</label><input name=q>" for _ in range(int(self.rng.integers(1, 4)))]
            body += [f"<p>{self.sentence(3, 12)}</p>"] * self.chance(0.3) + [f"<button>{self.sentence(1, 2)}</button>"]
        if kind == "comments":
            for _ in range(int(self.rng.integers(1, 6))):
                body.append(f'<div class="{self.pick(("comment", "reply", "comment-body", "response"))}"><b>{self.sentence(1, 3)}</b>'
                            f"<p>{self.paragraph()}</p></div>" if tag != "ol" else f"<li><p>{self.paragraph()}</p></li>")
            if self.chance(0.4):
                body.insert(0, f"<h2>{self.sentence(1, 3)}</h2>")
        return self.opened(tag, names, always=tag not in ("nav", "header", "footer", "aside", "form")) + "".join(body) + f"</{tag}>"

    def page(self) -> str:
        before = [k for k in ("header", "menu", "notice", "advert", "form") if self.chance(0.45)]
        after = [k for k in ("share", "comments", "sidebar", "advert", "notice", "form") if self.chance(0.35)]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        if self.chance(0.3):
            before.append("sidebar")
        out = [self.part(k) for k in before]
        if self.chance(0.97):
            out.append(self.main())
        out += [self.part(k) for k in after]
        if self.chance(0.85):
            out.append(self.part("footer"))
        inner = "".join(out)
        if self.chance(0.3):
            inner = f'<div class="{self.pick(("wrapper", "container", "page", "layout", "grid", "site"))}">{inner}</div>'
        return f"<html><body>{inner}" + ("</body></html>" if self.chance(0.8) else "")


def _own_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks up its parts: main text stands in article or main, and in no
    element that is or is named like another part. None if the page has neither element."""
    other = {n for _, names in PARTS.values() for n in names} | {"nav", "aside", "footer", "header", "form"}
    out = []
    for b in blocks:
        inside = False
        for element in b.path:
            tag, *words = element.split(" ")
            if tag in ("article", "main"):
                inside = True
            elif inside and ({tag, *words} & other):
                inside = False
                break
        out.append(inside)
    return np.array(out, dtype=float) if any(out) else None


def train_labeller(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", seed: int = 5,
                   sample_pages: int = SAMPLE_PAGES, training_pages: int = TRAINING_PAGES, epochs: int = EPOCHS) -> Labeller:
    """Train on at most ``sample_pages`` real pages (in hash order of the id; none above 50,000
    code points), as far as they mark up their parts, and on pages made of their words."""
    rows = (pages.select(F.col(id_col).alias("i"), F.col(html_col).cast("string").alias("h"))
            .where(C.sampled(F.xxhash64("i"), sample_pages, pages.count()))
            .where(F.col("h").isNotNull() & (F.length("h") <= 50_000))
            .orderBy(F.pmod(F.xxhash64("i"), F.lit(1 << 30)), "i", "h").limit(sample_pages).collect())
    parser, features, rng = _Parser(), _Features(), np.random.default_rng(seed)
    real = [parser.blocks(r["h"]) for r in rows]
    maker = _Maker(sorted({w for blocks in real for b in blocks for w in b.text.split()}), rng)
    known = [(features.page(b), own) for b in real if (own := _own_labels(b)) is not None]
    inputs, labels = [x for x, _ in known], [y for _, y in known]
    while len(inputs) < len(known) + training_pages:
        blocks = parser.blocks(maker.page())
        if not blocks:
            continue
        labels.append(np.array([b.text.startswith(MARK) for b in blocks], dtype=float))
        for b in blocks:
            b.text = b.text.replace(MARK, "").strip() or "."
        inputs.append(features.page(blocks))
    model = Labeller.new(rng)
    model.fit(inputs, labels, rng, epochs)
    return model


def extract_main_text(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of every page: its main blocks in page order,
    joined by one line feed. Null or empty html and pages without main text give an empty
    text; null ids and urls and repeated rows stay; other columns are ignored."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in model.weights.items()})
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        labeller, parser, features = Labeller(shared.value), _Parser(), _Features()
        for part in C.passes(batches, "html"):
            blocks = [parser.blocks(h) if h else [] for h in part.column("html").to_pylist()]
            keep = labeller.label([features.page(b) if b else ([], None, None, None) for b in blocks])
            texts = ["\n".join(x.text for x, k in zip(b, own, strict=True) if k) for b, own in zip(blocks, keep, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in blocks], pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint, n_blocks bigint")


def op5(spark, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages")
    return extract_main_text(pages, train_labeller(pages))

"""Token ids of whole texts for slow tokenizers: texts are cut where no token can cross, and every
distinct chunk is encoded once as long as a worker remembers it."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barcodeforge.llm import common as C

#: chunks a worker remembers; when there are more, it forgets those that it met only once (some 50
#: bytes a chunk)
REMEMBERED = 400_000
#: bytes beyond which a chunk is not remembered
LONG_CHUNK = 256
#: bytes of chunks handed to a tokenizer at once
CALL_BYTES = 1 << 16

#: bytes that surely are not white space next to a cut: printable ASCII; the lead bytes of
#: U+00C0..U+07FF, none of which is white space
_INK = np.zeros(256, dtype=bool)
_INK[0x21:0x7F] = True
_TWO = np.zeros(256, dtype=bool)
_TWO[0xC3:0xE0] = True
#: ASCII letters; the lead bytes of U+00C0..U+027F, all letters but two signs
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LETTER_LEAD = np.zeros(256, dtype=bool)
_LETTER_LEAD[0xC3:0xCA] = True
#: marks that end a word; none may stand inside an added token
MARKS = ".,;:!?)\"#*$%&"
_MARK = np.zeros(256, dtype=bool)
_MARK[list(MARKS.encode())] = True


def per_worker(key: str, make: Callable[[], object]):
    """What ``make`` returns, made once a Python worker process: tasks that follow one another in a
    worker share loaded tokenizers and learnt chunks. It is kept by a module of its own, since
    this one reaches the workers by value, anew with every task."""
    kept = sys.modules.setdefault("_barcodeforge_worker", types.ModuleType("_barcodeforge_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def chunk_starts(data: np.ndarray, offsets: np.ndarray, fine: bool = False) -> np.ndarray:
    """Starts of the chunks of all rows: the row starts, and every single space that stands between
    two characters that surely are no white space.

    A byte-level pattern that takes a space only before a word, or as part of a run of white
    space, always starts a new pre-token at such a space, and its choice there depends on
    nothing before it. A piece vocabulary without a piece that holds a space after another
    character never merges across it.

    ``fine``, for byte-level patterns alone: chunks also start at a line feed that stands like
    such a space, and at a mark behind a letter, which the pattern never takes together.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    before = np.zeros(len(data), dtype=bool)
    before[1:] = _INK[data[:-1]]
    before[2:] |= (data[1:-1] >= 0x80) & _TWO[data[:-2]]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = _INK[data[1:]] | _TWO[data[1:]]
    gap = data == 0x20
    cut = (gap | (data == 0x0A) if fine else gap) & before & after
    if fine:
        mark = _MARK[data]
        cut[1:] |= mark[1:] & _LETTER[data[:-1]]
        sign = (data[:-2] == 0xC3) & ((data[1:-1] == 0x97) | (data[1:-1] == 0xB7))
        cut[2:] |= mark[2:] & (data[1:-1] >= 0x80) & _LETTER_LEAD[data[:-2]] & ~sign
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True  # a row never starts inside another one's chunk
    return np.flatnonzero(cut)


class Vocabulary:
    """The bytes of every id, as one array."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.data[C.ranges(self.start[ids], self.size[ids])]


def _parts(chunks: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The n + 1 offsets of chunks and the bytes they point into."""
    cuts = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
    return cuts, np.frombuffer(chunks.buffers()[2], np.uint8)


class _Side:
    """What one tokenizer made of the chunks learnt so far: their ids, one after another."""

    def __init__(self, encode: Callable[[str], list[int]], vocabulary: Vocabulary):
        self.encode, self.vocabulary = encode, vocabulary
        self.ids = np.zeros(0, np.int32)
        self.first, self.count, self.sound = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, dtype=bool)

    def keep(self, wanted: np.ndarray) -> None:
        """Forget the chunks that are not ``wanted``."""
        self.ids = self.ids[C.ranges(self.first[wanted], self.count[wanted])]
        self.count, self.sound = self.count[wanted], self.sound[wanted]
        self.first = np.cumsum(self.count, dtype=np.int64) - self.count

    def shorten(self, chunks: int) -> None:
        """Forget all but the first ``chunks``."""
        if len(self.first) > chunks:
            self.ids = self.ids[:self.first[chunks]].copy()
            self.first, self.count, self.sound = self.first[:chunks], self.count[:chunks], self.sound[:chunks]

    def _apart(self, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks, their number and soundness for each, from one call a chunk."""
        found, sound = [], np.zeros(len(cuts) - 1, dtype=bool)
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            chunk = raw[a:b].tobytes()
            found.append(np.array(self.encode(chunk.decode("utf-8", "replace")), dtype=np.int32))
            sound[k] = self.vocabulary.spell(found[-1]).tobytes() == chunk
        return np.concatenate(found), np.array([len(x) for x in found], dtype=np.int32), sound

    def _together(self, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The same for chunks that may follow one another, from one call."""
        raw = raw[cuts[0]:cuts[-1]].tobytes()
        try:
            ids = np.array(self.encode(raw.decode()), dtype=np.int32)
        except UnicodeDecodeError:
            return None
        if self.vocabulary.spell(ids).tobytes() != raw:
            return None
        ends = np.cumsum(self.vocabulary.size[ids])
        wanted = cuts[1:] - cuts[0]
        at = np.searchsorted(ends, wanted)
        if (ends[at] != wanted).any():
            return None
        return ids, np.diff(at, prepend=-1).astype(np.int32), np.ones(len(at), dtype=bool)

    def learn(self, chunks: pa.LargeBinaryArray, calm: int) -> None:
        """Take in new chunks; the first ``calm`` of them may follow one another."""
        cuts, raw = _parts(chunks)
        call = (cuts[1:calm + 1] - cuts[0]) // CALL_BYTES
        edges = [0, *(np.flatnonzero(np.diff(call)) + 1).tolist(), calm]
        found = [(self.ids, self.count, self.sound)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                found.append(self._together(raw, cuts[a:b + 1]) or self._apart(raw, cuts[a:b + 1]))
        if calm < len(chunks):
            found.append(self._apart(raw, cuts[calm:]))
        self.ids, self.count, self.sound = (np.concatenate(x) for x in zip(*found, strict=True))
        self.first = np.cumsum(self.count, dtype=np.int64) - self.count


def _calm(chunks: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of chunks, and which may be encoded right before and after others: those that begin and end
    like a cut at a space or line feed."""
    cuts, data = _parts(chunks)
    sizes = np.diff(cuts)
    first, last = cuts[:-1], cuts[1:] - 1
    long = sizes >= 3
    second = data[np.where(long, first + 1, 0)]
    ends = _INK[data[np.maximum(last, 0)]] | ((data[np.maximum(last, 0)] >= 0x80) & _TWO[data[np.where(long, last - 1, 0)]])
    gap = (data[first] == 0x20) | (data[first] == 0x0A)
    return sizes, long & gap & (_INK[second] | _TWO[second]) & ends


class ChunkEncoder:
    """Ids of whole rows by one or more tokenizers, each ``(encode(text) -> ids, vocabulary)``.

    Chunks are compared as bytes. New ones are encoded many at a time, as one text whose ids
    are parted again by the bytes that they spell; where that does not work out, and for
    chunks at the ends of rows, one by one. A row is sound if the ids of every tokenizer spell it.
    ``fine``: see :func:`chunk_starts`.
    """

    def __init__(self, *sides: tuple[Callable[[str], list[int]], Vocabulary], remembered: int = REMEMBERED, fine: bool = False):
        self.sides = [_Side(*side) for side in sides]
        self.remembered, self.fine = remembered, fine
        self.known = pa.array([], pa.large_binary())
        self.again = np.zeros(0, dtype=bool)  # whether a chunk was met after it was learnt

    def _forget(self) -> None:
        wanted = self.again if 2 * self.again.sum() <= self.remembered else np.zeros(len(self.again), dtype=bool)
        self.known = self.known.filter(pa.array(wanted))
        for side in self.sides:
            side.keep(wanted)
        self.again = np.zeros(len(self.known), dtype=bool)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For each tokenizer all ids and the n + 1 offsets of the rows' ids; whether each row is sound."""
        rows = len(offsets) - 1
        starts = chunk_starts(data, offsets, self.fine)
        if not len(starts):
            return [(np.zeros(0, np.int32), np.zeros(rows + 1, np.int64))] * len(self.sides), np.ones(rows, dtype=bool)
        cuts = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        chunks = coded.dictionary
        if len(self.known) > self.remembered:
            self._forget()
        place = pc.index_in(chunks, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        self.again[place[place >= 0]] = True
        missing = np.flatnonzero(place < 0)
        if len(missing):
            sizes, calm = (x[missing] for x in _calm(chunks))
            # calm chunks first, long ones last: these are forgotten at the end of this call
            kind = np.where(sizes > LONG_CHUNK, 2, np.where(calm, 0, 1))
            missing = missing[np.argsort(kind, kind="stable")]
            new = chunks.take(pa.array(missing))
            place[missing] = len(self.known) + np.arange(len(new))
            for side in self.sides:
                side.learn(new, int((kind == 0).sum()))
            short = new.slice(0, int((kind < 2).sum()))
            self.known = pa.concat_arrays([self.known, short])
            self.again = np.concatenate([self.again, np.zeros(len(short), dtype=bool)])
        place = place[coded.indices.to_numpy()]
        at = np.searchsorted(starts, offsets)  # the first chunk of every row
        sound, out = np.ones(len(place), dtype=bool), []
        for side in self.sides:
            count = side.count[place]
            sound &= side.sound[place]
            out.append((side.ids[C.ranges(side.first[place], count)], np.concatenate([[0], np.cumsum(count, dtype=np.int64)])[at]))
            side.shorten(len(self.known))
        bad = np.concatenate([[0], np.cumsum(~sound)])
        return out, bad[at[1:]] == bad[at[:-1]]


#: characters that byte-level vocabularies write bytes as: printable Latin-1 stands for itself,
#: every other byte for the next character from U+0100 on
def byte_level_alphabet() -> dict[str, int]:
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


def byte_bpe(path: str, plain: bool = False) -> tuple[Callable[[str], list[int]], Vocabulary]:
    """The byte-level tokenizer file at ``path``; ``plain``: strings of special tokens are ordinary text."""
    import os

    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    if not plain and any(set(t.content[1:]) & {*MARKS, " ", "\n"} for t in tokenizer.get_added_tokens_decoder().values()):
        raise ValueError("an added token holds a space or a mark: its texts cannot be cut there")
    alphabet = byte_level_alphabet()
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, k in tokenizer.get_vocab(with_added_tokens=True).items():
        tokens[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    return lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, Vocabulary(tokens)

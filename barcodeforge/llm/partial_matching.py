"""Language-model scoring by prediction by partial matching: a byte-context trie learnt from the
corpus, escape estimation, symbol exclusion, and the code length of every whole document."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C
from barcodeforge.session import ensure_checkpoint_dir

#: bytes of context; a context with its symbol must fit into 63 bits
ORDER = 5
#: trie entries that a scoring task holds at a time (12 bytes each, and less for the contexts)
SHARD_ENTRIES = 4_000_000
#: coded positions that wait in a scoring task (8 bytes each) while it reads the parts one by one
WAITING = 1 << 24
#: tokens whose counts every task holds; all others are counted through a join
FREQUENT = 1 << 20
#: text bytes of one numpy pass
PASS = 1 << 17
#: distinct keys that a counting task gathers before it hands them on
GATHER = 700_000
END = 0x0A  # ends a document, and stands for what was before it; no word holds it
END_TOKEN = 0x5EED0FE17D
_U = np.uint64


def _stream(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The token sequences of a column as bytes: A-Z lower-cased, words joined by one space, one
    END behind each text and ``order`` of them before it. Returns the bytes, the first position
    and the number of coded positions of each row, the word hashes and the words of each row."""
    data, offsets = C.text_bytes(column)
    n = len(offsets) - 1
    data = C.LOWER[data]
    word = ~C.IS_SPACE[data]
    starts, ends, rows = C.spans(word, offsets)
    hashes = C.SpanHasher(data)(starts, ends)
    n_words = np.bincount(rows, minlength=n)
    inner = starts[1:][rows[1:] == rows[:-1]] - 1  # the last blank before a word that is not the first
    data[inner] = 0x20
    word[inner] = True
    size = np.diff(np.concatenate([[0], np.cumsum(word)])[offsets])
    first = np.cumsum(size) - size + np.arange(n) + order * np.arange(1, n + 1)
    out = np.full(int(size.sum()) + n * (order + 1), END, dtype=np.uint8)
    out[C.ranges(first, size)] = data[word]
    return out, first, size + 1, hashes, n_words


def _grams(stream: np.ndarray, first: np.ndarray, coded: np.ndarray, order: int) -> np.ndarray:
    """Context and symbol of every coded position as one number, the symbol lowest."""
    keys = np.zeros(len(stream) - order, dtype=_U)
    for j in range(order + 1):
        keys <<= _U(8)
        keys |= stream[j:len(stream) - order + j]
    return keys[C.ranges(first - order, coded)]


class _Tally:
    """Counts of keys, gathered over passes and merged by sorting."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        part = np.unique(keys, return_counts=True)
        self.parts.append(part)
        self.size += len(part[0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[cut], np.add.reduceat(counts, cut)

    def full(self) -> bool:
        """Whether to hand on: merges first, and is full if that left too many keys."""
        if self.size > 2 * GATHER:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            return self.size > GATHER
        return False


def corpus_counts(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``kind, key, n`` over all documents: kind 0 counts contexts of ``order`` bytes with their
    symbol, kind 1 counts tokens (by hash; END_TOKEN is the end of a document)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches):
        tallies = (_Tally(), _Tally())

        def drain(kind: int):
            keys, counts = tallies[kind].merged()
            tallies[kind].parts, tallies[kind].size = [], 0
            for a in range(0, len(keys), 100_000):
                k = keys[a:a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)),
                     pa.array(counts[a:a + 100_000].astype(np.int64))], ["kind", "key", "n"])

        for part in C.passes(batches, "text", PASS):
            stream, first, coded, words, _ = _stream(part.column("text"), order)
            tallies[0].add(_grams(stream, first, coded, order))
            tallies[1].add(np.concatenate([words, np.full(len(first), END_TOKEN, _U)]))
            for kind in (0, 1):
                if tallies[kind].full():
                    yield from drain(kind)
        yield from drain(0)
        yield from drain(1)

    return rows.mapInArrow(run, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def context_trie(grams: DataFrame, order: int = ORDER) -> tuple[list[DataFrame], list[DataFrame]]:
    """The trie from counts ``key, n`` of its highest order, one table for each context length.

    entries ``key, count``: a context with a symbol seen behind it. Below the highest order a
    symbol counts once for each longer context it was new in (update exclusion). contexts
    ``key, total, kinds, low_total, low_kinds``: what a context has seen, and what its suffix
    has seen besides (symbol exclusion), which is what an escape from it chooses from.
    """
    entries = [grams.select("key", F.col("n").cast("double").alias("count"))]
    for depth in range(order - 1, -1, -1):
        short = entries[0].select(F.col("key").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1)).alias("key"))
        entries.insert(0, C.stage_table(short.groupBy("key").agg(F.count("*").cast("double").alias("count"))))
    contexts: list[DataFrame] = []
    for depth, level in enumerate(entries):
        own = level.groupBy(F.shiftright("key", 8).alias("key")).agg(F.sum("count").alias("total"), F.count("*").alias("kinds"))
        if depth:
            mask = F.lit((1 << 8 * depth) - 1)
            lower = entries[depth - 1].select(F.col("key").alias("low"), F.col("count").alias("low_count"))
            taken = (level.select(F.shiftright("key", 8).alias("key"), F.col("key").bitwiseAND(mask).alias("low"))
                     .join(lower, "low").groupBy("key").agg(F.sum("low_count").alias("taken")))
            suffix = contexts[-1].select(F.col("key").alias("low"), F.col("total").alias("st"), F.col("kinds").alias("sk"))
            own = (own.join(taken, "key")
                   .withColumn("low", F.col("key").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))).join(suffix, "low")
                   .select("key", "total", "kinds", (F.col("st") - F.col("taken")).alias("low_total"),
                           (F.col("sk") - F.col("kinds")).alias("low_kinds")))
        else:
            own = own.select("*", F.lit(0.0).alias("low_total"), F.lit(0).cast("bigint").alias("low_kinds"))
        contexts.append(C.stage_table(own))
    return entries, contexts


class Trie:
    """Sorted arrays of the part of a trie whose contexts end in a range of two bytes (contexts
    shorter than that are in every part). A position's contexts all end alike, so exactly one
    part codes it."""

    def __init__(self, order: int, low: int, high: int):
        self.order, self.low, self.high = order, low, high
        self.entries, self.contexts = [], []
        self.unseen = 256.0

    def add(self, entry: list[np.ndarray], context: list[np.ndarray]) -> None:
        """The next longer contexts: columns of ``_entry_values`` and ``_context_values``."""
        self.entries.append(tuple(entry))
        *kept, kinds = context
        self.contexts.append(tuple(kept))
        if len(self.contexts) == 1 and len(kinds):
            self.unseen = max(1.0, 256.0 - float(kinds[0]))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each gram, 0 for those of other parts.

        The longest known context codes a symbol it has seen with (count - 1/2) / total, and
        escapes with (kinds / 2) / total. After an escape the shorter context leaves out all
        symbols that the longer one has seen. Behind the empty context, the symbols never seen
        share the rest evenly."""
        tail = (grams >> _U(8)) & _U(0xFFFF)
        mine = np.flatnonzero((tail >= _U(self.low)) & (tail < _U(self.high)))
        out = np.zeros(len(grams))
        if not len(mine):
            return out
        keys, inverse = np.unique(grams[mine], return_inverse=True)
        value = np.zeros(len(keys))
        escaped = np.zeros(len(keys), dtype=bool)
        norm, below = np.zeros(len(keys)), np.zeros(len(keys))
        open_ = np.arange(len(keys))
        for d in range(self.order, -1, -1):
            key = keys[open_] & _U((1 << 8 * (d + 1)) - 1)
            at, seen = _find(self.entries[d][0], key)
            ctx, known = _find(self.contexts[d][0], key >> _U(8))
            top = ~escaped[open_]
            log_total, log_escape, low_norm, low_escape = self.contexts[d][1:]
            hit = np.flatnonzero(seen)
            row = open_[hit]
            value[row] += self.entries[d][1][at[hit]] - np.where(top[hit], log_total[ctx[hit]], norm[row])
            miss = np.flatnonzero(~seen)
            row = open_[miss]
            step = np.where(known[miss], log_escape[ctx[miss]], 0.0) if len(log_escape) else np.zeros(len(miss))
            value[row] += np.where(top[miss], step, below[row])
            down = miss[known[miss]]
            row = open_[down]
            escaped[row] = True
            norm[row], below[row] = low_norm[ctx[down]], low_escape[ctx[down]]
            open_ = open_[miss]
        value[open_] -= math.log10(self.unseen)
        out[mine] = value[inverse]
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    # the queries come sorted but for a mask; sorted queries are found in order, in cache
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys


def _columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of a table in order of its first one, a key."""
    found = df.toArrow()
    key = found.column(0).to_numpy().view(_U)
    order = np.argsort(key, kind="stable")
    return [key[order], *(found.column(k).to_numpy()[order] for k in range(1, found.num_columns))]


def _entry_values(entries: DataFrame) -> DataFrame:
    return entries.select("key", F.log10(F.col("count") - 0.5).cast("float").alias("v0"))


def _context_values(contexts: DataFrame) -> DataFrame:
    norm = F.log10(F.greatest(F.col("low_total"), F.lit(0.5)))
    # a suffix that has nothing besides is passed with certainty
    below = F.when(F.col("low_kinds") > 0, F.log10(F.col("low_kinds") / 2) - norm).otherwise(0.0)
    values = [F.log10("total"), F.log10(F.col("kinds") / 2 / F.col("total")), norm, below, F.col("kinds")]
    return contexts.select("key", *(v.cast("float").alias(f"v{k}") for k, v in enumerate(values)))


class StoredTries:
    """The parts of a trie in the shared folder, read one at a time where they are used. Contexts
    shorter than two bytes (65,792 entries at most) are held here."""

    def __init__(self, path: str, order: int, bounds: list[int], short: list[tuple]):
        self.path, self.order, self.bounds, self.short = path, order, bounds, short

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def __iter__(self):
        return (self.load(k) for k in range(len(self)))

    def load(self, k: int) -> Trie:
        trie = Trie(self.order, self.bounds[k], self.bounds[k + 1])
        for entry, context in self.short:
            trie.add(entry, context)
        for depth in range(2, self.order + 1):
            trie.add(self._read("entries", k, depth, 1), self._read("contexts", k, depth, 5))
        return trie

    def _read(self, kind: str, k: int, depth: int, n_values: int) -> list[np.ndarray]:
        store, root = pa.fs.FileSystem.from_uri(self.path)
        folder = pa.fs.FileSelector(f"{root}/{kind}/part={k}/depth={depth}", allow_not_found=True)
        files = sorted(f.path for f in store.get_file_info(folder) if f.path.endswith(".parquet"))
        names = ["key", *(f"v{j}" for j in range(n_values))]
        tables = [pa.parquet.ParquetFile(store.open_input_file(f)).read(names, use_threads=False) for f in files]
        if not tables:
            return [np.zeros(0, _U), *[np.zeros(0, np.float32)] * n_values]
        found = pa.concat_tables(tables)
        key, *values = (found.column(name).to_numpy() for name in names)
        key = key.view(_U)
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, values = key[order], [v[order] for v in values]
        return [key, *values]


def load_tries(entries: list[DataFrame], contexts: list[DataFrame], order: int = ORDER,
               limit: int = SHARD_ENTRIES) -> StoredTries:
    """The trie as parts of at most ``limit`` entries (one two-byte ending at least), which Spark
    writes to the shared folder. Only the sizes of the endings and the contexts shorter than
    two bytes pass the driver."""
    spark = entries[0].sparkSession
    tail = lambda shift: F.shiftright("key", shift).bitwiseAND(F.lit(0xFFFF))
    sizes: dict[int, int] = {}
    for level in entries[2:]:
        for t, n in level.groupBy(tail(8)).count().collect():
            sizes[t] = sizes.get(t, 0) + n
    bounds, held = [0], 0
    for t in sorted(sizes):
        if held and held + sizes[t] > limit:
            bounds.append(t)
            held = 0
        held += sizes[t]
    bounds.append(1 << 16)
    short = [(_columns(_entry_values(e)), _columns(_context_values(c))) for e, c in zip(entries[:2], contexts[:2], strict=True)]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trie-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.deleteOnExit(target)
    if sizes:
        ends = np.array(sorted(sizes), dtype=np.int64)
        part_of = F.broadcast(spark.createDataFrame(pa.table(
            {"tail": ends, "part": (np.searchsorted(bounds, ends, side="right") - 1).astype(np.int32)})))
        for kind, levels, values, shift in (("entries", entries, _entry_values, 8), ("contexts", contexts, _context_values, 0)):
            rows = None
            for depth in range(2, order + 1):
                level = values(levels[depth]).withColumns({"depth": F.lit(depth), "tail": tail(shift)})
                rows = level if rows is None else rows.unionByName(level)
            by = ["part", "depth", "key"]
            (rows.join(part_of, "tail").drop("tail").repartitionByRange(*by).sortWithinPartitions(*by)
             .write.partitionBy("part", "depth").parquet(f"{path}/{kind}"))
    where = store.makeQualified(target).toString()
    return StoredTries(where.replace("file:/", "file:///", 1) if where.startswith("file:/") and not where.startswith("file://")
                       else where, order, bounds, short)


def _frequent(counts: DataFrame, limit: int) -> tuple[float, np.ndarray, np.ndarray]:
    """The least count such that at most ``limit`` tokens have as much, and those tokens."""
    level = F.floor(F.log2("n") * 4)
    levels = counts.groupBy(level.cast("int").alias("level")).agg(F.count("*").alias("k"), F.min("n").alias("n")).collect()
    least, held = float("inf"), 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        held += r["k"]
        if held > limit:
            break
        least = r["n"]
    found = counts.where(F.col("n") >= least).toArrow()
    keys, n = found.column("key").to_numpy().view(_U), found.column("n").to_numpy()
    order = np.argsort(keys)
    return least, keys[order], n[order]


def score_documents(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    order: int = ORDER, shard_entries: int = SHARD_ENTRIES, frequent: int = FREQUENT) -> DataFrame:
    """Score every whole text of ``docs`` with the model learnt from all of ``training``.

    Returns ``doc_id, n_tokens, n_known, train_tokens, base_score, score``. Tokens are the
    lower-cased words and one end. ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1)))
    over them; ``score`` is the log10 probability of the same token sequence spelt in bytes
    (words joined by one space, then the end) under the context trie.

    The corpus is counted in parallel and merged by a shuffle of distinct keys. The trie is
    written to the shared folder in parts of bounded size, which a task reads one at a time;
    counts of at most ``frequent`` tokens are broadcast, the rarer tokens of each document are
    joined to theirs.
    Null and empty texts have the end token alone. Repeated rows and null ids stay; with no
    training rows every byte has probability 1/256 and every token the same base; other
    columns are ignored.
    """
    spark = docs.sparkSession
    counts = C.stage_table(corpus_counts(training, text_col, order))
    tokens = counts.where("kind = 1").select("key", "n")
    n_train, n_types = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    size = math.log10(n_train + 0.5 * (n_types + 1))
    least, keys, n = _frequent(tokens, frequent)
    known = spark.sparkContext.broadcast((keys, np.log10(n + 0.5).astype(np.float64)))
    entries, contexts = context_trie(counts.where("kind = 0").select("key", "n"), order)

    tries = spark.sparkContext.broadcast(load_tries(entries, contexts, order, shard_entries))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    part = C.stage_table(_scored(rows, known, tries, order).withColumn("row", F.monotonically_increasing_id()))
    rare = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "row", F.col("t.rare").alias("key"), F.col("t.times").alias("times"))
    found = (rare.join(tokens.where(F.col("n") < least) if least != float("inf") else tokens, "key").groupBy("row")
             .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("gain")))
    full = part.join(found, "row", "left")
    n_known = F.col("n_known") + F.coalesce("more", F.lit(0))
    base = (F.col("gained") + F.coalesce("gain", F.lit(0.0)) + (F.col("n_tokens") - n_known) * math.log10(0.5)
            - F.col("n_tokens") * size)
    return full.select("doc_id", "n_tokens", n_known.cast("bigint").alias("n_known"),
                       F.lit(n_train).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")


def _code_lengths(trie: Trie, grams: np.ndarray, coded: np.ndarray) -> np.ndarray:
    """Sum over each row of its positions' log10 probabilities."""
    return np.add.reduceat(trie.log10(grams), np.cumsum(coded) - coded) if len(coded) else np.zeros(0)


def _scored(rows: DataFrame, shared, stored, order: int) -> DataFrame:
    """``doc_id, score, n_tokens, n_known, gained, rare, times``: the code length, sums over the
    tokens that the shared counts hold, and each document's other tokens with how often it has
    them. A task's positions wait until all parts of the trie, of which it holds one at a time,
    have coded theirs."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "score", "n_tokens", "n_known", "gained", "rare", "times"]

    def run(batches):
        (keys, gain), tries = shared.value, stored.value
        only = tries.load(0) if len(tries) == 1 else None
        waiting: list[tuple] = []

        def drain():
            scores = [np.zeros(len(coded)) for _, _, coded in waiting]
            for k in range(len(tries)):
                trie = only or tries.load(k)
                for score, (_, grams, coded) in zip(scores, waiting, strict=True):
                    score += _code_lengths(trie, grams, coded)
                del trie
            for score, (columns, *_) in zip(scores, waiting, strict=True):
                yield pa.RecordBatch.from_arrays([columns[0], pa.array(score), *columns[1:]], names)

        size = 0
        for part in C.passes(batches, "text", PASS):
            stream, first, coded, words, n_words = _stream(part.column("text"), order)
            n = len(n_words)
            row = np.repeat(np.arange(n), n_words)
            unique, inverse = np.unique(np.append(words, _U(END_TOKEN)), return_inverse=True)
            at, held = _find(keys, unique)
            weight = np.where(held, gain[at], 0.0) if len(keys) else np.zeros(len(unique))
            end, inverse = inverse[-1], inverse[:-1]
            n_known = np.bincount(row, weights=held[inverse], minlength=n) + held[end]
            gained = np.bincount(row, weights=weight[inverse], minlength=n) + weight[end]
            other = ~held[inverse]
            ids = np.concatenate([inverse[other], np.full(n, end)[~held[[end] * n]]]).astype(np.int64)
            rows_ = np.concatenate([row[other], np.arange(n)[~held[[end] * n]]]).astype(np.int64)
            pairs, times = np.unique(rows_ * len(unique) + ids, return_counts=True)
            cuts = np.searchsorted(pairs // len(unique), np.arange(n + 1)).astype(np.int32)
            grams = _grams(stream, first, coded, order)
            waiting.append(([part.column("doc_id"), pa.array(n_words.astype(np.int64) + 1),
                             pa.array(n_known.astype(np.int64)), pa.array(gained),
                             pa.ListArray.from_arrays(pa.array(cuts), pa.array(unique[pairs % len(unique)].view(np.int64))),
                             pa.ListArray.from_arrays(pa.array(cuts), pa.array(times.astype(np.int32)))], grams, coded))
            size += len(grams)
            if size >= (PASS if only else WAITING):
                yield from drain()
                waiting.clear()
                size = 0
        if waiting:
            yield from drain()

    return rows.mapInArrow(run, f"doc_id {kind}, score double, n_tokens bigint, n_known bigint, gained double, "
                                "rare array<bigint>, times array<int>")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    scored = score_documents(docs, docs.where(C.fold("doc_id") != 1))
    return scored.select("doc_id", (C.fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")

"""Alignment of the tokens that two tokenizers make of the same texts, as an Arrow pipeline."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C
from barcodeforge.llm.distinct_chunks import ChunkEncoder, Vocabulary, byte_bpe, per_worker

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: text bytes that are aligned together
ALIGN_BYTES = 1 << 19
#: id pairs whose counts go to every task; the rest are met by a join. At most 17 bytes each
SHARED_PAIRS = 1 << 20
#: distinct pairs that a task counts before it hands them on
PARTIAL_PAIRS = 1 << 19

PIECE_SPACE = "▁"


class _Pair:
    """Both tokenizers of a task, over texts that begin with the one space that the second adds."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        first, a = byte_bpe(byte_path, plain=True)
        second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        tokens = []
        for k in range(second.get_piece_size()):
            piece = second.id_to_piece(k)
            if PIECE_SPACE in piece.lstrip(PIECE_SPACE):
                raise ValueError("a piece spans a space inside a text: its texts cannot be cut at spaces")
            tokens.append(bytes([int(piece[1:-1], 16)]) if second.is_byte(k) else piece.replace(PIECE_SPACE, " ").encode())
        b = Vocabulary(tokens)
        # every chunk starts with a space, which the second tokenizer adds itself
        self.encode = ChunkEncoder((first, a), (lambda text: second.encode(text[1:]), b))
        self.a_size, self.b_size = pa.array(a.size), pa.array(b.size)
        self.names = pa.array([str(k) for k in range(max(len(a.size), len(b.size)))])


def _ends(ids: pa.ListArray, size: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flat ids, the document of each and the byte of it where each token ends."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    if not len(flat):
        return flat, doc, pa.array([], pa.int64())
    total = pc.cumulative_sum(size.take(flat))
    # a running sum begins again in every document: less what all earlier ones hold
    upto = pa.concat_arrays([pa.array([0], pa.int64()), total])
    return flat, doc, pc.subtract(total, upto.take(ids.offsets.take(doc).cast(pa.int64())))


def _listed(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _align(a_ids: pa.ListArray, b_ids: pa.ListArray, pair: _Pair) -> dict[str, pa.Array]:
    """Group and link columns of documents whose tokens spell the same bytes."""
    docs = len(a_ids)
    a, a_doc, a_end = _ends(a_ids, pair.a_size)
    b, b_doc, b_end = _ends(b_ids, pair.b_size)
    left = pa.table({"doc": a_doc, "end": a_end, "a": a.cast(pa.int64())})
    right = pa.table({"doc": b_doc, "end": b_end, "b": b.cast(pa.int64())})
    both = left.join(right, keys=["doc", "end"], join_type="full outer", use_threads=False)
    both = both.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    doc, a_here, b_here = (both.column(c).combine_chunks() for c in ("doc", "a", "b"))
    shared = pc.and_(a_here.is_valid(), b_here.is_valid())
    # between two neighbouring ends lies one stretch of one token of each side: the next that ends
    a_over, b_over = pc.fill_null_backward(a_here), pc.fill_null_backward(b_here)
    per_doc = lambda mask: np.bincount(doc.filter(mask).to_numpy(), minlength=docs) if len(doc) else np.zeros(docs, np.int64)
    n_groups = per_doc(shared)
    # texts of the groups: the ids between shared ends, joined inside out
    texts = []
    for ids, here in ((a, a_here), (b, b_here)):
        closes = np.flatnonzero(shared.filter(here.is_valid()).to_numpy(zero_copy_only=False))
        texts.append(pc.binary_join(_listed(pair.names.take(ids), np.diff(np.concatenate([[-1], closes]))), ","))
    groups = pc.binary_join(_listed(pc.binary_join_element_wise(*texts, "|"), n_groups), ";")
    link = pc.add(pc.shift_left(a_over, pa.scalar(32, pa.int64())), b_over)
    found = pa.table({"doc": doc, "pair": link}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    found = found.sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
    kinds = np.bincount(found.column("doc").to_numpy(), minlength=docs) if found.num_rows else np.zeros(docs, np.int64)
    flat = lambda c: found.column(c).combine_chunks().cast(pa.int64())
    return {
        "n_a": pc.list_value_length(a_ids).cast(pa.int64()), "n_b": pc.list_value_length(b_ids).cast(pa.int64()),
        "n_groups": pa.array(n_groups.astype(np.int64)),
        "n_links": pa.array((np.bincount(doc.to_numpy(), minlength=docs) if len(doc) else np.zeros(docs)).astype(np.int64)),
        "groups": groups.cast(pa.string()), "pairs": _listed(flat("pair"), kinds), "times": _listed(flat("count_all"), kinds)}


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_path: str | None = None,
                     piece_path: str | None = None) -> DataFrame:
    """``doc_id, row, n_a, n_b, n_groups, n_links, groups, pairs, times``: how the tokens of a
    byte-level tokenizer (A, of a space and the text) and a piece tokenizer (B, of the text; it
    adds the space) cover the same bytes.

    Byte offsets where tokens of both end cut them into groups; ``groups`` writes them as
    ``a1,a2|b1;a3|b2,b3``. Two token occurrences are linked if their bytes overlap; ``pairs`` has
    the distinct linked ids of the document as ``a * 2^32 + b``, ascending, ``times`` how often
    each is linked. ``row`` numbers the rows of one run.

    Per batch: ids as list columns, flattened with their parent index; token ends by running
    sums that begin again in each document; a full outer hash join of both sides on document
    and end, sorted, in which every row is one link and rows with both sides close a group;
    pairs counted by ``Table.group_by``.

    Null and empty texts, and texts that either tokenizer does not spell byte by byte, have no
    tokens: zeros, an empty text and empty lists. A very long text is one pass of its own, encoded
    in chunks. Repeated rows and null ids stay; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.when(text == "", "").otherwise(F.concat(F.lit(" "), text)).alias("text"),
                          F.monotonically_increasing_id().alias("row"))
    kind = rows_in.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import public_tokenizers

        paths = byte_path or public_tokenizers.path(BYTE_BPE), piece_path or public_tokenizers.path(PIECE_BPE)
        pair = per_worker(f"pair {paths}", lambda: _Pair(*paths))
        for part in C.passes(batches, "text", ALIGN_BYTES):
            data, offsets = C.text_bytes(part.column("text"))
            sides, sound = pair.encode(data, offsets)
            lists = []
            for ids, cuts in sides:
                counts = np.where(sound, np.diff(cuts), 0)
                lists.append(_listed(pa.array(ids[np.repeat(sound, np.diff(cuts))]), counts))
            found = _align(*lists, pair)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), *found.values()],
                                             ["doc_id", "row", *found])

    return rows_in.mapInArrow(run, f"doc_id {kind}, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                   "groups string, pairs array<bigint>, times array<bigint>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many rows of ``aligned(pairs)`` an id pair is linked, and whether
    no other pair with its A id is in more. Tasks count with ``Table.group_by`` and Spark adds
    the partial counts; the table of A ids is as long as the first vocabulary at most."""
    def run(batches):
        waiting, size = [], 0

        def counted():
            table = pa.concat_tables(waiting).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return table.rename_columns(["pair", "n"])

        for batch in batches:
            pairs = pc.list_flatten(batch.column("pairs"))
            waiting.append(pa.table({"pair": pairs, "n": pa.array(np.ones(len(pairs), np.int64))}))
            size += len(pairs)
            if size > 4 * PARTIAL_PAIRS:
                waiting = [counted()]
                size = waiting[0].num_rows
                if size > PARTIAL_PAIRS:
                    yield from waiting[0].to_batches()
                    waiting, size = [], 0
        if waiting:
            yield from counted().to_batches()

    partial = aligned.select("pairs").mapInArrow(run, "pair bigint, n bigint")
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = C.stage_table(counts)
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return C.stage_table(counts.join(most, F.shiftright(counts["pair"], 32) == most["a"])
                         .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def link_statistics(aligned: DataFrame, counts: DataFrame, shared: int = SHARED_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of every row of ``aligned(row, pairs, times)``: its links whose
    pair is ``best``, and the counts of all its links.

    The counts of the most frequent pairs, at most ``shared`` of them, go to all tasks: all those
    in at least 2^k rows, for the least k that keeps to that size. What is left is in fewer
    rows each, so no key of the join that meets it is hot.
    """
    spark = aligned.sparkSession
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(power.alias("k")).count().collect()}
    k = max(sizes, default=0) + 1
    total = 0
    while k > 0 and total + sizes.get(k - 1, 0) <= shared:
        k -= 1
        total += sizes.get(k, 0)
    known = counts.where(F.col("n") >= 1 << k).toArrow().combine_chunks().sort_by("pair")
    names = ("pair", "n", "best")
    sent = spark.sparkContext.broadcast([known.column(c).to_numpy() for c in names])

    def looked_up(batch):
        pairs, n, best = sent.value
        lists = batch.column("pairs")
        asked = pc.list_flatten(lists).to_numpy()
        times = pc.list_flatten(batch.column("times")).to_numpy()
        doc = pc.list_parent_indices(lists).to_numpy()
        if not len(pairs):
            return asked, times, doc, np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(pairs, asked), len(pairs) - 1)
        return asked, times, doc, at, pairs[at] == asked

    def summed(batches):
        for batch in batches:
            _, times, doc, at, hit = looked_up(batch)
            _, n, best = sent.value
            size = batch.num_rows
            sums = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
            if len(n):
                for out, value in zip(sums, (best[at] & hit, np.where(hit, n[at], 0)), strict=True):
                    np.add.at(out, doc, times * value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, sums)], ["row", "n_best", "count_sum"])

    def rest(batches):
        for batch in batches:
            asked, times, doc, _, hit = looked_up(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(doc[~hit])), pa.array(asked[~hit]), pa.array(times[~hit])], ["row", "pair", "times"])

    lists = aligned.select("row", "pairs", "times")
    sums = C.stage_table(lists.mapInArrow(summed, "row bigint, n_best bigint, count_sum bigint"))
    if k:
        rare = lists.mapInArrow(rest, "row bigint, pair bigint, times bigint").join(counts.where(F.col("n") < 1 << k), "pair")
        more = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        sums = C.stage_table(sums.union(more).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    sent.destroy()
    return sums


def op13(spark, sf_dir: str) -> DataFrame:
    aligned = align_tokenizers(C.table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    aligned = C.stage_table(aligned.withColumn("groups_sha256", digest).drop("groups"))
    found = link_statistics(aligned, pair_counts(aligned))
    return aligned.join(found, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

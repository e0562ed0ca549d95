"""SimHash near-duplicate groups by multi-index hashing over 64-bit fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C
from barcodeforge.llm.components import connected_components

SEED = 42
SPACE = np.uint8(0x20)


def _fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """One signed 64-bit fingerprint per text: bit set when over half the shingle hashes set it."""
    data, offsets = C.text_bytes(column)
    n = len(offsets) - 1
    out = np.zeros(n, dtype=np.uint64)
    data = C.LOWER[data]
    blank = C.IS_SPACE[data]
    # one 0x20 per run of white space (and per row start), so that shingles are byte slices
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    new_offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    data = np.where(blank, SPACE, data)[keep]
    starts, ends, rows = C.spans(data != SPACE, new_offsets)
    if not len(starts):
        return out.view(np.int64)
    first = np.searchsorted(rows, np.arange(n), side="left")
    count = np.searchsorted(rows, np.arange(n), side="right") - first
    take = np.where(count == 0, 0, np.maximum(1, count - shingle + 1))
    begin = C.ranges(first, take)
    last = np.minimum(begin + shingle - 1, np.repeat(first + count, take) - 1)
    buf, digest = data.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(buf[s:e], SEED) for s, e in zip(starts[begin].tolist(), ends[last].tolist(), strict=True)],
                      dtype=np.uint64)
    full = np.flatnonzero(take)
    cuts = np.concatenate([[0], np.cumsum(take[full])])
    ones = np.zeros((len(full), 64), dtype=np.int64)
    # rows in slices of some 10^5 shingles, so that the unpacked bits stay small
    row = 0
    while row < len(full):
        end = max(row + 1, int(np.searchsorted(cuts, cuts[row] + 200_000, side="right")) - 1)
        for part in range(cuts[row], cuts[end], 1 << 20):  # a very long text has several parts
            stop = min(cuts[end], part + (1 << 20))
            bits = np.unpackbits(hashes[part:stop].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            edges = np.clip(cuts[row:end], part, stop) - part
            live = np.flatnonzero(np.diff(np.append(edges, stop - part)) > 0)
            ones[row + live] += np.add.reduceat(bits, edges[live], axis=0, dtype=np.int32)
        row = end
    votes = (2 * ones > np.diff(cuts)[:, None]).astype(np.uint8)
    out[full] = np.packbits(votes, axis=1).view(">u8").ravel().astype(np.uint64)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: the signed 64-bit SimHash of every whole text.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are ``shingle`` words
    joined by one space, repeats counted; a shorter text has one shingle of all its words; no
    word at all (null, empty, white space) gives 0.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in C.passes(batches, "text", 1 << 18):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(_fingerprints(part.column("text"), shingle))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def _balls(distinct: DataFrame) -> DataFrame:
    """Radius-1 Hamming ball of each of the two 32-bit segments: ``seg, fp, near, flips`` where
    ``near`` is the whole fingerprint with at most one bit of segment ``seg`` flipped."""
    def ball(seg: int):
        flipped = [F.struct(F.lit(seg).alias("seg"), F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))).alias("near"),
                            F.lit(1).alias("flips")) for b in range(32 * seg, 32 * seg + 32)]
        return [F.struct(F.lit(seg).alias("seg"), F.col("fp").alias("near"), F.lit(0).alias("flips")), *flipped]

    return distinct.select("fp", F.explode(F.array(*ball(0), *ball(1))).alias("b")).select("fp", "b.*")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _segment(fp, seg):
    """A segment's value, with its number above it, as one table key."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(fp, 32).bitwiseOR(F.lit(1 << 32))
    return F.when(seg == 0, low).otherwise(high)


def hamming_components(distinct: DataFrame) -> DataFrame:
    """``node, component`` of the distinct fingerprints ``fp`` that link at 3 or fewer bits.

    Multi-index hashing with two 32-bit segments: of two fingerprints within 3 bits, one
    segment differs in at most one bit. Each segment's radius-1 ball is enumerated and looked
    up in the table of exact segment values, and the complete distance is verified.

    Two steps keep the output linear inside dense groups of near copies, where pairs would
    grow with the square: fingerprints that share a member of their balls are within 2 bits by
    construction and are linked to the smallest of them, not pairwise; pairs from the table
    are then only kept when they join two groups that the first step left apart.
    """
    # every fingerprint grows to 66 rows: the small table is dealt to all tasks before that, by an
    # expression of its own, since a partitioning that is there already would be kept and merged
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df: df.repartition(parts, F.xxhash64("fp"))
    balls = _balls(deal(distinct))
    # hubs: a whole fingerprint at most one flip away; each is shared by at most 65 others
    near = balls.where("flips = 1 or seg = 0").select("near", "fp")
    shared = near.groupBy("near").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    stars = near.join(shared, "near").where("fp <> least").select(F.col("fp").alias("src"), F.col("least").alias("dst"))
    close = C.stage_table(connected_components(stars))
    known = C.stage_table(distinct.join(close, distinct["fp"] == close["node"], "left")
                          .select("fp", F.coalesce("component", "fp").alias("grp")))
    probes = (_balls(deal(known.select("fp"))).select("fp", _segment(F.col("near"), F.col("seg")).alias("key")))
    entries = known.select("fp", "grp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg")).select(
        F.col("fp").alias("other"), F.col("grp").alias("other_grp"), _segment(F.col("fp"), F.col("seg")).alias("key"))
    # a probe that only meets its own entry leads nowhere; most end here, before any pair is made
    lone = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("other").alias("only"))
    lone = lone.select("key", F.when(F.col("n") == 1, F.col("only")).alias("only"))
    live = probes.join(lone, "key").where("only is null or only <> fp").select("fp", "key")
    live = live.join(known, "fp")
    pairs = (live.join(entries, (live["key"] == entries["key"]) & (live["grp"] > entries["other_grp"])
                       & (F.bit_count(live["fp"].bitwiseXOR(entries["other"])) <= 3))
             .select(F.col("grp").alias("src"), F.col("other_grp").alias("dst")).distinct())
    merged = connected_components(pairs).toDF("grp", "top")
    return (known.join(merged, "grp", "left")
            .select(F.col("fp").alias("node"), F.coalesce("top", "grp").alias("component")))


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            shingle: int = 3) -> DataFrame:
    """``doc_id, fp, component_id``: every document with its fingerprint and the smallest
    document id reachable over links of at most 3 differing bits.

    Equal fingerprints (zero included) are reduced to one row before any search. Null ids
    keep their row; they never name a component. Repeated rows stay repeated. An empty table
    gives an empty result. Other columns are ignored.
    """
    prints = C.stage_table(fingerprints(docs, id_col, text_col, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    groups = C.stage_table(hamming_components(first.select("fp")))
    named = groups.join(first, groups["node"] == first["fp"]).select("node", "component", "first_id")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(least, "component").select(F.col("node").alias("fp"), "component_id")
    return prints.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def op7(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = simhash_near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""SimHash document fingerprints from weighted term hashes, and permuted block tables that find
all fingerprints within a Hamming radius. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

#: a fingerprint is two 64-bit words
BITS = 128
#: distance within which documents are counted as near
RADIUS = 3
#: blocks of a fingerprint; more than the radius, so two near ones agree in a whole block
BLOCKS = 4
#: documents sorted together to find the next one, and the most ranges the ids are cut into
RANGE_ROWS = 2048
MAX_RANGES = 4096
#: second hash of a term
SALT = 7
_LANES = (1 << 32) | 1
_LEAST = -(1 << 63)


def terms(text: Column) -> Column:
    """Array of ``(h1, h2, w)``: every pair of neighbouring words (the last word alone ends it)
    with two hashes, weighted by its letters: long words are rare ones."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    after = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.zip_with(words, after, lambda a, b: F.struct(
        F.xxhash64(a, b).alias("h1"), F.xxhash64(F.lit(SALT), a, b).alias("h2"),
        (F.length(a) + F.coalesce(F.length(b), F.lit(0))).cast("bigint").alias("w")))


def _votes(hash_col: str) -> list[Column]:
    """Sums of the weights of the terms that set each bit; bits k and k + 32 share one sum."""
    return [F.sum(F.shiftrightunsigned(F.col(hash_col), k).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"{hash_col}_{k}")
            for k in range(32)]


def _signs(hash_col: str) -> Column:
    """One word of the fingerprint: a bit is set when the signed votes for it, +w where a term
    has it and -w where not, are above zero."""
    bits = []
    for k in range(32):
        lane = F.col(f"{hash_col}_{k}")
        for bit, votes in ((k, lane.bitwiseAND(F.lit(0xFFFFFFFF))), (k + 32, F.shiftrightunsigned(lane, 32))):
            mask = 1 << bit if bit < 63 else _LEAST
            bits.append(F.when(2 * votes > F.col("w"), F.lit(mask)).otherwise(F.lit(0)).cast("bigint"))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys, f1, f2`` of every row of ``texts``; ``keys`` must identify a row. Votes of a row
    are summed before any shuffle. A text without words has the fingerprint 0."""
    exploded = texts.select(*keys, F.explode_outer(terms(F.coalesce(F.col(text_col), F.lit("")))).alias("t"))
    exploded = exploded.select(*keys, "t.h1", "t.h2", "t.w")
    summed = exploded.groupBy(*keys).agg(*_votes("h1"), *_votes("h2"), F.sum("w").alias("w"))
    return summed.select(*keys, F.coalesce(_signs("h1"), F.lit(0)).alias("f1"), F.coalesce(_signs("h2"), F.lit(0)).alias("f2"))


def distance(a1, a2, b1, b2) -> Column:
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``range, pos, doc_id, text, next_text, next_range, next_pos``: every document with the
    one after it by ascending id (null first; equal ids by text), the first after the last.

    Ids are cut into ranges at quantiles that are ids themselves, and each range is sorted on
    its own; the first documents of a range also stand, marked, at the end of the range before.
    """
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LEAST))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    least, n = rows.agg(F.min("key"), F.count("*")).first()
    pieces = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    cuts = {least if least is not None else 0}
    if pieces > 1:
        at = [k / pieces for k in range(1, pieces)]
        cuts |= set(rows.agg(F.percentile_approx("key", at, 10 * pieces)).first()[0])
    cuts = sorted(cuts)
    bounds = F.lit(cuts) if len(cuts) > 1 else F.array(F.lit(cuts[0]))
    bounds = bounds.cast("array<bigint>")
    own = F.size(F.filter(bounds, lambda b: b <= F.col("key"))) - 1
    rows = rows.withColumn("own", own)
    before = F.pmod(F.col("own") - 1, F.lit(len(cuts)))
    places = F.when(F.col("key").isin(cuts), F.array(
        F.struct(F.col("own").alias("range"), F.lit(0).alias("mark")), F.struct(before.alias("range"), F.lit(1).alias("mark")))
    ).otherwise(F.array(F.struct(F.col("own").alias("range"), F.lit(0).alias("mark"))))
    rows = rows.withColumn("place", F.explode(places)).select("doc_id", "key", "text", "place.range", "place.mark")
    order = Window.partitionBy("range").orderBy("mark", "key", "text")
    rows = rows.withColumns({"pos": F.row_number().over(order), "next_text": F.lead("text").over(order),
                             "next_mark": F.lead("mark").over(order)}).where("mark = 0")
    last = F.col("next_mark") == 1
    return rows.select(
        "range", "pos", "doc_id", "text", "next_text",
        F.when(last, F.pmod(F.col("range") + 1, F.lit(len(cuts)))).otherwise(F.col("range")).alias("next_range"),
        F.when(last, F.lit(1)).otherwise(F.col("pos") + 1).alias("next_pos"))


def block_tables(prints: DataFrame) -> DataFrame:
    """One row per table: ``table, lead`` where table k is the fingerprint with block k moved to
    the front, looked up by that block (32 bits)."""
    low, high = F.lit(0xFFFFFFFF), 32
    lead = [F.col("f1").bitwiseAND(low), F.shiftrightunsigned("f1", high), F.col("f2").bitwiseAND(low),
            F.shiftrightunsigned("f2", high)]
    return prints.withColumn("t", F.explode(F.array(*[F.struct(F.lit(k).alias("table"), x.alias("lead"))
                                                      for k, x in enumerate(lead)]))).select("*", "t.table", "t.lead").drop("t")


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``f1, f2, n``: for every distinct fingerprint of ``queries(f1, f2)``, how many rows of
    ``prints(f1, f2)`` lie within ``radius`` bits (itself included).

    Equal fingerprints are one row with a count on both sides. A pair within 3 bits agrees in
    one of 4 blocks; where it does in several, the first one counts it, so that no pair has to
    be collected to be counted once.
    """
    if radius >= BLOCKS:
        raise ValueError(f"{BLOCKS} blocks find a radius below {BLOCKS}")
    table = block_tables(prints.groupBy("f1", "f2").agg(F.count("*").alias("copies")))
    table = table.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "copies", F.col("table").alias("tb"),
                         F.col("lead").alias("ld"))
    probe = block_tables(queries.select("f1", "f2").distinct())
    x1, x2 = F.col("f1").bitwiseXOR(F.col("g1")), F.col("f2").bitwiseXOR(F.col("g2"))
    low = F.lit(0xFFFFFFFF)
    first = F.when(x1.bitwiseAND(low) == 0, 0).when(F.shiftrightunsigned(x1, 32) == 0, 1).when(x2.bitwiseAND(low) == 0, 2).otherwise(3)
    pairs = probe.join(table, (F.col("table") == F.col("tb")) & (F.col("lead") == F.col("ld"))
                       & (F.bit_count(x1) + F.bit_count(x2) <= radius) & (first == F.col("table")))
    return pairs.groupBy("f1", "f2").agg(F.sum("copies").alias("n"))


def _text(f1, f2) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose last floor(n/2) code points
    are replaced by the first as many (or all) of the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, near_documents``. Likeness is 1 minus the share of differing bits.
    ``near_documents`` is set for ids divisible by 50: how many other rows of the table lie
    within 3 bits. Null texts are empty, a text without words has the fingerprint 0, repeated
    rows stay, a null id sorts first; a single row is its own next; other columns are ignored.
    """
    rows = with_next_text(docs, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("range", "pos", "doc_id", "next_range", "next_pos", n.cast("bigint").alias("n_chars"),
                       F.posexplode(F.array(F.col("text"), edited)).alias("version", "text"))
    rows = rows.withColumn("sha", F.when(F.col("version") == 1, F.sha2(F.col("text").cast("binary"), 256)))
    keys = ["range", "pos", "version", "doc_id", "next_range", "next_pos", "n_chars", "sha"]
    prints = C.stage_table(fingerprints(rows, keys))
    own = prints.where("version = 0").drop("version", "sha")
    changed = prints.where("version = 1").select(
        "range", "pos", F.col("sha").alias("edited_sha256"), F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    after = own.select(F.col("range").alias("next_range"), F.col("pos").alias("next_pos"), F.col("f1").alias("n1"),
                       F.col("f2").alias("n2"))
    whole = own.join(changed, ["range", "pos"]).join(after, ["next_range", "next_pos"])
    near = near_fingerprints(own.where("doc_id % 50 = 0"), own)
    whole = whole.withColumn("asked", F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))).join(near, ["f1", "f2"], "left")
    like = lambda a, b: 1 - distance(F.col("f1"), F.col("f2"), F.col(a), F.col(b)) / F.lit(float(BITS))
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", _text("f1", "f2").alias("fingerprint"),
        _text("e1", "e2").alias("edited_fingerprint"), like("e1", "e2").alias("near_edited"),
        like("n1", "n2").alias("near_next"), F.when(F.col("asked"), F.col("n") - 1).alias("near_documents"))


def op9(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(C.table(spark, sf_dir, "documents"))

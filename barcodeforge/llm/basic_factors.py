"""Periodic runs of words, found with a dictionary of basic factors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

#: words a run has at least, and how often its period fits into it
MIN_WORDS = 6
MIN_TIMES = 4
SPACES = r"[\x20\x09-\x0D]+"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words, and a number for each that equal words share."""
    blank = C.IS_SPACE[data]
    starts, ends, rows = C.spans(~blank, offsets)
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data[~blank]))])
    return starts, ends, rows, column.dictionary_encode().indices.to_numpy()


def periodic_runs(symbols: np.ndarray, rows: np.ndarray, min_words: int = MIN_WORDS,
                  min_times: int = MIN_TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every maximal run in the sequences of ``symbols`` (row
    numbers ascend and part them), by start and period.

    Basic factors are the stretches of 1, 2, 4, ... symbols. Equal ones of a length share a
    name, made from the names of their halves; only those that occur again near enough to
    be part of a run are carried on. At each length L, an occurrence whose successor lies in
    the window of 2 L that it starts (a distance d of L / 2 < d <= L; smaller ones belong to
    shorter factors) proposes the period d. Occurrences at neighbouring places with one distance
    are progressions of one run: the first starts it, the last one's successor ends it, and a
    place beyond either would have been among them. Since a run of four periods is longer than
    d + L, the distance to the nearest occurrence is its smallest period, and each run is
    proposed at one length only.
    """
    n = len(symbols)
    found = []
    if n:
        size = np.bincount(rows)[rows]
        widest = size // min_times  # the longest period a run of the row can have
        place = np.arange(n)
        name = rows.astype(np.int64) * (int(symbols.max()) + 1) + symbols
        length, longest = 1, int(widest.max())
        while len(place) and length // 2 < longest:
            order = np.argsort(name, kind="stable")
            p, k = place[order], name[order]
            same = k[1:] == k[:-1]
            gap = p[1:] - p[:-1]
            near = same & (gap <= widest[p[1:]])
            hit = np.flatnonzero(near & (gap <= length) & (gap > length // 2))
            if len(hit):
                at, step = p[hit], gap[hit]
                by_place = np.argsort(at)
                at, step = at[by_place], step[by_place]
                first = np.ones(len(at), dtype=bool)
                first[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1]) | (rows[at[1:]] != rows[at[:-1]])
                head = np.flatnonzero(first)
                tail = np.append(head[1:], len(at)) - 1
                start, period = at[head], step[head]
                end = at[tail] + length + period
                whole = end - start >= np.maximum(min_words, min_times * period)
                found.append(np.stack([start, end, period])[:, whole])
            live = np.zeros(len(p), dtype=bool)
            live[1:] |= near
            live[:-1] |= near
            rank = np.concatenate([[0], np.cumsum(~same)])
            named = np.full(n + length, -1, dtype=np.int64)
            named[p[live]] = rank[live]
            place = np.flatnonzero(named[:n] >= 0)
            right = named[place + length]
            fits = right >= 0
            fits[fits] = rows[place[fits]] == rows[place[fits] + length]
            place, right = place[fits], right[fits]
            name = named[place] * (n + 1) + right
            length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = np.unique(np.concatenate(found, axis=1), axis=1)
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _collapsed(data: np.ndarray, offsets: np.ndarray, starts, ends, rows, kept) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the rows' kept words, joined by one space."""
    starts, ends, rows = starts[kept], ends[kept], rows[kept]
    more = np.zeros(len(rows), dtype=np.int64)  # a space follows all but a row's last word
    more[:-1] = rows[1:] == rows[:-1]
    edge = np.zeros(len(data) + 2, dtype=np.int8)
    edge[starts] += 1
    np.subtract.at(edge, ends + more, 1)
    taken = np.cumsum(edge[:-2], dtype=np.int8) > 0
    out = np.where(C.IS_SPACE[data], np.uint8(0x20), data)[taken]
    return out, np.concatenate([[0], np.cumsum(taken)])[offsets]


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  min_times: int = MIN_TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte. ``runs`` lists every maximal
    stretch of at least ``max(min_words, min_times * period)`` words with its smallest period as
    ``start, length, period`` (word numbers from 0), by start and period. ``collapsed`` holds the
    words that no run repeats, joined by one space: a word goes if a run contains it after that
    run's first period.

    Null, empty and white-space texts have no words, no run and an empty text. A very long
    text is one numpy pass of its own, some 100 bytes a word. Repeated rows and null ids stay;
    an empty table gives an empty result; other columns are ignored.
    """
    if min_times < 4:
        raise ValueError("a run shorter than four periods may have no factor of every length that its search needs")
    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for part in C.passes(batches, "text"):
            data, offsets = C.text_bytes(part.column("text"))
            n = len(offsets) - 1
            starts, ends, rows, symbols = _words(data, offsets)
            first, last, period = periodic_runs(symbols, rows, min_words, min_times)
            base = np.searchsorted(rows, np.arange(n + 1), side="left")
            # a word goes if more runs began repeating before it than have ended
            edge = np.zeros(len(rows) + 1, dtype=np.int64)
            np.add.at(edge, first + period, 1)
            np.add.at(edge, last, -1)
            kept = np.cumsum(edge[:-1]) == 0
            out, cuts = _collapsed(data, offsets, starts, ends, rows, kept)
            run_row = rows[first] if len(first) else np.zeros(0, np.int64)
            runs = pa.StructArray.from_arrays(
                [pa.array(first - base[run_row]), pa.array(last - first), pa.array(period)], fields=list(item))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(run_row, np.arange(n + 1), side="left").astype(np.int32)), runs)
            text = pa.Array.from_buffers(
                pa.large_string(), n, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(base)), lists, text.cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return rows_in.mapInArrow(run, f"doc_id {kind}, n_words bigint, "
                                   "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text, and in one document of ten (by the crc32 of the id) its words from a place on
    replaced by repetitions of the next few of them. A null id plants nothing."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def planted(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")

    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, F.get(bound, F.lit(0))).otherwise(text)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse_runs(docs)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, F.lit("")).otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.p")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: equal words of a text joined at every distance, and neighbouring matches of one distance counted
ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT i::UBIGINT AS n, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
             lambda c, b: xor(c >> 8, t[((xor(c, b) & 255::UBIGINT) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h
  FROM documents, crc
), sizes AS (SELECT r, doc_id, w, h, h // 10 AS g, len(w)::BIGINT AS n FROM docs),
spots AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a,
         CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sizes
), words AS (
  SELECT r, n, i, CASE WHEN a IS NOT NULL AND i >= a THEN w[(a + (i - a) % p + 1)::BIGINT] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM spots)
), matches AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM matches
), stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
kept AS (
  SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs u WHERE u.r = w.r AND w.i >= u.start + u.period AND w.i < u.start + u.length)
  GROUP BY w.r
), found AS (
  SELECT r, count(*) AS n_runs, min((-length, start, period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY r
)
SELECT d.doc_id, coalesce(f.n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length, best[3]::BIGINT AS period,
       (-1000 * best[1] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN found f ON d.r = f.r LEFT JOIN kept k ON d.r = k.r
"""

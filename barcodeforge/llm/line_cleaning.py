"""Line-first cleaning of documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: words a document has at least, and the percentage of its words that repeated triples may hold
MIN_WORDS = 50
MAX_REPEATED = 50

# --- line rules -----------------------------------------------------------------------------
#: marks that end a sentence, possibly before closing quotes or brackets
SENTENCE_END = r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}][\x22'\)\]\x{201D}\x{2019}\x{BB}]*"
#: per mille of a line's characters that may be symbols
MAX_SYMBOLS = 100
#: percentage of a line's words that may end in two or more marks, as in ``BUY!! NOW!!``
MAX_SHOUTED = 20
#: separators that stand alone between the items of a menu, and the percentage of words they may be
SEPARATORS = ("|", ">", "<", "»", "«", "·", "•", "/", "-", "::")
MAX_SEPARATORS = 15
#: words of a line that may be a menu item, if all of them are menu words
MENU_WORDS = 8
MENU = ("home", "menu", "login", "log", "in", "out", "sign", "up", "register", "search", "about", "us", "contact",
        "help", "faq", "next", "previous", "prev", "back", "top", "share", "print", "sitemap", "skip", "to", "content")
#: phrases of notices that say nothing about the document's subject
BOILERPLATE = (
    "all rights reserved", "licensed under", "is licensed under", "released under the", "terms of use",
    "terms of service", "terms and conditions", "privacy policy", "cookie policy", "uses cookies", "use of cookies",
    "accept cookies", "enable javascript", "javascript is disabled", "subscribe to our", "sign up for our",
    "click here", "read more", "powered by", "lorem ipsum", "copyright (c)", "copyright ©", "follow us on",
    "share this", "leave a comment", "permission is hereby granted",
)
#: words beyond which a phrase does not make a line a notice: prose may quote it
NOTICE_WORDS = 40

#: percentage of a document's visible characters that its failed lines may hold
MAX_LOST = 30


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fault(line: Column, words: Column, symbols: Column | None = None) -> Column:
    """Name of the first rule that a line with these words fails, or null.

    * ``symbols``: more than MAX_SYMBOLS per mille of its visible characters are symbols;
    * ``shouting``: more than MAX_SHOUTED per cent of its words end in doubled ``!`` or ``?``;
    * ``navigation``: more than MAX_SEPARATORS per cent of its words are lone separators, or it is
      up to MENU_WORDS words long and all are menu words;
    * ``boilerplate``: up to NOTICE_WORDS words with a phrase of a notice;
    * ``punctuation``: no sentence ends at its end or anywhere in it.

    ``symbols`` may tell whether the whole document has a symbol at all. Costly tests stand
    behind cheap ones that they imply.
    """
    n = F.size(words)
    seen = F.length(F.array_join(words, ""))
    doubled = line.contains("!!") | line.contains("??") | line.contains("!?") | line.contains("?!")
    shouted = F.size(F.filter(words, lambda w: w.rlike(r"[!?]{2}\z")))
    separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
    menu = F.forall(words, lambda w: F.lower(F.regexp_replace(w, "[^A-Za-z]+", "")).isin(*MENU))
    low = F.lower(line)
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | low.contains(phrase)
    many = 1000 * _count(line, SYMBOLS) > MAX_SYMBOLS * seen
    return (F.when(many if symbols is None else symbols & many, "symbols")
            .when(doubled & (100 * shouted > MAX_SHOUTED * n), "shouting")
            .when((100 * separators > MAX_SEPARATORS * n) | ((n <= MENU_WORDS) & menu), "navigation")
            .when((n <= NOTICE_WORDS) & notice, "boilerplate")
            .when(~line.rlike(rf"{SENTENCE_END}(?:{WORD_GAP}|\z)"), "punctuation"))


def repeated_words(words: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more.

    Hashes of all windows, sorted as plain numbers, tell whether any can be repeated; only
    then are the windows themselves sorted with their places, so equality is that of the words.
    """
    def window(w, i, hashed: bool):
        parts = [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]
        return F.xxhash64(*parts) if hashed else F.struct(F.concat_ws(" ", *parts).alias("k"), i.alias("i"))

    def starts(w):
        return F.sequence(F.lit(0), F.size(w) - 3)

    def any_twice(hashes):
        return F.size(F.array_distinct(hashes)) < F.size(hashes)

    def covered(places):
        reach = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, reach, lambda a, p: F.struct(
            (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end")))["n"]

    def places(ordered):
        again = F.filter(ordered, lambda x, k: (x["k"] == F.get(ordered, k - 1)["k"]) | (x["k"] == F.get(ordered, k + 1)["k"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def exact(w):
        ordered = F.sort_array(F.transform(starts(w), lambda i: window(w, i, False)))
        return covered(_bind(ordered, places))

    twice = lambda w: _bind(F.transform(starts(w), lambda i: window(w, i, True)), any_twice)
    return F.when(F.size(words) < 4, F.lit(0)).when(twice(words), exact(words)).otherwise(F.lit(0))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """Documents with their failed lines removed, and what speaks for or against each.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_failed_lines, lost_percent, faults, clean_text, kept``. Lines are parted by
    ``\\n``; one without a word is neither judged nor removed. ``faults`` counts the failed lines
    by rule (see :func:`line_fault`). A document is kept if it passes the base rules (MIN_WORDS
    words, at most MAX_REPEATED per cent of them in repeated triples) and its failed lines hold
    at most ``max_lost`` per cent of its visible characters.

    One map pass, nothing is shuffled. Null, empty and white-space texts have zeros, an empty
    text and fail the base rules. A very long text is one row's arrays, some 60 bytes a word.
    Repeated rows and null ids stay; an empty table gives an empty result; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", words_of(F.col("text")).alias("words"), _count(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line"), words_of(line).alias("words"))).alias("lines"))
    judged = F.transform("lines", lambda x: F.struct(
        x["line"].alias("line"), F.size(x["words"]).alias("n"), F.length(F.array_join(x["words"], "")).alias("seen"),
        F.when(F.size(x["words"]) > 0, line_fault(x["line"], x["words"], F.col("n_symbols") > 0)).alias("fault")))
    rows = rows.select("doc_id", F.size("words").cast("bigint").alias("n_words"), "n_symbols",
                       F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
                       repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"), judged.alias("lines"))
    rows = rows.select(
        "*", F.transform(F.filter("lines", lambda x: x["n"] > 0), lambda x: x["line"]).alias("worded"),
        F.filter("lines", lambda x: x["fault"].isNotNull()).alias("failed"),
        F.array_join(F.transform(F.filter("lines", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n").alias("clean_text"))
    lost = F.aggregate("failed", F.lit(0), lambda n, x: n + x["seen"])
    rules = ("symbols", "shouting", "navigation", "boilerplate", "punctuation")
    failed_by = lambda rule: F.size(F.filter("failed", lambda x: x["fault"] == rule))
    faults = F.struct(*[failed_by(rule).cast("bigint").alias(rule) for rule in rules])
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words",
        base_failed.alias("base_failed"), F.size("worded").cast("bigint").alias("n_lines"),
        F.size("failed").cast("bigint").alias("n_failed_lines"), lost.cast("bigint").alias("lost_chars"), faults.alias("faults"),
        "clean_text")
    return rows.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost * F.col("word_chars")))


def op12(spark, sf_dir: str) -> DataFrame:
    found = clean_lines(C.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "n_lines", "n_failed_lines", "lost_chars",
                        F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))


def _oracle() -> str:
    gap = "[\\x20\\x09-\\x0D]"
    menu, separators = (", ".join(f"'{w}'" for w in words) for words in (MENU, SEPARATORS))
    notice = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
    end = SENTENCE_END.replace("'", "''")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{gap}+'), lambda w: w <> '') AS w FROM documents
), split_lines AS (
  SELECT r, i, l[i] AS line FROM (SELECT r, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT r, string_split(text, chr(10)) AS l FROM docs))
), looked AS (
  SELECT *, regexp_replace(line, '{gap}', '', 'g') AS seen, lower(line) AS low,
         list_filter(regexp_split_to_array(line, '{gap}+'), lambda x: x <> '') AS w FROM split_lines
), judged AS (
  SELECT *, CASE WHEN seen = '' THEN NULL
    WHEN 1000 * len(regexp_extract_all(line, '{SYMBOLS}')) > {MAX_SYMBOLS} * length(seen) THEN 'symbols'
    WHEN 100 * len(list_filter(w, lambda x: regexp_matches(x, '[!?]{{2}}\\z'))) > {MAX_SHOUTED} * len(w) THEN 'shouting'
    WHEN 100 * len(list_filter(w, lambda x: x IN ({separators}))) > {MAX_SEPARATORS} * len(w) THEN 'navigation'
    WHEN len(w) <= {MENU_WORDS} AND len(list_filter(w, lambda x: lower(regexp_replace(x, '[^A-Za-z]+', '', 'g')) NOT IN ({menu}))) = 0 THEN 'navigation'
    WHEN len(w) <= {NOTICE_WORDS} AND ({notice}) THEN 'boilerplate'
    WHEN NOT regexp_matches(line, '{end}(?:{gap}+|\\z)') THEN 'punctuation' END AS fault FROM looked
), by_line AS (
  SELECT r, count(*) FILTER (seen <> '') AS n_lines, count(*) FILTER (seen <> '') - count(DISTINCT line) FILTER (seen <> '') AS n_dup_lines,
         count(fault) AS n_failed_lines, coalesce(sum(length(seen)) FILTER (fault IS NOT NULL), 0) AS lost_chars,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (fault IS NULL), '') AS clean_text
  FROM judged GROUP BY r
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
), twice AS (
  SELECT r, count(DISTINCT place) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN (SELECT r, k FROM windows GROUP BY r, k HAVING count(*) > 1) USING (r, k)
  ) GROUP BY r
), base AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '{gap}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(t.n, 0)::BIGINT AS n_repeat_words
  FROM docs d LEFT JOIN twice t ON d.r = t.r
), flagged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {MAX_LOST} * word_chars AS kept, n_lines::BIGINT AS n_lines,
       n_failed_lines::BIGINT AS n_failed_lines, lost_chars::BIGINT AS lost_chars, sha256(clean_text) AS clean_sha256
FROM flagged JOIN by_line USING (r)
"""


ORACLE = _oracle()

"""Line-first quality rules (DataFrame functions only).

Each line is judged by itself: symbol clutter, no sentence punctuation,
navigation bars, boilerplate phrases, a line said before. Failing lines are
removed, and a document that loses too large a share of its text this way is
rejected. Document-level base rules (too few words, too many repeated five-word
windows) reject outright.

Defined results: a null text counts as empty; empty and blank texts have no
words and are rejected; repeated rows are each judged; an empty table gives an
empty table; other columns of the input are kept and new ones are only added by
``line_quality`` under the names in ``COLUMNS`` (an input column of such a name is left out).
No shuffle: a text is judged inside its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WORD, WS, packed, unpacked, words

SYMBOLS = r"[#*$%&|<>]"
BARS = r"[|»›•·]"
SENTENCE = r"[.!?;:…。！？।؟]"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOST_PCT = 50          # characters in failing lines, of all characters in words
MIN_SENTENCE_WORDS = 4     # a line this long must hold sentence punctuation
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_lines", "n_failed_lines", "lost_chars", "clean_text", "kept")

# Boilerplate phrases (lower case) of one line.
BOILERPLATE = (
    "all rights reserved", "licensed under the", "terms of service", "terms of use", "privacy policy",
    "cookie policy", "use of cookies", "uses cookies", "enable javascript", "lorem ipsum",
    "subscribe to our newsletter", "sign up for our newsletter", "click here to", "powered by",
)
NAVIGATION = (r"(?i)^[ \t]*(home|menu|next|previous|back|top|login|log in|sign in|sign up|register|search|"
              r"share|skip to content|read more|back to top|next page|previous page)[ \t.>»]*$")


def repeat_words(hashes: Column, keys: Column) -> Column:
    """Words inside five-word windows that occur twice or more.

    ``keys`` has one 64-bit key per window (see ``window_keys``); windows of one
    text are the same if their keys are. Linear unless a key repeats.
    """
    at = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    same = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))),
                      lambda x, y: F.when(x["k"] == y["k"], F.array(x["i"], y["i"])))
    pos = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda p: p.isNotNull()))))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(-5).alias("at"))
    covered = F.aggregate(pos, zero, lambda z, p: F.struct(
        (z["sum"] + F.least(F.lit(5), p - z["at"])).alias("sum"), p.alias("at")))["sum"]
    alone = (F.size(hashes) < 6) | (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(alone, F.lit(0)).otherwise(covered).cast("long")


def window_keys(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds one key per five-word window, from keys of two and of four words."""
    h, n = F.col(hashes), F.size(hashes)
    rest = lambda a, k: F.slice(a, k, F.greatest(n - (k - 1), F.lit(0)))
    pair = lambda a, b: F.xxhash64(a, b)
    df = df.withColumn("__k2", F.zip_with(h, rest(h, 2), pair))
    df = df.withColumn("__k4", F.zip_with("__k2", rest(F.col("__k2"), 3), pair))
    # zip_with pads to the longer side: keep the whole windows only
    keys = F.slice(F.zip_with("__k4", rest(h, 5), pair), 1, F.greatest(n - 4, F.lit(0)))
    return df.withColumn(out, F.when(n >= 5, keys).otherwise(F.array().cast("array<bigint>"))).drop("__k2", "__k4")


def line_fails(line: Column, symbols: Column, bars: Column, boiler: Column) -> Column:
    """True for a line that punctuation, navigation or boilerplate rules reject.

    The last three say whether the whole text has a symbol, a bar or a
    boilerplate phrase at all; without one, a line is not searched for it.
    """
    ink = F.length(F.regexp_replace(line, WS + "+", ""))
    n = F.regexp_count(line, F.lit(WORD))
    n_bars = F.regexp_count(line, F.lit(BARS))
    clutter = symbols & (F.regexp_count(line, F.lit(SYMBOLS)) * 10 > ink)
    bare = ~line.endswith(".") & ~line.rlike(SENTENCE) & (n >= MIN_SENTENCE_WORDS)
    nav = (bars & (n_bars >= 2) & (n_bars * 4 >= n)) | ((F.length(line) <= 40) & line.rlike(NAVIGATION))
    return clutter | bare | nav | (boiler & has_phrase(F.lower(line)))


def has_phrase(low: Column) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(p) for p in BOILERPLATE])


def line_quality(docs: DataFrame, text: str = "text", max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """All columns of ``docs`` and ``COLUMNS``: counts, the verdict and the cleaned text.

    ``clean_text`` joins the lines that passed (blank lines stay) by newlines;
    ``kept`` is false for a document that fails a base rule or loses more than
    ``max_lost_pct`` percent of its word characters to failing lines.
    """
    return _judged(docs, text, max_lost_pct).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in COLUMNS], *COLUMNS)


def _judged(docs: DataFrame, text: str, max_lost_pct: int) -> DataFrame:
    """``row`` (the input's columns) and ``COLUMNS``."""
    base = packed(docs, text=F.col(f"`{text}`"))
    t = F.coalesce(F.col("text"), F.lit(""))
    base = base.withColumn("__w", words(F.col("text")))
    base = base.withColumn("__h", F.transform("__w", lambda x: F.xxhash64(x)))
    base = window_keys(base, "__h", "__k")
    base = base.withColumns({
        "__split": F.split(t, "\n"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "__bars": t.rlike(BARS),
        "__boiler": has_phrase(F.lower(t)),
    })
    inked = F.filter("__split", lambda x: x.rlike(WORD))
    base = base.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_dup_lines": (F.size(inked) - F.size(F.array_distinct(inked))).cast("long"),
        "n_repeat_words": repeat_words(F.col("__h"), F.col("__k")),
        "__lines": F.transform("__split", lambda x: F.struct(x.alias("line"), (
            x.rlike(WORD) & line_fails(x, F.col("n_symbols") > 0, F.col("__bars"), F.col("__boiler"))).alias("bad"))),
    })
    bad = F.filter("__lines", lambda x: x["bad"])
    out = base.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT),
        "n_lines": F.size("__lines").cast("long"),
        "n_failed_lines": F.size(bad).cast("long"),
        "lost_chars": F.length(F.regexp_replace(
            F.array_join(F.transform(bad, lambda x: x["line"]), ""), WS + "+", "")).cast("long"),
        "clean_text": F.array_join(F.transform(F.filter("__lines", lambda x: ~x["bad"]), lambda x: x["line"]), "\n"),
    })
    out = out.withColumn("kept", ~F.col("base_failed")
                         & (F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost_pct))
    return out.select("row", *COLUMNS)


def accepted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The kept documents with their cleaned text (and its length), in the input's columns."""
    # the row number keeps the filter above the projections: pushed below, it would repeat their
    # expressions, and inside lambdas once per element
    out = _judged(docs, text, MAX_LOST_PCT).withColumn("__n", F.monotonically_increasing_id())
    out = out.filter(F.col("kept") & (F.col("__n") >= 0))
    changed = {text: F.col("clean_text")}
    if n_chars in docs.columns:
        changed[n_chars] = F.length("clean_text").cast(docs.schema[n_chars].dataType)
    return unpacked(out, docs.columns, **changed)


def quality_digest(docs: DataFrame) -> DataFrame:
    out = line_quality(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_lines", "n_failed_lines", "lost_chars")


_BOILER_SQL = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
ORACLE = rf"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
      string_split(text, chr(10)) AS lines FROM t),
g AS (SELECT rid, unnest(range(0, len(ws) - 4)) AS i, ws FROM w WHERE len(ws) >= 5),
gk AS (SELECT rid, i, array_to_string(ws[i + 1:i + 5], ' ') AS k FROM g),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM gk),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep WHERE c > 1) GROUP BY rid),
l0 AS (SELECT rid, unnest(lines) AS line FROM w),
l1 AS (SELECT rid, line, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n,
       length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS ink,
       length(line) - length(regexp_replace(line, '{SYMBOLS}', '', 'g')) AS sym,
       length(line) - length(regexp_replace(line, '{BARS}', '', 'g')) AS bars,
       lower(line) AS low FROM l0),
l2 AS (SELECT *, n > 0 AND (sym * 10 > ink OR (n >= {MIN_SENTENCE_WORDS} AND NOT regexp_matches(line, '{SENTENCE}'))
       OR (bars * 4 >= n AND bars >= 2) OR (length(line) <= 40 AND regexp_matches(line, '{NAVIGATION}')) OR {_BOILER_SQL}) AS bad FROM l1),
l3 AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (bad) AS n_failed_lines,
       coalesce(sum(ink) FILTER (bad), 0)::BIGINT AS lost_chars,
       count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines FROM l2 GROUP BY rid),
o AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
      n_dup_lines::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
      n_lines, n_failed_lines, lost_chars
      FROM w JOIN l3 USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND lost_chars * 100 <= word_chars * {MAX_LOST_PCT}) AS kept,
       n_lines, n_failed_lines, lost_chars FROM b
"""

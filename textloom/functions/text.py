"""Column -> Column text functions.

All functions are built from Spark SQL expressions so they stay inside
whole-stage codegen. Character classes are spelled out explicitly so that
Java regex (Spark) and RE2 (the SQL oracle) agree with Python's Unicode
``\\s`` / ``\\w`` on the data we process.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
# Python's str whitespace set (re ``\s`` on str), as a character class body.
WS = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Python's ``\w`` on str: letters, digits/numbers, underscore.
WORD = r"\p{L}\p{N}_"
# Word token of a default TF-IDF vectorizer: a run of two or more word chars.
TOKEN = rf"[{WORD}]{{2,}}"
# Stop words of the interactive loops (matched after strip, case-folded).
EXIT_WORDS = ("exit", "quit", "q")
# --------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Collapse whitespace runs to one space, then strip."""
    return F.trim(F.regexp_replace(_c(c), f"[{WS}]+", " "))


def strip_tags(c: Column | str) -> Column:
    """Remove ``<...>`` spans (non-greedy); applied after :func:`squeeze`."""
    return F.regexp_replace(_c(c), "<.*?>", "")


def strip_edges(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), f"^[{WS}]+|[{WS}]+$", "")


def clean_text(c: Column | str) -> Column:
    """null/empty -> ''; non word/space/hyphen -> space; squeeze; strip; lower."""
    x = F.coalesce(_c(c), F.lit(""))
    x = F.regexp_replace(x, f"[^{WORD}{WS}-]", " ")
    x = F.trim(F.regexp_replace(x, f"[{WS}]+", " "))
    return F.lower(x)


def strip_trailing(c: Column | str, chars: str = ".") -> Column:
    """Strip all trailing characters from ``chars`` (``rstrip``)."""
    return F.rtrim(_c(c), F.lit(chars))


def contains_ci(c: Column | str, needle: str) -> Column:
    """Case-folded substring test."""
    return F.lower(_c(c)).contains(needle.lower())


def in_ci(c: Column | str, values: Iterable[str]) -> Column:
    """Case-folded membership."""
    return F.lower(_c(c)).isin([v.lower() for v in values])


def template(text: str, c: Column | str) -> Column:
    """Fill the single ``{}`` slot of ``text`` with a column."""
    if "{}" not in text:
        return F.lit(text)
    head, tail = text.split("{}", 1)
    parts = [p for p in (F.lit(head) if head else None, _c(c), F.lit(tail) if tail else None)
             if p is not None]
    return F.concat(*parts)


def or_default(c: Column | str, value) -> Column:
    """C11: default for a missing field."""
    return F.coalesce(_c(c), F.lit(value))


def or_empty_array(c: Column | str) -> Column:
    """C11 for arrays: null -> empty array of strings."""
    return F.coalesce(_c(c), F.array().cast("array<string>"))


def label_suffix(c: Column | str) -> Column:
    """Integer after the last ``_`` (``LABEL_17`` -> 17)."""
    return F.substring_index(_c(c), "_", -1).cast("int")


def first_or_null(c: Column | str) -> Column:
    """First element of a non-empty array, else null."""
    a = _c(c)
    return F.when(F.size(a) > 0, a.getItem(0))


def clean_array(c: Column | str) -> Column:
    """:func:`clean_text` over every element (null array -> empty)."""
    return F.transform(or_empty_array(c), lambda x: clean_text(x))


def combined_text(*cols: Column | str) -> Column:
    """Join fields with a space, clean again."""
    return clean_text(F.concat_ws(" ", *[_c(c) for c in cols]))


def not_blank(c: Column | str, stop_words: Sequence[str] = EXIT_WORDS) -> Column:
    """C13 predicate: stripped text non-empty and not a stop word."""
    s = strip_edges(c)
    return (s != "") & ~F.lower(s).isin([w.lower() for w in stop_words])


def drop_blank(df, query: str, stop_words: Sequence[str] = EXIT_WORDS):
    """Drop blank and exit-word queries."""
    return df.filter(not_blank(query, stop_words))


def tokens(c: Column | str) -> Column:
    """K1: lowercase word tokens (runs of >= 2 word characters)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN), 0)


def ngram_array(toks: Column, n: int) -> Column:
    """Word n-grams of one order as an array (empty when too short)."""
    if n == 1:
        return toks
    k = F.size(toks) - n
    grams = F.transform(F.sequence(F.lit(0), k),
                        lambda i: F.array_join(F.slice(toks, i + 1, n), " "))
    return F.when(k >= 0, grams).otherwise(F.array().cast("array<string>"))


def ngrams_of_tokens(toks: Column | str, min_n: int = 1, max_n: int = 3) -> Column:
    """K2: all word n-grams of orders ``min_n..max_n`` of a token-array column.

    Pass a column *reference*: lambdas re-evaluate any expression they
    capture once per element.
    """
    t = _c(toks)
    return F.concat(*[ngram_array(t, n) for n in range(min_n, max_n + 1)])


def l2_normalize(c: Column | str) -> Column:
    """H3: L2-normalise a numeric array (double); a zero vector stays zero."""
    v = F.transform(_c(c), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)

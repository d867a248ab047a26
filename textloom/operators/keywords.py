"""Keyword fallback by a table of any number of keywords.

``catalog.keyword_command`` folds a short list into one CASE. Here the keywords are
rows. Each is looked for through one of its grams, the one that the texts hold least
often: texts and keywords meet by an equi-join on that gram, a pair is kept if the
text contains the keyword, and the first keyword in list order wins.

A gram is a run of q bytes of UTF-8, at most 8, and so one integer; a keyword's q is the largest
of ``SIZES`` that it is long enough for. Texts are read by NumPy where they are. Of their grams, only those
go to a shuffle whose cell, one of ``CELLS`` by a hash, a keyword waits for: the cells are a bitmap of fixed size
that is broadcast.

Only the first keyword of a text counts, so keywords are looked for in rounds, in list order: each has ``GROWTH`` times as many
as the one before, and a text with a hit is left out of the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom import defaults as D
from textloom.operators.blocked import arrow_schema
from textloom.operators.rank import global_rank
from textloom.session import saved

SIZES = (8, 5, 3, 2, 1)
CELLS = 1 << 24
FIRST_KEYWORDS = 1_024     # of the first round
GROWTH = 8
PIECE_BYTES = 1 << 17      # text read at once; a longer text is a piece of its own


def _cell(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64)


def _grams(texts: pa.Array, sizes: list[int], bitmap: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, gram, q) of the places in ``texts`` (no nulls) whose gram's cell is in the bitmap. The empty
    gram of q = 0 is in every text."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE_BYTES, "right")) - 1)
        n = np.diff(at[i:j + 1])
        if 0 in sizes:
            yield np.arange(i, j), np.zeros(j - i, np.uint64), 0
        buf, row = data[at[i]:at[j]], np.repeat(np.arange(i, j, dtype=np.int32), n)
        left = np.repeat(at[i + 1:j + 1], n) - np.arange(at[i], at[j])
        code = np.zeros(len(buf), np.uint64)
        for q in range(1, min(max(sizes), len(buf)) + 1):
            code = code[:len(buf) - q + 1]
            code |= buf[q - 1:].astype(np.uint64) << np.uint64(8 * (q - 1))
            if q not in sizes:
                continue
            gram = code if q == 8 else code | np.uint64(q << 56)
            keep = left[:len(gram)] >= q                        # not across texts
            if bitmap is not None:
                cell = _cell(gram)
                keep &= (bitmap[cell >> 6] >> (cell & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield row[:len(gram)][keep], gram[keep], q
        i = j


def prepared(keywords: DataFrame, keyword: str, command: str, order: str) -> DataFrame:
    """One row per case-folded keyword: its q and the (order, command) that comes first."""
    kw = keywords.filter(F.col(keyword).isNotNull()).groupBy(F.lower(keyword).alias("_kw")).agg(
        F.min(F.struct(F.col(order).alias("o"), F.col(command).alias("c"))).alias("_first"))
    q = F.lit(0)
    for size in reversed(SIZES):
        q = F.when(F.octet_length("_kw") >= size, size).otherwise(q)
    return kw.withColumn("_q", q)


def _keyword_grams(kw: DataFrame) -> DataFrame:
    """(_kw, _gram, _cell): the distinct grams of each keyword's own q."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = np.asarray(b.column("_q"))
            for row, gram, q in _grams(b.column("_kw"), [0, *SIZES]):
                mine = own[row] == q
                row, gram = row[mine], gram[mine]
                yield pa.RecordBatch.from_arrays([b.column("_kw").take(pa.array(row)), pa.array(gram.view(np.int64)), pa.array(_cell(gram))],
                                                 ["_kw", "_gram", "_cell"])

    return kw.select("_kw", "_q").mapInArrow(run, "_kw string, _gram long, _cell long").distinct()


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The cells of the grams, one bit each: ``CELLS`` bits however many grams there are."""
    bit = F.expr("shiftleft(1L, cast(_cell % 64 AS int))")
    rows = grams.groupBy(F.shiftright("_cell", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(CELLS // 64, np.uint64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _gram_counts(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(_gram, _n): how often texts hold a gram, of those in the cells of ``grams``."""
    held = texts.sparkSession.sparkContext.broadcast(_bitmap(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, gram, _ in _grams(b.column("_text"), sizes, held.value):
                gram, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], ["_gram", "_n"])

    return texts.select("_text").mapInArrow(run, "_gram long, _n long").groupBy("_gram").agg(F.sum("_n").alias("_n"))


def _held_grams(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(_k, _gram): the distinct grams of each text in the cells of ``grams``."""
    held = texts.sparkSession.sparkContext.broadcast(_bitmap(grams))
    schema = arrow_schema(texts.select("_k", F.lit(0).cast("long").alias("_gram")).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, gram, _ in _grams(b.column("_text"), sizes, held.value):
                order = np.lexsort((gram, row))
                row, gram = row[order], gram[order]
                new = np.r_[True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])][:len(row)]
                yield pa.RecordBatch.from_arrays([b.column("_k").take(pa.array(row[new])), pa.array(gram[new].view(np.int64))], schema=schema)

    return texts.select("_k", "_text").mapInArrow(run, "_k string, _gram long")


def keyword_hits(texts: DataFrame, kw: DataFrame) -> DataFrame:
    """(_k, _first): the first keyword that each text of (_k, _text) contains; texts without one are absent."""
    sizes = sorted(r["_q"] for r in kw.select("_q").distinct().collect())        # at most len(SIZES) + 1 rows
    if not sizes:
        return kw.select(F.lit("").alias("_k"), "_first").filter("false")
    wanted = saved(_keyword_grams(kw), "keyword-grams")
    rarest = wanted.join(_gram_counts(texts, wanted, sizes), "_gram", "left").groupBy("_kw").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"), F.col("_cell").alias("cell"))).alias("_a"))
    # a keyword with a gram that no text holds is in no text
    anchors = rarest.filter("_a.n > 0").join(kw, "_kw").select(
        F.col("_a.gram").alias("_gram"), F.col("_a.cell").alias("_cell"), "_kw", "_first")
    anchors = saved(global_rank(anchors, [F.col("_first"), F.col("_kw")], "_r"), "keyword-anchors")
    n, at, size, hits = anchors.count(), 0, FIRST_KEYWORDS, None
    while hits is None or at < n:
        done = saved(_round(texts, anchors.filter((F.col("_r") > at) & (F.col("_r") <= at + size)).drop("_r"), sizes), "keyword-round")
        found = done.filter("_first IS NOT NULL").select("_k", "_first")
        hits = found if hits is None else hits.union(found)
        texts = done.filter("_first IS NULL").select("_k", "_text")
        at, size = at + size, size * GROWTH
    return hits


def _round(texts: DataFrame, anchors: DataFrame, sizes: list[int]) -> DataFrame:
    """(_k, _first, _text): the first of the anchors' keywords that each text contains; or none, and the text."""
    pairs = _held_grams(texts, anchors, sizes).join(anchors, "_gram").select("_k", F.struct("_kw", "_first").alias("_c"))
    # a text's candidates go to the text, so it moves once
    near = texts.join(pairs.groupBy("_k").agg(F.collect_list("_c").alias("_c")), "_k", "left")
    found = F.transform(F.filter("_c", lambda c: F.contains(F.col("_text"), c["_kw"])), lambda c: c["_first"])
    return near.select("_k", F.array_min(found).alias("_first"), "_text").withColumn("_text", F.when(F.col("_first").isNull(), F.col("_text")))


def keyword_table_fallback(df: DataFrame, query: str, keywords: DataFrame, keyword: str = "keyword", command: str = "command",
                           order: str = "pos", hit: float = D.FALLBACK_HIT_SCORE, default: str = D.FALLBACK_NONE,
                           out: str = "command", score: str = "score") -> DataFrame:
    """``df`` with the command of the first keyword (smallest ``order``) that the case-folded query
    contains and the score ``hit``; none, or a null query: ``default`` and 0.0.

    Of equal keywords the first in order counts; null keywords are left out; the empty keyword is in
    every query. Equal queries are looked up once."""
    key = F.md5(F.lower(F.col(query)))
    texts = saved(df.filter(F.col(query).isNotNull()).groupBy(key.alias("_k")).agg(F.first(F.lower(query)).alias("_text")), "keyword-texts")
    hits = saved(keyword_hits(texts, saved(prepared(keywords, keyword, command, order), "keywords")), "keyword-hits")
    got = df.withColumn("_k", key).join(hits, "_k", "left")
    found = F.col("_first").isNotNull()
    return got.withColumns({out: F.when(found, F.col("_first.c")).otherwise(F.lit(default)),
                            score: F.when(found, F.lit(hit)).otherwise(F.lit(0.0))}).drop("_k", "_first")

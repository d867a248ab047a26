"""Shared helpers: reading tables, saving intermediates, hashed words of Arrow text columns.

``WS`` is the word separator class of every operator here: a word is a maximal
run of characters outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import shared_path, ship_package

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
PIECE = 1 << 20                       # bytes hashed at once
_ODD = 0x9E3779B97F4A7C17
_M64 = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the folder, by Spark's reader (any store Spark reaches)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the cluster's shared folder and read it back.

    Cuts lineage: later jobs (and recomputed tasks) start from the written table.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """``row`` (all columns of ``docs``) and the columns given: no name of the input can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The input's columns again, some of them replaced."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in columns])


def row_key(*cols: Column) -> Column:
    """96 bits of the values (nulls too): rows equal in all of them share it, whatever their ids are."""
    parts = [x for c in cols for x in (c, c.isNull())]
    return F.struct(F.xxhash64(*parts).alias("a"), F.hash(*parts).alias("b"))


def first_by_hash(ids: DataFrame, group: str, n: Column | int, id_col: str = "doc_id") -> DataFrame:
    """The ``n`` distinct ids of each group that a hash orders first, as (id, group).

    Cells of the hash are counted; whole cells before the one that holds the n-th id are
    taken, and only ids up to that cell are ranked: about n and a 65,536th of a group, so a
    group with a third of all rows is no task's work."""
    h = F.xxhash64(id_col)
    ids = ids.select(id_col, group).distinct().withColumn("_cell", F.shiftright(h, 48))
    cells = ids.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    until = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)     # 65,536 cells at most
    last = (cells.withColumn("_before", F.coalesce(F.sum("_n").over(until), F.lit(0))).filter(F.col("_before") < n)
            .groupBy(F.col(group).alias("_g")).agg(F.max("_cell").alias("_last")))
    near = ids.join(last, (F.col(group) == F.col("_g")) & (F.col("_cell") <= F.col("_last"))).select(id_col, group)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(h, id_col))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= n).select(id_col, group)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WS + "+"))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


# ---- hashed words (NumPy inside tasks) ---------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _table(fold: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64))
    if fold:
        t[65:91] = t[97:123]
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = {True: _table(True), False: _table(False)}
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        with np.errstate(over="ignore"):
            inv = pow(_ODD, -1, 1 << 64)
            up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _ODD, np.uint64)], dtype=np.uint64)
            down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inv, np.uint64)], dtype=np.uint64)
        _POW[:] = [up, down]
    return _POW[0], _POW[1]


def word_bounds(buf: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in ``buf``; a new text begins at each offset of ``firsts``."""
    ink = ~_SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[firsts] = True
    cut[0] = cut[-1] = True
    start = np.flatnonzero(ink & (cut[:-1] | np.r_[True, ~ink[:-1]]))
    end = np.flatnonzero(ink & (cut[1:] | np.r_[~ink[1:], True])) + 1
    return start, end


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each word (ASCII letters lower-cased if ``fold``): a polynomial of byte
    values by prefix sums, then mixed. Only the word's bytes matter, not its place."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(len(buf), PIECE))
    with np.errstate(over="ignore"):
        s = np.r_[np.uint64(0), np.cumsum(_BYTE[fold][buf] * up[:len(buf)], dtype=np.uint64)]
        h = (s[end] - s[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(_ODD))


def text_pieces(col: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of texts of about ``size`` bytes.

    A longer text is a run of its own, whole. Nulls are empty texts. No copy is made.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    n = len(col)
    if not n:
        return
    if col.null_count:
        col = col.fill_null("")
    raw = col.buffers()
    offs = np.frombuffer(raw[1], kind, n + 1 + col.offset)[col.offset:].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def hashed_texts(col: pa.Array, fold: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, word hashes, word offsets per text) of runs of texts."""
    for i, j, buf, offs in text_pieces(col):
        if len(buf) <= 4 * PIECE:
            start, end = word_bounds(buf, offs[:-1][offs[:-1] < len(buf)])
            yield i, j, word_hashes(buf, start, end, fold), np.searchsorted(start, offs)
            continue
        parts, at = [], 0              # one very long text, cut at separators
        while at < len(buf):
            to = min(at + PIECE, len(buf))
            while to < len(buf) and not _SPACE[buf[to]]:
                to += 1
            start, end = word_bounds(buf[at:to], np.zeros(0, np.int64))
            parts.append(word_hashes(buf[at:to], start, end, fold))
            at = to
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        yield i, j, h, np.array([0, len(h)])


def shingle_hashes(h: np.ndarray, width: int = 5) -> np.ndarray:
    """Hash of each window of ``width`` words; a shorter text is one window; no words, none."""
    if not len(h):
        return h
    k = min(width, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            out = out * np.uint64(_ODD) + h[j:len(h) - k + 1 + j]
            out ^= out >> np.uint64(29)
    return mix(out)

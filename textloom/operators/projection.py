"""A fitted text encoder: sparse random projection of IDF-weighted words to dense vectors.

Every word falls into one of ``BUCKETS`` cells by md5; the fit is the smooth idf of each cell, a
table of fixed size however large the vocabulary is. A word adds its idf, with signs by md5, to
``PARTS`` of the dimensions; a text is the normalised sum over its words. Dot products of such
vectors approximate those of the TF-IDF vectors they stand for.

The model is saved as Parquet, read back and broadcast (``BUCKETS`` numbers); ``vectors.embed``
applies it to Arrow batches. All choices are digits of md5, so any engine gives the same numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import tokens
from textloom.operators import grams, vectors

BUCKETS = 1 << 16
PARTS = 4                 # md5 has 32 hex digits: 4 for the cell of a word, 7 for each part
REMEMBERED = 200_000      # words a worker remembers before it starts anew


def word_bucket(word: Column) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int")


def fit_projection(docs: DataFrame, text: str) -> DataFrame:
    """(bucket, df, idf, n): of the cells that hold a word of ``docs``; null texts hold none but are counted."""
    n = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for held in grams.cell_rows(b.column("words"), BUCKETS, memory):
                total += held
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(total[bucket])], ["bucket", "df"])

    # a task counts the cells of its texts: at most BUCKETS rows of each go on
    cells = docs.select(tokens(text).alias("words")).mapInArrow(run, "bucket int, df long")
    counted = cells.groupBy("bucket").agg(F.sum("df").alias("df"))
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0
    return counted.select("bucket", "df", idf.alias("idf"), F.lit(n).cast("long").alias("n"))


def save_projection(fit: DataFrame, path: str, mode: str = "error") -> str:
    fit.write.mode(mode).parquet(path)
    return path


def load_projection(spark: SparkSession, path: str) -> np.ndarray:
    """The idf of each cell (at most ``BUCKETS`` rows); a cell without words of the fit has that of df = 0."""
    rows = spark.read.parquet(path).select("bucket", "idf", "n").toPandas()
    out = np.full(BUCKETS, np.log(1.0 + (rows["n"].iloc[0] if len(rows) else 0)) + 1.0)
    out[rows["bucket"].to_numpy(np.int64)] = rows["idf"]
    return out


def _parts(word: str, dims: int) -> tuple[int, list[int], list[float]]:
    digits = hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()
    drawn = [int(digits[4 + 7 * p:11 + 7 * p], 16) for p in range(PARTS)]
    return int(digits[:4], 16), [(x >> 1) % dims for x in drawn], [1.0 - 2.0 * (x & 1) for x in drawn]


def projection_encoder(spark: SparkSession, idf: np.ndarray, dims: int) -> Callable[[Sequence[Sequence[str]]], np.ndarray]:
    """The function of a batch of word lists that :func:`vectors.embed` applies."""
    held = spark.sparkContext.broadcast(idf)
    memory: dict[str, tuple[int, list[int], list[float]]] = {}

    def encode(batch: Sequence[Sequence[str]]) -> np.ndarray:
        idf = held.value
        sizes = [0 if t is None else len(t) for t in batch]
        flat = np.concatenate([np.asarray(t, object) for t, n in zip(batch, sizes, strict=True) if n] or [np.zeros(0, object)])
        out = np.zeros((len(sizes), dims))
        if not len(flat):
            return out
        code, words = pd.factorize(flat)
        if len(memory) > REMEMBERED:
            memory.clear()
        parts = []
        for w in words:
            if w not in memory:
                memory[w] = _parts(w, dims)
            parts.append(memory[w])
        weight = idf[np.array([p[0] for p in parts])]
        place, sign = np.array([p[1] for p in parts]), np.array([p[2] for p in parts])
        row = np.repeat(np.arange(len(sizes)) * dims, sizes)
        signed = sign * weight[:, None]
        for p in range(PARTS):
            np.add.at(out.reshape(-1), row + place[code, p], signed[code, p])
        norm = np.sqrt((out * out).sum(1))
        return out / np.where(norm > 0, norm, 1.0)[:, None]

    return encode


def project(df: DataFrame, id_col: str, text: str, idf: np.ndarray, dims: int = 64, out: str = "embedding") -> DataFrame:
    """H2: (id, vector of doubles) of every row; a text without words, null too, is a zero vector."""
    words = df.select(id_col, F.coalesce(tokens(text), F.array().cast("array<string>")).alias("_words"))
    return vectors.embed(words, id_col, "_words", projection_encoder(df.sparkSession, idf, dims), out, T.DoubleType())

"""Periodic runs of words by dyadic square catching.

A square is a stretch of words followed at once by its copy. Level k keeps a catcher
for every completed block of ``2^k`` words: it waits for the block's copy at each
distance q in ``[2^(k+1) - 1, 2^(k+2) - 2]`` (level 1 from distance 1). A square of
period q holds a whole block of its level, so a catcher sees it. When the copy
arrives, suffix comparisons (windows of ``2^(k-1), ..., 1`` words by their hashes, to
both sides) give the longest stretch in which words q apart are equal; squares of
neighbouring catchers that overlap merge into one stretch, and a stretch of at least
q matches is a run of period q. A run of period q that is also one of a smaller
period covers the same words, so the smallest period of equal stretches is kept.

The words of a batch of documents are appended at once: every comparison of a level
is one array operation over all its catchers, about two per word and level. A mark
of its own ends each document, so no stretch leaves it. One document is one task's
work: 8 bytes a word for each of its ``log2`` levels.

Defined results: null, empty and blank texts have no words and no runs; their digests
are those of the empty string. Null and repeated doc_ids are rows of their own. An
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import PIECE, mix, text_pieces, word_bounds, word_hashes, words

SHORTEST = 12              # words of the shortest run
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.uint8(32)
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def catch_squares(marks: np.ndarray, longest: int, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs in ``marks`` (one hash a word), ordered by start, then
    period. No stretch of equal words may be longer than ``longest``."""
    top = 1
    while 4 << top <= longest + 2:         # the level's smallest period, 2 * 2^k - 1, may still repeat
        top += 1
    tail = mix(np.arange(1, (8 << top) + 1, dtype=np.uint64) * _ODD ^ np.uint64(0x5BD1E995))
    n = len(marks)
    level = [np.concatenate([marks, tail])]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(1, top + 1):
        half, block = 1 << (k - 1), 1 << k
        last = level[-1]
        with np.errstate(over="ignore"):
            level.append(mix(last[:-half] * _ODD + last[half:]))
        found.append(_merged(level, k, block, n))
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = end - start >= np.maximum(shortest - period, period)
    start, period, length = start[keep], period[keep], (end - start + period)[keep]
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    first = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, period, length = start[first], period[first], length[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _merged(level: list[np.ndarray], k: int, block: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, distance) of the longest stretches of matches that level k's catchers see."""
    least = 1 if k == 1 else 2 * block - 1
    width = 4 * block - 1 - least
    here = level[k]
    catchers = -(-n // block)
    at, distance = np.nonzero(sliding_window_view(here[least:], width)[:catchers * block:block]
                              == here[:catchers * block:block, None])
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    new = np.r_[True, (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + 1)][:len(at)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)][:len(first)] - 1
    start, end, q = at[first] * block, (at[last] + 1) * block, distance[first] + least
    for j in range(k - 1, -1, -1):
        step, part = 1 << j, level[j]
        end += step * (part[end] == part[end + q])
        back = np.maximum(start - step, 0)
        start -= step * ((start >= step) & (part[back] == part[back + q]))
    return start, end, q


def _bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word; a very long text is cut at separators."""
    if len(buf) <= 4 * PIECE:
        start, end = word_bounds(buf, offs[:-1][offs[:-1] < len(buf)])
        return start, end, word_hashes(buf, start, end, fold=False)
    parts, at = [], 0
    while at < len(buf):
        to = min(at + PIECE, len(buf))
        while to < len(buf) and not (buf[to] == 32 or 9 <= buf[to] <= 13):
            to += 1
        start, end = word_bounds(buf[at:to], np.zeros(0, np.int64))
        parts.append((start + at, end + at, word_hashes(buf[at:to], start, end, fold=False)))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _collapsed(buf: np.ndarray, offs: np.ndarray, start: np.ndarray, end: np.ndarray, kept: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by single spaces."""
    start, end = start[kept], end[kept]
    step = np.zeros(len(buf) + 2, np.int8)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    ink = np.cumsum(step, dtype=np.int8)[:len(buf)].astype(bool)
    gap = np.zeros(len(buf) + 1, bool)
    gap[end] = True                        # the separator behind a kept word
    gap = gap[:-1] & ~ink
    text_ends = offs[1:-1]
    out = np.where(ink, buf, _SPACE)[ink | gap]
    cut = np.r_[0, np.cumsum(ink | gap)]
    # a word that ends its text has no separator of its own in it: what follows is the next text
    raw, res = out.tobytes(), []
    owed = set(text_ends.tolist())
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        lo, hi = int(cut[a]), int(cut[b])
        if a in owed and a < len(buf) and gap[a] and hi > lo and _ends_here(end, a):
            lo += 1
        res.append(raw[lo:hi].removesuffix(b" "))
    return res


def _ends_here(end: np.ndarray, at: int) -> bool:
    """Whether a kept word ends just before byte ``at`` (the first of a text)."""
    i = int(np.searchsorted(end, at))
    return i < len(end) and end[i] == at


def _digest(s: bytes) -> str:
    return hashlib.sha256(s).hexdigest()


def _piece(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple]:
    """(n_runs, start, length, period, exponent_milli, runs, collapsed) of each text."""
    start, end, h = _bounds(buf, offs)
    first = np.searchsorted(start, offs)                   # a text's first word
    n = np.diff(first)
    texts = len(n)
    owner = np.repeat(np.arange(texts), n)
    place = np.arange(len(h)) + owner                      # its place among the marks
    marks = mix(np.arange(1, len(h) + texts + 1, dtype=np.uint64) * _ODD ^ np.uint64(0xC2B2AE35))
    marks[place] = h
    s, length, q = catch_squares(marks, int(n.max(initial=0)))
    base = first[:-1] + np.arange(texts)
    of = np.searchsorted(base, s, "right") - 1
    drop = np.zeros(len(marks) + 1, np.int64)
    np.add.at(drop, s + q, 1)
    np.add.at(drop, s + length, -1)
    kept = np.cumsum(drop)[place] == 0
    joined = _collapsed(buf, offs, start, end, kept)
    rows = np.searchsorted(of, np.arange(texts + 1))
    for d in range(texts):
        mine = slice(rows[d], rows[d + 1])
        a, size, p = (s[mine] - base[d]).tolist(), length[mine].tolist(), q[mine].tolist()
        listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(a, size, p, strict=True)).encode()
        if a:
            y, x, z = min((-y, x, z) for x, y, z in zip(a, size, p, strict=True))
            yield len(a), x, -y, z, 1000 * -y // z, listed, joined[d]
        else:
            yield 0, None, None, None, None, listed, joined[d]


def word_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, the number of runs, the longest run (ties: smallest start, then period),
    and the digests of all runs and of the text without the words that a run repeats."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for _, _, buf, offs in text_pieces(b.column("text")):
                for row in _piece(buf, offs):
                    for values, v in zip(out, (*row[:5], _digest(row[5]), _digest(row[6])), strict=True):
                        values.append(v)
            long = [pa.array(x, pa.int64()) for x in out[:5]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *long, *[pa.array(x, pa.string()) for x in out[5:]]],
                                             [f.split()[0] for f in SCHEMA.split(", ")])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return src.mapInArrow(job, SCHEMA)


def repeating(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text): the words of a tenth of the documents repeat from a place on, as the contract
    of the query says; other texts are as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    ws = F.when((h % 10 == 0) & F.col(f"`{text}`").isNotNull(), words(F.col(f"`{text}`")))
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), ws.alias("ws"),
                    F.floor(h / 10).cast("long").alias("g"))
    x = x.withColumn("n", F.size("ws")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    x = x.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    word = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), lambda i: F.get(
        F.col("ws"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return x.select("doc_id", F.when(F.col("n") > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


def runs_digest(docs: DataFrame) -> DataFrame:
    return word_runs(repeating(docs))

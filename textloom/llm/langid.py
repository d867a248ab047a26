"""Language identification of mixed text: script ranges, word scores, Viterbi over words.

Learning counts byte trigrams (word edges included, ASCII folded) per language
over a bounded sample of labelled documents, ``FIT_ROWS`` per language, and
notes which scripts each language is written in. A word's script leaves the
languages that use it; its score for each is the mean-corrected log probability
of its trigrams; Viterbi with a switching penalty labels every word of the
whole text. A document's language is the one with most bytes of words.

The model is (languages x BUCKETS) floats, 256 KB a language, and is the only
thing sent to the tasks. Texts never move: scoring is one pass without shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with no labelled row every text is ``und``; a null doc_id is scored, counts as
not held out and is not learned from; ties go to the smaller language; repeated
rows are alike; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import first_by_hash, saved, text_pieces, word_bounds

FIT_ROWS = 4000            # labelled documents per language
BUCKETS = 1 << 16
SWITCH = 12.0              # nats that a change of language costs
SCRIPT_SHARE = 0.01        # of a language's letters, for the script to be one of its own
PIECE_BYTES = 4 << 20
UNKNOWN = "und"

# Script by UTF-8 lead byte (fixed values): first byte, last byte, script.
SCRIPTS = ((0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD4, 3), (0xD5, 0xD5, 4),
           (0xD6, 0xD7, 5), (0xD8, 0xDD, 6), (0xDE, 0xDF, 7), (0xE0, 0xE0, 8), (0xE1, 0xE1, 9), (0xE3, 0xE3, 10),
           (0xE4, 0xE9, 11), (0xEA, 0xED, 12))
# Lead bytes that letters share with punctuation and symbols are decoded: first letter, last letter, script.
# Other letters there: the rest of the basic plane one script, each 512 code points above it one.
DECODED = (0xC2, 0xCB, 0xCC, 0xE2, 0xEE, 0xEF, 0xF0, 0xF1, 0xF2, 0xF3, 0xF4)
RANGES = ((0x80, 0x33F, 1), (0x2000, 0x2BFF, 1), (0x2C00, 0x2C5F, 13), (0x2C60, 0x2C7F, 1), (0x2C80, 0x2CFF, 14),
          (0x2D00, 0x2D2F, 9), (0x2D30, 0x2D7F, 15), (0x2D80, 0x2DDF, 9), (0xF900, 0xFAFF, 11), (0xFB00, 0xFB12, 1),
          (0xFB13, 0xFB1C, 4), (0xFB1D, 0xFB4F, 5), (0xFB50, 0xFEFF, 6), (0xFF00, 0xFF65, 1), (0xFF66, 0xFF9F, 10),
          (0xFFA0, 0xFFDC, 12), (0x1AFF0, 0x1B16F, 10), (0x1D400, 0x1D7FF, 1), (0x20000, 0x3FFFF, 11))
OTHER, ABOVE = 16, 17
N_SCRIPTS = ABOVE + 128
_SCRIPT = np.zeros(256, np.uint8)
for _a, _b, _s in SCRIPTS:
    _SCRIPT[_a:_b + 1] = _s
_DECODED = np.zeros(256, bool)
_DECODED[list(DECODED)] = True
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    """Script of each letter under the decoded lead bytes, by code point; 0 for what is no letter."""
    point = np.arange(0x110000)
    out = np.where(point < 0x10000, OTHER, ABOVE + ((point >> 9) & 127)).astype(np.uint8)
    for a, b, script in RANGES:
        out[a:b + 1] = script
    out[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] != "L"]] = 0
    return out


def _scripts(buf: np.ndarray) -> np.ndarray:
    """Script of the letter that each byte begins, or 0."""
    script = _SCRIPT[buf]
    at = np.flatnonzero(_DECODED[buf])
    if len(at):
        b0, b1, b2, b3 = (buf[np.minimum(at + k, len(buf) - 1)].astype(np.int64) & 0x3F for k in range(4))
        lead = buf[at]
        point = np.where(lead < 0xE0, (b0 & 0x1F) << 6 | b1, np.where(
            lead < 0xF0, (b0 & 0x0F) << 12 | b1 << 6 | b2, (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        script[at] = _letters()[np.minimum(point, 0x10FFFF)]
    return script


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, script and first-word-per-text of the words that hold a letter."""
    start, end = word_bounds(buf, offs[:-1][offs[:-1] < len(buf)])
    if not len(start):
        return start, end, start, np.zeros(len(offs), np.int64)
    script = np.maximum.reduceat(_scripts(buf), start)
    some = script > 0
    start, end, script = start[some], end[some], script[some]
    return start, end, script, np.searchsorted(start, offs)


def _trigrams(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of the words, and each word's first place among them."""
    size = end - start
    first = np.cumsum(size) - size
    at = np.repeat(start - first, size) + np.arange(int(size.sum()))
    low = _FOLD[buf]
    mid = low[at]
    left = low[np.maximum(at - 1, 0)]
    right = low[np.minimum(at + 1, len(buf) - 1)]
    left[first] = 32
    right[first + size - 1] = 32
    key = (left << 16 | mid << 8 | right) * np.uint32(0x9E3779B1)
    return (key >> np.uint32(16)).astype(np.int64), first


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, kind, bucket, n): trigram counts (kind 0) and letters by script (kind 1) per language."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tri: dict[str, np.ndarray] = {}
        scr: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            for i, j, buf, offs in text_pieces(b.column("text")):
                for r in range(i, j):
                    part = buf[offs[r - i]:offs[r - i + 1]]
                    start, end, script, _ = _words(part, np.array([0, len(part)]))
                    if len(start):
                        key, _ = _trigrams(part, start, end)
                        tri[langs[r]] = tri.get(langs[r], 0) + np.bincount(key, minlength=BUCKETS)
                        scr[langs[r]] = scr.get(langs[r], 0) + np.bincount(script, minlength=N_SCRIPTS)
        for kind, counts in ((0, tri), (1, scr)):
            for lang, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array([kind] * len(at), pa.int32()), pa.array(at, pa.int32()),
                     pa.array(c[at].astype(np.int64))], ["lang", "kind", "bucket", "n"])

    return rows.mapInArrow(job, "lang string, kind int, bucket int, n long")


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> dict:
    """The model, from at most ``fit_rows`` documents per language that are not held out."""
    ids = docs.select("doc_id", F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = saved(first_by_hash(ids, "lang", fit_rows), "langid-rows")
    rows = docs.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text")).join(
        F.broadcast(ids), ["doc_id", "lang"], "left_semi")           # languages x fit_rows ids at most
    got = _counted(rows.select("lang", "text")).groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(got["lang"]))
    at = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    tri, scr = np.zeros((BUCKETS, len(langs))), np.zeros((N_SCRIPTS, len(langs)))
    for table, kind in ((tri, 0), (scr, 1)):
        some = (got["kind"] == kind).to_numpy()
        table[got["bucket"].to_numpy(np.int64)[some], at[some]] = got["n"].to_numpy()[some]
    logp = np.log(tri + 0.5) - np.log(tri.sum(0) + 0.5 * BUCKETS)
    uses = scr / np.maximum(scr.sum(0), 1) >= SCRIPT_SHARE
    uses[~uses.any(1)] = True                         # a script nobody uses rules nobody out
    return {"langs": langs, "logp": logp.astype(np.float32), "uses": uses}


def viterbi(score: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label per word. ``score``: (words, labels); ``first``: offset of each text's words, and the end.
    All texts advance together, the longest first, so a step is one array operation."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    n, steps = score.shape[1], int(size[0]) if len(size) else 0
    active = len(size) - np.searchsorted(size[::-1], np.arange(steps), "right")
    back = np.zeros(len(score), np.int16)             # the label a switch comes from
    moved = np.zeros((len(score), n), bool)
    best = np.zeros((len(size), n), np.float32)
    for t in range(steps):
        k = active[t]
        at = begin[:k] + t
        if t:
            prev = best[:k]
            top = prev.argmax(1)
            gain = prev[np.arange(k), top][:, None] - np.float32(switch)
            back[at] = top
            moved[at] = gain > prev
            best[:k] = np.maximum(prev, gain) + score[at]
        else:
            best[:k] = score[at]
    out = np.zeros(len(score), np.int16)
    label = best.argmax(1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        out[at] = label[:k]
        label[:k] = np.where(moved[at, label[:k]], back[at], label[:k])
    return out


def label_words(buf: np.ndarray, offs: np.ndarray, model: dict) -> tuple[np.ndarray, ...]:
    """Start, end, label of every word with a letter, and the first word of each text."""
    start, end, script, first = _words(buf, offs)
    n = len(model["langs"])
    if not len(start):
        return start, end, np.zeros(0, np.int16), first
    key, place = _trigrams(buf, start, end)
    score = np.empty((len(start), n), np.float32)
    for k in range(n):
        score[:, k] = np.add.reduceat(model["logp"][:, k][key], place)
    score -= score.max(1, keepdims=True)
    score[~model["uses"][script]] = -1e4
    return start, end, viterbi(score, first), first


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score (its share of word bytes), spans (lang, start, end in
    code points, of runs of words in one language)."""
    langs = model["langs"]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, share, spans = [UNKNOWN] * len(b), np.zeros(len(b)), [[] for _ in range(len(b))]
            letters = np.asarray(b.column("letters"))
            for i, j, buf, offs in text_pieces(b.column("text"), PIECE_BYTES):
                if not langs:
                    continue
                start, end, label, first = label_words(buf, offs, model)
                if not len(start):
                    continue
                doc = np.repeat(np.arange(j - i), np.diff(first))
                weight = np.bincount(doc * len(langs) + label, end - start, (j - i) * len(langs)).reshape(j - i, -1)
                total, top = weight.sum(1), weight.argmax(1)
                points = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)]
                edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])])
                last = np.r_[edge[1:], len(doc)] - 1
                for a, z in zip(edge, last, strict=True):
                    d, at = int(doc[a]), points[offs[doc[a]]]
                    spans[i + d].append((langs[label[a]], int(points[start[a]] - at), int(points[end[z]] - at)))
                for d in np.flatnonzero((total > 0) & letters[i:j]):
                    pred[i + d], share[i + d] = langs[top[d]], weight[d, top[d]] / total[d]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(pred), pa.array(share),
                 pa.array([[{"lang": x, "start": s, "end": e} for x, s, e in w] for w in spans], SPANS)],
                ["doc_id", "lang_pred", "score", "spans"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return src.mapInArrow(job, "doc_id long, lang_pred string, score double, "
                               "spans array<struct<lang:string,start:int,end:int>>")


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def language_digest(docs: DataFrame) -> DataFrame:
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        F.size("spans").cast("long").alias("n_spans"))

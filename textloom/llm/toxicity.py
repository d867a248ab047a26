"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult (a lexicon learned from labelled documents, by
whole words and by stems), threat, target, negation, reported speech, other. Five
small transducers read a clause's symbols; ``compose`` builds their product, and
the product machine turns each clause into matches: an insult or threat with its
weight and the states it was met in (aimed at someone, negated, reported). A
document's features add up its matches by kind; a logistic fit on the labelled
sample weighs the kinds.

Learning takes at most ``FIT_TOXIC`` + ``FIT_CLEAN`` labelled documents that are
not held out, chosen by a hash of the id, one of each group of near copies. Its
lexicon has at most ``LEXICON`` entries of 16 bytes. Scoring is one pass without shuffle.

Defined results: null and empty texts score as a text without matches; a null
doc_id is scored and not held out; several labels of a document: the highest;
no labelled rows: the fixed lists with fixed weights; repeated rows are alike;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import first_by_hash, hashed_texts, saved, shingle_hashes, text_pieces, word_hashes
from textloom.llm.langid import held_out

FIT_TOXIC, FIT_CLEAN = 4000, 8000
LEXICON = 20_000
MIN_TOXIC = 12             # distinct toxic documents of a lexicon entry
MIN_SHARE = 0.9            # of an entry's documents that are toxic, classes taken as equal
STEMS = (5, 6, 7)          # bytes
THRESHOLD = 0.7
PIECE_BYTES = 2 << 20

# Closed word classes.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting",
           "imbecile", "dumb", "ugly", "filth", "vermin", "bastard", "jerk", "fool")
THREATS = ("kill", "hurt", "beat", "shoot", "stab", "burn", "destroy", "hang", "punch", "strangle", "murder", "die")
TARGETS = ("you", "your", "you're", "u", "he", "she", "they", "them", "him", "her", "these", "those", "people")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "don't", "didn't", "won't", "without")
REPORTS = ("said", "says", "called", "quoted", "reported", "according", "alleged", "claims", "claimed", "wrote")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, N_SYMBOLS = range(7)


# ---- the grammar -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """States by number from 0 (start); ``step[state][symbol]`` is the next state; ``mark`` names
    the states that a match is marked with."""
    step: tuple[tuple[int, ...], ...]
    mark: tuple[bool, ...]


def _latch(symbol: int) -> Transducer:
    """Once the symbol is read, all that follows in the clause is marked."""
    return Transducer((tuple(int(s == symbol) for s in range(N_SYMBOLS)), (1,) * N_SYMBOLS), (False, True))


def _window(symbol: int, reach: int) -> Transducer:
    """What follows the symbol within ``reach`` words is marked."""
    step = [tuple(1 if s == symbol else 0 for s in range(N_SYMBOLS))]
    for k in range(1, reach + 1):
        step.append(tuple(1 if s == symbol else (k + 1) % (reach + 1) for s in range(N_SYMBOLS)))
    return Transducer(tuple(step), (False, *[True] * reach))


@dataclass(frozen=True)
class Machine:
    """A product of transducers: next state and mark bits by state, as arrays."""
    step: np.ndarray
    marks: np.ndarray


@lru_cache(maxsize=1)
def compose() -> Machine:
    """Target, negation, reported speech and repeated abuse, in one machine."""
    parts = (_latch(TARGET), _window(NEGATION, 3), _latch(REPORT), _latch(INSULT), _latch(THREAT))
    size = [len(p.step) for p in parts]
    states = np.array(np.unravel_index(np.arange(int(np.prod(size))), size))
    step = np.stack([np.ravel_multi_index(
        [np.array(p.step)[states[i], s] for i, p in enumerate(parts)], size) for s in range(N_SYMBOLS)], 1)
    marks = sum(np.array(p.mark)[states[i]].astype(int) << i for i, p in enumerate(parts))
    return Machine(step, marks)


# Features of a document, from its matches.
FEATURES = ("insult", "aimed insult", "negated insult", "reported insult", "repeated insult", "threat",
            "aimed threat", "negated threat", "strongest")
DEFAULT_WEIGHTS = np.array([-4.0, 2.5, 0.5, -1.5, -0.7, 0.5, 1.0, 2.0, -1.0, 1.0])


def _runs(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end of runs of letters, the clause number of each, and the first run of each text."""
    letter = _LETTER[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offs] = True
    cut[0] = cut[-1] = True
    start = np.flatnonzero(letter & (cut[:-1] | np.r_[True, ~letter[:-1]]))
    end = np.flatnonzero(letter & (cut[1:] | np.r_[~letter[1:], True])) + 1
    clause = np.cumsum(_STOP[buf] | cut[:-1])[start] if len(start) else start
    return start, end, clause, np.searchsorted(start, offs)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LETTER[39] = True                                # apostrophe
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 44, 46, 58, 59, 63]] = True


def _features(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Keys of the whole words and of each stem (0: too short for it)."""
    out = [word_hashes(buf, start, end)]
    for k in STEMS:
        long = end - start > k
        key = np.zeros(len(start), np.uint64)
        key[long] = word_hashes(buf, start[long], start[long] + k) ^ np.uint64(0xA5A5A5A5 + k)
        out.append(key)
    return out


def _closed() -> dict[int, int]:
    """Key -> symbol of the closed classes, and of the fixed insults."""
    out = {}
    for symbol, words in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
        buf = np.frombuffer(" ".join(words).encode(), np.uint8)
        s, e, _, _ = _runs(buf, np.array([0, len(buf)]))
        out |= {int(h): symbol for h in word_hashes(buf, s, e)}
    return out


def _lookup(model: dict, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and weight of each word."""
    closed = model["closed"]
    at = np.searchsorted(closed["key"], keys[0]).clip(max=len(closed["key"]) - 1)
    symbol = np.where(closed["key"][at] == keys[0], closed["symbol"][at], OTHER)
    weight = np.where((symbol == INSULT) | (symbol == THREAT), 1.0, 0.0)
    learned = model["key"]
    if len(learned):
        for k in keys:
            at = np.searchsorted(learned, k).clip(max=len(learned) - 1)
            weight = np.maximum(weight, np.where(learned[at] == k, model["weight"][at], 0.0))
        symbol = np.where((weight > 0) & (symbol == OTHER), INSULT, symbol)
    return symbol, weight


def matches(buf: np.ndarray, offs: np.ndarray, model: dict) -> tuple[np.ndarray, ...]:
    """Text, symbol, weight and marks of every insult and threat of the texts. Clauses without one
    are not read; the others are read by the composed machine, all side by side."""
    start, end, clause, first = _runs(buf, offs)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none, none.astype(float), none
    symbol, weight = _lookup(model, _features(buf, start, end))
    hit = (symbol == INSULT) | (symbol == THREAT)
    if not hit.any():
        return none, none, none.astype(float), none
    live = np.isin(clause, np.unique(clause[hit]))
    at = np.flatnonzero(live)
    text = np.searchsorted(first, at, "right") - 1
    edge = np.flatnonzero(np.r_[True, clause[at][1:] != clause[at][:-1]])
    size = np.diff(np.r_[edge, len(at)])
    machine, order = compose(), np.argsort(-size, kind="stable")
    begin, size = edge[order], size[order]
    state, marks = np.zeros(len(begin), np.int64), np.zeros(len(at), np.int64)
    for t in range(int(size[0])):
        k = len(size) - int(np.searchsorted(size[::-1], t, "right"))
        here = begin[:k] + t
        marks[here] = machine.marks[state[:k]]
        state[:k] = machine.step[state[:k], symbol[at[here]]]
    some = hit[at]
    return text[some], symbol[at][some], weight[at][some], marks[some]


def document_features(n: int, text: np.ndarray, symbol: np.ndarray, weight: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """(n, FEATURES): logs of summed weights by kind of match, and the strongest weight."""
    aimed, negated, reported, again = ((marks >> b & 1).astype(bool) for b in range(4))
    insult, threat = symbol == INSULT, symbol == THREAT
    kinds = (insult, insult & aimed, insult & negated, insult & reported, insult & again,
             threat, threat & aimed, threat & negated)
    out = np.zeros((n, len(FEATURES)))
    for c, kind in enumerate(kinds):
        out[:, c] = np.log1p(np.bincount(text[kind], weight[kind], n))
    np.maximum.at(out[:, -1], text, weight)
    return out


# ---- learning ----------------------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, text: str, fit_toxic: int, fit_clean: int) -> DataFrame:
    """(text, toxic) of the labelled documents to learn from, one of each group of near copies."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    ids = saved(first_by_hash(ids, "toxic", F.when(F.col("toxic") == 1, fit_toxic).otherwise(fit_clean)), "toxicity-rows")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(ids), "doc_id")                              # fit_toxic + fit_clean ids at most

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            copy = np.zeros(len(b), np.int64)
            for i, j, h, offs in hashed_texts(b.column("text")):
                for r in range(i, j):
                    s = shingle_hashes(h[offs[r - i]:offs[r - i + 1]])
                    copy[r] = s.min().view(np.int64) if len(s) else 0
            yield b.append_column("copy", pa.array(copy))

    rows = rows.select("doc_id", "text", "toxic").mapInArrow(job, "doc_id long, text string, toxic int, copy long")
    one = saved(rows, "toxicity-sample")
    keep = one.groupBy("copy", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return saved(one.join(keep, ["copy", "toxic", "doc_id"], "left_semi").select("text", "toxic"), "toxicity-sample")


def _lexicon(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and weights of the words and stems whose documents are toxic far above the base rate."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = np.asarray(b.column("toxic"))
            keys, marks = [], []
            for i, _, buf, offs in text_pieces(b.column("text")):
                start, end, _, first = _runs(buf, offs)
                found = _features(buf, start, end)
                for r in range(len(offs) - 1):
                    u = np.unique(np.concatenate([f[first[r]:first[r + 1]] for f in found]))
                    keys.append(u[u != 0])
                    marks.append(np.full(len(keys[-1]), toxic[i + r]))
            if keys:
                key, at = np.unique(np.concatenate(keys), return_inverse=True)
                mark = np.concatenate(marks)
                t = np.bincount(at, mark, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(t), pa.array(np.bincount(at, minlength=len(key)) - t)],
                    ["key", "toxic", "clean"])

    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.uint64), np.zeros(0)
    rate = (F.col("toxic") + 0.5) / (n1 + 1), (F.col("clean") + 0.5) / (n0 + 1)
    got = (sample.mapInArrow(job, "key long, toxic long, clean long").groupBy("key")
           .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
           .filter(F.col("toxic") >= MIN_TOXIC).withColumn("share", rate[0] / (rate[0] + rate[1]))
           .filter(F.col("share") >= MIN_SHARE).withColumn("weight", F.log(rate[0] / rate[1]))
           .orderBy(F.col("weight").desc(), "key").limit(LEXICON).select("key", "weight").toPandas())
    key = got["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)
    weight = got["weight"].to_numpy()[order]
    return key[order], weight / weight.max() if len(weight) else weight


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN) -> dict:
    """Lexicon and weights from the labelled documents that are not held out."""
    closed = sorted(_closed().items())
    model = {"closed": {"key": np.array([k for k, _ in closed], np.uint64), "symbol": np.array([s for _, s in closed])},
             "key": np.zeros(0, np.uint64), "weight": np.zeros(0), "logit": DEFAULT_WEIGHTS}
    sample = _sample(docs, labels, text, fit_toxic, fit_clean)
    model["key"], model["weight"] = _lexicon(sample)
    got = _job(sample, model, "toxic").toPandas()     # FEATURES numbers per sampled document
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))
    y = got["toxic"].to_numpy()
    if 0 < y.sum() < len(y):
        model["logit"] = _logistic(x, y)
    return model


def _job(rows: DataFrame, model: dict, key: str) -> DataFrame:
    """``key``, features and number of matches per row of (text, key)."""
    kind = rows.schema[key].dataType.simpleString()

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, n = np.zeros((len(b), len(FEATURES))), np.zeros(len(b), np.int64)
            for i, j, buf, offs in text_pieces(b.column("text"), PIECE_BYTES):
                text, symbol, weight, marks = matches(buf, offs, model)
                x[i:j] = document_features(j - i, text, symbol, weight, marks)
                n[i:j] = np.bincount(text, minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(list(x), pa.list_(pa.float64())), pa.array(n)], [key, "features", "n_matches"])

    return rows.select("text", key).mapInArrow(job, f"{key} {kind}, features array<double>, n_matches long")


def toxicity(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Per document: doc_id, score, predicted, n_matches and features."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = _job(rows, model, "doc_id")
    w = [float(v) for v in model["logit"]]
    logit = F.lit(w[0])
    for i, v in enumerate(w[1:]):
        logit = logit + F.col("features")[i] * v
    return out.withColumn("score", 1 / (1 + F.exp(-logit))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = toxicity(docs, fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_matches")

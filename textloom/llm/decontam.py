"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words over all documents give TF-IDF
   weights. Words are hashed to ``BUCKETS`` buckets, so every table is bounded.
2. Benchmark texts are cut into passages of two steps of ``STEP`` words. A
   distributed randomised SVD (range finder with power rounds; each round is one
   job that adds up A'(A Q) by bucket) yields the latent directions.
3. Each passage of each document is folded in and compared by cosine with all
   passages of the benchmark, in blocks of ``BLOCK`` (a stated query set).
4. A passage above ``MIN_COSINE`` that also covers ``MIN_COVER`` of the benchmark
   passage places an item in the document. So do ``ANCHORS`` of an item's rarest
   words near each other: of n words of which k must be found in order, at least
   ``ANCHORS`` of any n - k + ``ANCHORS`` are, so no place that step 5 would take is
   missed, whatever the size of the benchmark.
5. The longest common subsequence with the words there decides: ``COPIED`` of the
   item's words, or ``PARAPHRASED`` of them and the answer (its last sentence, or
   the column ``answer``) as well.

Items of fewer than ``SHORT`` words say too little for a cosine of whole
passages or a subsequence; they are looked for word by word in step 3's pass.

Defined results: null and blank texts hold no item; null and blank items match
nothing; equal items are each reported; a null doc_id is kept; repeated rows are
alike; an empty table on either side gives no hits; other columns are carried.
The texts are read twice and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import hashed_texts, packed, saved, unpacked

BUCKETS = 1 << 16
RANK, EXTRA, POWER = 256, 16, 2
STEP = 16
SHORT = 8
BLOCK = 20_000
MIN_COSINE = 0.5
MIN_COVER = 0.5            # of the benchmark passage, along its own direction
COPIED, PARAPHRASED = 0.8, 0.6
ANCHORS = 2                # rarest words of an item that place it
SEED = 7
HIT = "array<struct<item_id:long,lcs:double,start:long,end:long>>"


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def document_frequency(docs: DataFrame, text: str, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each bucket, of the ``wanted`` buckets, and all documents."""
    sc = docs.sparkSession.sparkContext
    share = sc.broadcast(wanted)                        # BUCKETS flags

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            n += len(b)
            for _, _, h, offs in hashed_texts(b.column(0)):
                at = _bucket(h)
                doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
                some = share.value[at]
                pair = np.unique(doc[some] * BUCKETS + at[some])
                total += np.bincount(pair % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[total[at], n])], ["bucket", "n"])

    got = (docs.select(text).mapInArrow(job, "bucket long, n long").groupBy("bucket")
           .agg(F.sum("n").alias("n")).toArrow())      # BUCKETS + 1 rows at most
    share.destroy()
    at, count = (got.column(c).to_numpy() for c in ("bucket", "n"))
    df, some = np.zeros(BUCKETS, np.int64), at >= 0
    df[at[some]] = count[some]
    return df, int(count[~some].sum())


def _passages(h: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps (first word of each) and passages (step, text) of the texts: step i and i + 1 of a text
    are passage i; a text of one step is one passage."""
    n = np.diff(offs)
    steps = -(-n // STEP)
    text = np.repeat(np.arange(len(n)), steps)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(steps) - steps, steps)
    lead = (nth == 0) | (nth < np.repeat(steps, steps) - 1)
    return offs[text] + nth * STEP, np.flatnonzero(lead), text


def _embed(h: np.ndarray, offs: np.ndarray, slot: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sum of the rows of each passage's words (row 0 is zero); passage starts and texts."""
    starts, lead, text = _passages(h, offs)
    if not len(starts):
        return np.zeros((0, rows.shape[1]), rows.dtype), starts, text
    at = np.r_[slot[_bucket(h)], 0]                   # row 0 is zero: what lies past a text's end
    ends = offs[text + 1]
    sums = np.zeros((len(starts), rows.shape[1]), rows.dtype)
    for a in range(0, len(starts), 1024):             # 1024 steps of rows at once
        z = min(a + 1024, len(starts))
        for j in range(STEP):
            word = starts[a:z] + j
            sums[a:z] += rows[at[np.where(word < ends[a:z], word, len(h))]]
    follows = np.r_[text[1:] == text[:-1], False]
    both = sums.copy()
    both[follows] += sums[1:][follows[:-1]]
    return both[lead], starts[lead], text[lead]


def _vector_sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the vectors (``width`` doubles each, as bytes) of each word of a partition."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sums = np.zeros(0, np.int64), np.zeros((0, width))
        for b in batches:
            v = [np.frombuffer(x.as_buffer(), np.float64) for x in b.column("v")]
            every, at = np.unique(np.r_[words, b.column("word").to_numpy()], return_inverse=True)
            more = np.zeros((len(every), width))
            np.add.at(more, at, np.concatenate([sums, np.reshape(v, (-1, width))]))
            words, sums = every, more
        yield from _vector_rows(words, sums)

    return job


def _vector_rows(words: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(words), 1024):
        yield pa.RecordBatch.from_arrays([pa.array(words[a:a + 1024]), pa.array([v.tobytes() for v in vectors[a:a + 1024]], pa.binary())],
                                         ["word", "v"])


def randomized_svd(bench: DataFrame, text: str, idf: np.ndarray) -> np.ndarray:
    """(words, RANK or fewer) right singular directions of the benchmark's TF-IDF passages, which are
    spread over tasks; only sums by word bucket come together. Row i stands for the i-th bucket with
    a weight; at most BUCKETS rows of RANK + EXTRA floats go to the tasks. A sum is a row of bytes: a
    column for each direction would make aggregates of hundreds of columns, whose plans, code and
    results fill the driver's memory."""
    spark = bench.sparkSession
    live = np.flatnonzero(idf > 0)
    slot = np.zeros(BUCKETS, np.int32)
    slot[live] = np.arange(1, len(live) + 1)
    weight = idf[live].astype(np.float32)
    q = np.random.default_rng(SEED).standard_normal((len(live), max(1, min(RANK + EXTRA, len(live)))))

    def applied(q: np.ndarray) -> np.ndarray:
        share = spark.sparkContext.broadcast((slot, weight, q.astype(np.float32)))

        def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slot, weight, q = share.value
            rows = np.r_[np.zeros((1, q.shape[1]), np.float32), q * weight[:, None]]
            out = np.zeros(rows.shape)
            for b in batches:
                for _, _, h, offs in hashed_texts(b.column(0)):
                    at = slot[_bucket(h)]
                    y, starts, owner = _embed(h, offs, slot, rows)
                    for v, s, o in zip(y, starts, owner, strict=True):
                        np.add.at(out, at[s:min(s + 2 * STEP, offs[o + 1])], v)
            some = np.flatnonzero(out[1:].any(1))
            yield from _vector_rows(some, out[1:][some] * weight[some, None])

        kind = "word long, v binary"
        sums = (bench.select(text).mapInArrow(job, kind).repartition("word")
                .mapInArrow(_vector_sums(q.shape[1]), kind).toArrow())
        share.destroy()                                 # its tasks are done
        z = np.zeros(q.shape)
        for b in sums.to_batches():
            for word, v in zip(b.column("word").to_numpy(), b.column("v"), strict=True):
                z[word] = np.frombuffer(v.as_buffer(), np.float64)
        return z

    if not len(live):
        return np.zeros((0, 1))
    for _ in range(POWER + 1):
        q, _ = np.linalg.qr(applied(q))
    value, turn = np.linalg.eigh(q.T @ applied(q))
    keep = np.argsort(-value)[:RANK]
    keep = keep[value[keep] > 1e-9 * max(value.max(), 1e-300)]
    return q @ turn[:, keep] if len(keep) else np.zeros((len(live), 1))


def _lcs(item_masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, by bit rows."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = item_masks.get(w)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _answer(text: str) -> str:
    """The last sentence of an item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p.strip()]
    return parts[-1] if parts else ""


def _anchors(hashes: list[np.ndarray], long: list[int], idf: np.ndarray) -> dict:
    """The rarest words of the items, enough that ``ANCHORS`` of them are in every place that meets the
    LCS rule: sorted distinct words, the postings of each (from ``first``), and the item and offset there."""
    word, item, offset = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in long:
        h = hashes[i]
        need = int(np.ceil(PARAPHRASED * len(h) - 1e-9))
        rare = np.argsort(-idf[_bucket(h)], kind="stable")[:len(h) - need + ANCHORS]
        word.append(h[rare])
        item.append(np.full(len(rare), i))
        offset.append(rare)
    word, item, offset = np.concatenate(word), np.concatenate(item), np.concatenate(offset)
    order = np.argsort(word, kind="stable")
    words, first = np.unique(word[order], return_index=True)
    return {"words": words, "first": np.r_[first, len(word)], "item": item[order], "offset": offset[order]}


def _places(block: dict, h: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, item, guess) of each item with ``ANCHORS`` anchors in one window of a text; one guess a step."""
    anchors = block["anchors"]
    if not len(anchors["words"]) or not len(h):
        return
    slot = np.minimum(np.searchsorted(anchors["words"], h), len(anchors["words"]) - 1)
    at = np.flatnonzero(anchors["words"][slot] == h)
    begin, size = anchors["first"][slot[at]], anchors["first"][slot[at] + 1] - anchors["first"][slot[at]]
    posting = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    at = np.repeat(at, size)
    item, offset = anchors["item"][posting], anchors["offset"][posting]
    text = np.searchsorted(offs, at, "right") - 1
    place, inv = np.unique(item * len(h) + at, return_inverse=True)     # a word met by two offsets counts once
    who, where = place // len(h), place % len(h)
    owner = np.searchsorted(offs, where, "right") - 1
    span = block["n"][who] + block["n"][who] // 4 + 2 * STEP
    far = ANCHORS - 1
    near = np.zeros(len(place), bool)
    if len(place) > far:
        run = ((who[far:] == who[:-far]) & (owner[far:] == owner[:-far]) & (where[far:] - where[:-far] < span[far:]))
        for j in range(ANCHORS):
            near[j:len(near) - far + j] |= run
    some = near[inv]
    text, item, guess = text[some], item[some], at[some] - offs[text[some]] - offset[some]
    key = np.unique(np.stack([text, item, guess // STEP], 1), axis=0, return_index=True)[1]
    yield from zip(text[key].tolist(), item[key].tolist(), guess[key].tolist(), strict=True)


def _block(rows: list, emb: dict, idf: np.ndarray) -> dict:
    """The items of a block: words, answers, passages in the latent space, anchors."""
    texts = [r["text"] for r in rows]
    hashes = []
    for _, _, h, offs in hashed_texts(pa.array(texts, pa.string())):
        hashes += [h[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]
    answers = []
    for _, _, h, offs in hashed_texts(pa.array([r["answer"] if r["answer"] is not None else _answer(r["text"]) for r in rows], pa.string())):
        answers += [h[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]
    long = [i for i, h in enumerate(hashes) if len(h) >= SHORT]
    flat = np.concatenate([hashes[i] for i in long]) if long else np.zeros(0, np.uint64)
    offs = np.r_[0, np.cumsum([len(hashes[i]) for i in long])].astype(np.int64)
    vec, start, owner = _embed(flat, offs, emb["slot"], emb["rows"])
    size = np.linalg.norm(vec, axis=1)
    some = size > 0
    return {"ids": [r["item_id"] for r in rows], "words": hashes, "answers": answers,
            "masks": [_masks(h.tolist()) for h in hashes], "anchors": _anchors(hashes, long, idf),
            "n": np.array([len(h) for h in hashes], np.int64),
            "vec": vec[some], "size": size[some],
            "at": (start - offs[owner])[some] if len(start) else start,
            "item": np.array(long, np.int64)[owner[some]] if len(start) else start,
            "short": [i for i, h in enumerate(hashes) if 0 < len(h) < SHORT]}


def _judge(block: dict, i: int, words: np.ndarray, guess: int) -> tuple[float, int, int] | None:
    """(share of the item's words, start, end) if the item stands around word ``guess``."""
    n = len(block["words"][i])
    lo, hi = max(0, guess - STEP), min(len(words), guess + n + n // 4 + STEP)
    masks, listed = block["masks"][i], words[lo:hi].tolist()
    if sum(w in masks for w in listed) < PARAPHRASED * n:
        return None
    share = _lcs(masks, n, listed) / n
    if share < PARAPHRASED:
        return None
    if share < COPIED:
        answer = block["answers"][i].tolist()
        if not answer or _lcs(_masks(answer), len(answer), listed) < COPIED * len(answer):
            return None
    return share, lo, hi


def _search(block: dict, emb: dict, h: np.ndarray, offs: np.ndarray) -> dict[tuple[int, int], tuple[float, int, int]]:
    """(text, item) -> best match, over the texts of a piece."""
    hits: dict[tuple[int, int], tuple[float, int, int]] = {}

    def note(text: int, i: int, found: tuple[float, int, int] | None) -> None:
        if found and found[0] > hits.get((text, i), (0.0,))[0]:
            hits[text, i] = found

    vec, starts, owner = _embed(h, offs, emb["slot"], emb["rows"])
    size = np.linalg.norm(vec, axis=1)
    tried: set[tuple[int, int, int]] = set()

    def attempt(text: int, i: int, guess: int) -> None:
        key = (text, i, guess // STEP)
        if key not in tried:
            tried.add(key)
            note(text, i, _judge(block, i, h[offs[text]:offs[text + 1]], guess))

    for a in range(0, len(vec), 4096):
        if not len(block["vec"]):
            break
        dot = vec[a:a + 4096] @ block["vec"].T
        bar = np.maximum(MIN_COSINE * size[a:a + 4096, None], MIN_COVER * block["size"]) * block["size"]
        for p, c in zip(*np.nonzero(dot >= np.maximum(bar, 1e-9)), strict=True):
            text = int(owner[a + p])
            attempt(text, int(block["item"][c]), int(starts[a + p] - offs[text] - block["at"][c]))
    for text, i, guess in _places(block, h, offs):
        attempt(text, i, guess)
    for i in block["short"]:
        item = block["words"][i]
        n = len(item)
        if len(h) < n:
            continue
        at = np.flatnonzero(np.logical_and.reduce([h[j:len(h) - n + 1 + j] == item[j] for j in range(n)]))
        text = np.searchsorted(offs, at, "right") - 1
        for t, s in zip(text, at, strict=True):
            if s + n <= offs[t + 1]:
                note(int(t), i, (1.0, int(s - offs[t]), int(s - offs[t] + n)))
    return hits


def contamination(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``text`` and ``hits``: (item_id, share of its words found in
    order, word range)."""
    spark = docs.sparkSession
    answer = F.col("answer").cast("string") if "answer" in bench.columns else F.lit(None).cast("string")
    items = saved(bench.select(F.col("item_id").cast("long").alias("item_id"),
                               F.coalesce(F.col("text"), F.lit("")).alias("text"), answer.alias("answer")), "bench-items")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, h, _ in hashed_texts(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bucket(h)))], ["bucket"])

    wanted = np.zeros(BUCKETS, bool)
    wanted[items.select("text").mapInArrow(buckets, "bucket long").distinct().toArrow()["bucket"].to_numpy()] = True
    df, n = document_frequency(docs.select(F.col(f"`{text}`").alias("text")), "text", wanted)
    idf = np.where(wanted, np.log((n + 2) / (df + 1)), 0.0)
    directions = randomized_svd(items, "text", idf)
    live = np.flatnonzero(idf > 0)
    slot = np.zeros(BUCKETS, np.int32)
    slot[live] = np.arange(1, len(live) + 1)
    rows = np.zeros((len(live) + 1, directions.shape[1]), np.float32)
    rows[1:] = directions * idf[live, None]
    del directions
    emb = {"slot": slot, "rows": rows}
    blocks = max(1, -(-items.count() // (BLOCK // 4)))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = packed(docs, text=F.col(f"`{text}`"), hits=F.array().cast(HIT))
    names, schema = out.columns, T.StructType(out.schema.fields)
    for k in range(blocks):
        block = _block(numbered.filter(F.col("block") == k).collect(), emb, idf)     # about BLOCK passages
        share = spark.sparkContext.broadcast((emb, block))
        out = out.mapInArrow(_job(share, names.index("text"), names.index("hits")), schema)
    return out


def _job(share, text_at: int, hits_at: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emb, block = share.value
        for b in batches:
            found = b.column(hits_at).to_pylist()
            for i, _, h, offs in hashed_texts(b.column(text_at)):
                for (r, item), (lcs, lo, hi) in sorted(_search(block, emb, h, offs).items()):
                    found[i + r] = [*found[i + r], {"item_id": block["ids"][item], "lcs": lcs, "start": lo, "end": hi}]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, b.schema.field(hits_at).type) if c == hits_at else b.column(c) for c in range(b.num_columns)],
                schema=b.schema)

    return job


def clean(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item of the benchmark."""
    return unpacked(contamination(docs, bench, text).filter(F.size("hits") == 0), docs.columns)


def contamination_digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    out = contamination(docs.select("doc_id", "text"), bench).select("row.doc_id", "hits")
    best = F.aggregate("hits", F.lit(0.0), lambda z, x: F.greatest(z, x["lcs"]))
    return out.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                      F.array_sort(F.transform("hits", lambda x: x["item_id"])).alias("items"), best.alias("lcs"))

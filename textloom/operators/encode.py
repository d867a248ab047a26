"""Fixed-length encoding (L1-L3) with a corpus vocabulary.

Ids: 0 = pad, 1 = unknown, then 2.. by document frequency desc, term asc.
Whole texts are tokenised; truncation to ``max_len`` is the encoder's
feature (the reference tokenises with ``truncation=True``).

Texts are encoded in batches: a batch holds its distinct terms once and each token as
a place among them, so only the distinct terms of a batch meet the vocabulary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import defaults as D
from textloom.functions.text import tokens
from textloom.operators.rank import global_rank
from textloom.session import checkpoint_root, saved

BATCH_TOKENS = 1 << 20     # tokens whose distinct terms meet the vocabulary together


def token_vocabulary(df: DataFrame, text: str, min_df: int = 1, max_terms: int | None = None,
                     materialize: bool = True) -> DataFrame:
    """``(term, df, token_id)`` over unigram tokens of whole texts.

    The fitted vocabulary is checkpointed to the shared folder by default
    (like a saved tokenizer), so size checks and later encodes read it
    instead of re-tokenising the corpus."""
    v = (df.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
         .groupBy("term").agg(F.count("*").alias("df")))
    if min_df > 1:
        v = v.filter(F.col("df") >= min_df)
    if materialize:
        # tokenise the corpus once; the size check and the ranking read this
        checkpoint_root(df.sparkSession)
        v = v.checkpoint(eager=True)
    r = global_rank(v, [F.col("df").desc(), F.col("term").asc()], rank_col="_r")
    if max_terms is not None:
        r = r.filter(F.col("_r") <= max_terms)
    return r.select("term", "df", (F.col("_r") + D.UNK_ID).cast("int").alias("token_id"))


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _batched(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch of keys: its distinct terms, and each token's place among them."""
    for b in rows:
        texts = pc.list_value_length(b.column("texts")).to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(b.column("texts").flatten()).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[np.cumsum(texts)]
        i = 0
        while i < len(b):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + BATCH_TOKENS, side="right")))
            part = b.slice(i, j - i)
            own = part.column("texts").flatten()
            words = own.flatten().dictionary_encode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), _listed(words.dictionary), _listed(part.column("key")),
                 _listed(part.column("copies")), _listed(pc.list_value_length(part.column("texts"))),
                 _listed(pc.list_value_length(own)), pa.array([words.indices.to_numpy().astype(np.int32).tobytes()], pa.binary())],
                ["batch", "terms", "key", "copies", "texts", "lengths", "places"])
            i = j


def _decoded(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, copies, got) of each key: the ids of its texts' tokens by position, then id."""
    for b in rows:
        for r in range(len(b)):
            one = {c: b.column(c).slice(r, 1).flatten() for c in ("key", "copies", "texts", "lengths", "found")}
            ids = np.zeros(len(one["found"]), np.int32)
            ids[one["found"].field("at").to_numpy()] = one["found"].field("id").to_numpy()
            got = ids[np.frombuffer(b.column("places")[r].as_buffer(), np.int32)]
            lengths = one["lengths"].to_numpy()
            texts = np.concatenate([[0], np.cumsum(one["texts"].to_numpy())])
            tokens_to = np.concatenate([[0], np.cumsum(lengths)])
            ends = tokens_to[texts]
            for k in np.flatnonzero(np.diff(texts) > 1):          # a key of several texts
                pos = np.concatenate([np.arange(n) for n in lengths[texts[k]:texts[k + 1]]])
                mine = got[ends[k]:ends[k + 1]]
                got[ends[k]:ends[k + 1]] = mine[np.lexsort((mine, pos))]
            yield pa.RecordBatch.from_arrays(
                [one["key"], one["copies"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(got, pa.int32()))],
                ["key", "copies", "got"])


def encode_fixed(df: DataFrame, id_cols, text: str, vocab: DataFrame, max_len: int,
                 ids: str = "input_ids", mask: str = "attention_mask") -> DataFrame:
    """L1: token ids truncated to ``max_len`` and right-padded with 0, plus
    the attention mask. Every input row gets exactly one output row; rows that share
    their ids share their tokens, and a row with a null id has none."""
    keys = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # the whole text is tokenised; only the first max_len tokens are kept
    first = F.slice(tokens(text), 1, max_len)
    by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.collect_list(F.when(known, first)).alias("texts"))
    by_key = by_key.select(F.struct(*keys).alias("key"), "copies", "texts")
    key_type = by_key.schema["key"].dataType
    kinds = {"batch": T.StringType(), "terms": T.ArrayType(T.StringType()), "key": T.ArrayType(key_type),
             "copies": T.ArrayType(T.LongType()), "texts": T.ArrayType(T.IntegerType()),
             "lengths": T.ArrayType(T.IntegerType()), "places": T.BinaryType()}
    batches = saved(by_key.mapInArrow(_batched, T.StructType([T.StructField(c, t) for c, t in kinds.items()])), "encode-batches")
    term = batches.select("batch", F.posexplode("terms").alias("at", "term")).join(vocab.select("term", "token_id"), "term", "left")
    found = term.groupBy("batch").agg(F.collect_list(F.struct("at", F.coalesce("token_id", F.lit(D.UNK_ID)).alias("id"))).alias("found"))
    none = F.array().cast("array<struct<at:int,id:int>>")
    whole = batches.drop("terms").join(found, "batch", "left").withColumn("found", F.coalesce("found", none))
    out = whole.mapInArrow(_decoded, T.StructType([T.StructField("key", key_type), T.StructField("copies", T.LongType()),
                                                   T.StructField("got", T.ArrayType(T.IntegerType()))]))
    out = out.select("key", "got", F.explode(F.sequence(F.lit(1), "copies")))
    got = F.col("got")
    n = F.size(got)
    pad = F.array_repeat(F.lit(D.PAD_ID), F.lit(max_len) - n)
    return out.select(*[F.col("key").getField(k).alias(k) for k in keys], F.concat(got, pad).alias(ids),
                      F.concat(F.array_repeat(F.lit(1), n),
                               F.array_repeat(F.lit(0), F.lit(max_len) - n)).alias(mask))


def mask_targets(c: Column | str, pad_id: int = D.PAD_ID, ignore: int = D.IGNORE_INDEX) -> Column:
    """L2: pad positions -> ``ignore`` (-100) in a target id array."""
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda i: F.when(i == pad_id, F.lit(ignore)).otherwise(i))


def lm_targets(df: DataFrame, ids: str = "input_ids", out: str = "labels") -> DataFrame:
    """L3: causal-LM labels = input ids with pad (= end token) -> -100."""
    return df.withColumn(out, mask_targets(ids))

"""Ids that many rows share, fits over hot groups, and tokenizer files of other kinds."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import common, wavelet
from textloom.llm.queries import tokenizer_file

import public_tokenizers


def test_first_by_hash_is_the_rank_over_each_group(spark):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 else rng.choice("abc")) for i in range(5_000)] + [(7, "hot")] * 50 + [(None, "a"), (1, None)]
    ids = spark.createDataFrame(rows, "doc_id long, g string")
    want = {}
    for r in ids.distinct().withColumn("h", F.xxhash64("doc_id")).collect():
        if r.g is not None:
            want.setdefault(r.g, []).append((r.h, r.doc_id is not None, r.doc_id))
    for n in (1, 40, 10**6):
        got = {}
        for r in common.first_by_hash(ids, "g", n).collect():
            got.setdefault(r.g, set()).add(r.doc_id)
        assert got == {g: {x[2] for x in sorted(v, key=lambda x: (x[0], x[1], x[2] or 0))[:n]} for g, v in want.items()}
    by_group = common.first_by_hash(ids, "g", F.when(F.col("g") == "hot", 30).otherwise(10)).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in by_group} == {"hot": 30, "a": 10, "b": 10, "c": 10}


def test_shards_of_a_table_with_a_third_of_null_ids(spark):
    rng = random.Random(2)
    rows = [(None if i % 3 == 0 else i // 2, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(60)))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # keep the ranges of so small a table
    try:
        shards = wavelet.write_shards(docs, tokenizer_file(), shard_tokens=2_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert shards.select("part").distinct().count() > 4
    got = wavelet.read_shards(shards).orderBy("start").collect()
    assert [r.doc_id is None for r in got] == [True] * 300 + [False] * 600
    known = [r.doc_id for r in got[300:]]
    assert known == sorted(known)
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    tok = Tokenizer.from_file(tokenizer_file())

    def crc(text):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 1]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (i is None, i or 0, *crc(t)) for i, t in rows)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokenizer_files_of_any_kind(name):
    path = public_tokenizers.path(name)
    tok, enc = Tokenizer.from_file(path), wavelet.WordEncoder(path)
    assert enc.by_words == (name == "word_bpe_49k.json")
    texts = ["Hello  world\n it's", "", " lead", "naïve 中文 \U0001f600", "a<|endoftext|>b", "tab\tx\x0by"]
    ids, sizes = enc.encode(pa.array(texts))
    want = [[*tok.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and sizes.tolist() == [len(w) for w in want]
    none, size = enc.encode(pa.array([], pa.string()))
    assert len(none) == 0 and len(size) == 0

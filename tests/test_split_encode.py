import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import encode, split

from conftest import rows


@pytest.mark.parametrize("n,expected", [(1, 1), (4, 1), (5, 1), (11, 3), (35, 7)])
def test_split_sizes(spark, n, expected):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = split.split_exact(df, "k")
    assert out.filter("split = 'test'").count() == expected == split.test_size(n, 0.2)
    assert out.count() == n


def test_split_sizes_follow_float_ceil(spark):
    # sizes where 0.2 * n in doubles differs from n / 5: size = ceil(0.2 * n) as the original
    sizes = [3, 6, 7, 12, 14, 17, 19, 23, 997, 1003]
    for n in sizes:
        got = split.split_exact(spark.range(n).withColumnRenamed("id", "k"), "k") \
            .filter("split = 'test'").count()
        assert got == split.test_size(n, 0.2), n


def test_split_invariant_to_partitioning_and_order(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    a = rows(split.split_exact(df, "k"), "k", "split")
    b = rows(split.split_exact(df.repartition(13).orderBy(F.rand(7)), "k"), "k", "split")
    assert a == b


def test_three_way_split(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    out = split.split_exact(df, "k", [("test", 0.1), ("validation", 0.1)])
    sizes = {r.split: r.n for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"test": 11, "validation": 11, "train": 79}


def test_stratified_with_hot_label(spark):
    # one label holds a third of the rows: quotas stay exact
    df = spark.range(9000).select(F.col("id").alias("k"),
                                  F.when(F.col("id") < 3000, "hot").otherwise(
                                      (F.col("id") % 7).cast("string")).alias("label"))
    out = split.split_stratified(df, "k", "label")
    q = {r.label: r.n_test for r in split.stratified_quotas(df, "label").collect()}
    got = {r.label: r.n for r in out.filter("split = 'test'").groupBy("label")
           .agg(F.count("*").alias("n")).collect()}
    assert got == q
    assert sum(q.values()) == 1800


def test_grouped_split_keeps_groups_together(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("g"), F.col("id").alias("k"))
    out = split.split_exact(df, "k", group_key="g")
    per_group = out.groupBy("g").agg(F.countDistinct("split").alias("n"))
    assert per_group.filter("n > 1").count() == 0
    assert out.select("g").filter("split = 'test'").distinct().count() == 8   # ceil(0.2 * 37)


def test_encode_lengths(spark):
    docs = spark.createDataFrame([(1, ""), (2, "aa bb cc"), (3, "aa bb cc dd")], "id int, t string")
    vocab = encode.token_vocabulary(docs, "t")
    enc = encode.encode_fixed(docs, "id", "t", vocab, 3)
    got = {r.id: (r.input_ids, r.attention_mask) for r in enc.collect()}
    v = {r.term: r.token_id for r in vocab.collect()}
    assert got[1] == ([0, 0, 0], [0, 0, 0])
    assert got[2] == ([v["aa"], v["bb"], v["cc"]], [1, 1, 1])
    assert got[3] == got[2]                                   # truncated at max_len
    tgt = enc.select("id", encode.mask_targets("input_ids").alias("y")).collect()
    assert {r.id: r.y for r in tgt}[1] == [-100, -100, -100]
    assert min(v.values()) == 2                              # 0 pad, 1 unknown


def test_null_labels_and_groups_keep_their_rows(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("lab"))
    for out in (split.split_stratified(df, "id", "lab"), split.split_exact(df, "id", group_key="lab")):
        assert out.count() == 100 and out.filter("lab IS NULL").count() == 20
    assert split.split_stratified(df, "id", "lab").filter("lab IS NULL AND split = 'test'").count() == 4


def test_only_the_distinct_terms_of_a_batch_meet_the_vocabulary(monkeypatch):
    texts = [[["aa", "bb", "aa", "cc"]]] * 1000 + [[], [["bb"], ["aa", "bb"]]]
    rows_ = pa.RecordBatch.from_arrays(
        [pa.array([{"id": i} for i in range(1002)]), pa.array([1] * 1001 + [2]), pa.array(texts, pa.list_(pa.list_(pa.string())))],
        ["key", "copies", "texts"])
    one = list(encode._batched([rows_]))
    assert [b.column("terms").to_pylist() for b in one] == [[["aa", "bb", "cc"]]]     # of 4,003 tokens
    monkeypatch.setattr(encode, "BATCH_TOKENS", 400)
    cut = list(encode._batched([rows_]))
    assert [len(b.column("key")[0]) for b in cut] == [100] * 9 + [101, 1]
    ids = {"aa": 7, "bb": 5, "cc": 2}
    for batches in (one, cut):
        got = []
        for b in batches:
            found = [{"at": i, "id": ids[t]} for i, t in enumerate(b.column("terms")[0].as_py())][::-1]
            kind = pa.list_(pa.struct([("at", pa.int32()), ("id", pa.int32())]))
            got += [x for y in encode._decoded([b.append_column("found", pa.array([found], kind))]) for x in y.column("got").to_pylist()]
        assert got == [[7, 5, 7, 2]] * 1000 + [[], [5, 7, 5]]


def test_encode_rows_that_share_an_id_and_rows_without_one(spark):
    docs = spark.createDataFrame([(1, "bb zz"), (1, "aa"), (2, None), (None, "aa"), (3, "zz aa bb cc")], "id long, t string")
    vocab = spark.createDataFrame([("aa", 2), ("bb", 3), ("cc", 4)], "term string, token_id int")
    got = sorted((r.id or 0, r.input_ids, r.attention_mask) for r in encode.encode_fixed(docs, "id", "t", vocab, 3).collect())
    assert got == [(0, [0, 0, 0], [0, 0, 0]), (1, [2, 3, 1], [1, 1, 1]), (1, [2, 3, 1], [1, 1, 1]),
                   (2, [0, 0, 0], [0, 0, 0]), (3, [1, 2, 3], [1, 1, 1])]

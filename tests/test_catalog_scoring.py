import math

from pyspark.sql import functions as F

from textloom.operators import catalog, metrics, scoring, vectors
from textloom.operators.rank import global_rank

from conftest import rows


def test_last_by_key_keeps_last_row_and_first_position(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "k string, o int, v string")
    out = rows(catalog.last_by_key(df, "k", "o"), "k", "o", "v", "first_pos")
    assert out == [("a", 3, "z", 1), ("b", 2, "y", 2)]


def test_merge_catalog(spark):
    basic = spark.createDataFrame([("a", "A0", "u1"), ("b", "B0", "u2")], "k string, d string, url string")
    detail = spark.createDataFrame([("a", 1, "A1", "s1"), ("a", 2, None, "s2"), ("c", 3, "C", "s3")],
                                   "k string, o int, d string, syntax string")
    out = rows(catalog.merge_catalog(basic, detail, "k", "k", "o"), "k", "d", "url", "syntax")
    # a: last non-null detail value wins (null never overrides); b unchanged; c ignored
    assert out == [("a", "A1", "u1", "s2"), ("b", "B0", "u2", None)]


def test_label_dictionary_first_appearance(spark):
    df = spark.createDataFrame([(0, "z"), (1, "a"), (2, "z"), (3, "m")], "o int, label string")
    assert rows(catalog.label_dictionary(df, "label", "o")) == [("a", 1), ("m", 2), ("z", 0)]


def test_global_rank_over_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(5)
    r = global_rank(df, [F.col("v").desc()], "r")
    got = rows(r, "v", "r")
    assert got == sorted((5000 - i, i) for i in range(1, 5001))


def test_keyword_fallback(spark):
    df = spark.createDataFrame([("change directory",), ("zip it",), ("hello",)], "q string")
    out = catalog.keyword_fallback(df, "q").select("q", "command", "score").collect()
    got = {r.q: (r.command, r.score) for r in out}
    assert got["change directory"] == ("dir", 0.5)        # 'directory' comes first
    assert got["zip it"] == ("ipconfig", 0.5)              # 'ip' matches inside a word
    assert got["hello"] == ("No command prediction generated", 0.0)


def test_consensus(spark):
    q = spark.createDataFrame([(1, "x"), (2, "y"), (3, "change directory")], "id int, text string")
    c = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x"), (2, "y"), (2, "x"), (3, ""), (3, "  ")],
                              "id int, cand string")
    out = {r.id: (r.command, r.score) for r in
           scoring.resolve_candidates(q, c, "id", "text", "cand").collect()}
    assert out == {1: ("x", 1.0), 2: ("x", 1.0), 3: ("dir", 0.5)}


def test_topk_ties_and_short_groups(spark):
    s = spark.createDataFrame([(1, 5, 0.5), (1, 3, 0.5), (1, 9, 0.1), (1, 1, 0.2), (2, 7, 1.0)],
                              "q int, label int, score double")
    out = rows(scoring.topk_labels(s, "q", "label", "score", 3), "q", "rank", "label")
    assert out == [(1, 1, 3), (1, 2, 5), (1, 3, 1), (2, 1, 7)]


def test_softmax_sums_to_one(spark):
    s = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 3.0), (2, "a", 1000.0)],
                              "q int, label string, logit double")
    out = scoring.softmax(s, "q", "logit")
    sums = {r.q: r.s for r in out.groupBy("q").agg(F.sum("score").alias("s")).collect()}
    assert all(math.isclose(v, 1.0) for v in sums.values())


def test_vector_topk_exact_with_zero_vector(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0, 0.0])],
                                  "id long, v array<double>")
    q = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.0, 0.0])], "qid long, v array<double>")
    out = rows(vectors.vector_topk(q, items, "qid", "id", "v", k=3), "qid", "rank", "id", "score")
    assert out[:3] == [(10, 1, 1, 1.0), (10, 2, 4, 1.0), (10, 3, 2, 0.0)]
    assert [r[3] for r in out[3:]] == [0.0, 0.0, 0.0]       # zero query scores 0.0
    # k larger than the number of items -> all items
    assert vectors.vector_topk(q, items, "qid", "id", "v", k=10).count() == 8


def test_class_report_edge_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    rep = {r.label: r for r in metrics.class_report(df, "y", "p").collect()}
    assert rep["b"].support == 0 and rep["b"].precision == 0.0      # only predicted
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0     # never predicted
    assert math.isclose(rep["a"].precision, 0.5) and math.isclose(rep["a"].recall, 0.5)
    assert math.isclose(rep["accuracy"].f1, 1 / 3)
    w = metrics.weighted_prf(df, "y", "p").first()
    assert math.isclose(w.precision, (2 * 0.5 + 1 * 0.0) / 3)

"""Pruned vector search against all pairs; stored forests by their node tables; sparse text vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import features, metrics, model, trees, vectors
from textloom.session import shared_path

from conftest import rows


def _best(X, ids, q, qids, k, exclude):
    S = np.round(q @ X.T, 9)
    out = []
    for r, who in enumerate(qids):
        order = sorted((-S[r, j], i) for j, i in enumerate(ids) if not (exclude and i == who))[:k]
        out += [(who, n + 1, i) for n, (_, i) in enumerate(order)]
    return sorted(out)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 3
    X = np.concatenate([centres[i] + rng.normal(size=(n, 8)) * .1 for i, n in enumerate([400, *[40] * 11])])
    return np.concatenate([X, X[:30], np.zeros((2, 8))])           # one large cluster, equal items, zero vectors


def _df(spark, X, name):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], f"{name} long, v array<double>")


@pytest.mark.parametrize("exclude,block", [(True, 32_768), (False, 50)])
def test_pruned_topk_equals_all_pairs(spark, points, exclude, block):
    items = _df(spark, points, "i")
    held = vectors.fit_clusters(items, "i", "v", 16)
    q = _df(spark, points, "q").repartition(3)
    got, probes = vectors.pruned_topk(q, held, "q", "i", "v", k=4, exclude_self=exclude, query_block=64, item_block=block)
    ids = range(len(points))
    assert rows(got.select("q", "rank", "i")) == _best(points, ids, points, ids, 4, exclude)
    done = vectors.scored_pairs(probes, held, len(points)).head()
    assert done.pairs == len(points) ** 2 and done.scored < 0.6 * done.pairs       # most pairs are skipped


def test_vector_topk_takes_the_pruned_way_for_many_items(spark, points):
    items, q = _df(spark, points, "i"), _df(spark, points[:50], "q")
    a = vectors.vector_topk(q, items, "q", "i", "v", k=3, item_block=100)
    assert rows(a.select("q", "rank", "i")) == _best(points, range(len(points)), points[:50], range(50), 3, False)


def test_pruned_topk_small_inputs(spark, points):
    items = _df(spark, points[:2], "i")
    q = _df(spark, points[:3], "q")
    got, _ = vectors.pruned_topk(q, vectors.fit_clusters(items, "i", "v", 16), "q", "i", "v", k=5)
    assert got.count() == 6
    none, _ = vectors.pruned_topk(q, vectors.fit_clusters(items.limit(0), "i", "v", 4), "q", "i", "v", k=5)
    assert none.count() == 0
    empty, _ = vectors.pruned_topk(q.limit(0), vectors.fit_clusters(items, "i", "v", 4), "q", "i", "v", k=5)
    assert empty.count() == 0


def test_node_tables_give_the_models_probabilities(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=5)], int(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(data, "k long, v array<double>, label int")
    path = shared_path(spark, "forest")
    model.save_forest(model.fit_forest(df, "v", "label", trees=7, depth=12), path)
    nodes = trees.forest_nodes(spark, path)
    want = {r.k: r for r in model.predict(model.load_forest(path), df, "v", "k").collect()}
    got = trees.predict_nodes(nodes, df, ["k"], "v").collect()
    assert len(got) == 300
    for r in got:
        assert abs(r.confidence - want[r.k].confidence) < 1e-9
    same = sum(r.prediction == want[r.k].prediction for r in got)
    assert same >= 297                              # ties between classes may fall either way
    with pytest.raises(ValueError):
        trees.class_probabilities(nodes.limit(0), df, ["k"], "v")


def test_text_forest_on_its_own_terms(spark):
    """Every term is a dimension; the report of a learnable fixture is right in all its figures."""
    words = {0: ["red", "green"], 1: ["iron", "steel"], 2: ["wheat", "rye"]}
    data = [(i, f"{words[i % 3][i % 2]} filler{i} common words", i % 3) for i in range(240)] + [(999, "", 0)]
    df = spark.createDataFrame(data, "k long, text string, label int")
    fit = features.fit_tfidf(df.select("k", "text"), "k", "text", (1, 1), materialize=True)
    numbers = model.term_numbers(fit.counts, 2)
    assert rows(numbers)[0] == ("common", 0) and numbers.count() == 8
    vec = model.sparse_vectors(features.fitted_weights(fit), df.select("k", "label"), "k", numbers)
    one = {r.k: r.features for r in vec.collect()}
    assert one[999].numNonzeros() == 0 and one[0].size == 8 and len(one) == 241
    assert [int(i) for i in one[0].indices] == sorted(r.number for r in numbers.filter("term IN ('common', 'words', 'red')").collect())
    forest = model.fit_forest(vec.filter("k % 4 > 0"), "features", "label", trees=20)
    rep = metrics.class_report(model.predict(forest, vec.filter("k % 4 = 0"), "features", ["k", "label"]), "label", "prediction")
    got = {r.label: r for r in rep.collect()}
    for lab in ("0", "1", "2"):
        assert got[lab].precision == got[lab].recall == got[lab].f1 == 1.0
    again = model.fit_forest(vec.filter("k % 4 > 0").repartition(11), "features", "label", trees=20)
    grown = lambda f: f.stages[0].toDebugString.split("\n", 1)[1]  # noqa: E731 - the first line holds the model's name
    assert grown(again) == grown(forest)             # the same forest however rows lie


def test_a_query_is_one_row_however_many_clusters_it_sees(spark):
    """Points without clusters: every query must see nearly all of them, and its vector is not copied to each."""
    X = np.random.default_rng(5).normal(size=(300, 6))
    held = vectors.fit_clusters(_df(spark, X, "i"), "i", "v", 40)
    q = _df(spark, X, "q").select("q", F.col("v").alias("_qv"), F.lit(-1e9).alias("_t"))
    probes = vectors._probes(q, held, 3, "_t")
    assert probes.count() == 300 and probes.agg(F.sum(F.size("_cls"))).head()[0] > 300 * 30
    assert max(b for _, b, _ in vectors._bins(held, 100)) < 6 and [n for _, _, n in vectors._bins(held, 5)].count(1) < 40


def test_repeated_queries_leave_out_their_own_items(spark, points):
    items, q = _df(spark, points, "i"), _df(spark, points[:40], "q")
    held = vectors.fit_clusters(items, "i", "v", 16)
    got, _ = vectors.pruned_topk(q.union(q), held, "q", "i", "v", k=2, exclude_self=True)
    assert got.filter("q = i").count() == 0 and got.count() == 80


def test_a_query_takes_only_a_bins_clusters_to_it(spark):
    X = np.random.default_rng(7).normal(size=(400, 6))
    held = vectors.fit_clusters(_df(spark, X, "i"), "i", "v", 40)
    bins = vectors._bins(held, 60)
    q = _df(spark, X, "q").select("q", F.col("v").alias("_qv"), F.lit(-1e9).alias("_t"))
    probes = vectors._probes(q, held, 3, "_t")
    got = vectors._by_bin(probes, bins).select("q", F.explode("_to").alias("b")).select("q", "b.bin", F.explode("b.cls").alias("c"))
    where = {c: range(b, b + n) for c, b, n in bins}
    want = sorted((r.q, b, c) for r in probes.collect() for c in r._cls for b in where[c])
    assert rows(got) == want and len(want) > 400 * 30

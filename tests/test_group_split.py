"""Stratified split of whole groups against its quotas and brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import group_split, split

from conftest import rows


def _sides(spark, data, **kw):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "k long, g string, label string")
    out = group_split.split_stratified_grouped(df, "g", "label", **kw)
    got = out.collect()
    assert len(got) == len(data) and out.columns == ["k", "g", "label", "split"]
    side = {}
    for r in got:
        assert side.setdefault(r.g, r.split) == r.split
    return df, out, side


def _off(data, side, quota):
    have = {}
    for g, lab in data:
        have[lab] = have.get(lab, 0) + (side[g] == "test")
    return sum(abs(have[lab] - q) for lab, q in quota.items())


@pytest.mark.parametrize("seed", range(3))
def test_close_to_the_best_choice_of_groups(spark, seed):
    random.seed(seed)
    data = [(f"g{g}", random.choice("abc")) for g in range(10) for _ in range(random.choice([1, 2, 3, 6]))]
    df, _, side = _sides(spark, data, fraction=0.3)
    quota = {r.label: r.n_test for r in split.stratified_quotas(df, "label", 0.3).collect()}
    names = sorted(side)
    best = min(_off(data, dict(zip(names, c, strict=True)), quota) for c in itertools.product(["test", "train"], repeat=len(names)))
    per = {}
    for r in data:
        per[r] = per.get(r, 0) + 1
    assert _off(data, side, quota) <= best + max(per.values())


def test_one_label_a_group_meets_its_bound(spark):
    random.seed(9)
    data = [(f"{lab}{g}", lab) for lab, n in (("a", 200), ("b", 60), ("c", 7)) for g in range(n) for _ in range(random.randint(1, 9))]
    data += [("hot", "a")] * 300
    df, out, side = _sides(spark, data)
    quota = {r.label: r.n_test for r in split.stratified_quotas(df, "label").collect()}
    got = {r.label: r.n for r in out.filter("split = 'test'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    for lab, largest in (("a", 300), ("b", 9), ("c", 9)):
        assert abs(got.get(lab, 0) - quota[lab]) <= largest / 2 + 1
    assert abs(got["a"] - quota["a"]) <= 1          # small groups make up for the large one


def test_order_partitions_nulls_and_empty(spark):
    random.seed(4)
    data = [(random.choice(["x", "y", None, *map(str, range(40))]), random.choice(["a", "b", None])) for _ in range(400)]
    df, out, _ = _sides(spark, data)
    again = group_split.split_stratified_grouped(df.repartition(9).orderBy(F.rand(3)), "g", "label")
    assert rows(out.select("k", "split")) == rows(again.select("k", "split"))
    report = group_split.split_report(out, "g", "label").collect()
    assert len(report) == 3 and all(r.within and r.n_split_groups == 0 for r in report)
    assert group_split.split_stratified_grouped(df.limit(0), "g", "label").count() == 0


def test_a_round_works_on_kinds(spark):
    """300 groups of two kinds, all on the train side: the moves come from one row a kind, and fill the quotas."""
    sides = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "g long, same long, side int").select(
        F.struct("g").alias("_g"), "same", "side")
    label = F.struct(F.col("l").alias("label")).alias("l")
    kinds = spark.createDataFrame([(0, "a", -2), (1, "b", -3)], "same long, l string, m long").select(
        "same", label, "m").select("same", F.col("l").alias("main"), F.array(F.struct("m", "l")).alias("p"))
    quotas = spark.createDataFrame([("a", 61), ("b", 9)], "l string, n_test long").select(label, "n_test").withColumnRenamed("l", "_l")
    moved = sorted(r["_g"]["g"] % 2 for r in group_split._improving(kinds, sides, quotas, 42).collect())
    assert moved == [0] * 30 + [1] * 3

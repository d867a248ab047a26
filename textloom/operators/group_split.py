"""Stratified split of whole groups (J2 with a group key).

Rows of a group stay on one side, and every label should have its J2 quota of rows
on the test side. Groups with several labels tie the quotas together, so groups are
assigned in three levels, each deciding all but at most one group of a cell:

1. groups with the same label counts are interchangeable: of k, ``floor(f k)`` are test
   and ``floor((1 - f) k)`` train, chosen by md5 order;
2. of those left over, groups with the same main label and size likewise;
3. what is left is at most one group per label and size: largest first, a group is
   test when the rows owed to its label reach half of its size.

Then groups are exchanged. In every round each label moves groups of that label alone,
largest first, as long as they fit into its distance from the quota; labels that have
none move the one group that lowers the sum of all distances most, and of such moves
that touch the same label the better one is made. Rounds stop when no move helps.

Groups with the same label counts on the same side are of one kind: a move helps by as much for
each of them, so a round works on the kinds and looks only for groups of the best ones.

Tables of groups are only counted, joined and hashed; what one task sees is a cell's
boundary (:func:`textloom.operators.split.assign_by_quota`), a label's distinct group
sizes, or one row per label. A null label or group is a value of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom import defaults as D
from textloom.operators.rank import topk
from textloom.operators.split import assign_by_quota, stratified_quotas
from textloom.session import saved

ROUNDS = 12
BATCH = 512                # groups of one label moved in a round


def _take(groups: DataFrame, cell: list[str], fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Decided groups (_g, side) and the groups left over, whose cells hold a fraction of a group."""
    test = F.floor(F.lit(fraction) * F.col("k"))
    cuts = groups.groupBy(*cell).agg(F.count(F.lit(1)).alias("k")).select(
        *cell, F.array(test, test + F.floor(F.lit(1.0 - fraction) * F.col("k"))).alias("cuts"))
    tagged = saved(assign_by_quota(groups.withColumn("_key", F.to_json("_g")), cell, ["_key"], cuts, seed), "split-level").drop("_key")
    decided = tagged.filter("_part < 2").select("_g", (1 - F.col("_part")).cast("int").alias("side"))
    return decided, tagged.filter("_part >= 2").drop("_part")


def _owed(groups: DataFrame, fraction: float) -> DataFrame:
    """Largest first, a group is test when its label is owed at least half of it."""
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<struct<g:string,side:int>>").alias("done"))

    def step(acc, e):
        owed = acc["owed"] + F.lit(fraction) * e["n"]
        test = owed >= e["n"] / 2
        one = F.struct(e["key"].alias("g"), F.when(test, 1).otherwise(0).alias("side"))
        return F.struct((owed - F.when(test, e["n"]).otherwise(0)).alias("owed"), F.concat(acc["done"], F.array(one)).alias("done"))

    sizes = groups.withColumn("_key", F.to_json("_g")).groupBy("main").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("m"), F.md5("_key").alias("h"), F.col("_key").alias("key"),
                                             F.col("_n").cast("double").alias("n")))).alias("all"))
    picked = sizes.select(F.explode(F.aggregate("all", start, step, lambda acc: acc["done"])).alias("d")).select("d.g", "d.side")
    return groups.withColumn("g", F.to_json("_g")).join(picked, "g").select("_g", "side")


def _improving(kinds: DataFrame, sides: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """(_g) of the groups to move in this round; no two touch the same label. ``kinds`` is (same, main, p), a row
    for all groups with the label counts ``p``; ``sides`` is (_g, same, side)."""
    per = saved(sides.groupBy("same", "side").agg(F.count(F.lit(1)).alias("k")).join(kinds, "same"), "split-kinds")
    placed = per.select("same", "side", "k", F.explode("p").alias("_p")).select(
        "same", "side", "k", F.col("_p.l").alias("_l"), (-F.col("_p.m")).alias("_c"))
    have = placed.groupBy("_l").agg(F.sum(F.when(F.col("side") == 1, F.col("_c") * F.col("k")).otherwise(0)).alias("have"))
    missing = saved(have.join(quotas, "_l").select("_l", (F.col("n_test") - F.col("have")).alias("d")), "split-missing")
    sign = 1 - 2 * F.col("side")
    gain = F.sum(F.abs("d") - F.abs(F.col("d") - sign * F.col("_c")))
    gains = placed.join(missing, "_l").groupBy("same", "side", "k").agg(
        gain.alias("gain"), F.count(F.lit(1)).alias("labels"), F.sum("_c").alias("n")).filter("gain > 0")
    gains = saved(gains.join(kinds.select("same", "main"), "same"), "split-gains")
    # of the kinds, those whose larger ones have fewer groups than a round moves
    larger = F.sum("k").over(Window.partitionBy("main").orderBy(-F.col("n")).rangeBetween(Window.unboundedPreceding, -1))
    alone = gains.filter("labels = 1 AND gain = n").withColumn("larger", F.coalesce(larger, F.lit(0))).filter(F.col("larger") < BATCH)
    alone = sides.join(alone.drop("larger"), ["same", "side"])
    pure = topk(alone, ["main"], [F.desc("n"), F.md5(F.to_json("_g")), F.to_json("_g")], BATCH)
    ahead = F.sum("n").over(Window.partitionBy("main").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    pure = pure.withColumn("ahead", ahead).join(missing, F.col("main") == F.col("_l")).filter(F.col("ahead") <= F.abs("d"))
    pure = saved(pure.select("_g", "main"), "split-pure")
    order = F.struct("gain", F.md5(F.concat_ws("|", F.lit(str(seed)), F.to_json("_g"))))
    most = gains.withColumn("most", F.max("gain").over(Window.partitionBy("main"))).filter("gain = most").drop("most")
    best = sides.join(most, ["same", "side"]).groupBy("main").agg(F.max_by(F.struct("_g", "same", "gain"), order).alias("m")) \
        .select("m._g", "m.same", "m.gain")
    touched = saved(best.join(kinds, "same").select("_g", F.explode("p.l").alias("_l"), "gain"), "split-moves")       # one group a label
    first = touched.groupBy("_l").agg(F.max_by("_g", order).alias("first"))
    busy = pure.select(F.col("main").alias("_l")).distinct().withColumn("busy", F.lit(True))
    free = (F.col("_g") == F.col("first")) & F.col("busy").isNull()
    single = touched.join(first, "_l").join(busy, "_l", "left").groupBy("_g").agg(F.min(free).alias("wins")).filter("wins").select("_g")
    return pure.select("_g").union(single)


def split_stratified_grouped(df: DataFrame, group_key: str, label: str, fraction: float = D.TEST_FRACTION,
                             seed: int = D.SPLIT_SEED, names: tuple[str, str] = ("test", "train"), out: str = "split",
                             rounds: int = ROUNDS) -> DataFrame:
    """J2 with groups: ``df`` with the side of each row; no group is on both sides. For a label
    whose rows all lie in groups of that label alone, the test side is off its quota by at most
    half of the label's largest group, plus one row of rounding."""
    x = df.select(F.struct(group_key).alias("_g"), F.struct(label).alias("_l"))
    counts = saved(x.groupBy("_g", "_l").agg(F.count(F.lit(1)).alias("_c")), "split-counts")
    profile = F.array_sort(F.collect_list(F.struct((-F.col("_c")).alias("m"), F.col("_l").alias("l"))))
    whole = saved(counts.groupBy("_g").agg(F.sum("_c").alias("_n"), profile.alias("p")).select(
        "_g", "_n", F.element_at("p", 1)["l"].alias("main"), F.xxhash64("p").alias("same"), "p"), "split-groups")
    groups = whole.drop("p")
    kinds = saved(whole.groupBy("same").agg(F.first("main").alias("main"), F.first("p").alias("p")), "split-profiles")
    quotas = saved(stratified_quotas(df.select(label), label, fraction).select(F.struct(label).alias("_l"), "n_test"), "split-quotas")
    alike, rest = _take(groups, ["same"], fraction, seed)
    sized, rest = _take(rest, ["main", "_n"], fraction, seed)
    sides = saved(alike.union(sized).union(_owed(rest, fraction)).join(groups.select("_g", "same"), "_g"), "split-sides")
    for _ in range(rounds):
        moves = saved(_improving(kinds, sides, quotas, seed), "split-exchange")
        if moves.isEmpty():
            break
        sides = saved(sides.join(moves.withColumn("moved", F.lit(1)), "_g", "left").select(
            "_g", "same", F.when(F.col("moved") == 1, 1 - F.col("side")).otherwise(F.col("side")).alias("side")), "split-sides")
    side = F.when(F.col("side") == 1, names[0]).otherwise(names[1])
    return df.withColumn("_g", F.struct(group_key)).join(sides.drop("same"), "_g").withColumn(out, side).drop("_g", "side")


def split_report(tagged: DataFrame, group_key: str, label: str, fraction: float = D.TEST_FRACTION,
                 test: str = "test", side: str = "split") -> DataFrame:
    """Per label: rows, quota of test rows, groups on both sides that hold it, and whether the test
    rows are within the label's largest count in one group of the quota."""
    t = tagged.select(F.struct(group_key).alias("_g"), F.col(label).alias(label), F.col(side).alias("_s"))
    per = t.groupBy("_g", label).agg(F.count(F.lit(1)).alias("c"), F.sum((F.col("_s") == test).cast("int")).alias("in_test"))
    both = t.groupBy("_g").agg((F.min("_s") != F.max("_s")).cast("long").alias("split"))
    seen = per.join(both, "_g").groupBy(label).agg(F.max("c").alias("largest"), F.sum("in_test").alias("got"), F.sum("split").alias("n_split_groups"))
    quotas = stratified_quotas(tagged.select(label), label, fraction).select(F.col(label).alias("_q"), "n_label", "n_test")
    return seen.join(quotas, F.col(label).eqNullSafe(F.col("_q"))).select(
        label, "n_label", "n_test", "n_split_groups", (F.abs(F.col("got") - F.col("n_test")) <= F.col("largest")).alias("within"))

"""Ranking primitives: per-group top-k (G1/G4/G5) and exact global rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import checkpoint_root


def topk(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int,
         rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k per group by ``order``.

    ``row_number`` + filter is planned as WindowGroupLimit: a partial limit
    runs before the shuffle, so a hot group ships at most k rows per map task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number over the whole table in ``order``.

    ``order`` must be a total order (end with a unique key). The table is
    range-partitioned, sorted within partitions, checkpointed to the shared folder (so both passes
    below see the same layout even after executor loss), then numbered by
    per-partition offsets -- no single task sees more than one range.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id())
            .checkpoint(eager=True))
    offsets = (laid.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0"))
               .withColumn("_off", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return (laid.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(rank_col, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_pid", "_mid", "_off", "_m0"))

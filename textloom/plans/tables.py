"""Loading the driver tables (one Parquet file per table)."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Primary keys used to spread a table whose file has fewer splits than task slots.
KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
        "lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id",
        "embeddings": "vec_id", "part": "p_partkey", "customer": "c_custkey"}
BYTES_PER_SLICE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table. A file stored as one row group is scanned by one task
    whatever its size; when the scan yields fewer splits than the file size
    warrants (1 MiB per task, up to the default parallelism), the rows are
    hash-spread by the table key. On a cluster with many files and row
    groups the scan already has enough splits and nothing is added."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    key = KEYS.get(name)
    if key is None or not os.path.exists(path):
        return df
    want = min(spark.sparkContext.defaultParallelism,
               math.ceil(os.path.getsize(path) / BYTES_PER_SLICE))
    if want > 1 and df.rdd.getNumPartitions() < want:
        df = df.repartition(want, key)
    return df

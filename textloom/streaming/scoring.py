"""Structured Streaming query scoring.

Queries arrive as a stream; each micro-batch is scored against static,
fitted tables (TF-IDF vocabulary and document term counts) and its top-k
rows are appended to a Parquet sink. Ranking windows are not allowed on
streaming DataFrames, so scoring runs per batch in ``foreachBatch``, where
the batch is an ordinary DataFrame. Queries that cannot be scored come back with an
``error``; they go to the error sink, the others to the sink. A failure of
the engine itself fails the batch, which Spark then runs again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import not_blank


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str,
                 checkpoint: str, query_col: str | None = None,
                 stop_words: Sequence[str] | None = None, available_now: bool = True,
                 error_sink: str | None = None, after_batch: Callable[[int], None] | None = None):
    """Start the streaming job; returns the ``StreamingQuery``.

    ``score(batch_df)`` maps a static batch of queries to result rows, written
    to ``sink/batch_id=<epoch>`` (idempotent per batch). Rows with a non-null
    ``error`` column, if the scorer has one, are written to ``error_sink`` instead.
    ``after_batch(epoch)`` is called when a batch is in its sinks and Spark has not committed it yet;
    if it (or the driver) fails there, the restarted stream runs the batch again into the same folders.
    ``query_col``: optional blank / exit-word filter (C13) before scoring.
    """
    src = stream
    if query_col is not None:
        src = src.filter(not_blank(query_col, stop_words or ("exit", "quit", "q")))

    def run(batch: DataFrame, epoch: int):
        # one folder per micro-batch, overwritten on retry: a batch re-run
        # after a failure replaces its rows instead of appending duplicates
        out = score(batch)
        if "error" in out.columns and error_sink is not None:
            out = out.persist()
            (out.filter("error IS NOT NULL").write.mode("overwrite").parquet(f"{error_sink}/batch_id={epoch}"))
            out.filter("error IS NULL").drop("error").write.mode("overwrite").parquet(f"{sink}/batch_id={epoch}")
            out.unpersist()
        else:
            out.write.mode("overwrite").parquet(f"{sink}/batch_id={epoch}")
        if after_batch is not None:
            after_batch(epoch)

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def with_errors(results: DataFrame, queries: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    """``results`` with a null ``error``, and one row with ``reason`` for each query that has no result
    (null-safe on the keys), so that every query of a batch leaves a row in one of the sinks."""
    found = results.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    missed = queries.select(*keys).distinct().join(found, same, "left_anti").withColumn("error", F.lit(reason))
    return results.withColumn("error", F.lit(None).cast("string")).unionByName(missed, allowMissingColumns=True)


def file_stream(spark, folder: str, file_glob: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """A Parquet file-source stream over what ``file_glob`` names in ``folder``: files, or a table that is
    a folder of part files."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{file_glob}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ()
    if any(f.isDirectory() for f in found):
        return r.parquet(path.toString())
    return r.option("pathGlobFilter", file_glob).parquet(folder)

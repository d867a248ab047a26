"""The scoring stream equals the batch query; a query that cannot be scored
leaves an error row and the others their results. M1: one load per worker."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from textloom.functions.text import drop_blank
from textloom.operators.scoring import score_batch

from textloom.session import shared_path
from textloom.streaming import scoring as stream

from conftest import SF_SMALL, rows


def _src(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").schema
    return stream.file_stream(spark, SF_SMALL, "conversations.parquet", schema)


def test_stream_matches_batch(spark):
    sink, ckpt = shared_path(spark, "t-sink"), shared_path(spark, "t-ckpt")

    def score(batch):
        return batch.filter(F.col("role") == "user").select("conv_id", "turn")

    stream.score_stream(_src(spark), score, sink, ckpt).awaitTermination()
    got = spark.read.parquet(sink).select("conv_id", "turn")
    want = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").filter("role = 'user'")
    assert rows(got) == rows(want, "conv_id", "turn")


def test_bad_query_leaves_the_others(spark):
    sink, ckpt, errs = (shared_path(spark, n) for n in ("t-sink", "t-ckpt", "t-err"))

    def scorer(model, pdf):
        if (pdf["conv_id"] == 7).any():
            raise ValueError("bad query")
        return pdf[["conv_id", "turn"]].assign(label="x", score=1.0)

    def score(batch):
        return score_batch(batch, ["conv_id", "turn"], "text", lambda: "model", scorer, "t-stream")

    stream.score_stream(_src(spark), score, sink, ckpt, query_col="text", error_sink=errs).awaitTermination()
    good, bad = spark.read.parquet(sink), spark.read.parquet(errs)
    turns = drop_blank(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"), "text")
    assert rows(bad, "conv_id", "turn") == rows(turns.filter("conv_id = 7"), "conv_id", "turn")
    assert bad.count() > 0 and all("bad query" in r.error for r in bad.collect())
    assert rows(good, "conv_id", "turn") == rows(turns.filter("conv_id <> 7"), "conv_id", "turn")


def test_engine_failure_fails_the_batch(spark):
    sink, ckpt = shared_path(spark, "t-sink"), shared_path(spark, "t-ckpt")

    def score(batch):
        raise ValueError("model not available")

    with pytest.raises(StreamingQueryException):
        stream.score_stream(_src(spark), score, sink, ckpt).awaitTermination()


def test_model_is_loaded_once_per_worker(spark):
    folder = tempfile.mkdtemp(prefix="textloom-loads-")

    def load():
        with tempfile.NamedTemporaryFile(dir=folder, prefix=f"{os.getpid()}-", delete=False):
            return 1

    def scorer(model, pdf):
        return pdf[["id"]].assign(label="x", score=float(model))

    for _ in range(2):
        df = spark.range(64).repartition(16).withColumn("f", F.lit(1.0))
        assert score_batch(df, "id", "f", load, scorer, f"loads-{folder}").count() == 64
    pids = [f.split("-")[0] for f in os.listdir(folder)]
    assert len(pids) == len(set(pids))


def test_stopped_between_sink_and_commit(spark):
    """A failure after the sinks are written and before the commit: the restarted stream runs the batch
    again, and every turn is in one sink once."""
    src = "/root/testdata/sf0.001/conversations.parquet"
    data = spark.read.parquet(src).select("conv_id", "turn", "role", "text")
    poison = spark.createDataFrame([(10_000, 0, "user", "\u2603 \u2603"), (None, 1, "user", "?")], data.schema)
    folder = shared_path(spark, "t-in")
    data.union(poison).repartition(4, "conv_id").write.parquet(folder)
    sink, ckpt, errs = (shared_path(spark, n) for n in ("t-sink", "t-ckpt", "t-err"))
    calls = []

    def score(batch):
        users = batch.filter("role = 'user'").select("conv_id", "turn", "text")
        hits = users.filter(F.col("text").rlike("[a-z]")).select("conv_id", "turn", F.lit(1.0).alias("score"))
        return stream.with_errors(hits, users, ["conv_id", "turn"], "no words")

    def stop_once(epoch):
        calls.append(epoch)
        if len(calls) == 2:
            raise RuntimeError("driver lost")

    def start():
        stream.score_stream(stream.file_stream(spark, folder, "*.parquet", data.schema, files_per_batch=1), score, sink, ckpt,
                            error_sink=errs, after_batch=stop_once).awaitTermination()

    with pytest.raises(StreamingQueryException):
        start()
    start()
    assert len(calls) > len(set(calls))                  # one batch ran twice
    key = lambda df: sorted((tuple(r) for r in df.select("conv_id", "turn").collect()), key=repr)
    good, bad = spark.read.parquet(sink), spark.read.parquet(errs)
    assert key(bad) == [(10_000, 0), (None, 1)] and {r.error for r in bad.collect()} == {"no words"}
    assert key(good) == key(data.filter("role = 'user'"))


def test_a_table_of_part_files_is_streamed_whole(spark):
    """A table stored as a folder of part files, as large tables are, has every row in the stream."""
    data = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    folder = shared_path(spark, "t-parts")
    data.repartition(5, "conv_id").write.parquet(f"{folder}/conversations.parquet")
    data.limit(3).write.parquet(f"{folder}/other.parquet")
    sink, ckpt = shared_path(spark, "t-sink"), shared_path(spark, "t-ckpt")
    src = stream.file_stream(spark, folder, "conversations.parquet", data.schema, files_per_batch=2)
    stream.score_stream(src, lambda batch: batch.select("conv_id", "turn"), sink, ckpt).awaitTermination()
    assert rows(spark.read.parquet(sink), "conv_id", "turn") == rows(data, "conv_id", "turn")

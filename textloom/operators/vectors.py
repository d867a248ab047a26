"""Dense vectors: normalisation, embedding hook, exact inner-product top-k (H1-H4).

Top-k over many items is exact and pruned. Items lie in coarse clusters with a centre c and
a radius r (their largest distance from c), so no item of a cluster scores more than
``q.c + |q| r`` against a query q (Cauchy-Schwarz). The clusters nearest to a query that
hold k items give its first threshold, the k-th score; of the other clusters only those
whose bound reaches it are scored. Clusters lie in bins of bounded size, and a query travels once to
each bin that holds a cluster it must see. A task holds one bin and streams its queries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import l2_normalize
from textloom.operators import blocked
from textloom.operators.rank import topk
from textloom.session import saved

# Rows of a block: a task holds one query block and one item block.
QUERY_BLOCK = 4_096
ITEM_BLOCK = 32_768
MAX_CLUSTERS = 1_024       # centres are broadcast: MAX_CLUSTERS x dimensions numbers
SLACK = 1e-8               # covers rounding of scores and bounds
PROBE_CELLS = 1_000_000    # (query, centre) pairs looked at at once
CELL_BLOCKS = 4            # query blocks that a task scores against its bin, one after the other, at least
CELLS = 256                # cells of all bins, about: each cell of a bin is a copy of its items


def normalize(df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
    """H3: L2-normalise a vector column (zero vector stays zero)."""
    return df.withColumn(out or vec, l2_normalize(vec))


def embed(df: DataFrame, id_col: str, text: str, fn: Callable[[list[str]], np.ndarray],
          out: str = "embedding", element: T.DataType = T.FloatType()) -> DataFrame:
    """H2: apply a user encoder to text batches (Arrow, once per batch); ``element`` is float or double."""
    schema = T.StructType([df.schema[id_col], T.StructField(out, T.ArrayType(element))])
    kind = np.float64 if isinstance(element, T.DoubleType) else np.float32

    def run(batches):
        for pdf in batches:
            vecs = np.asarray(fn(pdf[text].tolist()), dtype=kind)
            yield pd.DataFrame({id_col: pdf[id_col], out: list(vecs)})

    return df.select(id_col, text).mapInPandas(run, schema)


@dataclass
class Clusters:
    """Items in coarse clusters: ``items`` is (id, _iv, _cl); the arrays describe cluster 0, 1, ..."""
    items: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


def fit_clusters(items: DataFrame, iid: str, vec: str, count: int, rounds: int = 2, seed: int = 42) -> Clusters:
    """H4: coarse clusters. Centres start at the ``count`` items that a hash orders first and move to
    their members' means; the radius is exact for the centres used, so results do not depend on the fit."""
    count = max(1, min(count, MAX_CLUSTERS))
    x = items.select(iid, F.col(vec).cast("array<double>").alias("_iv"))
    first = x.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(iid).cast("string"))), iid).limit(count).collect()
    dims = len(first[0]["_iv"]) if first else 0
    centres = np.array([r["_iv"] for r in first], dtype=np.float64).reshape(len(first), dims)
    schema = T.StructType([*x.schema.fields, T.StructField("_cl", T.IntegerType()), T.StructField("_d", T.DoubleType())])

    def assigned(c: np.ndarray) -> DataFrame:
        table = items.sparkSession.sparkContext.broadcast(c)     # at most MAX_CLUSTERS rows

        def run(batches):
            c = table.value
            for pdf in batches:
                if len(pdf):
                    v = np.stack(pdf["_iv"].to_numpy()).astype(np.float64)
                    near = ((c * c).sum(1)[None, :] - 2 * v @ c.T).argmin(1)
                    yield pdf.assign(_cl=near.astype(np.int32), _d=np.sqrt(((v - c[near]) ** 2).sum(1)))

        return x.mapInPandas(run, schema)

    for _ in range(rounds if len(first) > 1 else 0):
        means = (assigned(centres).select("_cl", F.posexplode("_iv").alias("p", "v")).groupBy("_cl", "p").agg(F.avg("v").alias("v"))
                 .groupBy("_cl").agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("c"))).collect()
        for r in means:
            centres[r["_cl"]] = [v["v"] for v in r["c"]]
    held = saved(assigned(centres), "vector-clusters") if len(first) else x.withColumns({"_cl": F.lit(0), "_d": F.lit(0.0)})
    radii, sizes = np.zeros(len(first)), np.zeros(len(first), np.int64)
    for r in held.groupBy("_cl").agg(F.max("_d").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radii[r["_cl"]], sizes[r["_cl"]] = r["r"], r["n"]
    return Clusters(held.drop("_d"), centres, radii, sizes)


def _probes(queries: DataFrame, c: Clusters, need: int, threshold: str | None) -> DataFrame:
    """``queries`` (id, _qv) with the clusters to score, ``_cls``: first the nearest that hold ``need`` items,
    later (with a ``threshold`` column, kept) all others whose bound reaches it. A query without any is left out."""
    model = queries.sparkSession.sparkContext.broadcast((c.centres, c.radii, c.sizes))
    schema = T.StructType([*queries.schema.fields, T.StructField("_cls", T.ArrayType(T.IntegerType()))])
    arrow = blocked.arrow_schema(schema)
    step = max(1, PROBE_CELLS // max(1, len(c.centres)))

    def run(batches):
        centres, radii, sizes = model.value
        for b in batches if len(centres) else ():
            for s in range(0, len(b), step):
                part = b.slice(s, step)
                q = blocked.matrix(part.column("_qv"))
                near = q @ centres.T
                order = np.argsort(-near, axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                take = np.zeros(near.shape, bool)
                np.put_along_axis(take, order, np.c_[np.zeros(len(q)), held[:, :-1]] < need, axis=1)
                if threshold is not None:
                    bound = near + np.linalg.norm(q, axis=1)[:, None] * radii[None, :]
                    bar = part.column(threshold).to_numpy(zero_copy_only=False)
                    take = ~take & (bound >= bar[:, None] - SLACK) & (sizes > 0)[None, :]
                some = np.flatnonzero(take.any(axis=1))
                cl = pa.array(np.nonzero(take)[1].astype(np.int32))
                ends = np.r_[0, np.cumsum(take[some].sum(axis=1))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(some)).columns, pa.ListArray.from_arrays(pa.array(ends), cl)], schema=arrow)

    return queries.mapInArrow(run, schema)


def _bins(c: Clusters, item_block: int) -> list[tuple[int, int, int]]:
    """(cluster, first bin, bins): small clusters share a bin of about ``item_block`` items, a larger one
    has several of its own."""
    out, at, full = [], -1, item_block
    for cl, n in enumerate(c.sizes.tolist()):
        parts = blocked.blocks_of(n, item_block)
        if parts > 1 or full + n > item_block:
            at, full = at + 1, 0
        out.append((cl, at, parts))
        at, full = (at + parts - 1, item_block) if parts > 1 else (at, full + n)
    return out


def _by_bin(probes: DataFrame, bins: list[tuple[int, int, int]]) -> DataFrame:
    """``probes`` with ``_to`` in place of ``_cls``: each bin that a query must see, with its clusters there."""
    first, count = (np.array([b[c] for b in bins], np.int64) for c in (1, 2))
    kind = T.StructType([T.StructField("bin", T.IntegerType()), T.StructField("cls", T.ArrayType(T.IntegerType()))])
    schema = T.StructType([*[f for f in probes.schema.fields if f.name != "_cls"], T.StructField("_to", T.ArrayType(kind))])
    arrow = blocked.arrow_schema(schema)
    step = max(1, PROBE_CELLS // max(1, len(bins)))

    def run(batches):
        for b in batches:
            for s in range(0, len(b), step):
                part = b.slice(s, step)
                cl = part.column("_cls").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(part)), pc.list_value_length(part.column("_cls")).to_numpy(zero_copy_only=False))
                n = count[cl]
                at = np.repeat(first[cl] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                row, cl = np.repeat(row, n), np.repeat(cl, n)
                order = np.lexsort((at, row))
                row, at, cl = row[order], at[order], cl[order]
                new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1])][:len(row)])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(row)].astype(np.int32)), pa.array(cl.astype(np.int32)))
                to = pa.StructArray.from_arrays([pa.array(at[new].astype(np.int32)), lists], ["bin", "cls"])
                ends = np.r_[0, np.cumsum(np.bincount(row[new], minlength=len(part)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([*[part.column(f) for f in arrow.names[:-1]], pa.ListArray.from_arrays(pa.array(ends), to)
                                                  .cast(arrow.field("_to").type)], schema=arrow)

    return probes.mapInArrow(run, schema)


def _score_cells(probes: DataFrame, c: Clusters, qid: str, iid: str, k: int, exclude_self: bool,
                 query_block: int, item_block: int, threshold: str | None = None) -> DataFrame:
    """Top-k of each bin of the probed clusters. Items lie in bins of bounded size; a query goes once to
    each bin that holds a cluster it must see, whatever the number of its clusters there. A bin's queries
    are cut into cells of ``CELL_BLOCKS`` query blocks or more, so a bin that all queries ask for is many tasks; the
    more bins, the fewer cells, since each has the bin's items."""
    spark = probes.sparkSession
    schema = T.StructType([probes.schema[qid], c.items.schema[iid], T.StructField("score", T.DoubleType())])
    bins = _bins(c, item_block)
    if not bins:
        return spark.createDataFrame([], schema)
    table = F.broadcast(spark.createDataFrame(bins, "_cl int, _b0 int, _bs int"))    # at most MAX_CLUSTERS rows
    bar = F.col(threshold) if threshold else F.lit(float("-inf"))
    q = _by_bin(probes, bins).withColumn("_to", F.explode("_to")).select(
        F.col("_to.bin").alias("_bin"), F.col(qid).alias("_q"), F.col("_qv").alias("_v"), bar.alias("_t"), F.col("_to.cls").alias("_cls"))
    asked = saved(q.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")), "vector-bins")     # one row a bin
    most = blocked.blocks_of(CELLS, max(b + n for _, b, n in bins))
    cut = asked.select("_bin", F.least(F.ceil(F.col("_n") / (query_block * CELL_BLOCKS)), F.lit(most)).cast("int").alias("_qps"))
    q = q.join(F.broadcast(cut), "_bin").withColumn("_cell", F.pmod(F.xxhash64("_q"), "_qps").cast("int"))
    i = c.items.join(table, "_cl").withColumn("_bin", F.col("_b0") + F.pmod(F.xxhash64(iid), "_bs").cast("int"))
    i = i.join(F.broadcast(cut), "_bin").withColumn("_cell", F.explode(F.sequence(F.lit(0), F.col("_qps") - 1)))
    none = lambda df, col: F.lit(None).cast(df.schema[col].dataType)
    rows = i.select("_bin", "_cell", F.lit(0).alias("_kind"), none(q, "_q").alias("_q"), F.col(iid).alias("_i"), F.col("_iv").alias("_v"),
                    none(q, "_t").alias("_t"), F.array("_cl").alias("_cls")).union(
        q.select("_bin", "_cell", F.lit(1).alias("_kind"), "_q", none(c.items, iid).alias("_i"), "_v", "_t", "_cls"))
    rows = rows.repartition("_bin", "_cell").sortWithinPartitions("_bin", "_cell", "_kind")
    return rows.mapInArrow(blocked.stream_cells(k, exclude_self, query_block, schema), schema)


def pruned_topk(queries: DataFrame, clusters: Clusters, qid: str, iid: str, vec: str, k: int = 3, exclude_self: bool = False,
                query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> tuple[DataFrame, DataFrame]:
    """H4: the exact top-k of :func:`vector_topk`, and the probes (qid, _cl) that were scored."""
    q = queries.select(qid, F.col(vec).cast("array<double>").alias("_qv"))
    order = [F.round("score", blocked.SCORE_DECIMALS).desc(), F.col(iid).asc()]
    sizes = (qid, iid, k, exclude_self, query_block, item_block)
    need = k + int(exclude_self)
    near = saved(_probes(q, clusters, need, None), "vector-near")
    first = saved(_score_cells(near, clusters, *sizes), "vector-first")
    kth = topk(first, [qid], order, k).groupBy(F.col(qid).alias("_k")).agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).alias("_t"))
    bar = q.join(kth, F.col(qid).eqNullSafe(F.col("_k")), "left").withColumn("_t", F.coalesce("_t", F.lit(float("-inf"))))
    more = saved(_probes(bar.select(qid, "_qv", "_t"), clusters, need, "_t"), "vector-probes")
    rest = _score_cells(more, clusters, *sizes, "_t")
    scored = [p.select(qid, F.explode("_cls").alias("_cl")) for p in (near, more)]
    return topk(first.union(rest), [qid], order, k), scored[0].union(scored[1])


def scored_pairs(probes: DataFrame, clusters: Clusters, n_queries: int) -> DataFrame:
    """Pairs of query and item that were scored, of all pairs."""
    sizes = probes.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(clusters.sizes)], "_cl int, _n long")
    return probes.join(F.broadcast(sizes), "_cl").agg(F.sum("_n").alias("scored")).select(
        "scored", F.lit(int(n_queries) * int(clusters.sizes.sum())).cast("long").alias("pairs"))


def vector_topk(queries: DataFrame, items: DataFrame, qid: str, iid: str, vec: str,
                k: int = 3, exclude_self: bool = False, item_vec: str | None = None,
                query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """Exact top-k items per query by inner product (ties: smaller item id).

    Items of one block are scored as one, block of queries by block of queries. More are put into
    about ``sqrt(n)`` clusters and pruned by their bounds (:func:`pruned_topk`), so rows of
    neither side are copied to all blocks of the other. Returns ``qid, iid, score, rank`` with
    ``min(k, items)`` rows per query.
    """
    item_vec = item_vec or vec
    n_items = items.count()
    if n_items > item_block:
        held = fit_clusters(items.select(iid, item_vec), iid, item_vec, int(n_items ** 0.5))
        return pruned_topk(queries, held, qid, iid, vec, k, exclude_self, query_block, item_block)[0]
    schema = T.StructType([queries.schema[qid], items.schema[iid], T.StructField("score", T.DoubleType())])
    pairs = blocked.grid(queries.select(qid, F.col(vec).alias("_qv")), items.select(iid, F.col(item_vec).alias("_iv")),
                         [qid], iid, blocked.blocks_of(queries.count(), query_block), 1)
    cands = pairs.applyInPandas(blocked.dense_block(qid, "_qv", iid, "_iv", k, exclude_self), schema)
    order = [F.round("score", blocked.SCORE_DECIMALS).desc(), F.col(iid).asc()]
    return topk(cands, [qid], order, k)

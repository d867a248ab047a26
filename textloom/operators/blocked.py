"""Exact top-k scoring of queries against blocks of items.

Used by sparse (H5) and dense (H4) retrieval. Sparse: a task gets a block's document rows
first, then the queries that ask for the block as a stream, and scores them a few
thousand at a time (:func:`stream_blocks`). Dense: every (query block, item block) is one
group of a cogroup. Tasks use NumPy and emit the exact top-k per query (ties broken by item
id). Neither side passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORE_DECIMALS = 9
MAX_CELLS = 4_000_000      # dense (items x queries) block per step
MAX_PAIRS = 8_000_000      # term-posting expansions per step
BAR_SLACK = 1e-8           # covers the rounding of scores


def _select_block(S, hit, k):
    """(row, col) of entries that can be in a column's top-k (ties kept)."""
    Sr = np.where(hit, np.round(S, SCORE_DECIMALS), -np.inf)
    if S.shape[0] > k:
        kth = -np.partition(-Sr, k - 1, axis=0)[k - 1]
        sel = hit & (Sr >= kth[None, :])
    else:
        sel = hit
    return np.nonzero(sel)


def _final_topk(q_idx, item, score, k):
    """Exact top-k per query under (rounded score desc, item asc)."""
    if len(q_idx) == 0:
        return q_idx, item, score
    r = np.round(score, SCORE_DECIMALS)
    order = np.lexsort((item, -r, q_idx))
    q_s = q_idx[order]
    start = np.r_[0, np.flatnonzero(np.diff(q_s)) + 1]
    pos = np.arange(len(q_s)) - np.repeat(start, np.diff(np.r_[start, len(q_s)]))
    keep = order[pos < k]
    return q_idx[keep], item[keep], score[keep]


class _Candidates:
    def __init__(self, k):
        self.k = k
        self.parts = []
        self.size = 0

    def add(self, q, item, score):
        if len(q):
            self.parts.append((q, item, score))
            self.size += len(q)
        if self.size > 2_000_000:
            self.parts = [self.result()]
            self.size = len(self.parts[0][0])

    def result(self):
        if not self.parts:
            return np.array([], dtype=np.int64), np.array([]), np.array([], dtype=np.float64)
        q = np.concatenate([p[0] for p in self.parts])
        it = np.concatenate([p[1] for p in self.parts])
        s = np.concatenate([p[2] for p in self.parts])
        return _final_topk(q, it, s, self.k)


def _emit(qkeys: dict, item_col: str, q, item, score) -> pd.DataFrame:
    out = {c: np.asarray(v)[q] for c, v in qkeys.items()}
    out[item_col] = item
    out["score"] = score
    return pd.DataFrame(out)


def blocks_of(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def grid(queries: DataFrame, items: DataFrame, qids: list[str], iid: str, n_q: int, n_i: int):
    """The two sides grouped by (query block, item block): a row of one side goes
    to every block of the other."""
    def side(df, keys, mine, n, other, m):
        return (df.withColumn(mine, F.pmod(F.xxhash64(*keys), F.lit(n)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))))

    q = side(queries, qids, "_qb", n_q, "_ib", n_i)
    i = side(items, [iid], "_ib", n_i, "_qb", n_q)
    return q.groupBy("_qb", "_ib").cogroup(i.groupBy("_qb", "_ib"))


def stream_blocks(queries: DataFrame, docs: DataFrame, qids: list[str], did: str, k: int, query_block: int, schema) -> DataFrame:
    """Top-k of each query in each block it asks for. ``queries``: (qids, _ib, _t, _w); ``docs``: (did, _t,
    _wd, _ib). Rows meet by block: a task reads a block's documents, then streams its queries."""
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    left = docs.select("_ib", F.lit(0).alias("_kind"), *[none(queries, c) for c in qids], F.col(did).alias("_did"), "_t", F.col("_wd").alias("_w"))
    right = queries.select("_ib", F.lit(1).alias("_kind"), *qids, none(docs, did).alias("_did"), "_t", "_w")
    rows = left.union(right).repartition("_ib").sortWithinPartitions("_ib", "_kind", *qids)
    score = sparse_block(qids, did, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, doc_parts, ddf, parts, seen = None, [], None, [], 0

        def scores() -> Iterator[pa.RecordBatch]:
            nonlocal ddf, parts, seen
            if parts and (doc_parts or ddf is not None):
                if ddf is None:
                    ddf = pd.concat(doc_parts, ignore_index=True).sort_values(did, kind="stable")
                    doc_parts.clear()
                out = score(pd.concat(parts, ignore_index=True), ddf)
                if len(out):
                    yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)
            parts, seen = [], 0

        for b in batches:
            at = b.column("_ib").to_numpy(zero_copy_only=False)
            kind = b.column("_kind").to_numpy()
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1
            for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(b)], strict=True):
                if j <= i:
                    continue
                if at[i] != block:
                    yield from scores()
                    block, doc_parts, ddf = at[i], [], None
                part = b.slice(i, j - i)
                if kind[i] == 0:
                    doc_parts.append(part.select(["_did", "_t", "_w"]).to_pandas().set_axis([did, "_t", "_wd"], axis=1))
                    continue
                pdf = part.select([*qids, "_t", "_w"]).to_pandas().rename(columns={"_w": "weight"})
                new = pdf[qids].ne(pdf[qids].shift()).any(axis=1).to_numpy()
                starts = np.flatnonzero(new)
                if seen and len(starts) and (parts[-1][qids].iloc[-1] == pdf[qids].iloc[0]).all():
                    starts = starts[1:]                  # a query that began in the batch before
                if seen and len(starts) and seen + len(starts) > query_block:
                    if starts[0]:
                        parts.append(pdf.iloc[:starts[0]])
                    yield from scores()
                    pdf = pdf.iloc[starts[0]:]
                if len(pdf):
                    parts.append(pdf)
                    seen += len(starts)
        yield from scores()

    arrow = arrow_schema(schema)
    return rows.mapInArrow(run, schema)


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of numbers, all of one length and none null."""
    flat = col.flatten()
    if col.null_count or flat.null_count or (len(col) and len(flat) % len(col)):
        raise ValueError("vectors must have one length and no nulls")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(col), -1)


def stream_cells(k: int, exclude_self: bool, query_block: int, schema):
    """Rows (_bin, _cell, _kind, _q, _i, _v, _t, _cls) sorted by the first three: a cell's items first, each
    with its cluster, then its queries with the clusters they ask for and the score ``_t`` that counts.
    Gives each query's top-k of the cell; holds the items and ``query_block`` queries."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, held, waiting, seen = None, [], None, [], 0

        def items():
            cl = np.concatenate([p[2] for p in parts])
            order = np.argsort(cl, kind="stable")
            names, first = np.unique(cl[order], return_index=True)
            return (np.concatenate([p[0] for p in parts])[order], np.concatenate([p[1] for p in parts])[order],
                    dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(cl)], strict=True), strict=True)))

        def scores() -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting, seen
            if waiting and (parts or held):
                if held is None:
                    held = items()
                    parts.clear()
                batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                out = _score_cell(batch, *held, k, exclude_self)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([batch.column("_q").take(pa.array(out[0])), pa.array(out[1], arrow.field(1).type, from_pandas=True), pa.array(out[2])], schema=arrow)
            waiting, seen = [], 0

        for b in batches:
            key = np.stack([b.column(c).to_numpy() for c in ("_bin", "_cell", "_kind")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(b)], strict=True):
                if j <= i:
                    continue
                if cell is None or (key[:2, i] != cell).any():
                    yield from scores()
                    cell, parts, held = key[:2, i], [], None
                part = b.slice(i, j - i)
                if key[2, i] == 0:
                    parts.append((part.column("_i").to_numpy(zero_copy_only=False), matrix(part.column("_v")), part.column("_cls").flatten().to_numpy()))
                    continue
                for s in range(0, len(part), query_block):
                    more = part.slice(s, query_block)
                    if seen + len(more) > query_block:
                        yield from scores()
                    waiting.append(more)
                    seen += len(more)
        yield from scores()

    return run


def _score_cell(queries: pa.RecordBatch, ids: np.ndarray, vectors: np.ndarray, clusters: dict, k: int, exclude_self: bool):
    """(query row, item, score) of the best items of each query in the clusters that it asks for."""
    Q, bar = matrix(queries.column("_v")), queries.column("_t").to_numpy(zero_copy_only=False)
    asked = queries.column("_cls")
    row = np.repeat(np.arange(len(Q)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    cl = asked.flatten().to_numpy()
    order = np.argsort(cl, kind="stable")
    row, cl = row[order], cl[order]
    cands = _Candidates(k)
    qids = pd.Index(queries.column("_q").to_numpy(zero_copy_only=False))
    own = qids.get_indexer(ids) if exclude_self and qids.is_unique else None
    for name, (lo, hi) in clusters.items():
        who = row[np.searchsorted(cl, name):np.searchsorted(cl, name, "right")]
        step = max(1, MAX_CELLS // max(1, len(who)))
        for s in range(lo, hi if len(who) else lo, step):
            e = min(hi, s + step)
            S = vectors[s:e] @ Q[who].T
            hit = S >= bar[who][None, :] - BAR_SLACK
            if exclude_self and own is None:
                hit &= ids[s:e][:, None] != qids.to_numpy()[who][None, :]
            elif exclude_self:
                r = np.flatnonzero(own[s:e] >= 0)
                at = np.searchsorted(who, own[s:e][r]).clip(max=len(who) - 1)
                here = who[at] == own[s:e][r]
                hit[r[here], at[here]] = False
            if np.isneginf(bar[who]).any():                 # without a bar, nearly all items reach it
                d, q = _select_block(S, hit, k)
            else:
                d, q = np.nonzero(hit)
            cands.add(who[q], ids[s:e][d], S[d, q])
    return cands.result()


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def sparse_block(qids: list[str], item_col: str, k: int):
    """cogroup function: query rows ``(qids, _t, weight)`` and item rows
    ``(item, _t, _wd)``, where ``_t`` numbers a term."""
    def run(qdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
        terms, ptr, post_q, post_w, qkeys = query_postings(qdf, qids, "weight")
        nq = len(next(iter(qkeys.values())))
        cands = _Candidates(k)
        ti = np.searchsorted(terms, ddf["_t"].to_numpy()).clip(max=max(len(terms) - 1, 0))
        ddf = ddf[terms[ti] == ddf["_t"].to_numpy()] if len(terms) else ddf.iloc[:0]
        if len(ddf) and nq:
            ddf = ddf.sort_values(item_col, kind="stable")
            ti = np.searchsorted(terms, ddf["_t"].to_numpy())
            flat_w = ddf["_wd"].to_numpy(dtype=np.float64)
            items, doc = np.unique(ddf[item_col].to_numpy(), return_inverse=True)
            cnt = ptr[ti + 1] - ptr[ti]
            csum = np.cumsum(np.bincount(doc, weights=cnt, minlength=len(items)))
            first = np.searchsorted(doc, np.arange(len(items) + 1))
            s = 0
            while s < len(items):       # whole documents, bounded by cells and pairs
                base = csum[s - 1] if s else 0.0
                by_pairs = int(np.searchsorted(csum, base + MAX_PAIRS, side="right"))
                e = max(s + 1, min(by_pairs, s + max(1, MAX_CELLS // nq), len(items)))
                m = slice(first[s], first[e])
                c = cnt[m]
                tot = int(c.sum())
                if tot:
                    idx = np.repeat(ptr[ti[m]] - (np.cumsum(c) - c), c) + np.arange(tot)
                    lin = np.repeat(doc[m] - s, c) * nq + post_q[idx]
                    rw = np.repeat(flat_w[m], c) * post_w[idx]
                    size = (e - s) * nq
                    S = np.bincount(lin, weights=rw, minlength=size).reshape(e - s, nq)
                    hit = (np.bincount(lin, minlength=size) > 0).reshape(e - s, nq)
                    d_i, q_i = _select_block(S, hit, k)
                    cands.add(q_i, items[s:e][d_i], S[d_i, q_i])
                s = e
        return _emit(qkeys, item_col, *cands.result())

    return run


def dense_block(qid: str, q_vec: str, item_col: str, vec_col: str, k: int, exclude_self: bool):
    """cogroup function: inner products of query and item vectors."""
    def run(qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        qkeys = {qid: qdf[qid].to_numpy()}
        cands = _Candidates(k)
        if len(qdf) and len(idf):
            Q = np.stack(qdf[q_vec].to_numpy()).astype(np.float64)
            pos = pd.Index(qkeys[qid]) if exclude_self else None
            step = max(1, MAX_CELLS // len(Q))
            for s in range(0, len(idf), step):
                part = idf.iloc[s:s + step]
                ib = part[item_col].to_numpy()
                S = np.stack(part[vec_col].to_numpy()).astype(np.float64) @ Q.T
                hit = np.ones_like(S, dtype=bool)
                if exclude_self:
                    qi = pos.get_indexer(ib)
                    r = np.flatnonzero(qi >= 0)
                    hit[r, qi[r]] = False
                d_i, q_i = _select_block(S, hit, k)
                cands.add(q_i, ib[d_i], S[d_i, q_i])
        return _emit(qkeys, item_col, *cands.result())

    return run


def query_postings(qw: pd.DataFrame, qid_cols: list[str], weight: str):
    """CSR postings (terms, ptr, post_q, post_w, qkeys) from a query weight table."""
    keys = qw[qid_cols].drop_duplicates().reset_index(drop=True)
    keys["_q"] = np.arange(len(keys))
    qw = qw.merge(keys, on=qid_cols)
    terms, t_idx = np.unique(qw["_t"].to_numpy(), return_inverse=True)
    order = np.argsort(t_idx, kind="stable")
    post_q = qw["_q"].to_numpy()[order].astype(np.int64)
    post_w = qw[weight].to_numpy()[order].astype(np.float64)
    ptr = np.zeros(len(terms) + 1, dtype=np.int64)
    np.cumsum(np.bincount(t_idx, minlength=len(terms)), out=ptr[1:])
    qkeys = {c: keys[c].to_numpy() for c in qid_cols}
    return terms, ptr, post_q, post_w, qkeys

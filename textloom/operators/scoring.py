"""Scores, ranking and candidates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import defaults as D
from textloom.functions.text import not_blank
from textloom.operators.catalog import detail_lookup, keyword_command
from textloom.operators.rank import topk


def _ids(c):
    return [c] if isinstance(c, str) else list(c)


def topk_labels(scores: DataFrame, qid, label: str, score: str, k: int = 3,
                rank: str = "rank") -> DataFrame:
    """Top-k labels per query by score desc; ties -> smaller label
    (a stable sort over labels in id order). Fewer rows if fewer labels."""
    return topk(scores, _ids(qid), [F.col(score).desc(), F.col(label).asc()], k, rank)


def best_label(scores: DataFrame, qid, label: str, score: str,
               confidence: str = "confidence") -> DataFrame:
    """Argmax label per query (tie -> smaller label) and its score."""
    top = topk_labels(scores, qid, label, score, 1, "_rank")
    return top.drop("_rank").withColumnRenamed(score, confidence)


def softmax(df: DataFrame, qid, logit: str, out: str = "score") -> DataFrame:
    """M2: ``exp(x - max) / sum(exp(x - max))`` per query.

    Two keyed aggregates joined back (map-side partial aggregation; AQE splits
    a skewed key in the joins) instead of one window that would hold a hot
    query in a single task.
    """
    q = _ids(qid)
    m = df.groupBy(*q).agg(F.max(logit).alias("_m"))
    e = df.join(m, q).withColumn("_e", F.exp(F.col(logit) - F.col("_m")))
    s = e.groupBy(*q).agg(F.sum("_e").alias("_s"))
    return e.join(s, q).withColumn(out, F.col("_e") / F.col("_s")).drop("_m", "_e", "_s")


def distinct_candidates(df: DataFrame, qid, cand: str) -> DataFrame:
    """Distinct (query, candidate)."""
    return df.select(*_ids(qid), cand).distinct()


def candidate_mode(df: DataFrame, qid, cand: str, n: str = "n") -> DataFrame:
    """most frequent non-blank candidate per query over all candidates;
    ties -> smallest candidate string."""
    q = _ids(qid)
    counts = (df.filter(F.col(cand).isNotNull() & not_blank(cand, ()))
              .groupBy(*q, cand).agg(F.count("*").alias(n)))
    return topk(counts, q, [F.col(n).desc(), F.col(cand).asc()], 1, "_r").drop("_r")


def resolve_candidates(queries: DataFrame, candidates: DataFrame, qid, text: str, cand: str,
                       keywords: Sequence[tuple[str, str]] = tuple(D.FALLBACK_KEYWORDS),
                       command: str = "command", score: str = "score") -> DataFrame:
    """M3: consensus candidate (score 1.0); queries without a usable
    candidate fall back to the keyword rule (E8: 0.5 or 0.0)."""
    q = _ids(qid)
    mode = candidate_mode(candidates, q, cand).select(*q, F.col(cand).alias("_mode"))
    any_hit = F.lit(False)
    from textloom.functions.text import contains_ci
    for kw, _ in keywords:
        any_hit = any_hit | contains_ci(text, kw)
    fb_score = F.when(any_hit, F.lit(D.FALLBACK_HIT_SCORE)).otherwise(F.lit(0.0))
    return (queries.join(mode, q, "left")
            .select(*q, F.coalesce(F.col("_mode"), keyword_command(text, keywords)).alias(command),
                    F.when(F.col("_mode").isNotNull(), F.lit(1.0)).otherwise(fb_score).alias(score)))


def answer_cards(preds: DataFrame, catalog: DataFrame, pred_key: str, key: str,
                 order_by: str) -> DataFrame:
    """M4: prediction + confidence with the catalogue details of the label."""
    return detail_lookup(preds, catalog, pred_key, key, order_by)


# --- M1: batch scoring with a user model ----------------------------------

_MODELS: dict = {}


def _score_batches(key: str, loader, scorer, ids, batches):
    """Runs in the worker; this module is imported there, so ``_MODELS`` lives as
    long as the worker. A batch that raises is tried again row by row, and only
    the rows that raise get an error."""
    model = _MODELS.get(key)
    if model is None:
        model = _MODELS[key] = loader()
    for pdf in batches:
        try:
            yield scorer(model, pdf).assign(error=None)
        except Exception:  # noqa: BLE001 - found out row by row
            for i in range(len(pdf)):
                row = pdf.iloc[i:i + 1]
                try:
                    yield scorer(model, row).assign(error=None)
                except Exception as e:  # noqa: BLE001 - reported in the row
                    yield row[ids].assign(label=None, score=float("nan"), error=f"{type(e).__name__}: {e}")


def score_batch(df: DataFrame, id_cols, feature: str, loader: Callable[[], object],
                scorer: Callable[[object, pd.DataFrame], pd.DataFrame], cache_key: str,
                label_type: T.DataType = T.StringType()) -> DataFrame:
    """M1: ``(ids..., label, score, error)`` for every label of every row.

    ``loader()`` runs once per Python worker and ``cache_key`` (name a model by
    its content or version); ``scorer(model, batch)`` gets a pandas batch with
    the id columns and ``feature`` and returns long rows ``ids..., label, score``.
    A row whose scoring raises comes back once, with the ``error`` text.
    """
    ids = _ids(id_cols)
    schema = T.StructType([df.schema[c] for c in ids] +
                          [T.StructField("label", label_type), T.StructField("score", T.DoubleType()),
                           T.StructField("error", T.StringType())])

    def run(batches):
        return _score_batches(cache_key, loader, scorer, ids, batches)

    return df.select(*ids, feature).mapInPandas(run, schema)


def centroid_scorer(id_cols: Sequence[str], feature: str):
    """A scorer for :func:`score_batch`: inner product with label centroids.
    The model is ``(labels array, centroid matrix)``."""
    ids = list(id_cols)

    def score(model, pdf: pd.DataFrame) -> pd.DataFrame:
        labels, C = model
        if len(pdf) == 0:
            return pd.DataFrame({**{c: pdf[c] for c in ids}, "label": [], "score": []})
        X = np.stack(pdf[feature].to_numpy()).astype(np.float64)
        S = X @ C.T
        n, m = S.shape
        out = {c: np.repeat(pdf[c].to_numpy(), m) for c in ids}
        out["label"] = np.tile(labels, n)
        out["score"] = S.reshape(-1)
        return pd.DataFrame(out)

    return score

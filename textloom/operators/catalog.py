"""Keyed catalogues and joins.

Last-wins and first-appearance semantics take an explicit order column:
Spark tables are unordered. All per-key reductions are declarative
aggregates with map-side partial aggregation, so a hot key never moves its
rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import defaults as D
from textloom.functions.text import contains_ci, first_or_null
from textloom.operators.rank import global_rank


def last_by_key(df: DataFrame, key: str, order_by: str, first_pos: str | None = "first_pos"
                ) -> DataFrame:
    """One row per key, fields from the row with the largest ``order_by`` (rows
    with equal order: a fixed one, by a hash of their fields); ``first_pos`` keeps
    the smallest order (a dict keeps the first position)."""
    rest = [c for c in df.columns if c != key]
    aggs = [F.max_by(F.struct(*rest), F.struct(F.col(order_by), F.xxhash64(*rest))).alias("_last")]
    if first_pos:
        aggs.append(F.min(order_by).alias(first_pos))
    out = df.groupBy(key).agg(*aggs).select(key, "_last.*", *([first_pos] if first_pos else []))
    return out


def merge_catalog(basic: DataFrame, detail: DataFrame, key: str, basic_order: str,
                  detail_order: str) -> DataFrame:
    """Keys of ``basic`` only; per field the last non-null detail value
    (by ``detail_order``) overrides the basic value. Detail-only keys are
    ignored; detail-only fields are added."""
    b = last_by_key(basic, key, basic_order, first_pos=None)
    d_fields = [c for c in detail.columns if c not in (key, detail_order)]
    d = detail.groupBy(key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(detail_order))).alias(c)
        for c in d_fields])
    bb, dd = b.alias("b"), d.alias("d")
    cols = [F.col(f"b.{key}").alias(key)]
    for c in b.columns:
        if c == key:
            continue
        cols.append(F.coalesce(F.col(f"d.{c}"), F.col(f"b.{c}")).alias(c) if c in d_fields
                    else F.col(f"b.{c}"))
    cols += [F.col(f"d.{c}") for c in d_fields if c not in b.columns]
    return bb.join(dd, F.col(f"b.{key}") == F.col(f"d.{key}"), "left").select(*cols)


def enrich(pairs: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Inner equi-join (AQE broadcasts a side that is small in bytes)."""
    return pairs.join(catalog, key, "inner")


def unknown_keys(pairs: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the catalogue."""
    return pairs.join(catalog.select(key), key, "left_anti")


def keep_labels(df: DataFrame, valid: DataFrame, label: str) -> DataFrame:
    """Rows whose label is in the valid set."""
    return df.join(valid.select(label), label, "left_semi")


def detail_lookup(preds: DataFrame, catalog: DataFrame, left_key: str, key: str,
                  order_by: str) -> DataFrame:
    """E5: optional, case-sensitive, last-wins lookup of catalogue rows."""
    cat = last_by_key(catalog, key, order_by, first_pos=None)
    return preds.join(cat, preds[left_key] == cat[key], "left").drop(cat[key])


def detail_fields(description: str, syntax: str, examples: str) -> list[Column]:
    """E5 field rules: description; syntax only if truthy; first example."""
    return [F.col(description).alias("description"),
            F.nullif(F.col(syntax), F.lit("")).alias("syntax"),
            first_or_null(examples).alias("example")]


def label_dictionary(df: DataFrame, label: str, order_by: str, label_id: str = "label_id"
                     ) -> DataFrame:
    """ids 0.. by first appearance (smallest ``order_by``) of each label."""
    first = df.groupBy(label).agg(F.min(order_by).alias("_first"))
    ranked = global_rank(first, [F.col("_first").asc(), F.col(label).asc()], rank_col="_r")
    return ranked.select(label, (F.col("_r") - 1).cast("long").alias(label_id))


def encode_labels(df: DataFrame, labels: DataFrame, label: str, label_id: str = "label_id"
                  ) -> DataFrame:
    """Attach ids; a label that is not in the map keeps its row with a null id
    (:func:`unknown_keys` lists such rows)."""
    return df.join(labels.select(label, label_id), label, "left")


def decode_labels(df: DataFrame, labels: DataFrame, label_id: str = "label_id") -> DataFrame:
    """Attach label text for ids; an unknown id keeps its row with null text."""
    return df.join(labels, label_id, "left")


def keyword_command(query: Column | str,
                    keywords: Sequence[tuple[str, str]] = tuple(D.FALLBACK_KEYWORDS),
                    default: str = D.FALLBACK_NONE) -> Column:
    """E8 command: the first keyword (in list order) contained in the
    case-folded query wins; none -> ``default``. Folded into one CASE WHEN."""
    expr = None
    for kw, cmd in keywords:
        cond = contains_ci(query, kw)
        expr = F.when(cond, F.lit(cmd)) if expr is None else expr.when(cond, F.lit(cmd))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def keyword_fallback(df: DataFrame, query: str,
                     keywords: Sequence[tuple[str, str]] = tuple(D.FALLBACK_KEYWORDS),
                     hit: float = D.FALLBACK_HIT_SCORE, default: str = D.FALLBACK_NONE,
                     command: str = "command", score: str = "score") -> DataFrame:
    """Keyword fallback prediction with score ``hit`` (0.0 when none)."""
    any_hit = F.lit(False)
    for kw, _ in keywords:
        any_hit = any_hit | contains_ci(query, kw)
    return (df.withColumn(command, keyword_command(query, keywords, default))
            .withColumn(score, F.when(any_hit, F.lit(hit)).otherwise(F.lit(0.0))))

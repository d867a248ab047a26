"""Query bindings: each operator of the inventory run over the driver tables.

Every binding takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
whole tables and whole texts. Column names match ``textloom.plans.oracles``.
Counts and positions are cast to ``long`` so both engines agree on types.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import defaults as D
from textloom.functions import text as X
from textloom.operators import catalog, encode, expand, features, group_split, metrics, model, scoring, split
from textloom.operators import keywords, projection, trees, vectors
from textloom.plans.tables import table
from textloom.session import saved, shared_path
from textloom.sources import html, io
from textloom.streaming import scoring as stream

# --- binding parameters (not reference values) -----------------------------
PART_PHRASES_4 = [
    (("economy", "promo"), ["Find a budget part", "Show discounted parts"]),
    (("small",), ["List small parts"]),
]
PART_PHRASES_10 = [
    (("economy",), ["Cheapest parts", "Budget part list", "Low cost components"]),
    (("large",), ["Big parts", "Oversized components"]),
]
DOC_KEYWORDS = [("license", "license"), ("network", "network"), ("mit", "mit"), ("ip", "ip")]
VALID_LABEL_MIN = 15
HASH_DIMS = 256
FOREST_MIN_ROWS = 5       # words of fewer training documents are no feature of the text forest
STORED_TREES = 20
JSON_ARRAY_ROWS = 5_000
NO_TERM = "no term in common with any document"
VECTOR_CLUSTERS = 64
PROJECTED_DIMS = 64
CSV_FILES = 8
# ----------------------------------------------------------------------------


def _user_turns(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "conversations").filter(F.col("role") == "user")
            .select("conv_id", "turn", "text"))


def _long(c: str) -> F.Column:
    return F.col(c).cast("long").alias(c)


# --- C: scalar text functions ----------------------------------------------

def squeeze_strip_tags(spark, sf):
    """C1, C2 on whole pages."""
    return table(spark, sf, "pages").select("page_id", X.strip_tags(X.squeeze("html")).alias("text"))


def clean_text(spark, sf):
    """C3 on whole documents."""
    return table(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("text"))


def lower_strip_dots(spark, sf):
    """Squeezed, lower-cased, trailing dots stripped."""
    return table(spark, sf, "documents").select(
        "doc_id", X.strip_trailing(F.lower(X.squeeze("text")), ".").alias("text"))


def blank_query_filter(spark, sf):
    """Turns left after dropping blank and exit-word queries."""
    return X.drop_blank(table(spark, sf, "conversations"), "text").select("conv_id", "turn")


def combined_text(spark, sf):
    """Clean fields (missing document -> ''), clean each line, join, clean again."""
    c = table(spark, sf, "conversations").alias("c")
    d = table(spark, sf, "documents").alias("d")
    j = c.join(d, F.col("c.conv_id") == F.col("d.doc_id"), "left")
    lines = X.clean_array(F.split(F.col("c.text"), "\n"))
    return j.select(F.col("c.conv_id").alias("conv_id"), F.col("c.turn").alias("turn"),
                    X.combined_text(X.clean_text("c.text"), X.clean_text("d.lang"),
                                    X.clean_text("d.text"), X.clean_text("d.source"),
                                    F.array_join(lines, " ")).alias("combined_text"))


def label_suffix(spark, sf):
    """C12 + E7: id from ``NATION_7``; decoded through the region label map."""
    n = table(spark, sf, "nation").select(
        "n_nationkey", X.label_suffix("n_name").alias("label_id"))
    labels = table(spark, sf, "region").select(F.col("r_regionkey").alias("_rid"), "r_name")
    return (n.withColumn("_rid", F.pmod("label_id", F.lit(5)))
            .transform(lambda df: catalog.decode_labels(df, labels, "_rid"))
            .select("n_nationkey", "label_id", "r_name"))


# --- D: expansion ----------------------------------------------------------

def _parts(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("command"),
        F.concat_ws(" ", "p_name", "p_brand").alias("description"))


def augment4(spark, sf):
    """D1+D3: 4 templates + aliased phrase groups (types as commands)."""
    return (expand.augment(_parts(spark, sf), "command", "description", D.TEMPLATES_4,
                           PART_PHRASES_4, carry=["p_partkey"])
            .select("p_partkey", _long("pos"), "query"))


def augment10(spark, sf):
    """D2+D4: 10 templates + exact-key phrase groups."""
    return (expand.augment(_parts(spark, sf), "command", "description", D.TEMPLATES_10,
                           PART_PHRASES_10, carry=["p_partkey"], out="text")
            .select("p_partkey", _long("pos"), F.col("text").alias("query")))


def pair_rules(spark, sf):
    """D5 (+C4-C8): always / if contains 'the' / if contains 'ing' / literal for English."""
    docs = table(spark, sf, "documents")
    rules = [expand.Rule("How do I {}?"),
             expand.Rule("Show me {}", X.contains_ci("text", "the")),
             expand.Rule("I want to see {}", X.contains_ci("text", "ing")),
             expand.Rule("List all files in the current directory",
                         F.lower(F.col("lang")) == "en", "dir")]
    return (expand.pair_rules(docs, "doc_id", "text", rules, command_col="source")
            .select("doc_id", _long("pos"), "query", "command"))


def prompt_fanout(spark, sf):
    """Four prompt prefixes per user turn."""
    return (expand.prompt_fanout(_user_turns(spark, sf), "text", keep=["conv_id", "turn"])
            .select("conv_id", "turn", _long("variant"), "input_text"))


def lm_records(spark, sf):
    """User turn, the assistant reply, the conversation's document as explanation."""
    c = table(spark, sf, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("q"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"),
                                             F.col("text").alias("e"))
    j = u.join(a, ["conv_id", "turn"]).join(d, "conv_id")
    return expand.lm_records(j, "q", "a", "e").select("conv_id", "turn", "text")


def retrieval_text(spark, sf):
    """H1 + D8: last part per name (by key), ``name: type. Examples: brand parts``."""
    last = catalog.last_by_key(table(spark, sf, "part").select("p_name", "p_partkey", "p_type",
                                                               "p_brand"),
                               "p_name", "p_partkey", first_pos=None)
    x = last.withColumn("_ex", F.split("p_brand", "#"))
    return expand.retrieval_text(x, "p_name", "p_type", "_ex").select("p_name", "text")


def union_phrases(spark, sf):
    """I1 + I2: bag union of document and benchmark texts; rows and distinct."""
    u = expand.union_rows(table(spark, sf, "documents").select("text"),
                          table(spark, sf, "benchmark").select("text"))
    return u.agg(F.count("*").alias("n_rows"), F.countDistinct("text").alias("n_distinct"))


# --- E/F: catalogues, joins, aggregates ------------------------------------

def catalog_merge(spark, sf):
    """Customers (basic) merged with their last order fields (detail)."""
    basic = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").alias("balance"))
    detail = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_totalprice").alias("balance"),
        "o_orderpriority", "o_orderstatus")
    return catalog.merge_catalog(basic, detail, "c_custkey", "c_custkey", "o_orderkey")


def enrich_pairs(spark, sf):
    """E2 (+C3): labelled documents with cleaned text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return (catalog.enrich(docs, table(spark, sf, "labels"), "doc_id")
            .select("doc_id", "quality", "toxic", X.clean_text("text").alias("text")))


def unknown_keys(spark, sf):
    """Documents without labels."""
    return catalog.unknown_keys(table(spark, sf, "documents").select("doc_id"),
                                table(spark, sf, "labels"), "doc_id")


def valid_label_semi(spark, sf):
    """E4 + F2: parts whose (brand, type) label has at least 15 rows."""
    p = table(spark, sf, "part").withColumn("_label", F.concat_ws("|", "p_brand", "p_type"))
    return metrics.drop_rare(p, "_label", VALID_LABEL_MIN).select("p_partkey")


def detail_lookup(spark, sf):
    """E5 + C15: event -> customer details (syntax only if truthy, first example)."""
    ev = table(spark, sf, "events").select("event_id", "user_id")
    cust = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", "c_name", F.split("c_name", "#").alias("examples"))
    j = catalog.detail_lookup(ev, cust, "user_id", "c_custkey", "c_custkey")
    return j.select("event_id", *catalog.detail_fields("c_mktsegment", "c_name", "examples"))


def label_dictionary(spark, sf):
    """source labels numbered by first appearance (doc_id order)."""
    return catalog.label_dictionary(table(spark, sf, "documents"), "source", "doc_id") \
        .withColumnRenamed("source", "label")


def encode_labels(spark, sf):
    """Documents with their source label id."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("label"))
    return catalog.encode_labels(docs, label_dictionary(spark, sf), "label") \
        .select("doc_id", "label_id")


def dedup_last(spark, sf):
    """last order per customer (by order key) and the first position."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return catalog.last_by_key(o, "o_custkey", "o_orderkey")


def keyword_fallback(spark, sf):
    """First matching keyword (list order) in each document, 0.5 / 0.0."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return catalog.keyword_fallback(docs, "text", DOC_KEYWORDS).select("doc_id", "command", "score")


def keyword_table(spark, sf):
    """E8 by table: the first two words of every turn are keywords, in order of the turns; the first that
    each document contains."""
    turns = table(spark, sf, "conversations")
    kw = turns.select(F.regexp_extract("text", r"^[^ ]+ [^ ]+", 0).alias("keyword"),
                      F.concat_ws("-", "role", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("command"),
                      F.struct("conv_id", "turn").alias("pos")).filter("keyword <> ''")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return keywords.keyword_table_fallback(docs, "text", kw).select("doc_id", "command", "score")


def label_counts(spark, sf):
    """documents per source."""
    return metrics.label_counts(table(spark, sf, "documents"), "source")


def dataset_stats(spark, sf):
    """rows and distinct sources."""
    return metrics.dataset_stats(table(spark, sf, "documents"), "source")


def dataset_stats_merged(spark, sf):
    """statistics of lineitem from sketches stored per ship month, and whether the estimated number of
    orders is within 4 % of the exact one."""
    lines = table(spark, sf, "lineitem")
    path = shared_path(spark, "sketches")
    metrics.stats_sketch(lines, "l_orderkey", [F.date_format("l_shipdate", "yyyy-MM").alias("month")]).write.parquet(path)
    got = metrics.merged_stats(spark.read.parquet(path))
    exact = lines.select(F.countDistinct("l_orderkey")).scalar()
    return got.select("n_rows", (F.abs(F.col("n_keys") - exact) <= 0.04 * exact).alias("within"))


def distinct_candidates(spark, sf):
    """Distinct (user, event type)."""
    return scoring.distinct_candidates(table(spark, sf, "events"), "user_id", "event_type") \
        .withColumnRenamed("event_type", "candidate")


def candidate_mode(spark, sf):
    """most frequent event type per user (tie: smallest)."""
    ev = table(spark, sf, "events").select("user_id", F.col("event_type").alias("candidate"))
    return scoring.candidate_mode(ev, "user_id", "candidate")


def _candidates(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("doc_id"),
                     F.when(F.col("event_type") == "error", F.lit(" "))
                     .otherwise(F.col("event_type")).alias("candidate"))


def resolve_candidates(spark, sf):
    """M3: consensus of non-blank candidates, else the keyword fallback."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return scoring.resolve_candidates(docs, _candidates(spark, sf), "doc_id", "text",
                                      "candidate", DOC_KEYWORDS)


# --- G/M: scores and ranking -----------------------------------------------

def _line_scores(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey", F.col("l_linenumber").alias("label")).agg(
        F.max("l_extendedprice").alias("score"), F.max("l_quantity").alias("_q"))


def argmax_confidence(spark, sf):
    """F8 + F9 + G2: best line per order and its score."""
    return scoring.best_label(_line_scores(spark, sf).drop("_q"), "l_orderkey", "label", "score")


def topk_labels(spark, sf):
    """G1 + G4 + G5: top-3 lines per order by score."""
    return (scoring.topk_labels(_line_scores(spark, sf).drop("_q"), "l_orderkey", "label",
                                "score", 3)
            .select("l_orderkey", _long("rank"), "label", "score"))


def softmax_scores(spark, sf):
    """M2: softmax of quantity / 10 over the lines of an order."""
    s = _line_scores(spark, sf).select("l_orderkey", "label", (F.col("_q") / 10).alias("logit"))
    return scoring.softmax(s, "l_orderkey", "logit").select(
        "l_orderkey", "label", F.round("score", 6).alias("score"))


def answer_cards(spark, sf):
    """M4: best line per order with the order's details."""
    best = scoring.best_label(_line_scores(spark, sf).drop("_q"), "l_orderkey", "label", "score")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return (scoring.answer_cards(best, orders, "l_orderkey", "o_orderkey", "o_orderkey")
            .select("l_orderkey", "label", "confidence", "o_orderstatus", "o_orderpriority"))


# --- metrics over 1-nearest-neighbour predictions ---------------------------

def _nn_predictions(spark, sf):
    e = table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("q"), "embedding")
    nn = vectors.vector_topk(q, e.select("vec_id", "embedding"), "q", "vec_id", "embedding",
                             k=1, exclude_self=True)
    lab = e.select("vec_id", "label")
    return (nn.join(lab.select(F.col("vec_id").alias("q"), F.col("label").alias("y_true")), "q")
            .join(lab.select("vec_id", F.col("label").alias("y_pred")), "vec_id"))


def confusion(spark, sf):
    """F13."""
    return metrics.confusion(_nn_predictions(spark, sf), "y_true", "y_pred")


def class_report(spark, sf):
    """F12 (rounded to 6 decimals)."""
    r = metrics.class_report(_nn_predictions(spark, sf), "y_true", "y_pred")
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    "support")


def weighted_metrics(spark, sf):
    """F10 + F11 (rounded to 6 decimals)."""
    r = metrics.weighted_prf(_nn_predictions(spark, sf), "y_true", "y_pred")
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


# --- J: splits ---------------------------------------------------------------

def split_exact(spark, sf):
    """Exact 20 % test split of documents, seed 42."""
    return split.split_exact(table(spark, sf, "documents").select("doc_id"), "doc_id")


def split_stratified(spark, sf):
    """Stratified by language."""
    return split.split_stratified(table(spark, sf, "documents").select("doc_id", "lang"),
                                  "doc_id", "lang")


def split_grouped(spark, sf):
    """J1 with groups: whole conversations on one side."""
    c = table(spark, sf, "conversations").select("conv_id", "turn")
    return split.split_exact(c, ["conv_id", "turn"], group_key="conv_id") \
        .select("conv_id", "turn", "split")


def split_stratified_grouped(spark, sf):
    """J2 with groups: whole orders on one side, stratified by the return flag of their lines. Per flag:
    its quota of lines, groups on both sides, and whether its test lines are within one group of the quota."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    tagged = group_split.split_stratified_grouped(lines, "l_orderkey", "l_returnflag")
    return group_split.split_report(tagged, "l_orderkey", "l_returnflag").select(
        "l_returnflag", "n_label", "n_test", F.col("n_split_groups").cast("long").alias("n_split_groups"), "within")


def split_tenth(spark, sf):
    """Exact 10 % held-out split of user turns (seed required, 42)."""
    return split.split_exact(_user_turns(spark, sf).select("conv_id", "turn"), ["conv_id", "turn"],
                             [("test", 0.1)])


def rare_label_report(spark, sf):
    """F2 report: number of (brand, type) labels below the threshold."""
    p = table(spark, sf, "part").withColumn("_label", F.concat_ws("|", "p_brand", "p_type"))
    return metrics.excluded_labels(p, "_label", VALID_LABEL_MIN)


# --- K/H: features and retrieval ------------------------------------------

def ngrams(spark, sf):
    """K1 + K2: term counts of 1-3-grams per document."""
    return features.term_counts(table(spark, sf, "documents"), "doc_id", "text")


def vocabulary(spark, sf):
    """K3: document frequency per term."""
    return features.document_frequency(
        features.term_counts(table(spark, sf, "documents"), "doc_id", "text"))


def tfidf(spark, sf):
    """K4 + K5: fit-transform documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fit = features.fit_tfidf(docs, "doc_id", "text", materialize=True)
    return features.fitted_weights(fit).select(
        "doc_id", "term", F.round("weight", 6).alias("weight"))


def tfidf_transform(spark, sf):
    """K6: user turns under the documents' vocabulary (one job: the fit stays lazy)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fit = features.fit_tfidf(docs, "doc_id", "text")
    return features.transform_tfidf(fit, _user_turns(spark, sf), ["conv_id", "turn"], "text") \
        .select("conv_id", "turn", "term", F.round("weight", 6).alias("weight"))


def tfidf_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship (H5 + G1): for every user turn, the 3 best-matching documents
    by TF-IDF cosine (1-3 word n-grams, vocabulary fitted on the documents)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fit = features.fit_tfidf(docs, "doc_id", "text", materialize=True)
    res = features.tfidf_topk(fit, _user_turns(spark, sf), ["conv_id", "turn"], "text",
                              None, "doc_id", k=3)
    return res.select("conv_id", "turn", _long("rank"), "doc_id",
                      F.round("score", 6).alias("score"))


def hash_embed(spark, sf):
    """H2 default featuriser: md5-hashed unigram counts, L2-normalised."""
    return features.hash_embed(table(spark, sf, "documents"), "doc_id", "text", HASH_DIMS) \
        .select("doc_id", "bucket", F.round("weight", 6).alias("weight"))


def vector_normalize(spark, sf):
    """H3: normalised components, exploded."""
    e = vectors.normalize(table(spark, sf, "embeddings"), "embedding", "v")
    return e.select("vec_id", F.posexplode("v").alias("pos", "x")).select(
        "vec_id", _long("pos"), F.round("x", 6).alias("x"))


def vector_topk(spark, sf):
    """H4 + E9 + G3: 3 nearest other vectors by inner product."""
    e = table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("q"), "embedding")
    r = vectors.vector_topk(q, e.select("vec_id", "embedding"), "q", "vec_id", "embedding",
                            k=3, exclude_self=True)
    return r.select("q", _long("rank"), "vec_id", F.round("score", 6).alias("score"))


def vector_topk_clusters(spark, sf):
    """H4 pruned: the same neighbours through clusters, scoring only clusters whose bound reaches the
    third score found so far."""
    e = table(spark, sf, "embeddings")
    held = vectors.fit_clusters(e, "vec_id", "embedding", VECTOR_CLUSTERS)
    r, _ = vectors.pruned_topk(e.select(F.col("vec_id").alias("q"), "embedding"), held, "q", "vec_id", "embedding",
                               k=3, exclude_self=True)
    return r.select("q", _long("rank"), "vec_id", F.round("score", 6).alias("score"))


def _projected(spark, sf):
    """The encoder fitted on documents, saved and loaded, and the documents' vectors, saved and loaded."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = projection.save_projection(projection.fit_projection(docs, "text"), shared_path(spark, "projection"))
    idf = projection.load_projection(spark, path)
    return idf, saved(projection.project(docs, "doc_id", "text", idf, PROJECTED_DIMS), "projected")


def projected_embed(spark, sf):
    """H2 + A7: documents by the fitted encoder, through a saved model; components, exploded."""
    _, vec = _projected(spark, sf)
    return vec.select("doc_id", F.posexplode("embedding").alias("pos", "x")).select("doc_id", _long("pos"), F.round("x", 6).alias("x"))


def projected_topk(spark, sf):
    """H2 + A7 + H4: the 3 documents nearest to each first user turn, over saved and reloaded vectors."""
    idf, vec = _projected(spark, sf)
    first = table(spark, sf, "conversations").filter("turn = 0").select("conv_id", "text")
    q = projection.project(first, "conv_id", "text", idf, PROJECTED_DIMS)
    r = vectors.vector_topk(q, vec, "conv_id", "doc_id", "embedding", k=3)
    return r.select("conv_id", _long("rank"), "doc_id", F.round("score", 6).alias("score"))


# --- L: encoding -------------------------------------------------------------

def _explode2(df, key, a, b, out_a, out_b):
    z = df.select(key, F.posexplode(F.arrays_zip(a, b)).alias("pos", "_z"))
    return z.select(key, _long("pos"), F.col(f"_z.{a}").alias(out_a), F.col(f"_z.{b}").alias(out_b))


def encode_fixed(spark, sf):
    """L1: ids truncated / padded to 256 with attention mask."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = encode.token_vocabulary(docs, "text")
    enc = encode.encode_fixed(docs, "doc_id", "text", vocab, D.MAX_LEN_INPUT)
    return _explode2(enc, "doc_id", "input_ids", "attention_mask", "token_id", "attention_mask")


def encode_targets(spark, sf):
    """L2: source labels encoded to 64 ids with pad -> -100."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    vocab = encode.token_vocabulary(docs, "source")
    enc = encode.encode_fixed(docs, "doc_id", "source", vocab, D.MAX_LEN_TARGET)
    t = enc.select("doc_id", encode.mask_targets("input_ids").alias("target"))
    return t.select("doc_id", F.posexplode("target").alias("pos", "target")).select(
        "doc_id", _long("pos"), "target")


def encode_lm(spark, sf):
    """L3: causal-LM labels (ids with pad -> -100), 512 positions."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = encode.token_vocabulary(docs, "text")
    enc = encode.lm_targets(encode.encode_fixed(docs, "doc_id", "text", vocab, D.MAX_LEN_LM))
    return enc.select("doc_id", F.posexplode("labels").alias("pos", "label")).select(
        "doc_id", _long("pos"), "label")


# --- B: pages ----------------------------------------------------------------

def page_links(spark, sf):
    """B7 + B2: every link, resolved against the page URL."""
    return html.links(table(spark, sf, "pages")).select("page_id", _long("pos"), "href")


def page_heading(spark, sf):
    """B3 shape on h1: first heading text, else the default."""
    return html.tag_text(table(spark, sf, "pages"), "h1", D.NO_SYNTAX).select("page_id", "text")


def page_details(spark, sf):
    """Syntax (default), examples, long description, error."""
    return html.page_details(table(spark, sf, "pages"))


def page_table_rows(spark, sf):
    """B1 + B2: rows of a listing table made from every page: number, link, address."""
    pages = table(spark, sf, "pages").select("page_id", "url", F.concat(
        F.lit("<table><tr><th>no link</th></tr><tr><td>"), F.col("page_id").cast("string"), F.lit('</td><td><a href="../p/'),
        F.col("page_id").cast("string"), F.lit('">page '), F.col("page_id").cast("string"), F.lit("</a></td><td> "),
        F.regexp_replace("url", "&", "&amp;"), F.lit(" </td></tr></table>")).alias("html"))
    return html.table_rows(pages).filter("error IS NULL").select("page_id", _long("pos"), "command", "description", "url")


def part_page_details(spark, sf):
    """Details of a page made from every part, joined to the part."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    page = F.when(F.col("p_size") % 2 == 0, F.concat(
        F.lit("<h1>"), F.col("p_name"), F.lit("</h1><p>"), F.col("p_brand"), F.lit("</p><div>no</div><p> "), F.col("p_type"),
        F.lit(" </p><pre> "), F.col("p_type"), F.lit(" /S </pre><p>late</p><h3>Examples</h3><blockquote><p class='code'>"),
        F.col("p_name"), F.lit(" /1</p></blockquote><h3>end</h3><blockquote><p class='code'>no</p></blockquote>"))).otherwise(
        F.concat(F.lit("<p>"), F.col("p_brand"), F.lit("</p>")))
    details = html.page_details(part.select("p_partkey", page.alias("html")), "p_partkey")
    out = html.enrich_details(part.select("p_partkey", "p_name"), details, "p_partkey")
    return out.select("p_partkey", "p_name", "syntax", F.array_join("examples", "|").alias("examples"),
                      "description_detailed", "error")


def enriched_records(spark, sf):
    """The enriched pair record: E2, C3, C9-C11 over user turns and the documents of the same number."""
    turns = _user_turns(spark, sf).select("conv_id", "turn", F.col("text").alias("query"), F.col("conv_id").alias("command"))
    cat = table(spark, sf, "documents").select(
        F.col("doc_id").alias("command"), F.get(F.split("text", "\n"), F.lit(0)).alias("description"),
        F.col("text").alias("description_detailed"), F.col("lang").alias("syntax"), F.split("text", "\n").alias("examples"),
        F.col("source").alias("url"))
    j = catalog.enrich(turns, cat, "command")
    fields = {c: X.clean_text(c) for c in ("query", "description", "description_detailed", "syntax")}
    examples = F.array_join(X.clean_array("examples"), " ")
    return j.select("conv_id", "turn", "command", *[v.alias(k) for k, v in fields.items()], examples.alias("examples"), "url",
                    X.combined_text(*fields.values(), examples).alias("combined_text"))


def decoded_top3(spark, sf):
    """G1 + C12 + E7: the three best labels of every order line group, as text."""
    scores = table(spark, sf, "lineitem").groupBy("l_orderkey", F.concat(
        F.lit("LABEL_"), (F.col("l_suppkey") % 5).cast("string")).alias("label")).agg(
        F.max("l_extendedprice").alias("score"))
    top = scoring.topk_labels(scores, "l_orderkey", "label", "score", 3)
    top = top.withColumn("label_id", X.label_suffix("label").cast("long"))
    names = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("label_id"), "r_name")
    return catalog.decode_labels(top, names).select("l_orderkey", _long("rank"), "r_name", "score")


def find_command(spark, sf):
    """H1 -> D8 -> H2 -> H3 -> H4: the best part type for every part's name and type, by hashed vectors."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    last = catalog.last_by_key(part, "p_type", "p_partkey", first_pos=None)
    docs = last.select("p_type", F.concat_ws(" ", F.col("p_type"), F.col("p_name"), F.col("p_brand")).alias("text"))
    query = part.select("p_partkey", F.concat_ws(" ", F.col("p_name"), F.col("p_type")).alias("text"))
    vec = lambda df, key: features.hash_embed(df, key, "text", HASH_DIMS).select(
        key, F.col("bucket").cast("string").alias("term"), "weight")
    top = features.sparse_topk(vec(query, "p_partkey"), vec(docs, "p_type"), "p_partkey", "p_type", k=1)
    return top.select("p_partkey", F.col("p_type").alias("command"), F.round("score", 6).alias("score"))


def json_array_read(spark, sf):
    """A2: the orders table as JSON array files of bounded size, read back."""
    orders = table(spark, sf, "orders")
    path = shared_path(spark, "orders-array")
    io.write_json_arrays(orders, path, "o_orderkey", JSON_ARRAY_ROWS)
    return io.read_table(spark, path, orders.schema, "json")


def suffix_dispatch(spark, sf):
    """A3: the customer table written and read in each format by its suffix."""
    reg, out = table(spark, sf, "customer"), None
    for fmt in ("csv", "json", "parquet"):
        path = shared_path(spark, "customer") + f".{fmt}"
        io.write_table(reg, path, fmt)
        got = io.read_table(spark, path, reg.schema).withColumn("format", F.lit(fmt))
        out = got if out is None else out.unionByName(got)
    return out


def _text_forest(spark, sf):
    """Held-out predictions (doc_id, quality, prediction) of a forest on the documents' TF-IDF."""
    docs = table(spark, sf, "documents").select("doc_id", "text").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    s = split.split_exact(docs, "doc_id")
    train = s.filter(F.col("split") == "train")
    fit = features.fit_tfidf(train.select("doc_id", "text"), "doc_id", "text", (1, 1), materialize=True)
    weights = features.transform_tfidf(fit, s.select("doc_id", "text"), "doc_id", "text")
    numbers = model.term_numbers(fit.counts, FOREST_MIN_ROWS)
    vec = saved(model.sparse_vectors(weights, s.select("doc_id", "quality", "split"), "doc_id", numbers), "text-vectors")
    forest = model.fit_forest(vec.filter("split = 'train'"), "features", "quality")
    path = shared_path(spark, "forest")
    model.save_forest(forest, path)
    return model.predict(model.load_forest(path), vec.filter("split = 'test'"), "features", ["doc_id", "quality"])


def text_forest_report(spark, sf):
    """K1-K8 + F12: TF-IDF of documents -> 100 trees on their quality -> support of the held-out labels."""
    rep = metrics.class_report(_text_forest(spark, sf), "quality", "prediction")
    # the label rows and their support do not depend on how well the forest learned
    labels = rep.filter(~F.col("label").isin("accuracy", "macro avg", "weighted avg"))
    return labels.filter("support > 0").select(F.col("label").cast("string").alias("label"), _long("support"))


# --- K7/K8, M1: models --------------------------------------------------------

def forest_predict(spark, sf):
    """K7 + K8: random forest (100 trees, seed 42) on embeddings, 80/20 split."""
    e = table(spark, sf, "embeddings")
    s = split.split_exact(e, "vec_id")
    m = model.fit_forest(s.filter(F.col("split") == "train"), "embedding", "label",
                         trees=100, seed=42)
    return model.predict(m, s.filter(F.col("split") == "test"), "embedding", "vec_id")


def forest_tables(spark, sf):
    """K8: a saved forest's node table gives every held-out vector the class probabilities of the
    reloaded model itself (to 9 decimals)."""
    e = table(spark, sf, "embeddings")
    s = saved(split.split_exact(e, "vec_id"), "forest-split")
    path = shared_path(spark, "stored-forest")
    model.save_forest(model.fit_forest(s.filter("split = 'train'"), "embedding", "label", trees=STORED_TREES, seed=42), path)
    test = s.filter("split = 'test'")
    mine = trees.class_probabilities(trees.forest_nodes(spark, path), test, ["vec_id"], "embedding")
    own = model.load_forest(path).transform(test.withColumn("_features", model.array_to_vector("embedding")))
    own = own.select("vec_id", F.posexplode(model.vector_to_array("probability")).alias("class", "p"))
    return mine.join(own, ["vec_id", "class"], "full").select("vec_id", _long("class"), F.coalesce(
        F.abs(F.col("probability") - F.col("p")) < 1e-9, F.lit(False)).alias("agrees"))


def scored_batch(spark, sf):
    """M1: a user model (label centroids, computed by Spark) scoring every row."""
    e = table(spark, sf, "embeddings")
    cells = (e.select("label", F.posexplode("embedding").alias("pos", "x"))
             .groupBy("label", "pos").agg(F.avg("x").alias("cx")))
    # the user's model: one row per label (labels x dims numbers), as a fitted model is
    rows = (cells.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "cx"))).alias("c"))
            .orderBy("label").collect())
    labels = np.array([r["label"] for r in rows], dtype=np.int32)
    C = np.array([[x["cx"] for x in r["c"]] for r in rows], dtype=np.float64)
    bc = spark.sparkContext.broadcast((labels, C))
    out = scoring.score_batch(e, "vec_id", "embedding", lambda: bc.value,
                              scoring.centroid_scorer(["vec_id"], "embedding"),
                              cache_key=f"centroids-{uuid.uuid4().hex}", label_type=T.IntegerType())
    return out.filter("error IS NULL").select("vec_id", "label", F.round("score", 6).alias("score"))


# --- A: sources / sinks --------------------------------------------------------

def csv_json_roundtrip(spark, sf):
    """A1-A5: nation written as CSV and JSON, read back, rows present in both."""
    nat = table(spark, sf, "nation")
    schema = nat.schema
    p_csv, p_json = shared_path(spark, "nation-csv"), shared_path(spark, "nation-json")
    io.write_table(nat, p_csv, "csv")
    io.write_table(nat, p_json, "json")
    a = io.read_table(spark, p_csv, schema, "csv")
    b = io.read_table(spark, p_json, schema, "json")
    return a.join(b, list(schema.names), "inner").select(*schema.names)


def csv_split_read(spark, sf):
    """A1 + A4: documents as CSV files, those with line breaks in files of their own, read back: files
    without a quoted line break are split."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    path = shared_path(spark, "documents-csv")
    breaks = F.coalesce(F.col("text").rlike(r"[\r\n]"), F.lit(False))
    io.write_table(docs.repartitionByRange(CSV_FILES, breaks, "doc_id"), path, "csv")
    return io.read_table(spark, path, docs.schema, "csv")


def label_map_roundtrip(spark, sf):
    """A6 + A8: label dictionary written and read back as typed Parquet."""
    path = shared_path(spark, "labels")
    io.write_labels(label_dictionary(spark, sf), path)
    return io.read_labels(spark, path)


def model_roundtrip(spark, sf):
    """Fitted TF-IDF saved, reloaded, then used to transform user turns."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = shared_path(spark, "tfidf")
    model.save_tfidf(features.fit_tfidf(docs, "doc_id", "text", materialize=True), path)
    fit = model.load_tfidf(spark, path)
    return features.transform_tfidf(fit, _user_turns(spark, sf), ["conv_id", "turn"], "text") \
        .select("conv_id", "turn", "term", F.round("weight", 6).alias("weight"))


# --- N1: streaming -------------------------------------------------------------

def _stream_scoring(spark, sf):
    """The stream's sinks: results, and queries that could not be scored."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fit = features.fit_tfidf(docs, "doc_id", "text", materialize=True).materialize_norms()
    schema = table(spark, sf, "conversations").schema
    src = stream.file_stream(spark, sf, "conversations.parquet", schema)
    sink, errors, ckpt = (shared_path(spark, n) for n in ("stream-sink", "stream-errors", "stream-ckpt"))

    def score(batch):
        turns = batch.filter(F.col("role") == "user").select("conv_id", "turn", "text")
        r = features.tfidf_topk(fit, turns, ["conv_id", "turn"], "text", None, "doc_id", k=3)
        r = r.select("conv_id", "turn", _long("rank"), "doc_id", F.round("score", 6).alias("score"))
        return stream.with_errors(r, turns, ["conv_id", "turn"], NO_TERM)

    q = stream.score_stream(src, score, sink, ckpt, query_col="text", error_sink=errors)
    q.awaitTermination()
    return spark.read.parquet(sink), spark.read.parquet(errors)


def stream_scoring(spark, sf):
    """Conversations as a file stream; every micro-batch of user turns
    (without blank and exit-word queries) scored against the documents. The
    static side (packed texts, document norms) is saved once in the shared
    folder and reused by every batch."""
    return _stream_scoring(spark, sf)[0].select("conv_id", "turn", "rank", "doc_id", "score")


def stream_errors(spark, sf):
    """The same stream's error sink, and the number of results of every turn that has any."""
    good, bad = _stream_scoring(spark, sf)
    rows = good.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).withColumn("error", F.lit(None).cast("string"))
    return rows.unionByName(bad.select("conv_id", "turn", F.lit(0).cast("long").alias("n"), "error"))


QUERIES = {
    "tfidf_topk": tfidf_topk,
    "squeeze_strip_tags": squeeze_strip_tags,
    "clean_text": clean_text,
    "lower_strip_dots": lower_strip_dots,
    "blank_query_filter": blank_query_filter,
    "combined_text": combined_text,
    "label_suffix": label_suffix,
    "augment4": augment4,
    "augment10": augment10,
    "pair_rules": pair_rules,
    "prompt_fanout": prompt_fanout,
    "lm_records": lm_records,
    "retrieval_text": retrieval_text,
    "union_phrases": union_phrases,
    "catalog_merge": catalog_merge,
    "enrich_pairs": enrich_pairs,
    "unknown_keys": unknown_keys,
    "valid_label_semi": valid_label_semi,
    "detail_lookup": detail_lookup,
    "label_dictionary": label_dictionary,
    "encode_labels": encode_labels,
    "dedup_last": dedup_last,
    "keyword_fallback": keyword_fallback,
    "keyword_table": keyword_table,
    "label_counts": label_counts,
    "dataset_stats": dataset_stats,
    "dataset_stats_merged": dataset_stats_merged,
    "distinct_candidates": distinct_candidates,
    "candidate_mode": candidate_mode,
    "resolve_candidates": resolve_candidates,
    "argmax_confidence": argmax_confidence,
    "topk_labels": topk_labels,
    "softmax_scores": softmax_scores,
    "answer_cards": answer_cards,
    "confusion": confusion,
    "class_report": class_report,
    "weighted_metrics": weighted_metrics,
    "split_exact": split_exact,
    "split_stratified": split_stratified,
    "split_grouped": split_grouped,
    "split_stratified_grouped": split_stratified_grouped,
    "split_tenth": split_tenth,
    "rare_label_report": rare_label_report,
    "ngrams": ngrams,
    "vocabulary": vocabulary,
    "tfidf": tfidf,
    "tfidf_transform": tfidf_transform,
    "hash_embed": hash_embed,
    "projected_embed": projected_embed,
    "projected_topk": projected_topk,
    "vector_normalize": vector_normalize,
    "vector_topk": vector_topk,
    "vector_topk_clusters": vector_topk_clusters,
    "encode_fixed": encode_fixed,
    "encode_targets": encode_targets,
    "encode_lm": encode_lm,
    "page_links": page_links,
    "page_heading": page_heading,
    "page_details": page_details,
    "page_table_rows": page_table_rows,
    "part_page_details": part_page_details,
    "enriched_records": enriched_records,
    "decoded_top3": decoded_top3,
    "find_command": find_command,
    "json_array_read": json_array_read,
    "suffix_dispatch": suffix_dispatch,
    "text_forest_report": text_forest_report,
    "forest_predict": forest_predict,
    "forest_tables": forest_tables,
    "scored_batch": scored_batch,
    "csv_json_roundtrip": csv_json_roundtrip,
    "csv_split_read": csv_split_read,
    "label_map_roundtrip": label_map_roundtrip,
    "model_roundtrip": model_roundtrip,
    "stream_scoring": stream_scoring,
    "stream_errors": stream_errors,
}

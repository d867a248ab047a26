"""Not-modified revisit records of a web archive, resolved (DataFrame functions only).

A revisit stands for a capture whose server answered "not modified". It is
resolved by an as-of join: same canonical URL, the latest full response captured
before it. The validators must agree (ETag if both have one, else Last-Modified,
else the payload digest); then the revisit takes the response's payload, and the
headers that a 304 may update replace those of the response.

Records are looked at in two levels: inside (URL, slice) and, by each slice's last
response, across the slices of a URL. Slices are ranges of records by URL and time
of about equal numbers, wherever the times lie, so a URL with a third of all records
is many small groups. This search moves ids, times and validators only. Records meet
at the end by ``uid``, a hash of all columns, so they need no id of their own: full
responses stay where they are, and one join takes the payload of a base to its
revisits. Only if some rows are equal in all columns are whole records told apart,
and written once, before.

Defined results: a null or unparsable URL is its own text and matches equal
text only, a null URL matches nothing; a null time sorts first; of responses at
the same time the larger record id is later (null the least, then the larger uid),
and a response is not earlier than a revisit of the same time; rows equal in all
columns are one record, rows that only share an id, null ids too, are records of
their own; null headers are an empty map; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import row_key, saved

RECORDS_PER_SLICE = 200_000
# Headers (lower case) that a not-modified answer may update.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "server",
             "set-cookie", "vary", "warning")
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|sessionid|sid)="
RECORD = ("record_id", "type", "url", "time", "headers", "digest", "payload")


def canonical_url(url: Column) -> Column:
    """Scheme, leading www. or m., default port, fragment, tracking parameters and a closing slash go;
    the host is in lower case and parameters are sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.btrim(url), r"(?i)^https?://", ""), r"#.*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.when(url.isNotNull(), F.concat(host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _lower_keys(headers: Column) -> Column:
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"]))
    return F.coalesce(F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda z, e: F.map_concat(
        F.map_filter(z, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"]))),
        F.create_map().cast("map<string,string>"))


def _agree(a: str, b: str) -> Column:
    """Whether validators (structs etag, modified, digest) agree, by the strongest both have."""
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    x, y = F.col(a), F.col(b)
    return F.coalesce(weak(x["etag"]) == weak(y["etag"]), x["modified"] == y["modified"], x["digest"] == y["digest"],
                      F.lit(False))


def latest_responses(records: DataFrame) -> DataFrame:
    """(uid, base) of each revisit: the latest earlier response of its URL (null: none).
    ``records``: uid, record_id, type, key, time, check (validators)."""
    # revisits come before responses of the same time: a response must be earlier
    response = F.col("type") == "response"
    order = [F.col("time").asc_nulls_first(), "late", "record_id", "uid"]
    slices = max(1, -(-records.count() // RECORDS_PER_SLICE))
    r = saved(records.filter("key IS NOT NULL").dropDuplicates(["uid"]).withColumn("late", response.cast("int"))
              .repartitionByRange(slices, "key", *order).withColumn("slice", F.spark_partition_id()), "warc-slices")
    r = r.withColumn("own", F.when(response, F.struct("record_id", "uid", "check")))
    inside = Window.partitionBy("key", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("near", F.last("own", ignorenulls=True).over(inside))
    ends = r.groupBy("key", "slice").agg(F.max_by("own", F.when(response, F.struct(
        F.coalesce("time", F.lit(-(1 << 62))), "record_id", "uid"))).alias("end"))
    across = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("far", F.last("end", ignorenulls=True).over(across)).select("key", "slice", "far")
    found = r.filter(~response).join(ends, ["key", "slice"])
    return found.select("uid", F.coalesce("near", "far").alias("base"), "check")


def resolve(records: DataFrame) -> DataFrame:
    """Per record of ``records`` (the columns RECORD): record_id, type, key, time, status (full,
    resolved, mismatch or missing), base_id, headers and payload after resolution.

    ``type`` is response or revisit, ``time`` a long, ``headers`` a map."""
    entries = F.array_sort(F.map_entries("headers"))
    uid = row_key(*[entries if c == "headers" else F.col(c) for c in RECORD])
    rec = records.select(*RECORD, uid.alias("uid")).withColumn("headers", _lower_keys(F.col("headers"))) \
        .withColumn("key", canonical_url(F.col("url")))
    check = F.struct(F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"),
                     F.col("digest").alias("digest"))
    slim = saved(rec.select("uid", "record_id", "type", "key", F.col("time").cast("long").alias("time"), check.alias("check")), "warc-slim")
    if slim.select("uid").distinct().count() < slim.count():
        rec = saved(rec.dropDuplicates(["uid"]), "warc-records")
    base = latest_responses(slim)
    ok = F.col("base").isNotNull() & _agree("check", "base.check")
    links = saved(base.select(
        "uid", F.col("base.uid").alias("base_uid"), F.col("base.record_id").alias("base_id"),
        F.when(F.col("base").isNull(), "missing").when(ok, "resolved").otherwise("mismatch").alias("found")), "warc-links")
    response = F.coalesce(F.col("type") == "response", F.lit(False))
    own = ["record_id", "type", "key", "time"]
    full = rec.filter(response).select(*own, F.lit("full").alias("status"), F.lit(None).cast(rec.schema["record_id"].dataType).alias("base_id"),
                                       "headers", "payload")
    again = rec.filter(~response).join(links, "uid", "left").withColumn("found", F.coalesce("found", F.lit("missing")))
    left = again.filter("found <> 'resolved'").select(*own, F.col("found").alias("status"), "base_id", "headers", "payload")
    updates = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("base_headers", lambda k, _: ~F.map_contains_key("updates", k)), F.col("updates"))
    got = (again.filter("found = 'resolved'").select(*own, "base_id", "base_uid", updates.alias("updates")).join(
        rec.filter(response).select(F.col("uid").alias("base_uid"), F.col("headers").alias("base_headers"), "payload"), "base_uid")
        .select(*own, F.lit("resolved").alias("status"), "base_id", merged.alias("headers"), "payload"))
    return full.unionByName(left).unionByName(got)


def crawl_records(pages: DataFrame) -> DataFrame:
    """Records of a crawl over ``pages``: each page is captured in full at time 2 * page_id, and asked
    for again half a crawl of one page later; every third answer has another ETag than the page.
    The query's way to make revisits of the table; hosts and paths are the pages' own."""
    etag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit(""))), F.lit('"'))
    page = F.col("page_id").cast("long")
    full = pages.select(
        (page * 2).alias("record_id"), F.lit("response").alias("type"), "url", (page * 2).alias("time"),
        F.create_map(F.lit("ETag"), etag, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), (page * 2).cast("string")).alias("headers"),
        F.md5(F.coalesce(F.col("html"), F.lit(""))).alias("digest"), F.col("html").alias("payload"))
    stale = page % 3 == 0
    again = pages.select(
        (page * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), "url", (page * 2 + 1).alias("time"),
        F.create_map(F.lit("etag"), F.when(stale, F.lit('"other"')).otherwise(etag), F.lit("date"), (page * 2 + 1).cast("string"),
                     F.lit("content-type"), F.lit("text/plain")).alias("headers"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("payload"))
    return full.unionByName(again)


def revisit_digest(pages: DataFrame) -> DataFrame:
    out = resolve(crawl_records(pages.filter("page_id IS NOT NULL")))
    return out.select("record_id", "type", F.col("key").alias("canonical"), "status", "base_id",
                      F.col("headers")["date"].alias("date"), F.col("headers")["content-type"].alias("content_type"),
                      F.md5(F.coalesce("payload", F.lit(""))).alias("payload_md5"))


_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':(80|443)$', ''), '^(www|m)\.', '')"
ORACLE = rf"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html,
  regexp_replace(regexp_replace(trim(url), '^https?://', '', 'i'), '#.*$', '') AS rest FROM pages WHERE page_id IS NOT NULL),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
  lambda x: x <> '' AND NOT regexp_matches(lower(x), '{TRACKING}'))) AS kept FROM p),
c AS (SELECT page_id, html, CASE WHEN url IS NOT NULL THEN {_HOST}
  || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM q),
f AS (SELECT page_id * 2 AS record_id, canonical, md5(html) AS tag FROM c),
v AS (SELECT page_id * 2 + 1 AS record_id, canonical, CASE WHEN page_id % 3 = 0 THEN 'other' ELSE md5(html) END AS tag FROM c),
j AS (SELECT v.record_id, v.canonical, v.tag, max(f.record_id) AS base FROM v LEFT JOIN f
  ON f.canonical = v.canonical AND f.record_id < v.record_id GROUP BY ALL),
r AS (SELECT j.*, f.tag AS base_tag, CASE WHEN base IS NULL THEN 'missing' WHEN j.tag = f.tag THEN 'resolved' ELSE 'mismatch' END AS status
  FROM j LEFT JOIN f ON f.record_id = j.base)
SELECT record_id, 'response' AS type, canonical, 'full' AS status, NULL::BIGINT AS base_id, record_id::VARCHAR AS date,
  'text/html' AS content_type, tag AS payload_md5 FROM f
UNION ALL
SELECT record_id, 'revisit', canonical, status, base, record_id::VARCHAR,
  CASE WHEN status = 'resolved' THEN 'text/html' ELSE 'text/plain' END,
  CASE WHEN status = 'resolved' THEN base_tag ELSE md5('') END FROM r
"""

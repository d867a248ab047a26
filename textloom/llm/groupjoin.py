"""Similarity join of documents by a grouped prefix join on n-gram Jaccard.

1. Shingles are ordered by how many documents hold them, rare first. Frequencies are
   counted over all documents in ``BUCKETS`` hash buckets (a table of fixed size) and
   taken to a quarter of a power of two; equal ones are ordered by hash. Any total
   order gives right results; this one keeps frequent shingles out of prefixes.
2. Documents with equal sets are one class. Classes with the same size and the same
   prefix (the first ``n - ceil(J n) + 1`` shingles) are one group.
3. Similar sets share a prefix shingle, so groups that share one are compared: first
   with one leader of each shingle's groups, the one that shares most. Sizes and
   the shingle's positions filter pairs of groups. A shingle whose groups all hold one
   and the same earlier shingle is nobody's first common one and is left out.
4. Pairs that stay are expanded to members. A member of a group meets the group's first
   class and the leader's. The parities of the set's shingles in 512 buckets bound
   the symmetric difference from below and filter pairs of members; full sets verify.
5. Links found join components. Where the classes that share a shingle are still of
   several components, classes outside the largest meet eight leaders, one of each
   hash slot, and then, where that has not joined them, all others that the filters
   allow. So a crowd of near copies costs pairs in proportion to its size.

No pair that can change a component is left out: every filter is a bound. Shingles
are 64-bit hashes, sets are told apart by 128-bit digests.

Defined results: null and blank texts have an empty set, link with nothing and are
their own component; a null doc_id takes part and is a component's id only if no other
is there; repeated rows are copies; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import hashed_texts, row_key, saved, shingle_hashes
from textloom.llm.graph import components

WIDTH = 4
SIMILAR_PCT = 85
BUCKETS = 1 << 20
BLOCK = 1 << 16            # buckets of a row of the frequency table
PARITIES = 512
SLOTS = 8
PARTNERS = 256             # pairs of a leader that one task verifies together
BITS, PAGE = 1 << 23, 1 << 15      # places of the key filter, and of one row of it


def _sets(col: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for i, j, h, offs in hashed_texts(col):
        for r in range(i, j):
            yield r, np.unique(shingle_hashes(h[offs[r - i]:offs[r - i + 1]], width))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def prefix_length(n: int, similar_pct: int) -> int:
    return n - (similar_pct * n + 99) // 100 + 1


# ---- order of shingles ---------------------------------------------------------------------------

def _counted(docs: DataFrame, width: int) -> DataFrame:
    """(block, spot, n): per task, the documents that hold a shingle of each bucket; spot null: all of the block."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            held, size = [], 0
            for _, s in _sets(b.column("text"), width):
                held.append(s)
                size += len(s)
                if size > 1 << 20:
                    total += np.bincount((np.concatenate(held) >> np.uint64(44)).astype(np.int64), minlength=BUCKETS)
                    held, size = [], 0
            if held:
                total += np.bincount((np.concatenate(held) >> np.uint64(44)).astype(np.int64), minlength=BUCKETS)
        out: list[tuple] = []
        for k in range(BUCKETS // BLOCK):
            part = total[k * BLOCK:(k + 1) * BLOCK]
            spot = np.flatnonzero(part)
            if len(spot) > BLOCK // 2:
                out.append((k, None, part.astype(np.uint32).tobytes()))
            elif len(spot):
                out.append((k, spot.astype(np.uint16).tobytes(), part[spot].astype(np.uint32).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["block", "spot", "n"])

    return docs.mapInArrow(job, "block int, spot binary, n binary")


def _summed(counts: DataFrame) -> DataFrame:
    """Tables of the same block in a task added up."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, spot, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                mine = sums.setdefault(k, np.zeros(BLOCK, np.int64))
                at = slice(None) if spot is None else np.frombuffer(spot, np.uint16)
                mine[at] += np.frombuffer(n, np.int64 if spot is None and len(n) == 8 * BLOCK else np.uint32)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.nulls(len(sums), pa.binary()),
                 pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "spot", "n"])

    return counts.select("block", "spot", "n").mapInArrow(job, "block int, spot binary, n binary")


def shingle_levels(docs: DataFrame, width: int) -> np.ndarray:
    """Frequency level (0-255) of each bucket: ``BUCKETS`` bytes, whatever the number of documents."""
    counts = _counted(docs.select("text"), width).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    rows = _summed(_summed(counts.repartition("block", "salt")).repartition("block")).collect()
    total = np.zeros(BUCKETS, np.int64)
    for r in rows:
        total[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.n, np.int64)
    return np.minimum(255, np.floor(4 * np.log2(np.maximum(total, 1)))).astype(np.uint8)


def sketches(docs: DataFrame, levels: np.ndarray, similar_pct: int, width: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, key, text): doc_id, key, n_shingles, the set's digest, parities
    and prefix (items in order; null for an empty set)."""
    table = docs.sparkSession.sparkContext.broadcast(levels)      # BUCKETS bytes

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = table.value
        for b in batches:
            n = len(b)
            size, fp, bits, prefix = np.zeros(n, np.int64), [None] * n, [None] * n, [None] * n
            for r, s in _sets(b.column("text"), width):
                if len(s):
                    size[r], fp[r] = len(s), _digest(s)
                    odd = np.bincount((s & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
                    bits[r] = np.packbits(odd.astype(np.uint8)).view(np.int64)
                    item = level[(s >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(56) \
                        | s & np.uint64((1 << 56) - 1)
                    p = prefix_length(len(s), similar_pct)
                    if p < len(item):
                        item = np.partition(item, p - 1)[:p]
                    prefix[r] = np.sort(item).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(size), pa.array(fp, pa.binary()),
                 pa.array(bits, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "fp", "bits", "prefix"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        job, "doc_id long, key struct<a:long,b:int>, n_shingles long, fp binary, bits array<long>, prefix array<long>")


# ---- verification --------------------------------------------------------------------------------

def sets_in_cells(texts: DataFrame, width: int) -> DataFrame:
    """(cell, lead, fp, items): the set of each text, once for every cell it is sent to."""
    names, types = ["cell", "lead", "fp", "items"], (pa.string(), pa.bool_(), pa.binary(), pa.binary())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for b in batches:
            cells = b.column("cells")
            for r, s in _sets(b.column("text"), width):
                fp, items = _digest(s), s.tobytes()
                for c in cells[r].as_py():
                    out.append((c["cell"], c["lead"], fp, items))
                    size += len(items)
                    if size > 1 << 22:
                        yield batch(out)
                        out, size = [], 0
        if out:
            yield batch(out)

    return texts.select("text", "cells").mapInArrow(job, "cell string, lead boolean, fp binary, items binary")


def marked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``hit``: false for rows whose key is surely not in ``keys``. The keys' hashes are a
    bitmap of ``BITS`` places (1 MB in 256 rows, however many keys), so no row is shuffled."""
    spot = F.pmod(F.xxhash64(key), F.lit(BITS))
    page = F.floor(spot / PAGE).cast("int")
    bitmap = keys.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(spot % PAGE).alias("held"))
    x = rows.withColumn("page", page).withColumn("spot", (spot % PAGE).cast("int")).join(F.broadcast(bitmap), "page", "left")
    byte = F.conv(F.hex(F.expr("substring(held, spot div 8 + 1, 1)")), 16, 10).cast("int")
    return x.withColumn("hit", F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, spot % 8)")) != 0, F.lit(False))).drop("page", "spot", "held")


def rows_with_key(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The text of one row of ``docs`` for each row of ``keys`` (key, ...). Most other rows are dropped
    before texts are shuffled; the join on the key decides."""
    held = marked(docs, keys, "key").filter("hit").select(F.col("key.a").alias("ka"), F.col("key.b").alias("kb"), "text")
    return held.dropDuplicates(["ka", "kb"]).join(keys.withColumns({"ka": F.col("key.a"), "kb": F.col("key.b")}), ["ka", "kb"])


def one_of_each(sk: DataFrame) -> DataFrame:
    """(gid, n, prefix) of every group: its first row. Only rows that may be copies are shuffled."""
    known = sk.filter("fp IS NOT NULL").select("gid", "row", F.col("n_shingles").cast("int").alias("n"), "prefix")
    first = saved(known.groupBy("gid").agg(F.min("row").alias("first")), "join-first")
    copies = saved(known.select("gid", "row").join(first, "gid").filter("row > first").select("row"), "join-copies")
    rows = marked(known, copies, "row")
    more = rows.filter("hit").join(first.select(F.col("first").alias("row")), "row", "left_semi")
    return rows.filter(~F.col("hit")).select("gid", "n", "prefix").union(more.select("gid", "n", "prefix"))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, similar_pct: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the similarity. A cell is an ``a`` with up to about
    ``PARTNERS`` of its ``b``; every set travels once to each of its cells."""
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c"))
    cell = F.concat_ws("-", F.hex("a"), F.pmod(F.hash("b"), F.ceil(F.col("c") / PARTNERS).cast("int")))
    dealt = pairs.join(many, "a").select("a", "b", cell.alias("cell"))
    sent = dealt.select(F.col("a").alias("fp"), "cell", F.lit(True).alias("lead")).distinct() \
        .union(dealt.select("b", "cell", F.lit(False)))
    cells = sent.groupBy("fp").agg(F.collect_list(F.struct("cell", "lead")).alias("cells"))
    keys = saved(classes.select("fp", "key").join(cells, "fp").select("key", "cells"), "join-keys")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, lead, mine = None, b"", np.zeros(0, np.uint64)
        for batch in batches:
            out_a, out_b = [], []
            for c, first, fp, items in zip(*[batch.column(k).to_pylist() for k in ("cell", "lead", "fp")], batch.column("items"),
                                           strict=True):
                s = np.frombuffer(items.as_buffer(), np.uint64)
                if first:
                    here, lead, mine = c, fp, s.copy()
                    continue
                z = np.concatenate([mine, s])
                z.sort(kind="stable")
                both = int(np.count_nonzero(z[1:] == z[:-1]))
                if c == here and 100 * both >= similar_pct * (len(z) - both):
                    out_a.append(lead)
                    out_b.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])

    x = sets_in_cells(rows_with_key(docs, keys), width).repartition("cell").sortWithinPartitions("cell", F.desc("lead"))
    return saved(x.mapInArrow(job, "a binary, b binary"), "join-links")


# ---- candidates ----------------------------------------------------------------------------------

def _sizes_allow(x: str, y: str, pct: int) -> Column:
    return F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * pct


def _places_allow(x: str, y: str, pct: int) -> Column:
    """At most one common item and what follows it in both sets, if it is their first common one."""
    most = 1 + F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos")) - 1
    return most * (100 + pct) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * pct


def _parities_allow(x: str, y: str, pct: int) -> Column:
    odd = None
    for k in range(PARITIES // 64):
        d = F.bit_count(F.get(f"{x}.bits", F.lit(k)).bitwiseXOR(F.get(f"{y}.bits", F.lit(k))))
        odd = d if odd is None else odd + d
    return odd * (100 + pct) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - pct)


def _unordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """(a, b): y's side leads."""
    return pairs.select(F.col(f"{y}.fp").alias("a"), F.col(f"{x}.fp").alias("b")).distinct()


def leader_pairs(lists: DataFrame, groups: DataFrame, classes: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b) of classes: each list's leading group with the list's other groups, expanded, and
    each group's first class with its other members."""
    popular = lists.groupBy("gid").agg(F.sum(F.log2("size")).alias("popular"))
    held = lists.join(popular, "gid")
    lead = held.groupBy("item").agg(F.max_by(F.struct("gid", "n", "pos"), F.struct("popular", "gid")).alias("k")) \
        .select("item", "k.gid", "k.n", "k.pos")
    m, k = lists.alias("m"), lead.alias("k")
    pairs = m.join(k, (F.col("m.item") == F.col("k.item")) & (F.col("m.gid") != F.col("k.gid"))
                   & _sizes_allow("m", "k", pct) & _places_allow("m", "k", pct))
    pairs = pairs.select(F.col("m.gid").alias("gid"), F.col("k.gid").alias("lead")).distinct()
    pairs = pairs.union(groups.filter("members > 1").select("gid", F.col("gid").alias("lead")))
    first = groups.select(F.col("gid").alias("lead"), F.col("first").alias("fp"))
    y = pairs.join(first, "lead").join(classes.select("fp", "n", "bits"), "fp").alias("y")
    x = classes.select("fp", "gid", "n", "bits").alias("x")
    found = x.join(y, (F.col("x.gid") == F.col("y.gid")) & (F.col("x.fp") != F.col("y.fp"))
                   & _parities_allow("x", "y", pct) & _sizes_allow("x", "y", pct))
    return _unordered(found, "x", "y")


def open_members(lists: DataFrame, classes: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (item, pos, fp, n, bits, root) of lists that still hold several components, and those of
    them outside the list's largest component."""
    placed = classes.select("gid", "fp", "n", "bits").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rows = saved(lists.select("item", "gid", "pos").join(placed, "gid").drop("gid"), "join-open")
    most = (rows.groupBy("item", "root").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("item").agg(F.count(F.lit(1)).alias("c"), F.max_by("root", F.struct("k", "root")).alias("most"))
            .filter("c > 1").drop("c"))
    rows = saved(rows.join(most, "item").withColumn("rest", F.col("root") != F.col("most")).drop("most"), "join-open")
    return rows.drop("rest"), rows.filter("rest").drop("rest")


def shared_items(prefixes: DataFrame, groups: DataFrame) -> DataFrame:
    """(item, gid, n, pos, size): the prefix items that several groups hold, and one item for each
    group with several members. An item whose holders all have the same item just before it, or the
    same first item, is no pair's first common one and is dropped."""
    tokens = prefixes.select("gid", "n", F.posexplode("prefix").alias("pos", "item"))
    tokens = tokens.select("item", "gid", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("at"))
    by_item, by_group = Window.partitionBy("item"), Window.partitionBy("gid").orderBy("at")
    tokens = tokens.withColumn("size", F.count(F.lit(1)).over(by_item)).filter("size > 1")
    tokens = tokens.withColumn("prev", F.lag("item").over(by_group)).withColumn("head", F.first("item").over(by_group))
    same = lambda c: F.min(c).over(by_item) == F.max(c).over(by_item)
    behind = (same("prev") & (F.count("prev").over(by_item) == F.col("size"))) | (same("head") & (F.min("head").over(by_item) != F.col("item")))
    kept = tokens.withColumn("behind", F.coalesce(behind, F.lit(False))).filter(~F.col("behind")).select(
        "item", "gid", F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND((1 << 32) - 1).cast("int").alias("pos"), "size")
    alone = groups.filter("members > 1").select(F.xxhash64(F.lit(1), "gid").alias("item"), "gid", "n", F.lit(0).alias("pos"),
                                                F.lit(1).cast("long").alias("size"))
    return kept.union(alone)


def similar_components(sk: DataFrame, classes: DataFrame, docs: DataFrame, similar_pct: int, width: int) -> DataFrame:
    """(fp, root) of every class with a partner; other classes are alone. ``sk``: row, gid, fp,
    n_shingles, prefix of every document; ``classes``: fp, n, key, bits, gid; ``docs``: key and text."""
    held = classes.groupBy("gid").agg(F.count(F.lit(1)).alias("members"), F.min("fp").alias("first"),
                                      F.first("n").alias("n"))
    groups = saved(held, "join-groups")
    lists = saved(shared_items(one_of_each(sk), groups), "join-lists")
    slim = classes.select("fp", "gid", "n", "bits", "key")
    tried = saved(leader_pairs(lists, groups, slim, similar_pct), "join-pairs")

    confirmed = lambda pairs: verified(pairs, slim, docs, similar_pct, width)
    roots = components(confirmed(tried)).withColumnRenamed("node", "fp")
    popular = F.struct("seen", "fp")
    for last in (False, True):
        rows, rest = open_members(lists, slim, roots)
        if rest.isEmpty():
            break
        others = rows
        if not last:
            seen = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("seen"))
            slot = F.pmod(F.xxhash64("fp"), F.lit(SLOTS))
            others = rows.join(seen, "fp").groupBy("item", slot.alias("slot")).agg(
                F.max_by(F.struct("pos", "fp", "n", "bits", "root"), popular).alias("k")).select("item", "k.*")
        x, y = rest.alias("x"), others.alias("y")
        more = x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.root") != F.col("y.root"))
                      & _sizes_allow("x", "y", similar_pct) & _places_allow("x", "y", similar_pct)
                      & _parities_allow("x", "y", similar_pct))
        pairs = _unordered(more, "x", "y").join(tried, ["a", "b"], "left_anti")
        pairs = saved(pairs.join(tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"), "join-pairs")
        tried = tried.union(pairs)
        label = lambda c: F.coalesce(F.col(f"{c}.root"), F.col(f"e.{c[1]}"))
        links = confirmed(pairs).alias("e")
        links = links.join(roots.alias("ra"), F.col("e.a") == F.col("ra.fp"), "left") \
            .join(roots.alias("rb"), F.col("e.b") == F.col("rb.fp"), "left").select(label("ra").alias("a"), label("rb").alias("b"))
        links = saved(links.distinct(), "join-links")
        moved = components(links).select(F.col("node").alias("old"), F.col("root").alias("to"))
        named = roots.join(moved, F.col("root") == F.col("old"), "left").select("fp", F.coalesce("to", "root").alias("root"))
        new = moved.join(roots.select("fp"), F.col("old") == F.col("fp"), "left_anti").select(F.col("old").alias("fp"), F.col("to").alias("root"))
        roots = saved(named.union(new), "join-roots")
    return roots


def similarity_join(docs: DataFrame, text: str = "text", similar_pct: int = SIMILAR_PCT, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach, its own included)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    sk = sketches(docs, shingle_levels(docs, width), similar_pct, width)
    sk = saved(sk.withColumns({"gid": F.xxhash64("n_shingles", "prefix"), "row": F.monotonically_increasing_id()}), "join-sketches")
    classes = saved(sk.filter("fp IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").cast("int").alias("n"), F.min("key").alias("key"),
        F.first("bits").alias("bits"), F.first("gid").alias("gid")), "join-classes")
    roots = similar_components(sk, classes, docs, similar_pct, width)
    named = saved(classes.select("fp", "id").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "join-named")
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    out = sk.select("doc_id", "n_shingles", "fp").join(named.join(least, "root").select("fp", "component"), "fp", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def join_digest(docs: DataFrame) -> DataFrame:
    return similarity_join(docs)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, row_number() OVER () AS r FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM w UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM w JOIN reach ON reach.a = w.r JOIN w o ON o.r = reach.b LEFT JOIN n ON n.r = w.r GROUP BY w.r, w.doc_id
"""

"""Near-duplicate groups by a MinHash LSH forest, confirmed on full shingle sets.

1. One pass over the texts makes, per document, the size and digest of its set
   of five-word shingles and ``TREES`` groups of four minimum hashes.
2. Equal sets are one class from here on, however many copies there are.
3. The forest: tree t orders signatures by their groups t, t + 1, ... A region
   is a run of classes that agree on a prefix. Regions start at one group;
   regions of more than ``CROWD`` classes are split again at the next group
   (deeper prefixes where the forest is dense). Longest-prefix neighbours are
   compared through each region's leader, the class that agrees with most others
   over all trees, so a region yields candidates in proportion to its size.
4. Candidates that sizes allow are confirmed on full shingle sets.
5. Classes of regions that still hold several components are matched across
   components by an exact prefix filter: similar sets share one of their rarest
   items. Links found join components.

Two texts at similarity J share no region with probability (1 - J^4)^20: 4e-7
at 0.85 and 3e-5 at 0.8. Nothing else can lose a link between components of a region.

Defined results: null and blank texts have an empty set, link with nothing and
are kept; a null doc_id takes part, and is the component only if no other id is
there; repeated rows are copies of each other; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import hashed_texts, mix, row_key, saved, shingle_hashes
from textloom.llm.graph import components

WIDTH = 5
TREES, DEPTH = 20, 4
CROWD = 64
DEEPEST = 5                # groups in the longest prefix
SIMILAR_PCT = 80

with np.errstate(over="ignore"):
    _ODDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sets(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for i, j, h, offs in hashed_texts(col):
        for r in range(i, j):
            yield r, np.unique(shingle_hashes(h[offs[r - i]:offs[r - i + 1]], WIDTH))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, TREES) groups of DEPTH minimum hashes, 16 bits of each; sets are not empty."""
    size = np.array([len(s) for s in sets])
    flat, first = np.concatenate(sets), np.cumsum(size) - size
    out = np.zeros((len(sets), TREES), np.uint64)
    with np.errstate(over="ignore"):
        for k, odd in enumerate(_ODDS):
            low = mix(np.minimum.reduceat(flat * odd, first)) & np.uint64(0xFFFF)
            out[:, k // DEPTH] |= low << np.uint64(16 * (k % DEPTH))
    return out


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, key, n_shingles, the set's digest and its signature (null for an empty set).
    ``docs``: doc_id, key (row_key), the text."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(b)
            size, fp, sig = np.zeros(n, np.int64), [None] * n, [None] * n
            rows, held, total = [], [], 0

            def flush() -> None:
                nonlocal rows, held, total
                if rows:
                    for r, s in zip(rows, _signatures(held).view(np.int64), strict=True):
                        sig[r] = s
                rows, held, total = [], [], 0

            for r, s in _sets(b.column("text")):
                if len(s):
                    size[r], fp[r] = len(s), _digest(s)
                    rows.append(r)
                    held.append(s)
                    total += len(s)
                    if total > 1 << 18:
                        flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(size), pa.array(fp, pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "fp", "sig"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "key", F.col(text).alias("text"))
    return src.mapInArrow(job, "doc_id long, key struct<a:long,b:int>, n_shingles long, fp binary, sig array<long>")


def shingle_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """(fp, items) of each text with shingles: its digest and its sorted hashes."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, items, size = [], [], 0
            for _, s in _sets(b.column("text")):
                if len(s):
                    fp.append(_digest(s))
                    items.append(s.tobytes())
                    size += s.nbytes
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(fp, pa.binary()), pa.array(items, pa.binary())], ["fp", "items"])
                    fp, items, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(fp, pa.binary()), pa.array(items, pa.binary())], ["fp", "items"])

    return docs.select(F.col(text).alias("text")).mapInArrow(job, "fp binary, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame, similar_pct: int) -> DataFrame:
    """The pairs (a, b, ...) whose full sets meet the similarity."""
    names = pairs.columns

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                z = np.concatenate([x, y])
                z.sort()
                both = int(np.count_nonzero(z[1:] == z[:-1]))
                keep.append(100 * both >= similar_pct * (len(z) - both))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    sides = (pairs.join(sets.select(F.col("fp").alias("a"), F.col("items").alias("x")), "a")
             .join(sets.select(F.col("fp").alias("b"), F.col("items").alias("y")), "b"))
    return sides.select(*names, "x", "y").mapInArrow(job, pairs.schema).distinct()


def _canonical(x: str, y: str, similar_pct: int, *, roots: bool = False) -> tuple[Column, list[Column]]:
    """Whether sizes allow the similarity of two sides, and their unordered pair."""
    fits = (F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * similar_pct)
    low = F.col(f"{x}.fp") < F.col(f"{y}.fp")
    out = [F.least(f"{x}.fp", f"{y}.fp").alias("a"), F.greatest(f"{x}.fp", f"{y}.fp").alias("b")]
    if roots:
        out += [F.when(low, F.col(f"{x}.root")).otherwise(F.col(f"{y}.root")).alias("ra"),
                F.when(low, F.col(f"{y}.root")).otherwise(F.col(f"{x}.root")).alias("rb")]
    return fits, out


def _paired(members: DataFrame, leaders: DataFrame, similar_pct: int) -> DataFrame:
    """Unordered pairs of a leader and the members of its region whose sizes allow the similarity."""
    m, k = members.alias("m"), leaders.alias("k")
    fits, out = _canonical("m", "k", similar_pct)
    pairs = m.join(k, F.col("m.region") == F.col("k.region")).filter(F.col("m.fp") != F.col("k.fp"))
    return pairs.filter(fits).select(*out).distinct()


def parities(sets: DataFrame) -> DataFrame:
    """(fp, bits): whether the number of shingles in each of 512 buckets is odd."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = []
            for x in b.column("items"):
                spot = (np.frombuffer(x.as_buffer(), np.uint64) & np.uint64(511)).astype(np.int64)
                bits.append(np.packbits((np.bincount(spot, minlength=512) & 1).astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("fp"), pa.array(bits, pa.list_(pa.int64()))], ["fp", "bits"])

    return sets.select("fp", "items").mapInArrow(job, "fp binary, bits array<long>")


def _may_be_similar(x: str, y: str, pct: int) -> Column:
    """Bounds that similar sets meet: places of their first common item, and the parities, whose
    differences are at most the shingles that only one of the sets has."""
    size = F.col(f"{x}.n") + F.col(f"{y}.n")
    after = F.least(F.col(f"{x}.n") - F.col(f"{x}.rank"), F.col(f"{y}.n") - F.col(f"{y}.rank"))
    odd = None
    for k in range(8):
        d = F.bit_count(F.get(f"{x}.bits", F.lit(k)).bitwiseXOR(F.get(f"{y}.bits", F.lit(k))))
        odd = d if odd is None else odd + d
    return ((1 + after) * (100 + pct) >= size * pct) & (odd * (100 + pct) <= size * (100 - pct))


def _prefix_pairs(contested: DataFrame, sets: DataFrame, similar_pct: int) -> DataFrame:
    """All pairs of classes from different components that can be similar: two such sets share an
    item among the n - ceil(J n) + 1 rarest of each. In an item's group, classes outside the
    group's largest component meet all others; those inside it are linked already."""
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("items")]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            if len(at):
                yield pa.RecordBatch.from_arrays([b.column("fp").take(pa.array(at)), pa.array(np.concatenate(found))],
                                                 ["fp", "item"])

    mine = sets.join(contested.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    rows = saved(mine.mapInArrow(items, "fp binary, item long"), "neardup-items")
    often = rows.groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    rank = F.row_number().over(Window.partitionBy("fp").orderBy("c", "item"))
    prefix = F.col("n") - F.ceil(F.col("n") * similar_pct / 100) + 1
    ranked = (rows.join(often, "item").withColumn("rank", rank).join(contested, "fp")
              .filter((F.col("rank") <= prefix) & (F.col("c") > 1)).select("item", "fp", "n", "root", "rank"))
    ranked = saved(ranked.join(parities(mine), "fp"), "neardup-prefixes")
    most = (ranked.groupBy("item", "root").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("item").agg(F.max_by("root", F.struct("k", "root")).alias("most")))
    rest = ranked.join(most, "item").filter("root <> most")
    x, y = rest.alias("x"), ranked.alias("y")
    fits, out = _canonical("x", "y", similar_pct, roots=True)
    return x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.root") != F.col("y.root")) & fits
                  & _may_be_similar("x", "y", similar_pct)).select(*out).distinct()


def forest_regions(classes: DataFrame) -> DataFrame:
    """(fp, n, region) of every class in a region with others, at each depth."""
    level = classes.select("fp", "n", "sig", F.posexplode("sig").alias("tree", "group"))
    level = level.select("fp", "n", F.xxhash64("tree", "group").alias("region"), "tree")
    out = None
    for depth in range(1, DEEPEST + 1):
        sizes = level.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        here = saved(level.join(sizes, "region"), "forest-level")
        out = here if out is None else out.union(here)
        crowd = here.filter(F.col("size") > CROWD)
        if depth == DEEPEST or crowd.isEmpty():
            return out.select("fp", "n", "region", "size")
        level = crowd.drop("size").join(classes.select("fp", "sig"), "fp").select(
            "fp", "n", F.xxhash64("region", F.get("sig", (F.col("tree") + depth) % TREES)).alias("region"), "tree")
    return out


def _grouped(docs: DataFrame, text: str, similar_pct: int) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (fp, root, id, best) of each class: its component, smallest id and first row
    (smallest id, null last, then the key of all columns)."""
    key = row_key(*[F.col(f"`{c}`") for c in docs.columns])
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), key.alias("key"))
    sk = saved(sketches(docs), "neardup-sketches")
    classes = saved(sk.filter("fp IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("id"), F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")).alias("best"),
        F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "neardup-classes")
    members = saved(forest_regions(classes), "neardup-members")
    popular = members.groupBy("fp").agg(F.sum(F.log2("size")).alias("popular"))
    members = saved(members.select("fp", "n", "region").join(popular, "fp"), "neardup-members")
    leaders = members.groupBy("region").agg(F.max_by(F.struct("fp", "n"), F.struct("popular", "fp")).alias("k")) \
        .select("region", "k.fp", "k.n")
    pairs = saved(_paired(members, leaders, similar_pct), "neardup-pairs")
    involved = docs.join(members.select("fp").distinct().join(classes, "fp").select("best.key"), "key", "left_semi")
    sets = saved(shingle_sets(involved), "neardup-sets")
    links = saved(confirmed(pairs, sets, similar_pct), "neardup-links")
    roots = components(links).withColumnRenamed("node", "fp")
    placed = saved(members.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "neardup-placed")
    open_ = placed.groupBy("region").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    contested = saved(placed.join(open_.select("region"), "region", "left_semi").select("fp", "n", "root").distinct(),
                      "neardup-contested")
    roots = placed.select("fp", "root").distinct()
    if not contested.isEmpty():
        more = _prefix_pairs(contested, sets, similar_pct).join(pairs, ["a", "b"], "left_anti")
        new = saved(confirmed(more, sets, similar_pct).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
                    "neardup-links")
        if not new.isEmpty():
            moved = components(new).select(F.col("node").alias("root"), F.col("root").alias("to"))
            roots = roots.join(moved, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to")
    named = classes.select("fp", "id", "best").join(roots, "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    return sk, named


def near_duplicates(docs: DataFrame, text: str = "text", similar_pct: int = SIMILAR_PCT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and kept (it is its component's smallest id)."""
    sk, named = _grouped(docs.select("doc_id", text), text, similar_pct)
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.join(least, "root").select("fp", "component")
    out = sk.select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.withColumn("component_id", component).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "doc_id", "n_shingles", "component_id", "kept", "fp")


def deduplicated(docs: DataFrame, text: str = "text", similar_pct: int = SIMILAR_PCT) -> DataFrame:
    """One document of each group, in the input's columns: of the rows with the group's smallest id (null
    only if no other is there) one, whatever texts share that id. Null and blank texts stay; of rows
    equal in all columns, one."""
    sk, named = _grouped(docs, text, similar_pct)
    first = named.groupBy("root").agg(F.min("best").alias("best")).select("best.key")
    kept = saved(first.union(sk.filter("fp IS NULL").select("key")).distinct(), "neardup-kept")
    key = row_key(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    rows = rows.join(kept, "key", "left_semi").dropDuplicates(["key"])     # dealt by key once
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def neardup_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"), similar_pct=85).drop("fp")

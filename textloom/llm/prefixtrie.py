"""Prefix trie of conversations by burst tries.

A conversation is its sequence of turn ids (a digest of role and text); only ids and
byte counts are shuffled. Sequences are cut into segments of ``SEGMENT`` turns, and a
segment's place is the digest of all turns before it, so no row holds more than a
segment. Equal segments at the same place are one suffix with a count.

1. Burst: the suffixes under one trie head are a container. A container of more than
   ``BURST`` turns moves down the prefix that all its suffixes share and is burst by
   the next turn id: each id is the head of a container of its own. This repeats
   until every container is small, at most ``SEGMENT`` times, once per branching of a
   crowded prefix.
2. Sweep: a small container's suffixes are sorted; one pass with a stack of open
   nodes closes each node with its counts, children and subtree sums.
3. Heads of burst containers add up the heads below, last burst first, by partial
   aggregates; the segments that follow a segment hang below its last node.
4. Conversations that nobody else shares beyond a segment's end are chains; their
   subtree sums are running sums over segments, without a container.

Members that end in a node are hashed in order of id: sorted runs of ids become
strings of up to ``IDS`` ids first, and these are hashed as a stream.

Defined results: null role or text is empty; null turns come first, equal turns are
ordered by the digest of role and text; repeated rows are turns of their own; a null
conv_id is a conversation without a base, a member that is nobody's smallest id and
is left out of the digests of ends (which hold decimal ids); an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import saved

SEGMENT = 1024             # turns of a segment
BURST = 1 << 16            # turns of the largest container
IDS = 4096                 # ids of a hashed string
SHARED = 9                 # the contract's modulus: at most 8 turns come from the base
EMPTY = hashlib.sha256(b"").hexdigest()
_ENTRY = ("head string, ids array<binary>, lens array<long>, depth long, n long, id long, ends string, kids long, "
          "leaves long, saved long, top long")
_NODE = ("kind int, head string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


# ---- sequences -----------------------------------------------------------------------------------

def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv, rank, tid, bytes): the turns of each conversation numbered from 1.

    Turns are sorted over range partitions and counted on from one partition to the
    next, so a conversation with a third of all turns is spread over many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    x = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                             F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("tid"),
                             F.octet_length(text).cast("long").alias("bytes"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("tid")]
    x = x.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    x = saved(x.withColumn("part", F.shiftright("at", 33)), "trie-turns")
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at"))
    counts = x.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    onward = counts.withColumn("before", F.sum("c").over(earlier)).filter("before > 0") \
        .select(F.col("conv").alias("c0"), F.col("part").alias("p0"), "before")    # at most one row a partition
    x = x.withColumn("r", within).join(onward, F.col("conv").eqNullSafe(F.col("c0")) & (F.col("part") == F.col("p0")), "left")
    return x.select("conv", (F.col("r") + F.coalesce("before", F.lit(0))).cast("long").alias("rank"), "tid", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (conv) of each, and (conv, i, tid, bytes) of their turns."""
    h = F.coalesce(F.crc32(F.col("conv").cast("string")) % SHARED, F.lit(0)).cast("long")
    convs = turns.select("conv").distinct().withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % 5)
    first = turns.filter(F.col("rank") < SHARED).select(F.col("conv").alias("base"), "rank", "tid", "bytes")
    size = first.groupBy("base").agg(F.count(F.lit(1)).alias("size"))
    convs = convs.join(size, "base", "left").withColumn("have", F.least("h", F.coalesce("size", F.lit(0))))
    convs = saved(convs.select("conv", "base", "h", "have"), "trie-conversations")
    shared = convs.join(first, "base").filter("rank <= h").select("conv", F.col("rank").alias("i"), "tid", "bytes")
    c = convs.select(F.col("conv").alias("c0"), "h", "have")
    own = turns.join(c, F.col("conv").eqNullSafe(F.col("c0"))).filter("rank > h").select(
        "conv", (F.col("rank") - F.col("h") + F.col("have")).alias("i"), "tid", "bytes")
    return convs.select("conv"), shared.union(own)


def segments(turns: DataFrame) -> DataFrame:
    """One row per conversation and segment: seg, ids, lens, before / after (digests of all turns
    before it and through it), whole (of all turns), last, and bytes: in it, before it, in all."""
    place = [F.xxhash64("tid", "i"), F.xxhash64(F.lit(7), "i", "tid")]
    x = turns.groupBy("conv", F.floor((F.col("i") - 1) / SEGMENT).cast("long").alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("i", "tid", "bytes"))).alias("t"), F.bit_xor(place[0]).alias("a"),
        F.bit_xor(place[1]).alias("b"), F.sum("bytes").alias("bytes"))
    w = Window.partitionBy("conv").orderBy("seg")
    before, through, all_ = (w.rowsBetween(Window.unboundedPreceding, k) for k in (-1, 0, Window.unboundedFollowing))
    key = lambda over: F.concat_ws(":", *[F.coalesce(F.bit_xor(c).over(over), F.lit(0)) for c in "ab"])
    return x.select("conv", "seg", F.transform("t", lambda s: s["tid"]).alias("ids"),
                    F.transform("t", lambda s: s["bytes"]).alias("lens"), "bytes", key(before).alias("before"),
                    key(through).alias("after"), key(all_).alias("whole"), F.lead("seg").over(w).isNull().alias("last"),
                    F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("ahead"), F.sum("bytes").over(all_).alias("total"))


# ---- sweep of small containers -------------------------------------------------------------------

class _Open:
    """A node whose subtree is being read."""
    __slots__ = ("n", "id", "kids", "leaves", "saved", "ends", "bytes", "rows")

    def __init__(self, size: int) -> None:
        self.n = self.kids = self.leaves = self.saved = 0
        self.id = self.ends = None
        self.bytes, self.rows = size, []


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def sweep_container(depth: int, suffixes: Iterator[tuple]) -> tuple[list[list], _Open]:
    """Nodes strictly below a head and the head itself; suffixes (ids, lens, n, id, ends, kids,
    leaves, saved, top) come in order of ids; kids, leaves and saved are what hangs below their
    end, top the head's smallest member if the container does not hold all of the head's."""
    out: list[list] = []
    stack, path = [_Open(0)], []

    def close() -> None:
        node, above = stack.pop(), stack[-1]
        path.pop()
        for row in node.rows:
            row[2] = node.id
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.bytes
        row = [node.id, depth + len(stack), None, node.n, node.kids, node.leaves, node.saved, node.ends]
        out.append(row)
        above.rows.append(row)
        above.n += node.n
        above.id = _least(above.id, node.id)
        above.kids += 1
        above.leaves += node.leaves
        above.saved += node.saved

    parent = None
    for ids, lens, n, who, ends, kids, leaves, below, parent in suffixes:
        same = 0
        while same < len(path) and same < len(ids) and path[same] == ids[same]:
            same += 1
        while len(path) > same:
            close()
        for tid, size in zip(ids[same:], lens[same:], strict=True):
            stack.append(_Open(size))
            path.append(tid)
        top = stack[-1]
        top.n += n
        top.id = _least(top.id, who)
        top.ends = ends or top.ends
        top.kids, top.leaves, top.saved = top.kids + kids, top.leaves + leaves, top.saved + below
    while path:
        close()
    for row in stack[0].rows:
        row[2] = stack[0].id if parent is None else parent
    return out, stack[0]


def _swept(entries: DataFrame) -> DataFrame:
    """Nodes (kind 0) below each container's head and a row (kind 1) of the head's own values."""
    names = [f.split()[0] for f in _ENTRY.split(", ")]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.split()[1]])
                            for f in _NODE.split(", ")])
        rows: list[tuple] = []
        head, depth, held = None, 0, []

        def finish() -> None:
            below, top = sweep_container(depth, iter(held))
            rows.extend((0, None, *row) for row in below)
            rows.append((1, head, top.id, depth, None, top.n, top.kids, top.leaves, top.saved, top.ends))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
            rows.clear()
            return out

        for b in batches:
            for start in range(0, len(b), 1024):
                for e in zip(*[b.column(c).slice(start, 1024).to_pylist() for c in names], strict=True):
                    if e[0] != head:
                        if head is not None:
                            finish()
                        head, depth, held = e[0], e[3], []
                    held.append((e[1], e[2], *e[4:]))
                if len(rows) > 50_000:
                    yield batch()
        if head is not None:
            finish()
        if rows:
            yield batch()

    x = entries.select(*names).repartition("head").sortWithinPartitions("head", "ids")
    return x.mapInArrow(job, _NODE)


# ---- bursting ------------------------------------------------------------------------------------

def _leaves(kids: str = "kids", leaves: str = "leaves") -> F.Column:
    return F.when(F.col(kids) == 0, 1).otherwise(F.col(leaves))


def burst_trie(entries: DataFrame, burst: int = BURST) -> tuple[DataFrame, DataFrame]:
    """All nodes below the heads of ``entries`` (named place@digest), and (head, id, n, kids, leaves, saved, ends) of each head."""
    names = entries.columns
    current, small, rounds = entries, None, []
    while True:
        size = current.groupBy("head").agg(
            F.sum(F.size("ids") + 1).alias("turns"), F.count(F.lit(1)).alias("c"), F.min("ids").alias("lo"), F.max("ids").alias("hi"),
            F.min_by("lens", "ids").alias("path"), F.min("depth").alias("at"), F.sum("n").alias("members"), F.min("id").alias("least"), F.min("top").alias("top"))
        same = F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y))
        big = saved(size.filter((F.col("turns") > burst) & (F.col("c") > 1)).select(
            "head", "at", "members", "least", F.coalesce("top", "least").alias("top"), (F.array_position(same, False) - 1).cast("int").alias("lcp"), "path"), "trie-burst")
        if big.isEmpty():
            small = current if small is None else small.union(current)
            break
        rest = current.join(big.select("head"), "head", "left_anti")
        small = rest if small is None else small.union(rest)
        over = current.join(big.select("head", "at", "lcp"), "head")
        ended = over.filter(F.size("ids") == F.col("lcp")).select("head", "kids", "leaves", "saved", "ends")
        on = over.filter(F.size("ids") > F.col("lcp")).withColumn("next", F.get("ids", F.col("lcp")))
        on = on.withColumn("below", F.md5(F.concat(F.encode("head", "utf-8"), "next")))
        cut = lambda c: F.slice(c, F.col("lcp") + 2, F.greatest(F.size(c) - F.col("lcp") - 1, F.lit(0)))
        links = on.groupBy("head", "below").agg(F.first(F.get("lens", F.col("lcp"))).alias("bytes"))
        current = saved(on.select(F.col("below").alias("head"), cut(F.col("ids")).alias("ids"), cut(F.col("lens")).alias("lens"),
                                  (F.col("at") + F.col("lcp") + 1).alias("depth"), *names[4:-1], F.lit(None).cast("long").alias("top")), "trie-container")
        rounds.append((big, saved(links, "trie-links"), saved(ended, "trie-ended")))
    swept = saved(_swept(small), "trie-swept")
    nodes = swept.filter("kind = 0").select(*NODE)
    heads = swept.filter("kind = 1").select("head", F.col("conv_id").alias("id"), F.col("n_convs").alias("n"),
                                            F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
                                            F.col("saved_tokens").alias("saved"), "ends")
    for big, links, ended in reversed(rounds):
        child = links.withColumnRenamed("head", "up").join(heads.withColumnRenamed("head", "below"), "below")
        child = saved(child.select("up", "id", "n", "kids", _leaves().alias("leaves"), "ends",
                                   (F.col("saved") + (F.col("n") - 1) * F.col("bytes")).alias("saved")), "trie-children")
        at = big.select(F.col("head").alias("up"), (F.col("at") + F.col("lcp") + 1).alias("depth"),
                        F.when(F.col("lcp") > 0, F.col("least")).otherwise(F.col("top")).alias("parent"))
        nodes = nodes.union(child.join(at, "up").select(
            F.col("id").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends"))
        sums = child.select(F.col("up").alias("head"), F.lit(1).cast("long").alias("kids"), "leaves", "saved",
                            F.lit(None).cast("string").alias("ends")).union(ended.select("head", "kids", "leaves", "saved", "ends"))
        sums = sums.groupBy("head").agg(F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"),
                                        F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
        branch = saved(big.join(sums, "head"), "trie-branches")
        # the shared prefix of a burst container: nodes 1..lcp below its head, the last of which branches
        extra = F.col("members") - 1
        after = F.aggregate(F.slice("path", F.col("p"), F.greatest(F.col("lcp") - F.col("p") + 1, F.lit(0))),
                            F.lit(0).cast("long"), lambda s, v: s + v)
        chain = branch.filter("lcp > 0").withColumn("p", F.explode(F.sequence(F.lit(1), F.col("lcp"))))
        end = F.col("p") == F.col("lcp")
        nodes = nodes.union(chain.select(
            F.col("least").alias("conv_id"), (F.col("at") + F.col("p")).alias("depth"),
            F.when(F.col("p") == 1, F.col("top")).otherwise(F.col("least")).alias("parent_conv_id"),
            F.col("members").alias("n_convs"), F.when(end, F.col("kids")).otherwise(1).alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("saved") + extra * after).alias("saved_tokens"),
            F.when(end, F.col("ends")).alias("ends")))
        whole = F.aggregate(F.slice("path", F.lit(1), F.col("lcp")), F.lit(0).cast("long"), lambda s, v: s + v)
        straight = F.col("lcp") > 0
        heads = heads.union(branch.select(
            "head", F.col("least").alias("id"), F.col("members").alias("n"), F.when(straight, 1).otherwise(F.col("kids")).alias("kids"),
            "leaves", (F.col("saved") + F.when(straight, extra * whole).otherwise(0)).alias("saved"),
            F.when(~straight, F.col("ends")).alias("ends")))
    return nodes, heads.filter(F.col("head").contains("@"))    # heads of burst containers have no place


# ---- the whole trie ------------------------------------------------------------------------------

def _ends_digest(members: DataFrame) -> DataFrame:
    """(ends, ends_sha256): ids of the members that end in a node, ascending, comma-joined, hashed."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, ids = None, []
        for b in batches:
            for k, c in zip(b.column("ends").to_pylist(), b.column("conv").to_pylist(), strict=True):
                if k != key or len(ids) == IDS:
                    if ids:
                        out.append((key, ids[0], ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(c)
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["ends", "first", "ids"])
                out = []
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["ends", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            out = []
            for k, s in zip(b.column("ends").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(s.encode())
                else:
                    sha.update(b"," + s.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["ends", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], ["ends", "ends_sha256"])

    known = members.filter("conv IS NOT NULL").select("ends", "conv").repartitionByRange("ends", "conv")
    parts = known.sortWithinPartitions("ends", "conv").mapInArrow(strings, "ends string, first long, ids string")
    return parts.repartition("ends").sortWithinPartitions("ends", "first").mapInArrow(digests, "ends string, ends_sha256 string")


def _chains(segs: DataFrame, lone: DataFrame, entry_ids: DataFrame) -> DataFrame:
    """Nodes of the segments that one distinct conversation alone goes through."""
    x = segs.join(lone, ["seg", "before"]).groupBy("seg", "before", "after").agg(
        F.first("ids").alias("ids"), F.first("lens").alias("lens"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("id"),
        F.first("last").alias("last"), F.first("ahead").alias("ahead"), F.first("total").alias("total"))
    x = x.join(entry_ids, (F.col("before") == F.col("k0")) & (F.col("seg") == F.col("s0") + 1), "left")
    x = x.select("*", F.posexplode(F.transform("lens", lambda v, k: F.aggregate(
        F.slice("lens", F.lit(1), k), F.lit(0).cast("long"), lambda s, y: s + y))).alias("p", "sofar"))
    end = F.col("last") & (F.col("p") == F.size("ids") - 1)
    return x.select(F.col("id").alias("conv_id"), (F.col("seg") * SEGMENT + F.col("p") + 1).alias("depth"),
                    F.when(F.col("p") == 0, F.col("up")).otherwise(F.col("id")).alias("parent_conv_id"),
                    F.col("n").alias("n_convs"), F.when(end, 0).otherwise(1).cast("long").alias("n_children"),
                    F.lit(1).cast("long").alias("n_leaves"),
                    ((F.col("n") - 1) * (F.col("total") - F.col("ahead") - F.col("sofar"))).alias("saved_tokens"),
                    F.when(end, F.col("after")).alias("ends"))


def prefix_trie(convs: DataFrame, turns: DataFrame, burst: int = BURST) -> DataFrame:
    """All nodes of the trie. ``convs``: (conv) of every conversation; ``turns``: (conv, i, tid, bytes),
    i from 1 without gaps."""
    segs = saved(segments(turns), "trie-segments")
    entry = segs.groupBy("seg", "before", "after").agg(
        F.first("ids").alias("ids"), F.first("lens").alias("lens"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("id"),
        F.max("last").alias("ended"))
    entry = saved(entry, "trie-suffixes")
    none = lambda c: F.lit(0).cast("long").alias(c)
    hung = None                                   # (seg, after): what hangs below the end of a segment
    nodes = None
    deep = segs.filter("seg > 0").select("seg", "before", "whole", "conv", "ahead", "total")
    if not deep.isEmpty():
        places = saved(deep.groupBy("seg", "before").agg(
            (F.min("whole") == F.max("whole")).alias("alone"), F.count(F.lit(1)).alias("n"),
            F.min(F.col("total") - F.col("ahead")).alias("left")), "trie-places")
        lone = places.filter("alone").select("seg", "before")
        ids = entry.select(F.col("seg").alias("s0"), F.col("after").alias("k0"), F.col("id").alias("up"))
        nodes = _chains(segs, lone, ids)
        hung = places.filter("alone").select((F.col("seg") - 1).alias("seg"), F.col("before").alias("after"), F.lit(1).cast("long").alias("kids"),
                                             F.lit(1).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("left")).alias("saved"))
        shared = places.filter(~F.col("alone"))
        lowest = shared.agg(F.max("seg")).head()[0] or 0
        for k in range(lowest, 0, -1):            # as deep as two different conversations agree
            here = entry.filter(F.col("seg") == k).join(ids, (F.col("s0") == k - 1) & (F.col("before") == F.col("k0"))).join(shared.select("seg", "before"), ["seg", "before"], "left_semi")
            more, heads = burst_trie(_entries(here, hung), burst)
            nodes = nodes.union(more)
            hung = saved(hung.union(heads.select(F.lit(k - 1).cast("long").alias("seg"), F.substring_index("head", "@", -1).alias("after"), "kids",
                                                 _leaves().alias("leaves"), "saved")), "trie-hung")
    below, heads = burst_trie(_entries(entry.filter("seg = 0").withColumn("up", F.lit(None).cast("long")), hung), burst)
    nodes = below if nodes is None else nodes.union(below)
    no = F.lit(None).cast("long")
    top = heads.select(F.lit(0).cast("long").alias("c"), no.alias("conv"), "kids", "leaves", "saved")
    root = convs.select(F.lit(1).cast("long").alias("c"), "conv", no.alias("kids"), no.alias("leaves"), no.alias("saved"))
    root = root.union(top).agg(F.sum("c").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("kids").alias("kids"),
                               F.max("leaves").alias("leaves"), F.max("saved").alias("saved")).filter("n_convs > 0")
    root = root.select("conv_id", F.lit(0).cast("long").alias("depth"), no.alias("parent_conv_id"), "n_convs",
                       F.coalesce("kids", F.lit(0)).alias("n_children"), F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).alias("n_leaves"),
                       F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.lit("0:0").alias("ends"))
    nodes = saved(nodes.union(root), "trie-nodes")
    silent = convs.join(turns.select(F.col("conv").alias("c0")).distinct(), F.col("conv").eqNullSafe(F.col("c0")), "left_anti")
    ends = segs.filter("last").select(F.col("whole").alias("ends"), "conv").union(silent.select(F.lit("0:0"), "conv"))
    named = nodes.filter("ends IS NOT NULL").join(_ends_digest(ends), "ends", "left")
    out = named.select(*NODE[:-1], F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    return out.union(nodes.filter("ends IS NULL").select(*NODE[:-1], F.lit(EMPTY)))


def _entries(entry: DataFrame, hung: DataFrame | None) -> DataFrame:
    """The suffixes of one segment as entries of their containers; ``hung`` is what follows them, up
    the smallest member of the node that the segment hangs below (null: of the container)."""
    head = F.concat(F.col("seg").cast("string"), F.lit("@"), F.col("before"))
    x = entry
    if hung is None:
        x = x.withColumns({c: F.lit(0).cast("long") for c in ("kids", "leaves", "saved")})
    else:
        got = hung.groupBy("seg", "after").agg(*[F.sum(c).alias(c) for c in ("kids", "leaves", "saved")])
        x = x.join(got, ["seg", "after"], "left").na.fill(0, ["kids", "leaves", "saved"])
    return saved(x.select(head.alias("head"), "ids", "lens", (F.col("seg") * SEGMENT).alias("depth"), "n", "id",
                          F.when(F.col("ended"), F.col("after")).alias("ends"), "kids", "leaves", "saved", F.col("up").alias("top")), "trie-entries")


def trie_digest(conversations: DataFrame) -> DataFrame:
    convs, turns = rebuilt_turns(ranked_turns(conversations))
    return prefix_trie(convs, saved(turns, "trie-rebuilt"))


# DuckDB has no crc32; eight shifts per digit of the id.
ORACLE = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations),
h AS (SELECT c, coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda s, x: list_reduce(list_concat([xor(s, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))),
        4294967295) % 9, 0) AS h FROM ids),
t AS (SELECT conv_id AS c, tid, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS r FROM (
        SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid,
               strlen(coalesce(text, '')) AS bytes FROM conversations)),
x AS (SELECT h.c, 0 AS part, t.r, t.tid, t.bytes FROM h JOIN t ON t.c = h.c - h.c % 5 AND t.r <= h.h
      UNION ALL SELECT h.c, 1, t.r, t.tid, t.bytes FROM h JOIN t ON t.c IS NOT DISTINCT FROM h.c AND t.r > h.h),
i AS (SELECT c, tid, bytes, row_number() OVER (PARTITION BY c ORDER BY part, r) AS i FROM x),
s AS (SELECT c, string_agg(tid, '' ORDER BY i) AS s, count(*) AS m FROM i GROUP BY c),
p AS (SELECT i.c, i.i AS d, left(s.s, 32 * i.i) AS k, i.bytes, i.i = s.m AS ends FROM i JOIN s ON s.c IS NOT DISTINCT FROM i.c
      UNION ALL SELECT ids.c, 0, '', 0, s.m IS NULL FROM ids LEFT JOIN s ON s.c IS NOT DISTINCT FROM ids.c),
n AS (SELECT d, k, min(c) AS id, count(*) AS n, max(bytes) AS bytes,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS e FROM p GROUP BY d, k),
up AS (SELECT d - 1 AS d, left(k, 32 * (d - 1)) AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT n.*, coalesce(up.kids, 0) AS kids FROM n LEFT JOIN up USING (d, k)),
a AS (SELECT left(k, 32 * g) AS k, g AS d, sum((n - 1) * bytes) AS saved, sum((kids = 0)::INT) AS leaves
      FROM (SELECT *, unnest(range(d + 1)) AS g FROM v) GROUP BY 1, 2)
SELECT v.id AS conv_id, v.d::BIGINT AS depth, q.id AS parent_conv_id, v.n AS n_convs, v.kids AS n_children,
       a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, v.e AS ends_sha256
FROM v JOIN a USING (d, k) LEFT JOIN n q ON q.d = v.d - 1 AND q.k = left(v.k, 32 * (v.d - 1)) AND v.d > 0
"""

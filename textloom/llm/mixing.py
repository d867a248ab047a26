"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

1. Every source gets a weight; the weights share ``BUDGET_PCT`` percent of all
   words; a target above ``MAX_EPOCHS`` times its source stops there and the
   excess is shared again by weight (water filling, in closed form).
2. Documents are dealt by a hash into shards; inside a (source, shard) cell they
   lie end to end in seeded order and are cut into blocks of equal token counts.
3. Blocks go to sources by the highest quotients v / (2k - 1), then each
   source's blocks to its shards by the same rule: integer quotas.
4. A cell takes its quota as whole passes over its blocks plus a seeded choice
   of the rest (an affine permutation of block numbers, so no block is a row).

Shards grow with the row count, so no cell grows with the data even when one
source holds a third of all rows. Windows without a key run over one row per
source only.

Defined results: a null text has size 0; a null source is a source of its own
(last); a null doc_id is ordered like any other; repeated rows are dealt with
one by one; a source of blank texts has target 0; an empty table gives an empty
table; other columns are carried by ``mixed`` and ignored by ``mix_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import packed, saved, unpacked, words

WEIGHTS = (3, 1, 2)
BUDGET_PCT = 150
MAX_EPOCHS = 2
BLOCK = 128                # words of a block
ROWS_PER_SHARD = 50_000
SEED = "mix-1"
_STEP = 2147483647         # prime: coprime with every smaller block count


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *parts))


def _size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _keyed(docs: DataFrame, shards: int, size: Column) -> DataFrame:
    """Adds the source key, size, seeded order and shard under reserved names."""
    h = _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return docs.withColumns({
        "__nul": F.col("source").isNull(), "__src": F.coalesce(F.col("source"), F.lit("")),
        "__size": size, "__h": h,
        "__shard": F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(shards)})


def targets(sources: DataFrame, size: str) -> DataFrame:
    """Adds weight and water-filled target (words) to one row per source."""
    order = Window.orderBy("__nul", "__src")
    everyone = Window.partitionBy()
    pick = F.array(*[F.lit(w) for w in WEIGHTS])
    df = sources.withColumn("__weight", pick[(F.row_number().over(order) - 1) % len(WEIGHTS)])
    df = df.withColumn("__cap", F.col(size) * MAX_EPOCHS)
    fill = Window.orderBy(F.col("__cap") / F.col("__weight"), "__nul", "__src")
    before = F.coalesce(F.sum("__cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("__weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum(size).over(everyone) * F.lit(BUDGET_PCT / 100)
    df = df.withColumn("__full", F.col("__cap") / F.col("__weight") <= (budget - before) / left)
    rest = (budget - F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0)).over(everyone)) \
        / F.sum(F.when(F.col("__full"), 0).otherwise(F.col("__weight"))).over(everyone)
    return df.withColumn("target", F.when(F.col("__full"), F.col("__cap").cast("double"))
                         .otherwise(F.col("__weight") * rest)).drop("__full", "__cap")


def sainte_lague(df: DataFrame, by: list[str], key: list[str], weight: str, cap: str, seats: str,
                 out: str) -> DataFrame:
    """Adds the quota of each row: ``seats`` (the same on all rows of ``by``) go one by one to the
    highest quotient weight / (2k - 1), at most ``cap`` to a row; ties go to the smaller ``key``.

    A row's quota lies within ``slack`` of its exact share, so only quotients in
    that range are listed and ranked. Expects shares of at most the caps.
    """
    group = Window.partitionBy(*by)
    total = F.sum(weight).over(group)
    share = F.when(total > 0, F.col(seats) * F.col(weight) / total).otherwise(0.0)
    slack = F.when(total > 0, F.ceil(F.col(weight) * F.count(F.lit(1)).over(group) / total)).otherwise(0) + 2
    df = df.withColumns({"__share": share, "__slack": slack})
    df = df.withColumns({
        "__low": F.least(F.col(cap), F.greatest(F.lit(0), F.floor("__share") - F.col("__slack"))).cast("long"),
        "__high": F.least(F.col(cap), F.ceil("__share") + F.col("__slack")).cast("long")})
    df = df.withColumn("__open", F.col(seats) - F.sum("__low").over(group))
    ks = F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low") + 1, F.col("__high")))
    listed = df.withColumn("__k", F.explode(ks))
    rank = F.row_number().over(group.orderBy((F.col(weight) / (F.col("__k") * 2 - 1)).desc(), *key, "__k"))
    won = (listed.withColumn("__rank", rank).filter(F.col("__rank") <= F.col("__open"))
           .groupBy(*key).agg(F.count(F.lit(1)).alias("__won")))
    return (df.join(won, key, "left").withColumn(out, F.col("__low") + F.coalesce("__won", F.lit(0)))
            .drop("__share", "__slack", "__low", "__high", "__open", "__won"))


def _blocks(size: Column) -> Column:
    return F.when(size > 0, F.greatest(F.lit(1), F.floor((size * 2 + BLOCK) / (2 * BLOCK)))).otherwise(0).cast("long")


def cell_quotas(sized: DataFrame) -> DataFrame:
    """One row per (source, shard): words, blocks and quota, with the source's size and target."""
    cell = ["__nul", "__src", "__shard"]
    cells = sized.groupBy(*cell).agg(F.sum("__size").alias("__tok"))
    cells = cells.withColumn("__n", _blocks(F.col("__tok")))
    sources = cells.groupBy("__nul", "__src").agg(
        F.sum("__tok").alias("source_size"), F.sum("__n").alias("__all"))
    sources = targets(sources, "source_size")
    sources = sources.withColumns({
        "__v": F.when(F.col("source_size") > 0,
                      F.col("target") * F.col("__all") / F.col("source_size")).otherwise(0.0),
        "__most": F.col("__all") * MAX_EPOCHS})
    sources = sources.withColumn("__seats", F.round(F.sum("__v").over(Window.partitionBy())).cast("long"))
    sources = sainte_lague(sources, [], ["__nul", "__src"], "__v", "__most", "__seats", "__quota")
    cells = cells.join(sources.select("__nul", "__src", "source_size", "target", "__quota"), ["__nul", "__src"])
    cells = cells.withColumn("__most", F.col("__n") * MAX_EPOCHS)
    return sainte_lague(cells, ["__nul", "__src"], cell, "__n", "__most", "__quota", "__q").select(
        *cell, "source_size", "target", "__tok", "__n", "__q")


def _placed(keyed: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds ``__parts``: (first word, end, times) of each run of the document that a block covers."""
    cell = ["__nul", "__src", "__shard"]
    run = Window.partitionBy(*cell).orderBy("__h", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    df = keyed.withColumn("__end", F.sum("__size").over(run)).join(cells, cell)
    n, tok, q = F.col("__n"), F.col("__tok"), F.col("__q")
    start, end = F.col("__end") - F.col("__size"), F.col("__end")
    offset = F.conv(F.substring(_hash(F.col("__src"), F.col("__nul").cast("string"), F.col("__shard").cast("string")), 1, 7),
                    16, 10).cast("long")
    df = df.withColumns({"__start": start, "__off": offset, "__passes": F.floor(q / n).cast("long"), "__rest": q % n,
                         "__b0": F.floor(start * n / tok).cast("long"), "__b1": F.floor((end - 1) * n / tok).cast("long")})

    def part(b: Column) -> Column:
        first = F.floor((b * tok + n - 1) / n)
        last = F.floor(((b + 1) * tok + n - 1) / n)
        chosen = (b * F.lit(_STEP) + F.col("__off")) % n < F.col("__rest")
        return F.struct(
            (F.greatest(first, F.col("__start")) - F.col("__start")).cast("long").alias("from"),
            (F.least(last, F.col("__end")) - F.col("__start")).cast("long").alias("to"),
            (F.col("__passes") + chosen.cast("long")).alias("times"))

    parts = F.transform(F.sequence("__b0", "__b1"), part)
    return df.withColumn("__parts", F.when(F.col("__size") > 0, parts))


def _shards(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_SHARD))


def _prepared(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, int]:
    sizes = saved(docs.select("doc_id", "source", _size(F.col(text)).alias("n_words")), "mix-sizes")
    shards = _shards(sizes.count())
    sized = _keyed(sizes, shards, F.col("n_words"))
    return sized, saved(cell_quotas(sized), "mix-cells"), shards


def mix_plan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and taken (words, repeats counted).

    The texts are read once, into sizes that are saved in the shared folder.
    """
    sized, cells, _ = _prepared(docs, text)
    taken = F.aggregate("__parts", F.lit(0).cast("long"), lambda z, p: z + (p["to"] - p["from"]) * p["times"])
    return _placed(sized, cells).select(
        "doc_id", "source", F.col("__size").alias("size"), "source_size", "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The mix itself, in the input's columns: one row per pass over a document that takes any of
    its words. A pass that takes all words keeps the text as it is; a pass that takes some joins
    those words by single spaces."""
    _, cells, shards = _prepared(docs, text)
    df = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), text=F.col(f"`{text}`"))
    df = _placed(_keyed(df, shards, _size(F.col("text"))), cells)
    df = df.withColumn("__pass", F.explode(F.array(*[F.lit(i) for i in range(1, MAX_EPOCHS + 1)])))
    mine = F.filter("__parts", lambda p: p["times"] >= F.col("__pass"))
    # the row number keeps the filter above the projections, whose expressions it would repeat
    df = df.withColumn("__mine", mine).withColumn("__n", F.monotonically_increasing_id())
    df = df.filter((F.size("__mine") > 0) & (F.col("__n") >= 0))
    df = df.withColumn("__w", words(F.col("text")))
    some = F.array_join(F.flatten(F.transform(
        "__mine", lambda p: F.slice(F.col("__w"), (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")))), " ")
    df = df.withColumn("__some", F.when(F.size("__mine") == F.size("__parts"), F.col("text")).otherwise(some))
    changed = {text: F.col("__some")}
    if n_chars in docs.columns:
        changed[n_chars] = F.length("__some").cast(docs.schema[n_chars].dataType)
    return unpacked(df, docs.columns, **changed)


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix_plan(docs.select("doc_id", "source", "text")).drop("source")


ORACLE = rf"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, source IS NULL AS nul, coalesce(source, '') AS src,
  len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
  md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
sh AS (SELECT greatest(1, (count(*) + {ROWS_PER_SHARD} - 1) // {ROWS_PER_SHARD}) AS shards FROM t),
k AS (SELECT t.*, ('0x' || substr(h, 1, 8))::BIGINT % shards AS shard FROM t, sh),
c0 AS (SELECT nul, src, shard, sum(size)::BIGINT AS tok FROM k GROUP BY ALL),
c AS (SELECT *, CASE WHEN tok > 0 THEN greatest(1, (tok * 2 + {BLOCK}) // (2 * {BLOCK})) ELSE 0 END AS n FROM c0),
s0 AS (SELECT nul, src, sum(tok)::BIGINT AS source_size, sum(n)::BIGINT AS nn FROM c GROUP BY ALL),
s1 AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY nul, src) - 1) % {len(WEIGHTS)}] AS w FROM s0),
s2 AS (SELECT *, {MAX_EPOCHS} * source_size / w AS r,
  coalesce(sum({MAX_EPOCHS} * source_size) OVER (ORDER BY {MAX_EPOCHS} * source_size / w, nul, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
  sum(w) OVER (ORDER BY {MAX_EPOCHS} * source_size / w, nul, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl,
  sum(source_size) OVER () * {BUDGET_PCT / 100}::DOUBLE AS budget FROM s1),
s3 AS (SELECT *, r <= (budget - cb) / wl AS full_ FROM s2),
s4 AS (SELECT *, (budget - sum(CASE WHEN full_ THEN {MAX_EPOCHS} * source_size ELSE 0 END) OVER ())
  / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (), 0) AS lam FROM s3),
s5 AS (SELECT nul, src, source_size, nn, CASE WHEN full_ THEN ({MAX_EPOCHS} * source_size)::DOUBLE ELSE w * lam END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target * nn / source_size ELSE 0 END AS v FROM s5),
seats AS (SELECT round(sum(v))::BIGINT AS seats FROM s6),
q0 AS (SELECT nul, src, row_number() OVER (ORDER BY v / (2 * kk - 1) DESC, nul, src, kk) AS rk
  FROM (SELECT *, unnest(range(1, {MAX_EPOCHS} * nn + 1)) AS kk FROM s6)),
q AS (SELECT s6.nul, s6.src, source_size, target, count(q0.src) AS quota FROM s6 CROSS JOIN seats
  LEFT JOIN q0 ON q0.nul = s6.nul AND q0.src = s6.src AND rk <= seats GROUP BY ALL),
cq0 AS (SELECT c.*, source_size, target, quota FROM c JOIN q ON c.nul = q.nul AND c.src = q.src),
cq1 AS (SELECT nul, src, shard, quota, row_number() OVER (PARTITION BY nul, src ORDER BY n / (2 * kk - 1) DESC, shard, kk) AS rk
  FROM (SELECT *, unnest(range(1, {MAX_EPOCHS} * n + 1)) AS kk FROM cq0)),
cq AS (SELECT cq0.nul, cq0.src, cq0.shard, tok, n, source_size, target, count(cq1.src) AS q FROM cq0
  LEFT JOIN cq1 ON cq1.nul = cq0.nul AND cq1.src = cq0.src AND cq1.shard = cq0.shard AND rk <= cq1.quota GROUP BY ALL),
p AS (SELECT doc_id, size, source_size, target, tok, n, q,
  ('0x' || substr(md5('{SEED}|' || cq.src || '|' || cq.nul::VARCHAR || '|' || cq.shard::VARCHAR), 1, 7))::BIGINT AS off,
  (sum(size) OVER (PARTITION BY k.nul, k.src, k.shard ORDER BY h, doc_id, size, rid ROWS UNBOUNDED PRECEDING))::BIGINT AS e
  FROM k JOIN cq ON k.nul = cq.nul AND k.src = cq.src AND k.shard = cq.shard)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  list_sum(list_transform(range(((e - size) * n // tok)::BIGINT, ((e - 1) * n // tok + 1)::BIGINT), lambda b:
    (least(((b + 1) * tok + n - 1) // n, e) - greatest((b * tok + n - 1) // n, e - size))
    * (q // n + CASE WHEN (b * {_STEP} + off) % n < q % n THEN 1 ELSE 0 END)))::BIGINT END AS taken FROM p
"""

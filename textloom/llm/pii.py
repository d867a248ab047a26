"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Base rules find emails, IP addresses, payment cards and phone numbers. These
are the seed entities. Their surrounding words induce lexical patterns (one or
two words to the left, one to the right, one on either side). Identifier-like
tokens that no base rule took are further instances of the pattern-instance
graph. In each round a pattern's confidence is the share of trusted values
among the distinct values it occurs with, an instance's score is the noisy-or
of its confident patterns, and instances above the bar become trusted. Trusted
instances are added as spans of the kind their shape suggests.

Every text is read once; what is kept of it (spans, candidate tokens, context
words) is saved in the shared folder, and the graph works on that. Values and
patterns are deduplicated by partial aggregates before any join, so a frequent
value or context is one row per task.

Defined results: a null text is empty and has no spans; a null doc_id is kept;
repeated rows each get the spans; an empty table gives an empty table; other
columns are ignored. Positions are code points, end exclusive. In a text, c candidate tokens
are compared with b base spans in c * b steps; all else is linear.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WS, saved

KINDS = ("email", "ip", "card", "phone")
# The patterns accept what the plain ones accept. Possessive runs and anchors to the start of a run
# keep them linear and free of recursion; \G continues right after the match before.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
CONTEXT = 80               # characters looked at on either side
ROUNDS = 3
MIN_SUPPORT = 4            # distinct trusted values of a pattern
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.9


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """True if the digit string passes the Luhn check."""
    rev = F.reverse(digits)
    doubled = F.translate(rev, "0123456789", "0246813579")
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda z, i: z + F.when(
        i % 2 == 1, F.substring(rev, i, 1)).otherwise(F.substring(doubled, i, 1)).cast("int"))
    return total % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    n = F.length(_digits(v))
    return {"email": F.lit(True), "ip": v.rlike(_OCTETS), "phone": n.between(8, 15),
            "card": F.when(n.between(16, 19), luhn(_digits(v))).otherwise(False)}[kind]


RUN = 256                  # lengths summed at once


def _scanned(df: DataFrame, patterns: dict[str, tuple[Column, str]]) -> DataFrame:
    """For each name, from (condition, pattern): ``m_`` matches, ``g_`` gaps before, between and after
    them, ``e_`` their end positions. Positions are running sums of lengths, summed in runs of RUN,
    so a text with many matches costs time in proportion to them. Every step is a column that the
    next one uses more than once, so that it is computed once."""
    t, ks = F.col("__t"), list(patterns)
    none = lambda kind: F.array().cast(f"array<{kind}>")
    add = lambda z, x: z + x
    df = df.withColumns({f"m_{k}": F.when(c, F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none("string"))
                         for k, (c, p) in patterns.items()})
    df = df.withColumns({f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.split(t, p, -1)).otherwise(none("string"))
                         for k, (_, p) in patterns.items()})
    df = df.withColumns({f"d_{k}": F.zip_with(F.slice(f"g_{k}", 1, F.size(f"m_{k}")), f"m_{k}",
                                              lambda g, m: F.length(g) + F.length(m)) for k in ks})
    run = lambda d: F.transform(F.sequence(F.lit(0), F.floor((F.size(d) - 1) / RUN).cast("int")),
                                lambda c: F.slice(d, c * RUN + 1, RUN))
    df = df.withColumns({f"r_{k}": F.when(F.size(f"d_{k}") > 0, run(F.col(f"d_{k}"))).otherwise(none("array<int>")) for k in ks})
    df = df.withColumns({f"s_{k}": F.transform(f"r_{k}", lambda r: F.aggregate(r, F.lit(0), add)) for k in ks})
    before = lambda s: F.transform(F.sequence(F.lit(0), F.size(s) - 1),
                                   lambda c: F.aggregate(F.slice(s, 1, c), F.lit(0), add))
    df = df.withColumns({f"o_{k}": F.when(F.size(f"s_{k}") > 0, before(F.col(f"s_{k}"))).otherwise(none("int")) for k in ks})
    return df.withColumns({f"e_{k}": F.flatten(F.zip_with(f"r_{k}", f"o_{k}", lambda r, o: F.transform(
        r, lambda _, i: o + F.aggregate(F.slice(r, 1, i + 1), F.lit(0), add)))) for k in ks})


def _hits(k: str) -> Column:
    """(start, end, value, left and right context) of the matches of ``k``. Contexts are cut from the
    gaps and matches around."""
    m, g = F.col(f"m_{k}"), F.col(f"g_{k}")
    text = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
    left = lambda i: F.right(F.concat(F.right(text(m, i - 2), F.lit(CONTEXT)), F.right(text(g, i - 1), F.lit(CONTEXT)),
                                      F.right(text(m, i - 1), F.lit(CONTEXT)), F.right(text(g, i), F.lit(CONTEXT))), F.lit(CONTEXT))
    right = lambda i: F.left(F.concat(F.left(text(g, i + 1), F.lit(CONTEXT)), F.left(text(m, i + 1), F.lit(CONTEXT)),
                                      F.left(text(g, i + 2), F.lit(CONTEXT))), F.lit(CONTEXT))
    return F.transform(F.arrays_zip(m.alias("v"), F.col(f"e_{k}").alias("e")), lambda x, i: F.struct(
        (x["e"] - F.length(x["v"])).alias("start"), x["e"].alias("end"), x["v"].alias("value"),
        left(i).alias("left"), right(i).alias("right")))


_WIDE = "array<struct<kind:string,start:int,end:int,value:string,left:string,right:string>>"


def _base(kind: str) -> Column:
    return F.transform(F.filter(_hits(kind), lambda x: _valid(kind, x["value"])), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["start"], x["end"], x["value"], x["left"], x["right"])).cast(_WIDE)


def _candidates() -> Column:
    """Identifier-like tokens (outer punctuation off) with the kind their shape suggests."""
    tail = lambda v: F.regexp_replace(v, r"^[(\[{<\"'=:]+", "")
    core = lambda v: F.regexp_replace(tail(v), r"[)\]}>\"',.;:!?]+$", "")
    cores = F.transform(_hits("token"), lambda x: F.struct(
        (x["end"] - F.length(tail(x["value"]))).alias("start"), core(x["value"]).alias("value"), x["left"], x["right"]))

    def kind(v: Column) -> Column:
        n = F.length(_digits(v))
        return (F.when(v.rlike(r"^[^@]+@[^@]+$") | v.rlike(r"(?i)^[a-z0-9._%+-]+[\[(]at[\])][a-z0-9.-]+$"), "email")
                .when(v.rlike(r"^[0-9]+(\.[0-9]+){3}$") | v.rlike(r"^[0-9a-fA-F]{1,4}(:[0-9a-fA-F]{0,4}){2,7}$"), "ip")
                .when(v.rlike(r"^[0-9][0-9-]*[0-9]$") & n.between(12, 19), "card")
                .when(v.rlike(r"^[(]?[0-9][0-9().-]*[0-9]$") & n.between(7, 11), "phone"))

    spans = F.transform(cores, lambda x: F.struct(
        kind(x["value"]).alias("kind"), x["start"], (x["start"] + F.length(x["value"])).alias("end"), x["value"],
        x["left"], x["right"]))
    return F.filter(spans, lambda s: s["kind"].isNotNull()).cast(_WIDE)


def _word(w: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(w, r"^[\p{Punct}]+|[\p{Punct}]+$", "")), "[0-9]+", "0")


def _patterns(span: Column) -> Column:
    """The lexical patterns around a span."""
    cut = lambda c: F.split(F.btrim(c, F.lit(" \t\n\x0b\x0c\r")), WS + "+")
    before, after = cut(span["left"]), cut(span["right"])
    one = _word(F.element_at(before, -1))
    two = F.when(F.size(before) > 1, _word(F.get(before, F.size(before) - 2))).otherwise("")
    right = _word(F.get(after, F.lit(0)))
    both = [F.when(one != "", F.concat(F.lit("L:"), one)),
            F.when((one != "") & (two != ""), F.concat_ws(" ", F.lit("LL:"), two, one)),
            F.when(right != "", F.concat(F.lit("R:"), right)),
            F.when((one != "") & (right != ""), F.concat_ws(" ", F.lit("LR:"), one, right))]
    return F.filter(F.array(*both), lambda p: p.isNotNull())


def found_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: its key, base spans, and instances (base spans and candidates) with patterns."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select("doc_id", F.xxhash64(t).alias("text_hash"), t.alias("__t"))
    may = {"email": F.col("__t").contains("@"), "phone": F.col("__t").contains("+"), "ip": F.col("__t").rlike("[0-9]"),
           "card": F.col("__t").rlike("[0-9]"), "token": F.col("__t").rlike("[0-9@]")}
    df = _scanned(df, {k: (c, PATTERNS.get(k, TOKEN)) for k, c in may.items()})
    df = df.withColumn("__b", F.concat(*[_base(k) for k in KINDS])).withColumn("__c", _candidates())
    free = F.filter("__c", lambda c: ~F.exists("__b", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    df = df.withColumn("__f", F.when(F.size("__b") > 0, free).otherwise(F.col("__c")))
    span = lambda x: F.struct(x["kind"], x["start"], x["end"], x["value"])
    tag = lambda known: lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        F.lower(x["value"]).alias("value"), F.lit(known).alias("seed"), _patterns(x).alias("patterns"))
    return df.select("doc_id", "text_hash", F.transform("__b", span).cast(_SPAN).alias("base"), F.concat(
        F.transform("__b", tag(True)), F.transform("__f", tag(False))).alias("instances"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The (kind, value) pairs that patterns reveal. ``edges``: kind, value, seed, pattern."""
    edges = saved(edges.groupBy("kind", "value", "pattern").agg(F.max("seed").alias("seed")), "pii-edges")
    known = edges.filter("seed").select("kind", "value").distinct()
    for _ in range(rounds):
        marked = edges.join(known.withColumn("known", F.lit(True)), ["kind", "value"], "left")
        good = (marked.groupBy("kind", "pattern")
                .agg(F.count("known").alias("trusted"), F.count(F.lit(1)).alias("all"))
                .withColumn("confidence", F.col("trusted") / (F.col("all") + 1))
                .filter((F.col("trusted") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE)))
        doubt = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        new = (marked.filter("known IS NULL").join(good.select("kind", "pattern", "confidence"), ["kind", "pattern"])
               .groupBy("kind", "value").agg((1 - doubt).alias("score"))
               .filter(F.col("score") >= MIN_SCORE).select("kind", "value"))
        known = saved(known.union(new), "pii-known")
    return known.join(edges.filter("seed").select("kind", "value").distinct(), ["kind", "value"], "left_anti")


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, ``base`` and ``added`` spans (kind, start, end, value)."""
    found = saved(found_spans(docs, text), "pii-found")
    each = found.select("doc_id", "text_hash", F.explode("instances").alias("i"))
    edges = each.select("i.kind", "i.value", "i.seed", F.explode("i.patterns").alias("pattern"))
    new = bootstrap(edges)
    added = (each.filter("NOT i.seed").select("doc_id", "text_hash", "i.kind", "i.start", "i.end", "i.value")
             .join(new, ["kind", "value"]).distinct()
             .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("kind", "start", "end", "value")).alias("added")))
    a, b = found.alias("a"), added.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    return a.join(b, same, "left").select(
        "a.doc_id", "a.base", F.coalesce("b.added", F.array()).cast(_SPAN).alias("added"))


def _rank(kind: Column) -> Column:
    return reduce(lambda c, k: c.when(kind == k[1], k[0]), enumerate(KINDS), F.when(F.lit(False), -1))


def _joined(spans: Column) -> Column:
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        _rank(s["kind"]).alias("r"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", s["k"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    df = pii_spans(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))

"""Keyword tables against a plain loop over the list."""

import random

from textloom.operators import catalog, keywords

from conftest import rows

DOCS = "i long, t string"
KEYS = "keyword string, command string, pos long"


def _first(text, table):
    low = None if text is None else text.lower()
    for kw, cmd, _ in sorted((k for k in table if k[0] is not None), key=lambda k: (k[2], k[1])):
        if low is not None and kw.lower() in low:
            return cmd, 0.5
    return "None", 0.0


def _check(spark, texts, table):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = keywords.keyword_table_fallback(docs, "t", spark.createDataFrame(table, KEYS), default="None").select("i", "command", "score")
    assert rows(got) == sorted((i, *_first(t, table)) for i, t in enumerate(texts))


def test_list_order_lengths_and_nulls(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc \n") for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [None, "", "A", "\U0001f600xéY", texts[0], texts[0].upper()]
    table = [("".join(rng.choice("aBc ") for _ in range(rng.randrange(1, 10))), f"k{i}", rng.randrange(60)) for i in range(80)]
    table += [(None, "null", -1), ("\U0001f600X", "sign", -2), ("Éy", "accent", -3), table[0], ("%_.*", "literal", -4)]
    _check(spark, texts, table)


def test_the_empty_keyword_is_in_every_text(spark):
    _check(spark, ["a", "", None, "zz"], [("", "all", 5), ("zz", "z", 1), ("a", "late", 9)])


def test_no_keywords_and_no_rows(spark):
    _check(spark, ["a", None], [])
    docs = spark.createDataFrame([], DOCS)
    assert keywords.keyword_table_fallback(docs, "t", spark.createDataFrame([("a", "b", 1)], KEYS)).count() == 0


def test_a_short_table_is_the_folded_list(spark):
    table = [("net", "n", 0), ("mit", "m", 1), ("ip", "i", 2)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Ship it", "permit", "the NET", "", "x"])], DOCS)
    a = keywords.keyword_table_fallback(docs, "t", spark.createDataFrame(table, KEYS))
    assert rows(a) == rows(catalog.keyword_fallback(docs, "t", [(k, c) for k, c, _ in table]))


def test_a_hundred_thousand_keywords(spark):
    table = spark.range(100_000).selectExpr("concat('key', lpad(cast(id * 7919 % 100000 AS string), 5, '0')) AS keyword",
                                            "concat('c', cast(id AS string)) AS command", "id AS pos")
    docs = spark.createDataFrame([(i, f"say KEY{i * 137 % 100_000:05d}, then key{(i * 31 + 5) % 100_000:05d}.") for i in range(300)], DOCS)
    got = {r.i: r.command for r in keywords.keyword_table_fallback(docs, "t", table).collect()}
    place = {p * 7919 % 100_000: p for p in range(100_000)}
    assert got == {i: f"c{min(place[i * 137 % 100_000], place[(i * 31 + 5) % 100_000])}" for i in range(300)}


def test_only_grams_that_keywords_wait_for_are_moved(spark):
    texts = spark.createDataFrame([("a", "the network is down, the license too"), ("b", "x" * 5_000), ("c", "")], "_k string, _text string")
    kw = keywords.prepared(spark.createDataFrame([("network", "n", 1), ("license too", "l", 0)], KEYS), "keyword", "command", "pos")
    grams = keywords._keyword_grams(kw)
    assert grams.count() == 3 + 4                       # network by 5 bytes, the other by 8
    held = keywords._held_grams(texts, grams, [5, 8])
    assert held.join(grams, "_gram").count() == 7 and held.count() <= 9
    assert keywords._gram_counts(texts, grams, [5, 8]).join(grams, "_gram").count() == 7


def test_keywords_in_rounds(spark, monkeypatch):
    """Texts are asked for few keywords at a time, in list order; a text with a hit is not asked for more."""
    monkeypatch.setattr(keywords, "FIRST_KEYWORDS", 3)
    monkeypatch.setattr(keywords, "GROWTH", 2)
    seen, held = [], keywords._held_grams
    monkeypatch.setattr(keywords, "_held_grams", lambda t, a, s: (seen.append((t.count(), a.count())), held(t, a, s))[1])
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=6)) for _ in range(60)] + ["omega", "none of them"]
    table = [("alpha", "a", 1), ("beta", "b", 2), ("gamma", "c", 3), ("gamma d", "e", 5), ("omega", "o", 30)]
    table += [(f"alpha {w}", w, 10 + i) for i, w in enumerate(["beta", "gamma", "delta"])] + [("delta", "d", 4), ("delta", "x", 0)]
    _check(spark, texts, table)
    assert len(seen) > 1 and seen[0][1] == 3 and seen[1][0] < seen[0][0]

"""Cases in which an operator once did less than the whole job."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.llm import decontam, langid, neardup, warc
from textloom.llm.common import hashed_texts, read

SF_SMALL = "/root/testdata/sf0.001"


def _lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        prev = 0
        for j, b in enumerate(y, 1):
            prev, row[j] = row[j], prev + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_decontamination_of_a_large_benchmark(spark):
    """2,000 items of 8 to 60 words cut from the documents, a fifth of the words of every third changed."""
    rng = random.Random(5)
    docs = read(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = {r.doc_id: [w.decode() for w in r.text.encode().lower().split()] for r in docs.collect()}
    long = sorted(i for i, w in texts.items() if len(w) >= 60)
    items, home = [], {}
    for k in range(2000):
        doc, n = rng.choice(long), rng.randint(8, 60)
        at = rng.randint(0, len(texts[doc]) - n)
        words = texts[doc][at:at + n]
        if k % 3 == 0:
            for j in rng.sample(range(n), n // 5):
                words[j] = f"changed{j}"
            assert _lcs(words, texts[doc][at:at + n]) >= 0.8 * n
        items.append((k, " ".join(words)))
        home[k] = doc
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontam.contamination(docs, bench).select("row.doc_id", F.explode("hits.item_id").alias("item"))
    found = {(r.doc_id, r.item) for r in hits.collect()}
    missed = [k for k, doc in home.items() if (doc, k) not in found]
    assert not missed, f"{len(missed)} of {len(home)} items are not found in the document they were cut from"


RECORDS = "record_id long, type string, url string, time long, headers map<string,string>, digest string, payload string"


def test_records_with_null_and_repeated_ids(spark):
    rows = [(None, "response", "http://a.org/", 1, {"ETag": "x"}, None, "one"),
            (None, "response", "http://b.org/", 2, {"ETag": "y"}, None, "two"),
            (None, "revisit", "https://www.a.org", 5, {"etag": "x"}, None, None),
            (7, "response", "http://c.org/", 1, {"ETag": "p"}, None, "three"),
            (7, "response", "http://d.org/", 1, {"ETag": "q"}, None, "four"),
            (7, "revisit", "http://d.org/", 3, {"etag": "q"}, None, None),
            (7, "revisit", "http://d.org/", 3, {"etag": "q"}, None, None)]
    got = warc.resolve(spark.createDataFrame(rows, RECORDS))
    assert sorted((r.key, r.time, r.status, r.payload) for r in got.collect()) == [
        ("a.org", 1, "full", "one"), ("a.org", 5, "resolved", "one"), ("b.org", 2, "full", "two"),
        ("c.org", 1, "full", "three"), ("d.org", 1, "full", "four"), ("d.org", 3, "resolved", "four")]


def test_revisits_of_variants_over_many_slices(spark, monkeypatch):
    """Bases that are not the record before: captures far apart, URL variants, one URL with a third of the records."""
    monkeypatch.setattr(warc, "RECORDS_PER_SLICE", 7)
    rng = random.Random(3)
    forms = ["http://{}/", "https://www.{}", "HTTP://m.{}:80/#x", "https://{}/?utm_source=q"]
    rows, keys = [], {}
    for i in range(600):
        host = "hot.org" if i % 3 == 0 else f"h{rng.randrange(60)}.org"
        kind = "response" if rng.random() < 0.2 else "revisit"
        tag = rng.choice("uv")
        rows.append((i, kind, rng.choice(forms).format(host), rng.randrange(400), {"ETag": tag}, None, f"p{i}" if kind == "response" else None))
        keys[i] = host
    base = {}
    for i, kind, _, time, headers, _, payload in rows:
        earlier = [(r[3], r[0]) for r in rows if r[1] == "response" and keys[r[0]] == keys[i] and r[3] < time]
        b = max(earlier)[1] if earlier else None
        same = b is not None and rows[b][4] == headers
        base[i] = (None, "full", payload) if kind == "response" else (
            b, "missing" if b is None else "resolved" if same else "mismatch", rows[b][6] if same else None)
    got = {r.record_id: (r.base_id, r.status, r.payload) for r in warc.resolve(spark.createDataFrame(rows, RECORDS)).collect()}
    assert got == base
    assert sum(b is not None and b != i - 1 for i, (b, _, _) in base.items()) > 200
    assert {s for _, s, _ in base.values()} == {"full", "missing", "resolved", "mismatch"}


def test_one_document_of_each_group_whatever_its_id(spark):
    rng = random.Random(9)

    def near(w):
        return [*w[:60], "other", *w[61:]]

    a, b, c, d = ([f"{x}{rng.randrange(10**6)}" for _ in range(120)] for x in "abcd")
    rows = [(None, a, "x"), (None, near(a), "x"), (1, b, "x"), (None, near(b), "x"), (2, c, "x"), (2, c, "y"),
            (3, d, "x"), (2, near(d), "x"), (3, ["lone"], "x"), (None, [], "x"), (None, [], "x"), (4, None, "z")]
    docs = spark.createDataFrame([(i, None if w is None else " ".join(w), s) for i, w, s in rows], "doc_id long, text string, source string")
    got = [(r.doc_id, r.text, r.source) for r in neardup.deduplicated(docs).collect()]
    of = [sum(t in (" ".join(w), " ".join(near(w))) for _, t, _ in got) for w in (a, b, c, d)]
    assert of == [1, 1, 1, 1]
    assert len(got) == 7 and {(1, " ".join(b), "x"), (2, " ".join(near(d)), "x"), (3, "lone", "x"), (None, "", "x"),
                              (4, None, "z")} < set(got)


def test_every_letter_has_a_language(spark):
    tifinagh = "\u2d30\u2d4e\u2d30\u2d63\u2d49\u2d56 \u2d30\u2d3d\u2d30\u2d4d"
    learn = read(spark, SF_SMALL, "documents").select("doc_id", "text", "lang").union(
        spark.createDataFrame([(10**6 + i, tifinagh * (1 + i % 3), "zgh") for i in range(40)], "doc_id long, text string, lang string"))
    model = langid.fit(learn)
    assert "zgh" in model["langs"]
    letters = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c))[0] == "L"]
    some = [c for c in letters if chr(c).encode()[0] in langid.DECODED][::7] + letters[::101]
    docs = spark.createDataFrame([(c, f"12 {chr(c)}{chr(c)} 3") for c in some] + [(-1, "\u201c12\u201d \U0001f600 \u2014"),
                                 (-2, tifinagh)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs.filter(F.col("text").rlike(r"\p{L}")), model).collect()}
    assert len(got) > 0.9 * len(some) and "und" not in got.values()
    assert got[-2] == "zgh" and -1 not in got
    assert langid.identify(docs.filter("doc_id = -1"), model).first().spans == []


def test_directions_of_the_benchmark_come_to_the_driver_as_narrow_rows(spark, monkeypatch):
    """They span all passages' rows, and no result of the fit has a column for each direction."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 120, n)) for n in (5, 16, 17, 60, 100, 33)] * 3 + [None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string").repartition(4)
    flat = [(h, offs) for _, _, h, offs in hashed_texts(pa.array(texts[:6], pa.string()))]
    live = np.unique(np.concatenate([decontam._bucket(h) for h, _ in flat]))
    idf = np.zeros(decontam.BUCKETS)
    idf[live] = rng.uniform(0.5, 3, len(live))
    widths = []
    for name in ("toPandas", "toArrow", "collect"):
        def spied(self, f=getattr(type(bench), name)):
            widths.append(len(self.columns))
            return f(self)
        monkeypatch.setattr(type(bench), name, spied)
    v = decontam.randomized_svd(bench.select("text"), "text", idf)
    assert widths and max(widths) <= 2
    rows = []
    for h, offs in flat:
        for words in (decontam._bucket(h[a:z]) for a, z in zip(offs[:-1], offs[1:], strict=True)):
            steps = [words[i:i + decontam.STEP] for i in range(0, len(words), decontam.STEP)]
            for passage in [np.r_[a, b] for a, b in zip(steps[:-1], steps[1:], strict=True)] or steps:
                rows.append(np.bincount(np.searchsorted(live, passage), minlength=len(live)) * idf[live])
    rows = np.array(rows)
    assert v.shape == (len(live), np.linalg.matrix_rank(rows))
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-6 and np.abs(rows - rows @ v @ v.T).max() < 1e-3

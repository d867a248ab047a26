"""The fitted projection encoder: vectors against a plain loop, save and load, edge cases."""

import hashlib
import math
import re

import numpy as np

from textloom.operators import projection
from textloom.session import shared_path

TEXTS = ["the cat sat", "The dog sat sat", None, "", "zebra quagga", "a b c", "cat dog zebra the the"]


def _vector(text, idf, dims):
    v = np.zeros(dims)
    for w in re.findall(r"\w{2,}", (text or "").lower()):
        h = hashlib.md5(w.encode()).hexdigest()
        for p in range(4):
            x = int(h[4 + 7 * p:11 + 7 * p], 16)
            v[(x >> 1) % dims] += (-1 if x % 2 else 1) * idf[int(h[:4], 16)]
    n = np.linalg.norm(v)
    return v / n if n else v


def _loaded(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    path = projection.save_projection(projection.fit_projection(docs, "t"), shared_path(spark, "projection"))
    return docs, projection.load_projection(spark, path)


def test_vectors_and_idf(spark):
    docs, idf = _loaded(spark, TEXTS)
    df = {}
    for t in TEXTS:
        for b in {int(hashlib.md5(w.encode()).hexdigest()[:4], 16) for w in re.findall(r"\w{2,}", (t or "").lower())}:
            df[b] = df.get(b, 0) + 1
    want = np.array([math.log((1 + len(TEXTS)) / (1 + df.get(b, 0))) + 1 for b in range(projection.BUCKETS)])
    assert np.allclose(idf, want, atol=1e-12)
    got = {r.i: r.embedding for r in projection.project(docs, "i", "t", idf, 32).collect()}
    assert sorted(got) == list(range(len(TEXTS)))
    for i, t in enumerate(TEXTS):
        assert np.allclose(got[i], _vector(t, want, 32), atol=1e-12)
    assert not any(got[2]) and not any(got[3]) and not any(got[5])


def test_dot_products_follow_shared_words(spark):
    base = " ".join(f"word{i}" for i in range(60))
    half = " ".join(f"word{i}" for i in range(30)) + " " + " ".join(f"other{i}" for i in range(30))
    docs, idf = _loaded(spark, [base, half, " ".join(f"far{i}" for i in range(60))])
    v = {r.i: np.array(r.embedding) for r in projection.project(docs, "i", "t", idf, 4_096).collect()}
    assert v[0] @ v[0] > 0.999 and 0.25 < v[0] @ v[1] < 0.65 and abs(v[0] @ v[2]) < 0.15


def test_an_empty_fit(spark):
    docs, idf = _loaded(spark, [])
    assert np.allclose(idf, 1.0) and projection.project(docs, "i", "t", idf).count() == 0

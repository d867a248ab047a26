"""Prefix trie, n-gram join and run detection against SQL and brute force, with edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import groupjoin, prefixtrie, wordruns
from textloom.llm.common import text_pieces

from conftest import rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ---- runs of words -------------------------------------------------------------------------------

def _runs(w):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            smaller = any(all(w[x] == w[x + r] for x in range(s, s + size - r)) for r in range(1, q))
            if size >= max(12, 2 * q) and not smaller:
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _row(w):
    found = _runs(w)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in found), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def _texts():
    random.seed(11)
    out = []
    for _ in range(250):
        letters = random.choice(["a", "ab", "abc", "abcdefghij"])
        w = [random.choice(letters) * random.randint(1, 2) for _ in range(random.randint(0, 80))]
        if random.random() < .5 and len(w) > 4:
            a = random.randrange(len(w))
            p = random.randint(1, max(1, (len(w) - a) // 2))
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        out.append(random.choice(["", " ", "\n"]) + random.choice([" ", "\t\n ", "  "]).join(w) + random.choice(["", " "]))
    fib, thue = ["a", "ab"], "a"
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    while len(thue) < 512:
        thue += "".join("ba"[c == "b"] for c in thue)
    return [*out, " ".join(fib[-1]), " ".join(thue), None, "", " \n", "x", "é é é é é é é é é é é é", *["a b c d " * 9] * 3]


def test_runs_equal_brute_force(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id long, text string, n_runs string")
    got = {r[0]: tuple(r)[1:] for r in wordruns.word_runs(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _row(WORDS.findall(t or "")), (i, t)


def test_runs_of_a_long_text_and_null_ids(spark):
    long = "w" + " a b" * 40_000 + " " + " ".join(str(i) for i in range(700_000))
    df = spark.createDataFrame([(None, long), (None, long), (3, "a " * 20)], "doc_id long, text string")
    got = rows(wordruns.word_runs(df).select(F.coalesce("doc_id", F.lit(-1)), "n_runs", "start", "length", "period"))
    assert got == [(-1, 1, 1, 80_000, 2)] * 2 + [(3, 1, 0, 20, 1)]
    assert wordruns.word_runs(df.limit(0)).count() == 0


def test_runs_query_repeats_words_as_stated(spark):
    random.seed(2)
    docs = [(i, " ".join(random.choice("abcdefgh") + str(k) for k in range(random.randint(0, 60)))) for i in range(300)]
    docs += [(1000, None), (1001, " ")]
    got = {r[0]: tuple(r)[1:] for r in wordruns.runs_digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        w, h = WORDS.findall(t or ""), zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
        assert got[i] == _row(w), i


def test_marks_between_texts_stop_runs():
    pieces = list(text_pieces(pa.array(["a b " * 5, "a b " * 5])))
    assert [r[0] for _, _, buf, offs in pieces for r in wordruns._piece(buf, offs)] == [0, 0]


# ---- prefix trie ---------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string"


def _conversations():
    random.seed(5)
    out = []
    for c in [*range(100), None]:
        for k in range(random.choice([0, 1, 3, 8, 12, 30])):
            role = random.choice(["user", "a", None]) if random.random() < .3 else "user"
            text = random.choice(["x", "yé", None]) if random.random() < .2 else "h"
            out.append((c, random.choice([k, k, k, None, 3]), role, text))
    return out


def _oracle(data):
    con = duckdb.connect()
    cols = list(zip(*data, strict=True)) or [[]] * 4
    con.register("conversations", pa.table({n: pa.array(v, t) for n, v, t in zip(
        ("conv_id", "turn", "role", "text"), cols, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)}))
    rel = con.execute(prefixtrie.ORACLE)
    names = [d[0] for d in rel.description]
    return sorted((tuple(r[names.index(c)] for c in prefixtrie.NODE[:-1]) + (r[names.index("ends_sha256")],) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("segment,burst", [(1024, 1 << 16), (1024, 20), (4, 1 << 16), (3, 12), (1, 5)])
def test_trie_at_every_cut_equals_sql(spark, monkeypatch, segment, burst):
    monkeypatch.setattr(prefixtrie, "SEGMENT", segment)
    data = _conversations()
    df = spark.createDataFrame(data, CONV).withColumn("head", F.lit("clash"))
    convs, turns = prefixtrie.rebuilt_turns(prefixtrie.ranked_turns(df.repartition(5)))
    got = prefixtrie.prefix_trie(convs, turns, burst).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _oracle(data)


def test_trie_small_inputs(spark):
    empty = spark.createDataFrame([], CONV)
    assert prefixtrie.trie_digest(empty).count() == 0
    alone = spark.createDataFrame([(None, None, None, None)], CONV)
    assert sorted(r.depth for r in prefixtrie.trie_digest(alone).collect()) == [0, 1]
    silent = [(c, 0, "user", "x") for c in range(40)]       # most have no turn left
    got = prefixtrie.trie_digest(spark.createDataFrame(silent, CONV)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _oracle(silent)


def test_trie_with_a_hot_conversation(spark):
    data = [(7, k, "user", str(k)) for k in range(3000)] + [(c, 0, "user", "t") for c in range(500)] * 4
    got = prefixtrie.trie_digest(spark.createDataFrame(data, CONV).repartition(6)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _oracle(data)


# ---- n-gram join ---------------------------------------------------------------------------------

def _set(t):
    w = WORDS.findall((t or "").translate(FOLD))
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def _components(docs, pct=85):
    sets = [_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def _near_copies(seed, bases, copies):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [random.choice(vocab) for _ in range(40)]
    docs = []
    for _ in range(bases):
        base = [random.choice(vocab) for _ in range(random.randint(30, 160))] + passage * random.randint(0, 1)
        for _ in range(random.choice([1, 1, copies])):
            w = list(base)
            for _ in range(random.randint(0, 6)):
                k = random.randrange(len(w))
                w[k:k + random.randint(0, 1)] = [random.choice(vocab)] * random.randint(0, 1)
            docs.append(" ".join(w))
    docs += [None, "", " \t", "a", "A", "a b", "a b c", "a b c d", "a b c d e"] * 2
    random.shuffle(docs)
    return [(None if random.random() < .05 else i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_all_pairs(spark, seed):
    docs = _near_copies(seed, 14, 25)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("gid", F.lit(1)).repartition(7)
    got = sorted((tuple(r) for r in groupjoin.similarity_join(df).collect()), key=repr)
    assert got == _components(docs)


def test_join_at_another_width_and_empty(spark):
    docs = [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, "q")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(groupjoin.similarity_join(df, similar_pct=70, width=1), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3)]
    assert groupjoin.similarity_join(df.limit(0)).count() == 0


def test_prefix_length_is_the_least_that_keeps_every_pair():
    for n in range(1, 300):
        p = groupjoin.prefix_length(n, 85)
        need = -(-85 * n // 100)                   # a similar set holds at least this many of n
        assert n - p + 1 == need


def test_words_of_several_batches_are_remembered():
    """A full memory forgets words of one batch, not those that keep coming; ids are the tokenizer's."""
    from textloom.llm import wavelet
    from textloom.llm.queries import tokenizer_file

    enc = wavelet.WordEncoder(tokenizer_file(), cache_words=60)
    batches = [["common, Old " + " ".join(f"w{b}x{i}" for i in range(40)), "common, don't \u65e5 <|endoftext|>"] for b in range(3)]
    for texts in batches:
        ids, sizes = enc.encode(pa.array(texts))
        whole = [enc.tok.encode(t, add_special_tokens=False).ids + [enc.end_id] for t in texts]
        assert ids.tolist() == sum(whole, []) and sizes.tolist() == [len(w) for w in whole]
    assert "common," in enc.index and "w0x1" not in enc.index and len(enc.index) <= 60


def test_known_words_take_few_bytes():
    """Words and runs are remembered as Arrow strings: some twenty bytes each, not a Python object each."""
    from textloom.llm import wavelet
    from textloom.llm.queries import tokenizer_file

    enc = wavelet.WordEncoder(tokenizer_file())
    words = [f"Word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}," for i in range(10_000)]
    enc.encode(pa.array([" ".join(words)]))
    assert len(enc.words) >= 10_000 and enc.words.nbytes < 24 * len(enc.words) and enc.runs.nbytes < 24 * len(enc.runs)
    again, sizes = enc.encode(pa.array([words[77]]))
    assert again.tolist() == [*enc.tok.encode(words[77], add_special_tokens=False).ids, enc.end_id] and sizes.tolist() == [len(again)]

"""Results of the operators against SQL, brute force, round trips and held-out labels."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import chat, langid, mixing, neardup, pii, toxicity, wavelet
from textloom.llm.common import hashed_texts, read
from textloom.llm.queries import ORACLES, QUERIES, tokenizer_file

from conftest import SF_SMALL

TABLES = ("documents", "labels", "benchmark", "pages", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.execute(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in rel.description)
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = rel.df()[cols].astype(object).where(lambda x: x.notna(), None).itertuples(index=False)
    kind = dict(df.dtypes)
    cast = lambda c, v: v if v is None else int(v) if kind[c] in ("bigint", "int") else norm(v)
    assert got == sorted((tuple(cast(c, v) for c, v in zip(cols, r, strict=True)) for r in want), key=repr)


# ---- personal data -----------------------------------------------------------------------------

def _luhn(d):
    return sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15))
    return [(k, *m.span()) for k, p, ok in rules for m in re.finditer(p, t) if ok(m)]


def test_pii_base_spans(spark, texts):
    random.seed(3)
    odd = ["a@b.com.x@y.z a@b.c_d@e.f 8.8.8.8.9 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111", "9" * 9000 + "x" * 9000 + "@x.de",
           *("".join(random.choices("1234.@+- ()ab\n4é", k=60)) for _ in range(60))]
    rows = [*texts.items(), *((10_000 + i, t) for i, t in enumerate(odd))]
    got = {r.doc_id: r for r in pii.pii_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = _base(t)
        spans = ",".join(f"{k}:{a}:{e}" for k, a, e in want)
        assert got[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), (i, got[i].spans, spans)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]


def test_pii_patterns_find_unseen_identifiers(spark):
    seeds = [(i, f"please reach the desk under phone +1 (555) 555-{1000 + i} today") for i in range(30)]
    unseen = [(100, "please reach the desk under phone 555-867-5309 today"), (101, "the year 2024-11-30 was 1234567 days")]
    got = {r.doc_id: r for r in pii.pii_digest(spark.createDataFrame(seeds + unseen, "doc_id long, text string")).collect()}
    t = unseen[0][1]
    assert got[100].spans == f"phone:{t.index('555')}:{t.index('5309') + 4}" and got[100].n_phone == 0
    assert got[101].n_added == 0 and all(got[i].n_added == 0 for i in range(30))


# ---- chat --------------------------------------------------------------------------------------

def _cheapest(roles):
    """All state sequences, all costs."""
    best = float("inf")
    for states in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, at = 0.0, chat.START
        for r, s in zip(roles, states, strict=True):
            cost, at = cost + chat._COST[r][at, s], s
        best = min(best, cost + chat._END[at])
    return best


def test_role_repair_is_cheapest_and_legal(spark):
    random.seed(5)
    names = ["user", "assistant", "system", "tool", None]
    convs = {c: [random.choice(names) for _ in range(random.randint(1, 6))] for c in range(40)}
    step = chat.CHUNK // 2                     # several chunks in a conversation
    rows = [(c, k * step, r, f"t{c}.{k}") for c, roles in convs.items() for k, r in enumerate(roles)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    cost = {r.conv_id: r.cost for r in chat.repair_cost(turns).collect()}
    done = {}
    for r in chat.repair(turns).collect():
        done.setdefault(r.conv_id, []).append(r)
    for c, roles in convs.items():
        assert cost[c] == _cheapest([chat._role(r) for r in roles]), (c, roles)
        parts = sorted(done[c], key=lambda r: r.turn)
        text = "".join(p.rendered for p in parts)
        order = re.findall(r"<\|(\w+)\|>", text)
        order = order[1:] if order[0] == "system" else order
        assert order == ["user", "assistant"] * (len(order) // 2)
        assert [t for t in re.findall(r"t\d+\.\d+", text)] == [f"t{c}.{k}" for k in range(len(roles))]


# ---- near duplicates ---------------------------------------------------------------------------

@pytest.mark.parametrize("pct", [80, 85])
def test_near_duplicates_match_all_pairs(spark, texts, pct):
    random.seed(7)
    rows = dict(texts)
    for k, t in enumerate([texts[i] for i in sorted(texts)[:12]]):
        w = t.split(" ")
        for j in range(4):
            v = list(w)
            for _ in range(1 + len(w) // 60):
                v[random.randrange(len(v))] = f"changed{j}"
            rows[1000 + 10 * k + j] = " ".join(v)
    rows |= {2000: "a b c", 2001: "A  b\tc", 2002: "a b c d", 2003: "", 2004: None}
    sets = {}
    for i, t in rows.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(rows), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= pct * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = neardup.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), similar_pct=pct)
    for r in got.collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_word_hashes_do_not_depend_on_place():
    texts = ["Alpha beta\ngamma", "x  ALPHA\tbeta", "é " * 5, "", None, "y" * 3_000_000 + " alpha"]
    out = {}
    for i, j, h, offs in hashed_texts(pa.array(texts)):
        for r in range(i, j):
            out[r] = h[offs[r - i]:offs[r - i + 1]]
    assert [len(out[r]) for r in range(6)] == [3, 3, 5, 0, 0, 2]
    assert out[0][0] == out[1][1] == out[5][1] and out[0][1] == out[1][2] and len(set(out[2])) == 1


# ---- language, toxicity ------------------------------------------------------------------------

def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    score = rng.normal(size=(14, 3)).astype(np.float32)
    first = np.array([0, 6, 6, 7, 14])
    got = langid.viterbi(score, first, 0.9)
    value = lambda s, p: sum(s[i, x] for i, x in enumerate(p)) - 0.9 * sum(a != b for a, b in itertools.pairwise(p))
    for a, b in itertools.pairwise(first):
        if b > a:
            best = max(value(score[a:b], p) for p in itertools.product(range(3), repeat=int(b - a)))
            assert value(score[a:b], tuple(got[a:b])) == pytest.approx(best, abs=1e-5)


def test_language_of_held_out_documents(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op5_script_viterbi_language"](spark, SF_SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    out = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(out) >= 0.95 * len(out)


def test_language_spans_of_mixed_text(spark):
    docs = read(spark, SF_SMALL, "documents")
    model = langid.fit(docs)
    en, de = (docs.filter(f"lang = '{x}' AND n_chars > 600").orderBy("doc_id").first().text[:400] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, en + " " + de)], "doc_id long, text string")
    spans = langid.identify(mixed, model).first().spans
    assert [s.lang for s in spans] == ["en", "de"] and abs(spans[1].start - 401) <= 30


def test_toxicity_separates_clauses(spark):
    model = {"closed": None, "key": np.zeros(0, np.uint64), "weight": np.zeros(0), "logit": toxicity.DEFAULT_WEIGHTS}
    closed = sorted(toxicity._closed().items())
    model["closed"] = {"key": np.array([k for k, _ in closed], np.uint64), "symbol": np.array([s for _, s in closed])}
    rows = [(1, "You stupid idiot, you are a moron."), (2, "He is not stupid at all."), (3, "She said they called it stupid."),
            (4, "A quiet morning by the sea."), (5, "I will kill you."), (6, None)]
    got = {r.doc_id: r.score for r in toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] > 0.7 > got[3] and got[1] > got[2] > got[4] == got[6] and got[5] > got[4]


# ---- mixing ------------------------------------------------------------------------------------

def test_sainte_lague_matches_one_seat_at_a_time(spark):
    random.seed(2)
    rows = [(g, k, random.random() * 10 ** random.randint(0, 2)) for g in range(5) for k in range(random.randint(1, 30))]
    seats = {g: random.randint(0, 200) for g in range(5)}
    df = spark.createDataFrame([(g, k, w, 10**6, seats[g]) for g, k, w in rows], "g int, k int, w double, cap long, seats long")
    got = {(r.g, r.k): r.q for r in mixing.sainte_lague(df, ["g"], ["g", "k"], "w", "cap", "seats", "q").collect()}
    for g, n in seats.items():
        own = {k: w for x, k, w in rows if x == g}
        won = dict.fromkeys(own, 0)
        for _ in range(n):
            k = max(own, key=lambda k: (own[k] / (2 * won[k] + 1), -k))
            won[k] += 1
        assert {k: got[g, k] for k in own} == won


def test_mix_comes_near_its_targets(spark):
    docs = read(spark, SF_SMALL, "documents")
    plan = mixing.mix_plan(docs)
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w")).collect():
        assert abs(r.t - r.w) <= mixing.BLOCK + 0.01 * r.w
    assert plan.filter("taken > 2 * size").count() == 0
    words = mixing.mixed(docs).select(F.sum(mixing._size(F.col("text"))).alias("n")).first().n
    assert words == plan.agg(F.sum("taken")).first()[0]


# ---- token shards ------------------------------------------------------------------------------

def test_encoder_equals_the_tokenizer():
    random.seed(1)
    letters = ["a", "É", "́", "^", "<|endoftext|>", " ", "\n", "\x0b", "\x1c", "\x85", " ", "'s", "'", "1", "中", "ﬁ",
               "İ", "Σ", "ß", "ª", "|", "x", "‍", "😀", "가", "ᅡ", "º", "×"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 20))) for _ in range(4000)]
    enc = wavelet.WordEncoder(tokenizer_file(), cache_words=500)
    for lo in range(0, 4000, 1000):
        ids, sizes = enc.encode(pa.array(texts[lo:lo + 1000]))
        at = np.r_[0, np.cumsum(sizes)]
        for i, t in enumerate(texts[lo:lo + 1000]):
            assert ids[at[i]:at[i + 1]].tolist() == [*enc.tok.encode(t, add_special_tokens=False).ids, 1], t


def test_shards_answer_like_the_array():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 300, 5000).astype(np.uint32)
    s = wavelet.Shard(wavelet.build_image(ids, 9, np.arange(5), np.ones(5, bool), np.full(5, 1000)))
    assert (s.decode() == ids).all()
    for i in rng.integers(0, 5000, 60):
        t = int(ids[i])
        assert s.access(int(i)) == t and s.rank(t, int(i)) == int((ids[:i] == t).sum()) and s.count(t) == int((ids == t).sum())
    assert s.occurrences(7) == np.flatnonzero(ids == 7).tolist() and s.count(511) == 0


def test_token_shards(spark, texts):
    enc = wavelet.encoder(tokenizer_file(), 1)
    start = 0
    got = QUERIES["op10_wavelet_tokens"](spark, SF_SMALL).orderBy("doc_id").collect()
    for r in got:
        ids = np.array([*enc.tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_decontamination_finds_every_whole_item(spark, con, texts):
    items = {i: t.lower().split() for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    got = {r.doc_id: r for r in QUERIES["op3_latent_decontamination"](spark, SF_SMALL).collect()}
    for i, t in texts.items():
        w = t.lower().split()
        held = {k for k, v in items.items() if any(w[j:j + len(v)] == v for j in range(len(w) - len(v) + 1))}
        assert held <= set(got[i]["items"])
        assert got[i].contaminated or not held
    assert sum(r.contaminated for r in got.values()) <= 0.1 * len(texts)

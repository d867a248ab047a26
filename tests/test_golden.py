"""Checks of the catalogue operators on a small fixture with the awkward rows:
quoting, a repeated key, a key with a space, a lower-case key, NBSP and bullets,
a trailing dot, an empty description."""

import json

import pytest
from pyspark.sql import functions as F

from textloom import defaults as D
from textloom.operators import catalog, expand
from textloom.sources import io

ROWS = [
    ("Peek", 'Get the owner, "quoted", of an object (file, directory).', "http://x.example/peek"),
    ("LOOP /F", "Loop over the lines of a file", "http://x.example/loop1"),
    ("LOOP /F", "Loop over the words of a <b>line</b>", "http://x.example/loop2"),
    ("cd", "Change  Directory - move to a folder.", "http://x.example/cd"),
    ("DIR", "Display a list of files • and folders", "http://x.example/dir"),
    ("IPCONFIG", "Configure IP", "http://x.example/ip"),
    ("::", "", "http://x.example/colon"),
]


@pytest.fixture(scope="module")
def basic(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalogue") / "basic.csv"
    quote = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"') else x
    lines = ["command,description,url", *(",".join(map(quote, r)) for r in ROWS)]
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode())
    df = io.read_table(spark, str(path), "command string, description string, url string")
    return df.coalesce(1).withColumn("ord", F.monotonically_increasing_id())   # single-file order


def _lower(text):
    return (text or "").lower().rstrip(".")


def test_csv_quoting(basic):
    got = [tuple(r) for r in basic.orderBy("ord").select("command", F.coalesce("description", F.lit("")), "url").collect()]
    assert got == ROWS


def test_default_pair_rules(basic):
    full = basic.fillna("", ["description"])
    out = (expand.pair_rules(full, "command", "description", expand.default_pair_rules("command", "description"),
                             carry=["ord"]).orderBy("ord", "pos").select("query", "command").collect())
    want = []
    for cmd, text, _ in ROWS:
        for query, needle, other, key in D.PAIR_RULES:
            if (needle is None or needle.lower() in text.lower()) and (key is None or cmd.lower() == key.lower()):
                want.append((query.replace("{}", _lower(text)), other or cmd))
    assert [tuple(r) for r in out] == want and len(want) > len(ROWS)


def test_augment_counts(basic):
    def count(templates, phrases):
        return sum(len(templates) + sum(len(p) for aliases, p in phrases if cmd.lower() in [a.lower() for a in aliases])
                   for cmd, _, _ in ROWS)

    full = basic.fillna("", ["description"])
    a4 = expand.augment(full, "command", "description", D.TEMPLATES_4, D.PHRASES_ALIASED)
    a10 = expand.augment(full, "command", "description", D.TEMPLATES_10, D.PHRASES_EXACT, out="text")
    assert a4.count() == count(D.TEMPLATES_4, D.PHRASES_ALIASED) > 4 * len(ROWS)
    assert a10.count() == count(D.TEMPLATES_10, D.PHRASES_EXACT) > 10 * len(ROWS)
    assert expand.prompt_fanout(a10, "text").count() == len(D.PROMPT_PREFIXES) * a10.count()
    first = a4.filter((F.col("command") == "cd") & (F.col("pos") == 0)).first()
    assert "change directory - move to a folder" in first.query


def test_last_wins_enrich_and_unknown(spark, basic):
    cat = catalog.last_by_key(basic, "command", "ord")
    assert cat.count() == 6 and cat.filter("command = 'LOOP /F'").first().url.endswith("loop2")
    pairs = spark.createDataFrame([("a", "cd"), ("b", "DIR"), ("c", "dir"), ("d", "LOOP /F")], "query string, command string")
    assert catalog.enrich(pairs, cat, "command").count() == 3
    assert [r.command for r in catalog.unknown_keys(pairs, cat, "command").collect()] == ["dir"]
    ids = spark.createDataFrame([("cd", 0)], "command string, label_id long")
    assert sorted((r.command, r.label_id) for r in catalog.encode_labels(pairs, ids, "command").collect()) == [
        ("DIR", None), ("LOOP /F", None), ("cd", 0), ("dir", None)]
    assert catalog.decode_labels(spark.createDataFrame([(0,), (9,)], "label_id long"), ids).count() == 2


def test_json_array_and_suffix(spark, tmp_path):
    path = tmp_path / "pairs.json"
    path.write_text(json.dumps([{"query": q, "command": c} for c, q, _ in ROWS], indent=1))
    got = io.read_table(spark, str(path), "query string, command string")
    assert sorted(map(tuple, got.collect())) == sorted((q, c) for c, q, _ in ROWS)
    with pytest.raises(ValueError):
        io.read_table(spark, str(tmp_path / "pairs.xml"))
    table = io.param_table(spark, [("a", 1)], "label string, label_id long")
    assert table.first().label_id == 1

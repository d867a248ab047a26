"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import (chat, decontam, langid, mixing, neardup, pii, quality, toxicity, warc, wavelet)
from textloom.llm.queries import tokenizer_file

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, hits string, kept string, "
          "`__w` string, row string, region string")
PROSE = "The old harbour was quiet in the morning. Two boats came in with the tide and left before noon.\n"
LONG = " ".join(f"word{i % 977} runs{i % 613} on{i % 389}." for i in range(20_000))


def _row(doc_id, text, lang="en", source="a"):
    return doc_id, text, lang, source, len(text or ""), "h", "k", "w", "r", "g"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [_row(1, PROSE * 2), _row(1, PROSE * 2), _row(2, PROSE * 2), _row(3, None), _row(4, ""), _row(5, " \n\t "),
            _row(None, PROSE + "mail me at a.b@c.org now."), _row(6, LONG, None, None), _row(7, "é 中 1", None),
            _row(8, "a b"), _row(9, "a b", "fr"), _row(10, "you stupid idiot. you are a moron.")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (None, "a b"), (4, PROSE)], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (10, None, 1), (None, 1, 1), (10, 0, 0), (3, 1, None)],
                                 "doc_id long, quality int, toxic int")


def _ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=str)


def _operators(docs, bench, labels):
    yield pii.pii_digest(docs)
    yield decontam.contamination_digest(docs, bench)
    yield neardup.neardup_digest(docs)
    yield langid.language_digest(docs)
    yield toxicity.toxicity_digest(docs, labels)
    yield quality.quality_digest(docs)
    yield mixing.mix_digest(docs)
    yield wavelet.token_digest(docs, tokenizer_file())


def test_every_row_comes_back(odd, bench, labels):
    for out in _operators(odd, bench, labels):
        assert _ids(out) == _ids(odd), out.columns


def test_empty_tables(odd, bench, labels):
    none = odd.filter("false")
    for out in _operators(none, bench, labels):
        assert out.count() == 0
    for out in _operators(odd.limit(3), bench.filter("false"), labels.filter("false")):
        assert out.count() == 3
    for stage in (quality.accepted, neardup.deduplicated, mixing.mixed):
        assert stage(none).columns == odd.columns and stage(none).count() == 0


def test_stages_keep_clashing_columns(odd, bench):
    for out in (quality.accepted(odd), neardup.deduplicated(odd), decontam.clean(odd, bench), mixing.mixed(odd)):
        assert out.columns == odd.columns
        assert {r["hits"] for r in out.select("hits").collect()} == {"h"}
    # a text said twice is one repeated window after the other
    assert _ids(quality.accepted(odd)) == sorted([6, None], key=str)
    assert _ids(neardup.deduplicated(odd)) == sorted([1, 3, 4, 5, 6, 7, 8, 10, None], key=str)
    assert _ids(decontam.clean(odd, bench)) == sorted([3, 4, 5, 6, 7, 10], key=str)


def test_defined_results(odd, bench, labels):
    got = {r.doc_id: r for r in quality.quality_digest(odd).collect()}
    assert not got[3].kept and got[3].n_words == 0 and got[1].n_dup_lines == 1
    near = {r.doc_id: r for r in neardup.neardup_digest(odd).collect()}
    assert near[3].n_shingles == 0 and near[3].kept and near[3].component_id == 3
    assert near[2].component_id == 1 and near[9].component_id == 8 and near[8].n_shingles == 1
    tok = wavelet.token_digest(odd, tokenizer_file()).orderBy("start").collect()
    assert tok[0].doc_id is None and [r.n_tokens for r in tok if r.doc_id in (3, 4, 5)] == [1, 1, 1]
    lang = {r.doc_id: r for r in langid.language_digest(odd).collect()}
    assert lang[3].lang_pred == lang[4].lang_pred == "und" and lang[3].score == 0
    tox = {r.doc_id: r for r in toxicity.toxicity_digest(odd, labels).collect()}
    assert tox[10].score > tox[3].score and tox[3].predicted == 0 and tox[10].predicted == 1


def test_chat_edges(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, None, None), (2, None, "assistant", "x"),
         (2, 5000, "tool", "y"), (3, 0, "system", "s")], "conv_id long, turn long, role string, text string")
    out = chat.repair(turns.withColumn("op", F.lit(1)))
    assert out.count() == 6 and chat.repair(turns.filter("false")).count() == 0


def test_warc_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "", "x"), (2, "", "x"), (None, "u", "v"), (3, "not a url", "")],
                                  "page_id long, url string, html string").withColumn("key", F.lit(1))
    out = {r.record_id: r.status for r in warc.revisit_digest(pages).collect()}
    assert out == {2: "full", 3: "missing", 4: "full", 5: "resolved", 6: "full", 7: "mismatch"}
    assert warc.revisit_digest(pages.filter("false")).count() == 0


def test_pipeline_stages(spark, odd, tmp_path):
    sf = str(tmp_path)
    odd.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this is in any of the texts at all, not a word of it.")],
                          "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == odd.columns
    assert corpus_pipeline.run(spark, sf).count() == docs.count()

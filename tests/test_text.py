from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.functions import text as X


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()[0]


def test_squeeze_and_strip_tags(spark):
    assert one(spark, X.squeeze("s"), "a  b") == "a b"
    assert one(spark, X.strip_tags(X.squeeze("s")), "x <b>y</b> z") == "x y z"
    # tags stripped after squeezing: the double space stays
    assert one(spark, X.strip_tags(X.squeeze("s")), "a <br> b") == "a  b"
    # NBSP and U+001C are whitespace (as in Python)
    assert one(spark, X.squeeze("s"), "a \u001c b ") == "a b"


def test_clean_text(spark):
    assert one(spark, X.clean_text("s"), None) == ""
    assert one(spark, X.clean_text("s"), "") == ""
    assert one(spark, X.clean_text("s"), "A • b!") == "a b"
    assert one(spark, X.clean_text("s"), "x² e-mail") == "x² e-mail"
    assert one(spark, X.clean_text("s"), "é") == "e"       # combining accent removed
    assert one(spark, X.clean_text("s"), "É") == "é"


def test_trailing_dots_and_case(spark):
    assert one(spark, X.strip_trailing("s"), "end..") == "end"
    assert one(spark, X.strip_trailing("s"), "end. ") == "end. "
    assert one(spark, X.contains_ci("s", "LIST"), "Lists files") is True
    assert one(spark, X.in_ci("s", ["dir", "ls"]), "DIR") is True


def test_template_label_suffix_first(spark):
    assert one(spark, X.template("How do I {}?", "s"), "x") == "How do I x?"
    assert one(spark, X.label_suffix("s"), "LABEL_17") == 17
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(X.first_or_null("a")).collect()] == ["a", None, None]


def test_blank_filter(spark):
    df = spark.createDataFrame([(1, "  "), (2, "Exit"), (3, " q "), (4, "list files"), (5, None)],
                               "id int, q string")
    assert [r.id for r in X.drop_blank(df, "q").collect()] == [4]


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The cat_s  sat, a b",)], "s string")
    toks = df.select(X.tokens("s").alias("t"))
    assert toks.first()[0] == ["the", "cat_s", "sat"]
    grams = toks.select(X.ngrams_of_tokens("t", 1, 3)).first()[0]
    assert grams == ["the", "cat_s", "sat", "the cat_s", "cat_s sat", "the cat_s sat"]
    short = spark.createDataFrame([(["x"],), ([],)], "t array<string>")
    assert [r[0] for r in short.select(X.ngrams_of_tokens("t", 1, 3)).collect()] == [["x"], []]


def test_l2_normalize_zero_stays_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(X.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \t\n  -.<>")), max_size=30))
def test_squeeze_idempotent_and_matches_python(spark, s):
    got = one(spark, X.squeeze("s"), s)
    assert got == " ".join(s.split())
    assert one(spark, X.squeeze("s"), got) == got

"""JSON arrays written in files of bounded size and read back."""

from textloom.session import shared_path
from textloom.sources import io

from conftest import rows


def test_json_arrays_round_trip(spark):
    texts = ["[1, 2]", 'a "quoted" ] [', "back\\slash", "line\nbreak", "", "  [", "\u00e9\u2603"]
    df = spark.createDataFrame([(i, t, [t, "x"]) for i, t in enumerate(texts * 30)], "k long, t string, a array<string>")
    path = shared_path(spark, "arrays")
    io.write_json_arrays(df, path, "k", 20)
    files = spark.read.text(path, wholetext=True).collect()
    assert len(files) > 5 and all(f.value.startswith("[{") for f in files)
    assert rows(io.read_table(spark, path, df.schema, "json")) == rows(df)


def test_json_arrays_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k long, t string")
    path = shared_path(spark, "arrays")
    io.write_json_arrays(df, path, "k", 20)
    assert io.read_table(spark, path, df.schema, "json").count() == 0


def test_json_lines_are_not_taken_for_an_array(spark):
    df = spark.createDataFrame([(1, "[x]"), (2, None)], "k long, t string")
    path = shared_path(spark, "lines")
    io.write_table(df, path, "json")
    assert rows(io.read_table(spark, path, df.schema, "json").select("k")) == [(1,), (2,)]


CSV = "k long, t string, u string"


def _csv(spark, parts):
    """One folder, each list of rows in a file of its own."""
    path = shared_path(spark, "csv")
    for part in parts:
        io.write_table(spark.createDataFrame(part, CSV).coalesce(1), path, "csv", mode="append")
    return path


def test_csv_without_quoted_breaks_is_split(spark):
    part = [(i, f'a "quoted" ""{i}"", with comma', "  edge ") for i in range(20_000)]
    path = _csv(spark, [part])
    assert list(io.csv_files(spark, path).values()) == [False]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = io.read_table(spark, path, CSV, "csv")
        assert got.rdd.getNumPartitions() > 4
        assert rows(got) == sorted(part)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_only_files_with_quoted_breaks_are_read_whole(spark):
    plain = [(i, "x, y", None) for i in range(50)]
    broken = [(100, "one\ntwo", "a"), (101, 'say "hi\nthere"', "b"), (102, '"\n"', "c"), (103, "x", "d\n\ne")]
    path = _csv(spark, [plain, broken])
    assert sorted(io.csv_files(spark, path).values()) == [False, True]
    got = io.read_table(spark, path, CSV, "csv")
    assert rows(got.fillna("-")) == sorted((k, t, u or "-") for k, t, u in plain + broken)
    only = _csv(spark, [broken])
    assert rows(io.read_table(spark, only, CSV, "csv")) == sorted(broken)


def test_csv_in_a_folder_with_signs_and_an_empty_one(spark):
    path = shared_path(spark, "a b [1] {x}")
    for part in ([(1, "p", "q")], [(2, "r\ns", "t")]):
        io.write_table(spark.createDataFrame(part, CSV).coalesce(1), path, "csv", mode="append")
    literal = path.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    assert rows(io.read_table(spark, literal, CSV, "csv")) == [(1, "p", "q"), (2, "r\ns", "t")]
    empty = _csv(spark, [[]])
    assert io.read_table(spark, empty, CSV, "csv").count() == 0

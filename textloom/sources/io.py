"""Sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    for f in FORMATS:
        if path.rstrip("/").endswith("." + f):
            return f
    raise ValueError("Data file must be CSV, JSON or Parquet")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """A1-A3: read by suffix. CSV: header, RFC-4180 quoting (a quote inside a
    field is doubled, not backslash-escaped), multi-line fields, UTF-8; only files
    that hold a quoted line break are read whole (:func:`csv_files`).
    JSON: an array of records (multi-line) or JSON lines."""
    f = _fmt(path, fmt)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if f == "csv":
        r = r.option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
        return _read_csv(spark, r, path)
    if f == "json":
        return r.option("multiLine", True).json(path) if _is_array_json(spark, path) \
            else r.json(path)
    return r.parquet(path)


_GLOB = r"([*?{}\[\]\\])"


def csv_files(spark: SparkSession, path: str) -> dict[str, bool]:
    """The files of a CSV path, and whether each holds a line break inside quotes: whether it has a line
    with an odd number of quotes. A doubled quote is two, so a line that begins outside quotes ends
    inside them only if its number is odd; if no line's is, every line is a whole record. (An
    unquoted field with a lone quote counts too; such a file is read whole, with equal rows.)

    One scan, split by byte ranges. One row a file, as any reader lists them on the driver."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    files = spark.read.text(path).groupBy("_metadata.file_path").agg(F.max(quotes % 2 == 1).alias("broken"))
    return {unquote(r["file_path"]): r["broken"] for r in files.collect()}


def _read_csv(spark: SparkSession, reader, path: str) -> DataFrame:
    files = csv_files(spark, path)
    if not any(files.values()):
        return reader.csv(path)
    if all(files.values()):
        return reader.option("multiLine", True).csv(path)
    if not re.search(_GLOB, path):
        reader = reader.option("basePath", path)             # columns of folders named key=value stay
    names = {broken: sorted(re.sub(_GLOB, r"\\\1", f) for f, b in files.items() if b == broken) for broken in (False, True)}
    lines = reader.csv(names[False])
    return lines.unionByName(reader.option("multiLine", True).csv(names[True]))


def _is_array_json(spark: SparkSession, path: str) -> bool:
    """Peek at the first non-blank character of a JSON file or folder."""
    first = F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1)        # one character reaches the driver
    head = spark.read.text(path).select(first.alias("c")).filter("c <> ''").limit(1).collect()
    return bool(head) and head[0]["c"] == "["


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error",
                array_join: Sequence[str] = ()) -> str:
    """A4/A5: write CSV (header, RFC-4180 quoting, white space kept), JSON lines or Parquet.
    CSV cannot hold arrays: name them in ``array_join`` to join with spaces."""
    out = df
    if fmt == "csv":
        for c in df.columns:
            if isinstance(df.schema[c].dataType, T.ArrayType):
                if c not in array_join:
                    raise ValueError(f"array column {c!r} needs array_join for CSV")
                out = out.withColumn(c, F.array_join(c, " "))
        out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"') \
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif fmt == "json":
        out.write.mode(mode).json(path)
    else:
        out.write.mode(mode).parquet(path)
    return path


def write_json_arrays(df: DataFrame, path: str, key: str, rows: int, mode: str = "error") -> str:
    """A5: files of one JSON array of about ``rows`` records each, as :func:`read_table` reads them.
    Records are dealt by a hash of the key, so a task holds an array at a time; rows of one key
    stay together."""
    arrays = -(-df.count() // rows) or 1
    part = F.pmod(F.xxhash64(key), F.lit(arrays))
    out = df.groupBy(part.alias("_p")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    out.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)
    return path


LABELS_SCHEMA = "label string, label_id bigint"


def write_labels(labels: DataFrame, path: str, mode: str = "error") -> str:
    """Label map as a typed two-column Parquet table."""
    labels.select(F.col("label").cast("string"), F.col("label_id").cast("long")) \
        .write.mode(mode).parquet(path)
    return path


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Read a label map back (ids keep their type; no string keys)."""
    return spark.read.schema(LABELS_SCHEMA).parquet(path)


def param_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small parameter table from literal rows (templates, keywords...)."""
    return spark.createDataFrame(list(rows), schema)

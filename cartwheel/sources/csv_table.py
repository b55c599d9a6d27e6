"""CSV tables read as text: header row, comma separator, double-quote quoting with doubled quotes.

Every value is a string (no inference); quoted fields may span lines. Rows whose field count
differs from the header fail the read (``on_ragged='fail'``) or are kept with the raw line in
``_corrupt_record`` (``on_ragged='keep'``); Spark would otherwise pad short rows and cut long ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_splits import file_records, parse_records

READ_OPTIONS = {
    "header": "true", "inferSchema": "false", "multiLine": "true", "recursiveFileLookup": "true", "quote": '"', "escape": '"',
    "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "quoteAll": "false",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def safe_names(names: list[str]) -> list[str]:
    """Spark's header rule: an empty name becomes ``_c<i>``, a repeated name gets its column
    position appended (``name,name`` at positions 1 and 2 -> ``name1,name2``)."""
    lowered = [n.lower() for n in names]
    out = []
    for i, n in enumerate(names):
        if n == "":
            out.append(f"_c{i}")
        elif lowered.count(n.lower()) > 1:
            out.append(f"{n}{i}")
        else:
            out.append(n)
    return out


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line (read by Spark, one small job)."""
    return safe_names(_first_line(spark, path))


def _first_line(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.options(**{**READ_OPTIONS, "header": "false"}).csv(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path}: file has no header line")
    return [str(v) if v is not None else "" for v in first[0]]


def _check_equal_headers(spark: SparkSession, path: str) -> None:
    """Raise if the first lines of the files differ (needed where Spark can't compare names itself)."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"), "value")
    if rows.groupBy("f").agg(F.min_by("value", "i").alias("h")).select("h").distinct().limit(2).count() > 1:
        raise ValueError(f"{path}: the files have different headers")


def read_csv_table(spark: SparkSession, path: str, on_ragged: str = "fail", columns: list[str] | None = None,
                   splits: bool = False, positions: bool = False) -> DataFrame:
    """All columns as text. Every file must have the same header in the same order; a difference fails the read.

    A file is read by one task, or with ``splits`` by as many as it has splits (``csv_splits``; the same rows, one shuffle more):
    the way to read few large files. ``positions`` (with ``splits``) adds ``_file, _block, _line``, the order of the files."""
    if positions and not splits:
        raise ValueError("positions are known to a read by splits only")
    raw = _first_line(spark, path)
    names = columns or safe_names(raw)
    if splits:
        return parse_records(file_records(spark, path), raw, names, READ_OPTIONS, on_ragged, positions)
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    opts = dict(READ_OPTIONS)
    if names == raw:
        opts["enforceSchema"] = "false"  # Spark compares each file's header with the names
    else:
        _check_equal_headers(spark, path)
    if on_ragged == "fail":
        opts["mode"] = "FAILFAST"
    elif on_ragged == "keep":
        opts["mode"] = "PERMISSIVE"
        opts["columnNameOfCorruptRecord"] = "_corrupt_record"
        fields.append(T.StructField("_corrupt_record", T.StringType(), True))
    else:
        raise ValueError(f"unknown on_ragged {on_ragged!r}")
    return spark.read.options(**opts).schema(T.StructType(fields)).csv(path)

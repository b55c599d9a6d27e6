"""Fixed-size row chunks of a table and their CSV export (one CSV per chunk, header repeated).

chunk_id = floor((row_no - 1) / chunk_size), 0-based, in the global order ``order_by``. The row
number comes from a distributed prefix count (no single-task window). Writing repartitions by
chunk id -- a chunk holds at most ``chunk_size`` rows, so no task gets more than that -- and
sorts inside each chunk, giving one file per chunk in row order under ``chunk_id=<i>/``.
Without ``order_by`` the order is that of the files: by path, then by place in the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import global_row_number
from .csv_splits import FILE_ORDER
from .csv_table import WRITE_OPTIONS


def _check(chunk_size: int) -> None:
    if not isinstance(chunk_size, int) or chunk_size < 1:
        raise ValueError(f"chunk_size must be a positive integer, got {chunk_size!r}")


def in_file_order(df: DataFrame) -> DataFrame:
    """``df`` with ``_file, _block, _line``: path of the file a row comes from, byte offset of its split, place in the split.

    ``df`` has them from ``read_csv_table(positions=True)``, or is a read of files (Parquet, CSV, text ...) with no more than filters and
    selections on it. However the files are cut into tasks, the order is the same; paths are ordered bytewise (``10.csv`` before ``2.csv``)."""
    if set(FILE_ORDER) <= set(df.columns):
        return df
    path, block, line = FILE_ORDER
    return df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.file_block_start").alias(block),
                     F.monotonically_increasing_id().alias(line))


def chunk_rows(df: DataFrame, chunk_size: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """Input columns plus ``row_no`` (1-based) and ``chunk_id`` (0-based).

    ``order_by`` is a unique key. None: the order of the rows in their files (``in_file_order``), so repeated rows and tables without a key
    are chunked alike in every run."""
    _check(chunk_size)
    if order_by is None:
        numbered = global_row_number(in_file_order(df), list(FILE_ORDER), out="row_no").drop(*FILE_ORDER)
    else:
        numbered = global_row_number(df, list(order_by), out="row_no")
    return numbered.withColumn("chunk_id", F.floor((F.col("row_no") - 1) / chunk_size).cast("bigint"))


def chunk_manifest(chunked: DataFrame, key: str | None = None, trailing_empty: bool = False,
                   chunk_size: int | None = None) -> DataFrame:
    """``chunk_id, n_rows, first_row, last_row`` (+ first/last ``key``).

    ``trailing_empty=True`` (needs ``chunk_size``) adds a zero-row line when the row count is a
    multiple of the chunk size -- the header-only file of the single-machine splitter.
    """
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.min("row_no").cast("bigint").alias("first_row"), F.max("row_no").cast("bigint").alias("last_row")]
    if key:
        aggs += [F.min_by(key, "row_no").alias("first_key"), F.max_by(key, "row_no").alias("last_key")]
    man = chunked.groupBy("chunk_id").agg(*aggs)
    if not trailing_empty:
        return man
    _check(chunk_size)
    total = chunked.count()
    if total % chunk_size:
        return man
    # an empty row range: first = total + 1, last = total
    extra = man.sparkSession.createDataFrame(
        [(total // chunk_size, 0, total + 1, total)], "chunk_id bigint, n_rows bigint, first_row bigint, last_row bigint")
    for c in man.columns[4:]:
        extra = extra.withColumn(c, F.lit(None).cast(man.schema[c].dataType))
    return man.unionByName(extra)


def write_chunks(df: DataFrame, path: str, chunk_size: int, order_by: Sequence[str] | None = None,
                 line_sep: str | None = None) -> DataFrame:
    """Write one CSV per chunk to ``path/chunk_id=<i>/`` and return the manifest."""
    chunked = chunk_rows(df, chunk_size, order_by)
    cols = [c for c in df.columns if order_by is not None or c not in FILE_ORDER]
    opts = dict(WRITE_OPTIONS)
    if line_sep:
        opts["lineSep"] = line_sep
    (chunked.repartition("chunk_id").sortWithinPartitions("chunk_id", "row_no")
     .select(*cols, "chunk_id")
     .write.mode("overwrite").options(**opts).partitionBy("chunk_id").csv(path))
    return chunk_manifest(chunked)

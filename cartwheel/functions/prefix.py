"""Distributed prefix sums and global row numbers.

A global ``row_number()`` or running sum without ``PARTITION BY`` moves every row into one task.
Instead:

1. range-partition on the (total) order and sort inside each partition;
2. number the rows with ``monotonically_increasing_id`` (partition in the upper bits, position in the
   lower 33) and fix the result in the shared checkpoint folder, so every later read sees the same
   layout even if tasks are re-run; running sums are windows inside a partition;
3. one small job collects the per-partition totals (one row per partition, bounded by the
   partition count, never by the data), turns them into offsets and broadcasts them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID = "_cw_pid"
_POS = "_cw_pos"
_LOCAL = "_cw_local"
_POSITION_BITS = 33  # fixed by monotonically_increasing_id


def global_cumsum(df: DataFrame, order_by: Sequence[str], out: str = "cum",
                  value_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value_col`` (BIGINT; count of rows if None) in the
    global order ``order_by``. ``order_by`` must be a total order (unique key)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
               .withColumn("_cw_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    local = (ordered.withColumn(_PID, F.shiftright("_cw_id", _POSITION_BITS))
             .withColumn(_POS, F.col("_cw_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))).drop("_cw_id"))
    if value_col is None:
        local = local.withColumn(_LOCAL, F.col(_POS) + 1)
        totals = local.groupBy(_PID).agg(F.max(_LOCAL).alias("_cw_total"))
    else:
        w = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = local.groupBy(_PID).agg(F.sum(F.col(value_col).cast("bigint")).alias("_cw_total"))
        local = local.withColumn(_LOCAL, F.sum(F.col(value_col).cast("bigint")).over(w))
    offsets, acc = [], 0
    for row in sorted(totals.collect(), key=lambda r: r[_PID]):
        offsets.append((int(row[_PID]), acc))
        acc += int(row["_cw_total"] or 0)
    off_df = spark.createDataFrame(offsets or [(0, 0)], f"{_PID} long, _cw_offset long")
    return (local.join(F.broadcast(off_df), _PID, "left")
            .withColumn(out, (F.col(_LOCAL) + F.coalesce("_cw_offset", F.lit(0))).cast("bigint"))
            .drop(_PID, _POS, _LOCAL, "_cw_offset"))


def global_row_number(df: DataFrame, order_by: Sequence[str], out: str = "row_no",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number in the global order ``order_by`` without a single-task window."""
    return global_cumsum(df, order_by, out=out, value_col=None, num_partitions=num_partitions)

"""Helpers shared by the operators: intermediate tables in the cluster's shared folder, joins that
stand a hot key, and gapless numbers inside groups of any size."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A key with more than 1/HOT_SHARE of all rows is hot; there are fewer than HOT_SHARE such keys.
HOT_SHARE = 1000


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: lineage is cut, a lost
    executor recomputes nothing before this point. The folder's retention policy removes the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(col: str | Column) -> Column:
    """The text's bytes; null counts as empty."""
    return F.encode(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")), "utf-8")


def id_crc(col: str | Column) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.encode((F.col(col) if isinstance(col, str) else col).cast("string"), "utf-8"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled whatever size Spark expects. That size is the one of compressed files; a table
    just below ``spark.sql.autoBroadcastJoinThreshold`` can take twenty times as much as a hash table, which the driver would build."""
    return df.hint("merge")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` inner-joined with ``groups`` (one row per key; ``size``: its number of rows).

    Keys with more than 1/1000 of all rows are joined by broadcast: by counting there are fewer than
    1000 of them, whatever the input. All other keys meet in an ordinary shuffled join.
    Both inputs should be stored tables, since each is read twice."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_SHARE > F.lit(int(total))
    heavy = F.broadcast(groups.where(hot))
    rest = rows.join(F.broadcast(groups.where(hot).select(key)), key, "left_anti")
    return rows.join(heavy, key).unionByName(rest.join(shuffled(groups.where(~hot)), key))


def numbered(rows: DataFrame, group: str, key: list[str], out: str, n_rows: int, per_bucket: int = 1024) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... without gaps inside each ``group``, whatever the group's size.

    Rows are dealt to hash buckets of about ``per_bucket`` rows by ``key``; a window numbers each bucket,
    and running sums of the bucket counts (in two levels, so no task sees a long list) give its offset.
    The order inside a group is by bucket, then ``key``; rows equal in ``key`` are interchangeable."""
    buckets = max(1, math.ceil(n_rows / per_bucket))
    b = rows.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("long")).withColumn("_c", F.expr("_b div 1024"))
    fine = b.groupBy(group, "_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    coarse = fine.groupBy(group, "_c").agg(F.sum("_n").alias("_cn"))
    w = Window.partitionBy(group).orderBy("_c")
    coarse = coarse.select(group, "_c", F.coalesce(F.sum("_cn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_coff"))
    w = Window.partitionBy(group, "_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn("_foff", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    off = fine.join(coarse, [group, "_c"]).select(F.col(group).alias("_g"), F.col("_b").alias("_ob"), (F.col("_foff") + F.col("_coff")).alias("_off"))
    w = Window.partitionBy(group, "_b").orderBy(*key)
    n = b.withColumn("_r", F.row_number().over(w) - 1)
    return (n.join(off, n[group].eqNullSafe(off["_g"]) & (n["_b"] == off["_ob"]))
            .withColumn(out, (F.col("_off") + F.col("_r")).cast("long")).drop("_b", "_c", "_r", "_g", "_ob", "_off"))

"""Joins on a key of which one value may hold a large part of all rows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may get; keys with more are dealt to several tasks.
KEY_ROWS = 100_000
#: Up to so many heavy keys are broadcast.
BROADCAST_KEYS = 1_000_000


def salted_join(rows: DataFrame, side: DataFrame, key: str, salt: str, key_rows: int = KEY_ROWS) -> DataFrame:
    """``rows`` inner-joined with ``side`` on ``key``; ``side`` has few rows for each key.

    A key with more than ``key_rows`` rows in ``rows`` is dealt by the hash of ``salt`` to as many parts as it has multiples of
    them, and its rows of ``side`` are copied to each part. There are at most rows / key_rows such keys."""
    heavy = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > key_rows)
    heavy = heavy.select(F.col(key).alias("_heavy"), F.ceil(F.col("_n") / F.lit(key_rows)).cast("int").alias("_parts")).persist(StorageLevel.MEMORY_AND_DISK)
    n_heavy = heavy.count()
    if not n_heavy:
        return rows.join(side, key)
    heavy = F.broadcast(heavy) if n_heavy <= BROADCAST_KEYS else heavy

    def parts(df: DataFrame) -> DataFrame:
        return df.join(heavy, df[key] == F.col("_heavy"), "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop("_heavy")

    a = parts(rows).withColumn("_salt", F.pmod(F.xxhash64(salt), F.col("_parts")).cast("int")).drop("_parts")
    b = parts(side).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return a.join(b, [key, "_salt"]).drop("_salt")

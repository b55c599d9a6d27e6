"""Time-based splits of interactions (week ranges)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def week_range(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Rows with ``lo <= week_no <= hi`` (closed range)."""
    return df.filter(F.col("week_no").between(lo, hi))


def split_by_week(df: DataFrame, test_start: int) -> tuple[DataFrame, DataFrame]:
    """Train = weeks before ``test_start``, test = the rest."""
    return df.filter(F.col("week_no") < test_start), df.filter(F.col("week_no") >= test_start)


def split_two_level(df: DataFrame, level2_start: int, valid_start: int,
                    holdout: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Level-1 train (< level2_start), level-2 train [level2_start, valid_start), validation.

    ``holdout`` replaces the validation block with an external table of the same schema.
    """
    l1 = df.filter(F.col("week_no") < level2_start)
    l2 = df.filter((F.col("week_no") >= level2_start) & (F.col("week_no") < valid_start))
    val = holdout if holdout is not None else df.filter(F.col("week_no") >= valid_start)
    return l1, l2, val


def truth_table(df: DataFrame, price_col: str = "sales_value") -> DataFrame:
    """Distinct purchased (user, item) pairs with the money spent: ``user_id, item_id, spent``."""
    return df.groupBy("user_id", "item_id").agg(F.sum(price_col).alias("spent"))


def eval_users(train: DataFrame, test: DataFrame) -> DataFrame:
    """Users of the test block, flagged ``is_cold`` when they have no training history."""
    seen = train.select("user_id").distinct().withColumn("is_cold", F.lit(False))
    return (test.select("user_id").distinct().join(seen, "user_id", "left")
            .select("user_id", F.coalesce("is_cold", F.lit(True)).alias("is_cold")))

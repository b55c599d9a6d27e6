"""Per-group ranking and top-n.

Scores are compared after rounding to 9 decimals and ties go to the smaller id, so the order
does not depend on partitioning or on the last bits of a floating-point sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCORE_DECIMALS = 9


def score_order(score: str = "score", tie: str = "item_id", ascending: bool = False) -> list[Column]:
    s = F.round(F.col(score), SCORE_DECIMALS)
    return [s.asc() if ascending else s.desc(), F.col(tie).asc()]


def rank_within(df: DataFrame, by: str | Sequence[str] = "user_id", score: str = "score",
                tie: str = "item_id", out: str = "rank", ascending: bool = False) -> DataFrame:
    """Add ``out`` = 1, 2, ... per group ``by`` ordered by score (desc) then ``tie`` (asc)."""
    keys = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*keys).orderBy(*score_order(score, tie, ascending))
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def top_n(df: DataFrame, n: int, by: str | Sequence[str] = "user_id", score: str = "score",
          tie: str = "item_id", out: str = "rank", ascending: bool = False) -> DataFrame:
    """Keep the first ``n`` rows per group.

    ``row_number() <= n`` lets Spark insert a partial ``WindowGroupLimit`` before the shuffle, so a
    group with many rows is cut to ``n`` on the map side and a hot key never reaches one task whole.
    """
    return rank_within(df, by, score, tie, out, ascending).filter(F.col(out) <= n)


def rerank(df: DataFrame, by: str = "user_id", order_col: str = "rank", tie: str = "item_id",
           out: str = "rank") -> DataFrame:
    """Renumber 1..m per group keeping the existing order (e.g. after dropping items)."""
    w = Window.partitionBy(by).orderBy(F.col(order_col).asc(), F.col(tie).asc())
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def global_top(df: DataFrame, n: int, score: str = "score", tie: str = "item_id",
               out: str = "rank", ascending: bool = False) -> DataFrame:
    """Global top-n (``TakeOrderedAndProject``: each task keeps n rows, one task merges n x tasks)."""
    top = df.orderBy(*score_order(score, tie, ascending)).limit(n)
    w = Window.orderBy(*score_order(score, tie, ascending))
    # the window runs over at most n rows after the limit
    return top.withColumn(out, F.row_number().over(w).cast("bigint"))

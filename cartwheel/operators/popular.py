"""Popularity: per-item sales statistics, the global top-n list, and per-user popular lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import global_top

POPULARITY_MEASURES = ("count", "quantity", "sales", "users")


def item_popularity(inter: DataFrame) -> DataFrame:
    """``item_id, n_purchases, n_users, quantity, sales``.

    Distinct buyers are counted by grouping (item, user) first: both steps are hash aggregates
    with map-side combine, so a best-selling item is summed in pieces across tasks.
    """
    per_pair = inter.groupBy("item_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"), F.sum("sales_value").alias("s"))
    return per_pair.groupBy("item_id").agg(
        F.sum("n").cast("bigint").alias("n_purchases"),
        F.count(F.lit(1)).cast("bigint").alias("n_users"),
        F.sum("q").alias("quantity"),
        F.sum("s").alias("sales"))


def _measure(by: str) -> str:
    return {"count": "n_purchases", "quantity": "quantity", "sales": "sales", "users": "n_users"}[by]


def popular(inter: DataFrame, n: int, by: str = "count") -> DataFrame:
    """Top-n popular items: ``item_id, score, rank`` (ties to the smaller id)."""
    pop = item_popularity(inter).select("item_id", F.col(_measure(by)).cast("double").alias("score"))
    return global_top(pop, n)


def popular_list(inter: DataFrame, n: int, by: str = "count") -> list[tuple[int, float]]:
    """The top-n list on the driver: at most ``n`` rows, a size fixed by the caller."""
    return [(int(r["item_id"]), float(r["score"])) for r in popular(inter, n, by).orderBy("rank").collect()]


def recs_from_list(users: DataFrame, items: list[tuple[int, float]]) -> DataFrame:
    """Give every user the same ranked list (``user_id, item_id, rank, score``).

    The list is an inline literal of bounded size, expanded per user by a generator: no join, no
    shuffle, the users keep their partitioning.
    """
    if not items:
        return users.select("user_id").limit(0).select(
            "user_id", F.lit(None).cast("bigint").alias("item_id"),
            F.lit(None).cast("bigint").alias("rank"), F.lit(None).cast("double").alias("score"))
    lit = F.array(*[F.struct(F.lit(int(i)).cast("bigint").alias("item_id"),
                             F.lit(r + 1).cast("bigint").alias("rank"),
                             F.lit(float(s)).alias("score")) for r, (i, s) in enumerate(items)])
    return users.select("user_id", F.inline(lit))

"""Item prefilter: drop (or collapse to a fake id) items that make poor recommendations.

Rules, each optional, applied in this order:

1. bought by more than ``hi_share`` of all users (too obvious);
2. bought by fewer than ``lo_share`` of all users (too rare);
3. not sold in the last ``active_weeks`` weeks of the data;
4. mean unit price (sales / quantity) below ``min_price`` or above ``max_price``;
5. of the survivors keep the ``top_n`` by quantity sold.

``mode='drop'`` removes the interactions of failed items; ``mode='collapse'`` keeps them under
``fake_item_id`` so user histories keep their length (the fake id is removed from lists later).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY_SCALE, exact_money
from ..functions.prefix import global_row_number


MAX_BROADCAST_ITEMS = 1_000_000  # a top_n up to this many (id, flag) rows is sent to all tasks


def item_stats(inter: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    per_pair = inter.groupBy("item_id", "user_id").agg(
        F.sum("quantity").alias("q"), F.sum(exact_money("sales_value", scale)).alias("s"),
        F.max("week_no").alias("lw"))
    # money is summed exactly (DECIMAL) so ratios do not depend on summation order
    return per_pair.groupBy("item_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_users"), F.sum("q").alias("quantity"),
        F.sum("s").cast("double").alias("sales"), F.max("lw").alias("last_week"))


def kept_items(inter: DataFrame, top_n: int | None = None, lo_share: float | None = None,
               hi_share: float | None = None, active_weeks: int | None = None,
               min_price: float | None = None, max_price: float | None = None, scale: int = MONEY_SCALE) -> DataFrame:
    """Items passing every rule: ``item_id, n_users, quantity, unit_price, last_week, qty_rank``."""
    glob = inter.agg(F.countDistinct("user_id").alias("n"), F.max("week_no").alias("w")).collect()[0]
    n_users, max_week = int(glob["n"] or 0), int(glob["w"] or 0)
    st = item_stats(inter, scale).withColumn(
        "unit_price", F.when(F.col("quantity") != 0, F.col("sales") / F.col("quantity")))
    cond = F.lit(True)
    if hi_share is not None:
        cond = cond & (F.col("n_users") <= F.lit(hi_share * n_users))
    if lo_share is not None:
        cond = cond & (F.col("n_users") >= F.lit(lo_share * n_users))
    if active_weeks is not None:
        cond = cond & (F.col("last_week") > F.lit(max_week - active_weeks))
    if min_price is not None:
        cond = cond & (F.col("unit_price") >= F.lit(min_price))
    if max_price is not None:
        cond = cond & (F.col("unit_price") <= F.lit(max_price))
    kept = st.filter(cond).withColumn("_negq", -F.col("quantity"))
    # rank by quantity over the whole catalogue without a single-task window
    ranked = global_row_number(kept, ["_negq", "item_id"], out="qty_rank").drop("_negq")
    if top_n is not None:
        ranked = ranked.filter(F.col("qty_rank") <= top_n)
    return ranked.select("item_id", "n_users", "quantity", "unit_price", "last_week", "qty_rank")


def prefilter_items(inter: DataFrame, mode: str = "drop", fake_item_id: int = 999999, **rules) -> DataFrame:
    """Apply ``kept_items`` to the interactions (``mode`` = 'drop' or 'collapse')."""
    keep = kept_items(inter, **rules).select("item_id", F.lit(True).alias("_keep"))
    if (rules.get("top_n") or MAX_BROADCAST_ITEMS + 1) <= MAX_BROADCAST_ITEMS:
        keep = F.broadcast(keep)  # at most top_n rows: the interactions are not shuffled on a hot item
    if mode == "drop":
        return inter.join(keep, "item_id", "left_semi")
    if mode == "collapse":
        j = inter.join(keep, "item_id", "left")
        return j.withColumn("item_id", F.when(F.col("_keep"), F.col("item_id"))
                            .otherwise(F.lit(fake_item_id).cast("bigint"))).select(*inter.columns)
    raise ValueError(f"unknown mode {mode!r}")

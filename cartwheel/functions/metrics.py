"""Ranking metrics at k: Precision, Recall, Money Recall, MRR (reciprocal rank), nDCG and AP.

Definitions (per user; ``rel_r`` = 1 if the item at rank r is in the bought set B):

* precision@k  = sum_{r<=k} rel_r / k   (k even when the list is shorter)
* recall@k     = sum_{r<=k} rel_r / |B|
* ndcg@k       = sum_{r<=k} rel_r / log2(r+1)  /  sum_{r<=min(k,|B|)} 1 / log2(r+1)
* ap@k         = sum_{r<=k} rel_r * hits(<=r) / r  /  min(k, |B|)
* rr@k         = 1 / (first r <= k with rel_r = 1), else 0
* money_recall@k = sum_{r<=k} rel_r * price_r  /  sum_{b in B} price_b

A user with an empty B (or zero denominator) scores 0 for every metric. NaN or NULL prices count as
0 under ``nan_policy='zero'`` and poison the ratio under ``'propagate'``.

Two entry points give equal numbers:

* ``metrics_per_user(recs, truth, ks)`` -- long form (one row per recommendation / purchase). It
  needs one join and per-user aggregates with map-side combine; a user with a huge purchase history
  (``LIST_ROWS``) is summed in pieces rather than collected.
* ``with_metrics(lists, ks)`` -- list form (one row per user with array columns), computed with
  built-in higher-order functions, no Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Purchases of a user that are joined as one row.
LIST_ROWS = 20_000

METRICS = ("precision", "recall", "ndcg", "ap", "rr", "money_recall")


def _clean_price(c: Column, nan_policy: str) -> Column:
    if nan_policy == "zero":
        return F.nanvl(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0))
    if nan_policy == "propagate":
        return F.coalesce(c.cast("double"), F.lit(float("nan")))
    raise ValueError(f"unknown nan_policy {nan_policy!r}")


def _idcg(m: Column) -> Column:
    """sum_{r=1..m} 1/log2(r+1); 0 for m <= 0."""
    terms = F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(0.0),
                        lambda acc, r: acc + F.lit(1.0) / F.log2(r + F.lit(1)))
    return F.when(m > 0, terms).otherwise(F.lit(0.0))


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metrics_per_user(recs: DataFrame, truth: DataFrame, ks: Sequence[int],
                     prices: DataFrame | None = None, users: DataFrame | None = None,
                     nan_policy: str = "zero", rec_prices: DataFrame | None = None) -> DataFrame:
    """Per-user metrics for every k in ``ks``.

    recs   -- ``user_id, item_id, rank`` (rank 1..m, unique per user)
    truth  -- ``user_id, item_id`` distinct bought pairs
    prices -- optional ``item_id, price`` of bought items (without it Money Recall is NULL: not computed)
    rec_prices -- optional ``item_id, price`` of recommended items (default: ``prices``)
    users  -- optional ``user_id`` set to score (default: users present in truth)

    Returns ``user_id, k, n_hits, n_true`` and one column per metric.
    """
    ks = _check_ks(ks)
    truth_priced = _priced_truth(truth, prices)
    r = recs.filter(F.col("rank") <= ks[-1]).select("user_id", "item_id", "rank")
    # a hit is a bought item, so its price comes with the purchase row: one join gives both
    hits = _hits(r, truth, truth_priced)
    if rec_prices is not None:
        hits = hits.drop("price").join(rec_prices.select("item_id", "price"), "item_id", "left")
    return _from_hits(hits, truth_priced, ks, users, nan_policy, prices is not None)


def _hits(r: DataFrame, truth: DataFrame, truth_priced: DataFrame) -> DataFrame:
    """``r`` joined with the purchases on (user, item). A user's purchases are one row, so lists that are dealt by user stay where they are; with a
    history of more than ``LIST_ROWS`` items the rows meet pair by pair."""
    longest = truth.where("user_id IS NOT NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if longest > LIST_ROWS:
        return r.join(truth_priced, ["user_id", "item_id"])
    bought = truth_priced.where("item_id IS NOT NULL").groupBy("user_id").agg(
        F.collect_set("item_id").alias("_ids"), F.collect_list(F.struct("item_id", "price")).alias("_bought"))
    met = r.join(bought.hint("merge"), "user_id").where(F.array_contains("_ids", F.col("item_id")))
    same = F.filter("_bought", lambda b: b["item_id"] == F.col("item_id"))
    return met.select("user_id", "item_id", "rank", F.explode(same).alias("_b")).select("user_id", "item_id", "rank", F.col("_b.price").alias("price"))


def metrics_for_global_list(items: DataFrame, truth: DataFrame, ks: Sequence[int],
                            prices: DataFrame | None = None, users: DataFrame | None = None,
                            nan_policy: str = "zero") -> DataFrame:
    """Same as ``metrics_per_user`` when every user gets the same ranked list ``item_id, rank``
    (popularity). Hits come from joining the purchases with the list, broadcast (its length is
    bounded by max(ks)), so the users x list rows are never built."""
    ks = _check_ks(ks)
    truth_priced = _priced_truth(truth, prices)
    lst = items.filter(F.col("rank") <= ks[-1]).select("item_id", "rank")
    hits = truth_priced.join(F.broadcast(lst), "item_id")
    if users is not None:
        hits = hits.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return _from_hits(hits, truth_priced, ks, users, nan_policy, prices is not None)


def _check_ks(ks: Sequence[int]) -> list[int]:
    ks = sorted({int(k) for k in ks})
    if not ks or ks[0] < 1:
        raise ValueError("ks must be positive integers")
    return ks


def _priced_truth(truth: DataFrame, prices: DataFrame | None) -> DataFrame:
    """Distinct bought pairs with the item price (0 without a price table)."""
    pairs = truth.select("user_id", "item_id")
    if prices is None:
        return pairs.withColumn("price", F.lit(0.0))
    return pairs.join(prices.select("item_id", "price"), "item_id", "left")


def _from_hits(hits: DataFrame, truth_priced: DataFrame, ks: list[int], users: DataFrame | None,
               nan_policy: str, priced: bool) -> DataFrame:
    k_array = F.array(*[F.lit(k) for k in ks])
    hits = hits.withColumn("price", _clean_price(F.col("price"), nan_policy))
    # at most max_k hit rows per user: the window never sees an unbounded group
    hits = hits.withColumn(
        "hit_no", F.row_number().over(Window.partitionBy("user_id").orderBy("rank")))
    per_k = (hits.withColumn("k", F.explode(k_array)).filter(F.col("rank") <= F.col("k"))
             .groupBy("user_id", "k")
             .agg(F.count(F.lit(1)).alias("n_hits"),
                  F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1)).alias("dcg"),
                  F.sum(F.col("hit_no") / F.col("rank")).alias("ap_sum"),
                  F.min("rank").alias("first_hit"),
                  F.sum("price").alias("money_hit")))
    truth_stats = (truth_priced.withColumn("price", _clean_price(F.col("price"), nan_policy))
                   .groupBy("user_id")
                   .agg(F.count(F.lit(1)).alias("n_true"), F.sum("price").alias("money_true")))
    if users is None:
        base = truth_stats
    else:
        base = users.select("user_id").distinct().join(truth_stats, "user_id", "left")
    base = (base.withColumn("k", F.explode(k_array))
            .withColumn("n_true", F.coalesce("n_true", F.lit(0)).cast("bigint"))
            .withColumn("money_true", F.coalesce("money_true", F.lit(0.0))))
    j = base.join(per_k, ["user_id", "k"], "left")
    n_hits = F.coalesce("n_hits", F.lit(0)).cast("bigint")
    k = F.col("k")
    n_true = F.col("n_true")
    money_true = F.col("money_true")
    money_hit = F.coalesce("money_hit", F.lit(0.0))
    return j.select(
        "user_id", k.cast("int").alias("k"), n_hits.alias("n_hits"), n_true.alias("n_true"),
        F.when(n_true > 0, n_hits / k).otherwise(F.lit(0.0)).alias("precision"),
        _safe_div(n_hits.cast("double"), n_true).alias("recall"),
        F.when(n_true > 0, _safe_div(F.coalesce("dcg", F.lit(0.0)), _idcg(F.least(k, n_true))))
        .otherwise(F.lit(0.0)).alias("ndcg"),
        _safe_div(F.coalesce("ap_sum", F.lit(0.0)), F.least(k, n_true).cast("double")).alias("ap"),
        F.when((n_true > 0) & F.col("first_hit").isNotNull(), F.lit(1.0) / F.col("first_hit"))
        .otherwise(F.lit(0.0)).alias("rr"),
        (F.when(F.isnan(money_true) | F.isnan(money_hit), F.lit(float("nan")))
         .when(money_true != 0, money_hit / money_true).otherwise(F.lit(0.0)) if priced
         else F.lit(None).cast("double")).alias("money_recall"),
    )


def mean_metrics(per_user: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric per k (and any extra group columns): ``[group..], k, metric means``."""
    keys = list(group_cols) + ["k"]
    return per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_users"),
        *[F.avg(m).alias(m) for m in METRICS])


def long_metrics(means: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Unpivot mean metrics to ``[group..], metric, k, value``."""
    stack = ", ".join(f"'{m}', `{m}`" for m in METRICS)
    return means.selectExpr(*[f"`{c}`" for c in group_cols], "k",
                            f"stack({len(METRICS)}, {stack}) as (metric, value)")


# ---------------------------------------------------------------- list form (higher-order functions)

def with_metrics(lists: DataFrame, ks: Sequence[int], nan_policy: str = "zero",
                 rec_col: str = "recommended_list", bought_col: str = "bought_list",
                 rec_price_col: str = "prices_recommended",
                 bought_price_col: str = "prices_bought") -> DataFrame:
    """Append ``<metric>_at_<k>`` columns to a one-row-per-user list dataset.

    Arrays are handled by Spark's higher-order functions inside generated code; a NULL list is
    treated as empty. An item that a list repeats counts once, at its first place, and so does its price;
    NULL items count for nothing; a price missing beyond the end of a price list is a NULL price.
    """
    out = lists
    rec = F.coalesce(F.col(rec_col), F.array())
    bought = F.coalesce(F.col(bought_col), F.array())
    n_true = F.size(F.array_distinct(F.filter(bought, lambda x: x.isNotNull())))
    has_prices = rec_price_col in lists.columns and bought_price_col in lists.columns
    if has_prices:
        bought_prices = F.coalesce(F.col(bought_price_col), F.array())
        paid = F.transform(bought, lambda x, i: F.when(F.array_position(bought, x) == i + 1, _clean_price(F.get(bought_prices, i), nan_policy))
                           .otherwise(0.0))
        money_true = F.aggregate(paid, F.lit(0.0), lambda acc, p: acc + p)
    for k in sorted({int(k) for k in ks}):
        top = F.slice(rec, 1, k)
        # a hit is a bought item at its first place in the list
        flags = F.transform(top, lambda x, i: F.coalesce(F.array_contains(bought, x) & (F.array_position(top, x) == i + 1), F.lit(False)))
        n_hits = F.aggregate(flags, F.lit(0), lambda acc, f: acc + F.when(f, 1).otherwise(0))
        dcg = F.aggregate(
            F.transform(flags, lambda f, i: F.when(f, F.lit(1.0) / F.log2(i + F.lit(2))).otherwise(0.0)),
            F.lit(0.0), lambda acc, v: acc + v)
        ap_sum = F.aggregate(
            F.transform(flags, lambda f, i: F.when(
                f, F.size(F.filter(F.slice(flags, 1, i + 1), lambda g: g)) / (i + F.lit(1.0)))
                .otherwise(0.0)),
            F.lit(0.0), lambda acc, v: acc + v)
        first = F.array_position(flags, True)
        kk = F.lit(k)
        out = out.withColumn(f"precision_at_{k}", F.when(n_true > 0, n_hits / kk).otherwise(0.0))
        out = out.withColumn(f"recall_at_{k}", _safe_div(n_hits.cast("double"), n_true))
        out = out.withColumn(f"ndcg_at_{k}", F.when(n_true > 0, _safe_div(dcg, _idcg(F.least(kk, n_true))))
                             .otherwise(0.0))
        out = out.withColumn(f"ap_at_{k}", _safe_div(ap_sum, F.least(kk, n_true).cast("double")))
        out = out.withColumn(f"rr_at_{k}", F.when((n_true > 0) & (first > 0), F.lit(1.0) / first)
                             .otherwise(0.0))
        if has_prices:
            rp = F.coalesce(F.col(rec_price_col), F.array())
            money_hit = F.aggregate(
                F.transform(flags, lambda f, i: F.when(f, _clean_price(F.get(rp, i), nan_policy))
                            .otherwise(0.0)),
                F.lit(0.0), lambda acc, v: acc + v)
            out = out.withColumn(
                f"money_recall_at_{k}",
                F.when(F.isnan(money_true) | F.isnan(money_hit), F.lit(float("nan")))
                .when(money_true != 0, money_hit / money_true).otherwise(0.0))
    return out

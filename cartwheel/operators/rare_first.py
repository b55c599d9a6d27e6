"""Exact top-k cosine neighbours over shared keys, without the square of a best seller's buyers.

Users are alike by the items they share. An item with b buyers gives b^2 / 2 products in a plain self-join, so an item that a third of
all users bought would be the whole cost. Items are split by how many buyers they have:

1. Rare items come first: a self-join over them finds every pair of users that shares one, with the sum of its rare products.
2. The unseen rest of a pair is bounded by Cauchy-Schwarz: at most the product of the two users' norms over hot items. A pair
   stays only if that can lift it to the user's k-th best sum; what stays gets its exact sum over hot items.
3. A pair that shares hot items only has a similarity that depends on the two users' hot parts alone. Users with the same
   hot part are one class, of which the k + 1 smallest ids can be neighbours; classes meet in an exact maximum inner
   product search, and only for users whose k-th best is not above their hot norm already.

A pair left out of step 3's list has k others before it whose similarity is at least as large, so the lists are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import SCORE_DECIMALS, top_n
from ..functions.skew import salted_join
from ..session import ensure_checkpoint_dir
from .item_item import DEFAULT_BLOCK, blocked_pairs, cosine_neighbours
from .mips import exact_mips

#: A key shared by more than this part of all rows' owners is hot; there are at most (mean keys of an owner) / share of them.
HOT_SHARE = 0.02
_SLACK = 2 * 10.0 ** -SCORE_DECIMALS


def _dense(dim: int):
    @F.pandas_udf("array<double>")
    def run(entries: pd.Series) -> pd.Series:
        out = []
        for e in entries:
            v = np.zeros(dim)
            for x in e:
                v[x["ix"]] = x["w"]
            out.append(v)
        return pd.Series(out)
    return run


def rare_first_neighbours(mat: DataFrame, k: int, key: str = "item_id", other: str = "user_id", weight: str = "weight", hot_share: float = HOT_SHARE,
                          block: int = DEFAULT_BLOCK, out_id: str = "user_id", out_nb: str = "neighbour_id", trace: dict | None = None) -> DataFrame:
    """``<out_id>, <out_nb>, rank, sim``: the result of ``cosine_neighbours`` for non-negative weights.

    ``hot_share``: part of all ``other`` ids above which a key is hot. ``trace`` receives hot_keys, rare_pairs, kept_pairs,
    classes. Users whose weights are all zero have no neighbours."""
    ensure_checkpoint_dir(mat.sparkSession)
    mat = mat.select(key, other, F.col(weight).cast("double").alias("w")).where(F.col("w") > 0)
    norms = mat.groupBy(other).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    unit = mat.join(norms, other).select(key, other, (F.col("w") / F.col("_norm")).alias("w")).persist(StorageLevel.MEMORY_AND_DISK)
    n_other = norms.count()
    hot = [r[key] for r in unit.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_share * n_other).select(key).orderBy(key).collect()]
    if trace is not None:
        trace["hot_keys"] = len(hot)
    if not hot:
        return cosine_neighbours(unit, k, key, other, "w", block, out_id, out_nb)
    place = mat.sparkSession.createDataFrame(list(enumerate(hot)), f"ix int, {key} bigint")
    place = F.broadcast(place)  # bounded by the mean number of keys of an owner over the share
    parts = unit.join(place, key).groupBy(other).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("h"), F.array_sort(F.collect_list(F.struct("ix", "w"))).alias("e"))
    parts = parts.checkpoint(eager=True)

    # 1: rare pairs with the sum of their rare products
    rare = unit.join(place.select(key), key, "left_anti")
    pairs = blocked_pairs(rare, key, other, "w", block).groupBy("a", "b").agg(F.sum("p").alias("rare"))
    sums = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "rare").unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "rare"))
    sums = sums.checkpoint(eager=True)
    h = parts.select(other, "h")
    # 2: a pair is kept if its bound reaches the k-th best sum of rare products of its user
    least = top_n(sums, k, by="u", score="rare", tie="v").where(F.col("rank") == k).select("u", F.col("rare").alias("least"))
    wide = sums.join(h.select(F.col(other).alias("u"), F.col("h").alias("hu")), "u", "left").join(h.select(F.col(other).alias("v"), F.col("h").alias("hv")), "v", "left")
    bound = F.col("rare") + F.coalesce("hu", F.lit(0.0)) * F.coalesce("hv", F.lit(0.0))
    kept = wide.join(least, "u", "left").where(F.col("least").isNull() | (bound >= F.col("least") - _SLACK))
    entries = lambda c, e: parts.select(F.col(other).alias(c), F.col("e").alias(e))
    plain = kept.where("hu IS NULL OR hv IS NULL").select("u", "v", F.col("rare").alias("sim"))
    mixed = kept.where("hu IS NOT NULL AND hv IS NOT NULL").join(entries("u", "eu"), "u").join(entries("v", "ev"), "v")
    both = F.expr("aggregate(eu, 0D, (acc, x) -> acc + x.w * aggregate(filter(ev, y -> y.ix = x.ix), 0D, (s, y) -> s + y.w))")
    exact = plain.unionByName(mixed.select("u", "v", (F.col("rare") + both).alias("sim"))).checkpoint(eager=True)

    # 3: pairs over hot keys alone, class by class
    best = top_n(exact, k, by="u", score="sim", tie="v").where(F.col("rank") == k).select(F.col("u").alias(other), F.col("sim").alias("least"))
    members = parts.select(F.col(other).alias("v"), "e").withColumn("rank", F.row_number().over(Window.partitionBy("e").orderBy("v"))).where(F.col("rank") <= k + 1)
    members = members.checkpoint(eager=True)  # cut to k + 1 of a class before the shuffle
    first = members.where("rank = 1").select(F.col("v").alias("cls"), "e")
    vectors = first.select(F.col("cls").alias("id"), _dense(len(hot))("e").alias("vec")).checkpoint(eager=True)
    lists = members.join(first, "e").select("cls", "v")
    asking = parts.join(best, other, "left").where(F.col("least").isNull() | (F.col("h") >= F.col("least") - _SLACK))
    asking = salted_join(asking.select(F.col(other).alias("u"), "e"), first, "e", "u").select("u", "cls").checkpoint(eager=True)
    asked = vectors.join(asking.select(F.col("cls").alias("id")).distinct(), "id", "left_semi")
    if trace is not None:
        trace |= {"rare_pairs": sums.count() // 2, "kept_pairs": exact.count(), "classes": vectors.count(), "asked": asked.count()}
    near = exact_mips(asked, vectors, k + 1).where(F.col("score") > 0).select(F.col("qid").alias("cls"), F.col("cid").alias("near"), "score")
    near = near.join(lists.select(F.col("cls").alias("near"), "v"), "near")  # at most (k + 1)^2 rows a class
    near = top_n(near, k + 1, by="cls", tie="v").select("cls", "v", F.col("score").alias("sim"))
    alone = salted_join(asking, near, "cls", "u").where(F.col("u") != F.col("v")).select("u", "v", "sim")
    out = exact.unionByName(alone).groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return top_n(out, k, by="u", score="sim", tie="v").select(F.col("u").alias(out_id), F.col("v").alias(out_nb), "rank", "sim")

"""Paths the supplied tables do not reach: hot users in co-occurrence, ids beyond 32 bits."""

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.factor import IdIndex, fit_als
from cartwheel.operators.item_item import _blocked, cooccurrence


def test_hot_user_is_split_into_bounded_blocks(spark):
    # one user holds most rows; with block=8 no (user, block pair) join key may exceed 8 x 8 products
    rows = [(0, i, 1.0) for i in range(200)] + \
        [(u, i, 1.0) for u in range(1, 40) for i in (u % 50, (u + 1) % 50)]
    mat = spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")
    m = _blocked(mat, "user_id", "item_id", block=8).collect()
    hot = [r for r in m if r["user_id"] == 0]
    assert {r["_nb"] for r in hot} == {25}
    sizes = {}
    for r in hot:
        sizes[r["_blk"]] = sizes.get(r["_blk"], 0) + 1
    assert max(sizes.values()) <= 8 * 2  # hash blocks: about 8 rows each
    assert all(r["_nb"] == 1 for r in m if r["user_id"] != 0)
    # and the blocked sums equal the plain pair counts
    blocked = {(r["a"], r["b"]): r["dot"] for r in cooccurrence(mat, block=8).collect()}
    plain = {(r["a"], r["b"]): r["dot"] for r in cooccurrence(mat, block=10_000).collect()}
    assert blocked == plain
    assert blocked[(1, 2)] == 2.0   # the hot user and user 1
    assert blocked[(0, 1)] == 1.0   # the hot user only
    assert len(blocked) == 200 * 199 // 2


def test_wide_ids_are_reindexed_for_als(spark):
    base = 10 ** 12
    rows = [(base + u, base * 2 + i, 1.0) for u in range(12) for i in range(8) if (u + i) % 3]
    mat = spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")
    idx = IdIndex.fit(mat, "user_id")
    assert idx.table is not None
    enc = idx.encode(mat).select("user_id_idx").distinct().collect()
    assert sorted(r["user_id_idx"] for r in enc) == list(range(1, 13))
    rec = fit_als(mat, factors=3, iterations=2, seed=1)
    out = rec.recommend(mat.select("user_id").distinct(), 2).collect()
    assert {r["user_id"] for r in out} == {base + u for u in range(12)}
    assert all(r["item_id"] >= base * 2 for r in out)

"""Exact and approximate similarity search against brute force: inner products, rare items first, hash tables, skewed joins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.functions.skew import salted_join
from cartwheel.operators.factor import fit_als, similar_from_factors
from cartwheel.operators.item_item import blocked_pairs, cosine_neighbours, item_item_neighbours, item_item_scores
from cartwheel.operators.lsh import lsh_knn
from cartwheel.operators.mips import best_per_row, exact_mips
from cartwheel.operators.rare_first import rare_first_neighbours
from cartwheel.operators.vectors import similar_vectors


def _frame(spark, rows, name="vec"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"id long, {name} array<double>")


def _brute(q, c, k, seen=frozenset()):
    out = {}
    for a, x in q:
        s = sorted((-round(float(np.dot(x, y)), 9), b) for b, y in c if (a, b) not in seen)
        out[a] = [b for _, b in s[:k]]
    return out


def _lists(df, a="qid", b="cid"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r[a], []).append(r[b])
    return out


def test_best_per_row_keeps_ties_in_order():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, -np.inf], [-np.inf] * 5, [2.0, 2.0, 2.0, 2.0, 2.0]])
    row, col = best_per_row(scores, np.array([9, 7, 5, 6, 1]), 2)
    assert list(zip(row, col)) == [(0, 2), (0, 3), (2, 4), (2, 2)]


@pytest.mark.parametrize("block", [3, 10, 2048])
def test_inner_products_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    q = [(i, rng.normal(size=4)) for i in range(40)] + [(40, np.zeros(4)), (41, np.ones(4)), (10 ** 12, np.ones(4))]
    c = [(i, rng.normal(size=4) * rng.exponential()) for i in range(100)] + [(200 + i, np.ones(4)) for i in range(8)] + [(300, np.zeros(4))]
    seen = {(a, b) for a, _ in q[:20] for b, _ in c if (a + b) % 3 == 0} | {(41, b) for b, _ in c}
    table = spark.createDataFrame(sorted(seen) + [(1, 5), (7, 9999)], "id long, cid long")
    got = exact_mips(_frame(spark, q + [(77, None)]), _frame(spark, [*c, (500, None)]).withColumnRenamed("id", "cid"), 6, c_id="cid", seen=table.distinct(), block_rows=block)
    want = _brute(q, c, 6, seen | {(1, 5)})
    assert _lists(got) == {a: x for a, x in want.items() if x}


def test_blocks_that_cannot_win_are_not_visited(spark):
    rng = np.random.default_rng(1)
    c = [(i, rng.normal(size=3) * (100 if i < 40 else 0.01)) for i in range(400)]
    q = [(i, rng.normal(size=3)) for i in range(30)]
    trace = []
    got = exact_mips(_frame(spark, q), _frame(spark, c), 3, block_rows=20, trace=trace)
    assert _lists(got) == _brute(q, c, 3)
    assert trace[0] == (0, 1, 30) and max(hi for _, hi, _ in trace) <= 7  # of 20 blocks
    assert exact_mips(_frame(spark, q), _frame(spark, c).limit(0), 3).count() == 0
    assert exact_mips(_frame(spark, q).limit(0), _frame(spark, c), 3).count() == 0


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(4)
    rows = {(int(u), int(i)) for u, i in zip(rng.integers(0, 120, 1500), rng.integers(0, 90, 1500))}
    return spark.createDataFrame([(u, i, 1.0) for u, i in sorted(rows)], "user_id bigint, item_id bigint, weight double").persist()


def test_als_lists_equal_the_models_own(spark, matrix):
    als = fit_als(matrix, factors=5, iterations=3, seed=3)
    users = matrix.select("user_id").distinct()
    seen = {(r.user_id, r.item_id) for r in matrix.collect()}
    u = als.users.table.collect()
    names, items = {r.user_id_idx: r.user_id for r in u}, {r.item_id_idx: r.item_id for r in als.items.table.collect()}
    whole = {names[r.user_id_idx]: [(items[x.item_id_idx], x.rating) for x in r.recommendations] for r in als.model.recommendForUserSubset(als.users.table.select("user_id_idx"), 1000).collect()}
    for exclude in (False, True):
        got = als.recommend(users, 7, exclude_seen=exclude)
        scores = {(r.user_id, r.item_id): r.score for r in got.collect()}
        for user, mine in _lists(got, "user_id", "item_id").items():
            want = [(i, s) for i, s in whole[user] if not exclude or (user, i) not in seen][:7]
            assert len(mine) == 7 and not (exclude and any((user, i) in seen for i in mine))
            # single precision there, double here: equal up to near ties
            assert np.allclose([scores[user, i] for i in mine], [s for _, s in want], atol=1e-5)


def test_one_long_history_does_not_lengthen_other_lists(spark, matrix):
    items = matrix.select("item_id").distinct()
    long = matrix.unionByName(items.select(F.lit(999).cast("bigint").alias("user_id"), "item_id", F.lit(1.0).alias("weight")))
    got = _lists(fit_als(long, factors=4, iterations=2, seed=1).recommend(long.select("user_id").distinct(), 5, exclude_seen=True), "user_id", "item_id")
    assert 999 not in got and all(len(x) == 5 for x in got.values())


def _planted(spark, users=400, items=300, seed=2):
    """A best seller that two thirds of the users bought, a second one, and users who bought nothing else."""
    rng = np.random.default_rng(seed)
    rows = {(int(u), int(i)) for u, i in zip(rng.integers(0, users, 6 * users), rng.integers(2, items, 6 * users))}
    rows |= {(u, 0) for u in range(users) if u % 3} | {(u, 1) for u in range(0, users, 4)} | {(users + u, 0) for u in range(40)}
    return spark.createDataFrame([(u, i, 1.0 + (u * 7 + i) % 3) for u, i in sorted(rows)], "user_id bigint, item_id bigint, weight double")


@pytest.mark.parametrize("binary", [True, False])
def test_rare_first_equals_the_plain_join_at_a_fraction_of_its_pairs(spark, binary):
    mat = _planted(spark)
    mat = (mat.withColumn("weight", F.lit(1.0)) if binary else mat).persist()
    trace = {}
    got = rare_first_neighbours(mat, 5, hot_share=0.1, trace=trace)
    want = cosine_neighbours(mat, 5, "item_id", "user_id", out_id="user_id")
    rows = lambda df: {(r.user_id, r["rank"]): (r.neighbour_id, round(r.sim, 6)) for r in df.collect()}
    assert rows(got) == rows(want)
    buyers = [r["count"] for r in mat.groupBy("item_id").count().collect()]
    assert trace["hot_keys"] == 2 and trace["rare_pairs"] < 0.25 * sum(b * (b - 1) // 2 for b in buyers)
    assert trace["classes"] < 440


def test_rare_first_without_hot_items_and_without_rows(spark, matrix):
    plain = cosine_neighbours(matrix, 3, "item_id", "user_id", out_id="user_id")
    key = lambda df: sorted((r.user_id, r["rank"], r.neighbour_id, round(r.sim, 9)) for r in df.collect())
    assert key(rare_first_neighbours(matrix, 3, hot_share=1.0)) == key(plain)
    assert key(rare_first_neighbours(matrix, 3, hot_share=0.0)) == key(plain)  # all items hot
    assert rare_first_neighbours(matrix.limit(0), 3).count() == 0


def test_products_of_a_join_key_are_bounded(spark):
    """Counted on the join itself: one user with 3,000 items, others with few."""
    rows = [(0, i, 1.0) for i in range(3000)] + [(u, (u * 13 + k) % 3000, 1.0) for u in range(1, 200) for k in range(5)]
    mat = spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")
    pairs = blocked_pairs(mat, block=100)
    assert pairs.count() == 3000 * 2999 // 2 + 199 * 10
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2  # only the heavy rows are copied; light rows join as they are


def test_salted_join_spreads_a_hot_key(spark):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("key"))
    side = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (3, None), (None, "d")], "key bigint, x string")
    got = salted_join(rows, side, "key", "id", key_rows=100)
    want = rows.join(side, "key")
    assert sorted(map(tuple, got.select("id", "key", "x").collect()), key=str) == sorted(map(tuple, want.select("id", "key", "x").collect()), key=str)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()


def test_item_item_scores_with_a_best_seller(spark, monkeypatch):
    mat = _planted(spark, 120, 80)
    nb = item_item_neighbours(mat, 5)
    plain = {(r.user_id, r.item_id): round(r.score, 9) for r in item_item_scores(mat, nb).collect()}
    monkeypatch.setattr("cartwheel.functions.skew.salted_join.__defaults__", (10,))
    assert {(r.user_id, r.item_id): round(r.score, 9) for r in item_item_scores(mat, nb).collect()} == plain


def test_hash_tables_find_near_vectors_and_copies(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    vectors = [(i, centres[i % 40] + 0.1 * rng.normal(size=16)) for i in range(800)] + [(1000 + i, np.ones(16)) for i in range(300)] + [(2000, np.zeros(16)), (2001, np.zeros(16)), (3000, None)]
    table = _frame(spark, vectors, "v")
    trace = {}
    got = _lists(lsh_knn(table, 5, "id", "v", bucket=0.2, trace=trace), "id", "neighbour_id")
    exact = _lists(similar_vectors(table.where("v IS NOT NULL"), 5, "id", "v"), "id", "neighbour_id")
    assert sum(len(set(got.get(i, [])) & set(x)) for i, x in exact.items() if i < 2000) >= 0.9 * sum(len(x) for i, x in exact.items() if i < 2000)
    assert got[1000] == [1001, 1002, 1003, 1004, 1005] and got[1299] == [1000, 1001, 1002, 1003, 1004]
    assert trace["points"] == 802 and trace["pairs"] < 0.25 * trace["all_pairs"]  # copies make no pairs
    assert lsh_knn(table.limit(0), 5, "id", "v").count() == 0


def test_factor_space_neighbours_in_both_modes(spark, matrix):
    als = fit_als(matrix, factors=5, iterations=3, seed=3)
    exact, near = (_lists(similar_from_factors(als, 4, "user", m), "user_id", "neighbour_id") for m in ("exact", "lsh"))
    assert sum(len(set(near.get(u, [])) & set(x)) for u, x in exact.items()) >= 0.9 * sum(map(len, exact.values()))
    with pytest.raises(ValueError):
        similar_from_factors(als, 4, "user", "nope")

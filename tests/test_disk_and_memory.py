"""What stays on disk and what the driver builds: shuffle files end with their step, growing tables are sent few times."""

import re

import numpy as np
from pyspark.sql import functions as F

from cartwheel.functions.metrics import metrics_per_user
from cartwheel.operators import mips
from cartwheel.operators.factor import fit_als
from cartwheel.operators.features import feature_frame, pair_features
from cartwheel.operators.item_item import cosine_neighbours, item_item_recs
from cartwheel.operators.lsh import lsh_knn
from cartwheel.plans.evaluation import compare, generator_recall
from cartwheel.session import settled, stored


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def _matrix(spark, users=40, items=25):
    rng = np.random.default_rng(3)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, users, 400), rng.integers(0, items, 400))})
    return spark.createDataFrame([(u, i, 1.0 + (u * i) % 3) for u, i in rows], "user_id bigint, item_id bigint, weight double")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_kept_tables_leave_no_shuffle_files_and_are_not_broadcast(spark):
    mat = _matrix(spark)
    made = mat.groupBy("user_id").agg(F.sum("weight").alias("w"))  # planned before the setting is made
    before = _shuffle_files(spark)
    for keep in (stored, settled):
        kept = keep(made)
        assert _rows(kept) == _rows(mat.groupBy("user_id").agg(F.sum("weight").alias("w")).coalesce(1)) and kept.columns == made.columns
    files = _shuffle_files(spark)
    stored(made), settled(made)
    assert _shuffle_files(spark) == files >= before
    assert "Broadcast" not in _plan(mat.join(stored(made), "user_id"))


def test_reports_score_one_list_after_the_other(spark):
    truth = spark.createDataFrame([(u, i) for u in range(9) for i in range(u % 3 + 1)], "user_id bigint, item_id bigint")
    users = truth.select("user_id").distinct()
    lists = {n: spark.createDataFrame([(u, (u + n) % 4, 1, 1.0) for u in range(9)], "user_id bigint, item_id bigint, rank bigint, score double") for n in range(3)}
    for report in (compare({str(n): (x, False) for n, x in lists.items()}, truth, (1, 2), users),
                   generator_recall({str(n): x for n, x in lists.items()}, truth, (1, 2), users)):
        assert "Exchange" not in _plan(report) and report.count() == 6  # nothing of the lists' plans is left


def test_waves_give_the_same_neighbours_and_lists(spark):
    mat = _matrix(spark)
    one = cosine_neighbours(mat, 5, group_products=50)
    many = cosine_neighbours(mat, 5, group_products=50, waves=4)
    assert _rows(one) == _rows(many)
    cut = cosine_neighbours(mat, 5, block=4, group_products=50, item_rows=6, waves=3)
    assert _rows(cut) == _rows(one)
    nb = stored(one)
    extra = mat.unionByName(spark.createDataFrame([(None, 1, 1.0), (None, 2, 1.0)], mat.schema))
    for users in (None, mat.where("user_id % 3 > 0").select("user_id")):
        assert _rows(item_item_recs(extra, nb, 2, users, wave_rows=100)) == _rows(item_item_recs(extra, nb, 2, users))


def test_candidates_travel_once_by_item_and_once_by_user(spark):
    hist = spark.createDataFrame([(1, 10, 7, 3, 2.0, 20.0), (1, 11, 8, 4, 1.0, 30.0), (1, 12, None, 4, 1.0, 5.0), (2, 13, 8, 5, 1.0, 28.0)],
                                 "user_id bigint, basket_id bigint, item_id bigint, week_no int, quantity double, sales_value double")
    types = spark.createDataFrame([(7, "a"), (8, "b"), (8, "b"), (9, None)], "item_id bigint, type string")  # an item with two rows
    cands = spark.createDataFrame([(1, 7, 0.5, 1), (1, 7, 0.5, 1), (1, 8, 0.25, 2), (1, 9, 0.1, 3), (3, 8, 0.5, 1), (1, None, 0.1, 4)],
                                  "user_id bigint, item_id bigint, score double, rank bigint")
    got = pair_features(cands, hist, types, 10)
    # user 1 has spent 20 on a, 2 x 30 on b (two rows), 5 on no type, for 2 + 2 + 1 units
    price = 85 / 5
    want = [(1, 7, 1, 7, 20 / 85, 10 - price, 0.5, 1)] * 2 + [(1, 8, 1, 6, 60 / 85, 29 - price, 0.25, 2)] * 2 \
        + [(1, 9, 0, -1, 0.0, 0.0, 0.1, 3)] + [(3, 8, 0, -1, 0.0, 0.0, 0.5, 1)] * 2
    rows = _rows(got.where("item_id IS NOT NULL"))
    assert rows == sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in want), key=str)
    assert [tuple(r)[2:4] for r in got.where("item_id IS NULL").collect()] == [(0, -1)]
    big = lambda df: df.hint("merge")
    plan = _plan(pair_features(big(cands), big(hist), big(types), 10))
    assert not re.search(r"hashpartitioning\(user_id#\w+, (item_id|type)", plan)
    # candidates of an item with two rows in the item table are repeated, its purchases are not
    items = spark.createDataFrame([(7, 1), (8, 1), (8, 1)], "item_id bigint, one int").select(
        "item_id", *[F.col("one").cast("double").alias(c) for c in ("n_buyers", "units_per_week", "mean_price", "price_share_in_type", "repeat_rate")])
    x = feature_frame(cands, hist, types, 10, item_table=items)[0]
    assert sorted(r[0] for r in x.where("user_id = 1 AND item_id IS NOT NULL").select(F.round("type_spend_share", 6)).collect()) == \
        sorted(round(s, 6) for s in [20 / 85] * 2 + [60 / 85] * 4 + [0.0])


def test_lists_dealt_by_user_stay_where_they_are(spark):
    truth = spark.createDataFrame([(u, i) for u in range(6) for i in range(u)], "user_id bigint, item_id bigint")
    recs = spark.createDataFrame([(u, 2 * r, r + 1) for u in range(6) for r in range(3)], "user_id bigint, item_id bigint, rank bigint")
    prices = spark.createDataFrame([(0, 1.0), (2, 5.0), (2, 7.0), (4, None)], "item_id bigint, price double")  # an item with two prices
    got = metrics_per_user(recs.repartition("user_id"), truth, (1, 3), prices=prices)
    assert not re.search(r"hashpartitioning\(user_id#\w+, item_id", _plan(got))
    hits = {(r["user_id"], r["k"]): r["n_hits"] for r in got.collect()}
    want = {(u, k): sum((2 if i == 2 else 1) for i in (0, 2, 4)[:k] if i < u) for u in range(1, 6) for k in (1, 3)}
    assert hits == want


def test_solver_has_a_block_for_so_many_weights(spark):
    mat = _matrix(spark)
    n = mat.count()
    assert fit_als(mat, factors=2, iterations=2).model.userFactors.rdd.getNumPartitions() == 10
    assert fit_als(mat, factors=2, iterations=2, block_ratings=n // 14).model.userFactors.rdd.getNumPartitions() > 13


def test_tables_of_a_search_may_come_in_waves(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(80, 6))
    v[40:44] = v[3]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    assert _rows(lsh_knn(table, 3, wave_rows=100)) == _rows(lsh_knn(table, 3))


def test_products_nearer_than_single_precision_are_told_apart():
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    c = base + 1e-8 * rng.normal(size=(5000, 8))
    q = np.vstack([base, base * 1e-9, np.zeros(8), -base])
    ids = rng.permutation(5000)
    scores = np.round(q @ c.T, 9)
    row, name, value = mips.best_products(q, c, ids, 6)
    for r in range(4):
        best = sorted(zip(-scores[r], ids))[:6]
        assert [-s for s, _ in best] == list(np.round(value[row == r], 9)) and [i for _, i in best] == list(name[row == r])

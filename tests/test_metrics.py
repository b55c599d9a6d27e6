"""Hand-worked metric values (FIXTURES.md section A), long form = list form = Spark's evaluator."""

import math

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from cartwheel.functions.metrics import mean_metrics, metrics_per_user, with_metrics
from cartwheel.sources.lists import lists_to_long

NAN = float("nan")
ROWS = [
    (1, [1, 2, 3, 4, 5], [2, 5, 9], [10.0, 20.0, 30.0, 40.0, 50.0], [20.0, 50.0, NAN]),
    (2, [1, 2], [7], [10.0, 20.0], [70.0]),
    (3, [3], [3, 4, 5, 6, 7, 8], [30.0], [30.0, 40.0, 50.0, 60.0, 70.0, 80.0]),
    (4, [1], [], [10.0], []),
]
SCHEMA = ("user_id bigint, recommended_list array<bigint>, bought_list array<bigint>, "
          "prices_recommended array<double>, prices_bought array<double>")

EXPECTED = {  # (k, user): precision, recall, ndcg, ap, rr, money_recall
    (3, 1): (0.333333, 0.333333, 0.296082, 0.166667, 0.5, 0.285714),
    (3, 2): (0, 0, 0, 0, 0, 0),
    (3, 3): (0.333333, 0.166667, 0.469279, 0.333333, 1.0, 0.090909),
    (3, 4): (0, 0, 0, 0, 0, 0),
    (5, 1): (0.4, 0.666667, 0.477624, 0.3, 0.5, 1.0),
    (5, 3): (0.2, 0.166667, 0.339160, 0.2, 1.0, 0.090909),
}
MEANS_K3 = (0.166667, 0.125, 0.191340, 0.125, 0.375, 0.094156)
NAMES = ("precision", "recall", "ndcg", "ap", "rr", "money_recall")


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _long(lists):
    recs = lists_to_long(lists).select("user_id", "item_id", "rank")
    truth = lists.select("user_id", F.explode(F.arrays_zip(F.col("bought_list").alias("item_id"),
                                                           F.col("prices_bought").alias("price"))).alias("z"))
    truth = truth.select("user_id", "z.item_id", "z.price")
    # prices per item (the fixture's prices are consistent per item)
    prices = (lists_to_long(lists).select("item_id", "price")
              .unionByName(truth.select("item_id", "price")).groupBy("item_id").agg(F.max("price").alias("price")))
    return recs, truth.select("user_id", "item_id"), prices


def test_list_form_matches_hand_values(lists):
    out = with_metrics(lists, (3, 5)).collect()
    by_user = {r["user_id"]: r for r in out}
    for (k, u), exp in EXPECTED.items():
        got = [by_user[u][f"{m}_at_{k}"] for m in NAMES]
        assert got == pytest.approx(exp, abs=1e-6), (k, u, got)


def test_long_form_matches_hand_values(spark, lists):
    recs, truth, _ = _long(lists)
    # money recall in long form uses a per-item price table; the NaN price of item 9 counts as 0
    prices = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, 40.0), (5, 50.0), (6, 60.0), (7, 70.0),
                                    (8, 80.0), (9, NAN)], "item_id bigint, price double")
    users = lists.select("user_id")
    per = metrics_per_user(recs, truth, (3, 5), prices=prices, users=users).collect()
    got = {(r["k"], r["user_id"]): tuple(r[m] for m in NAMES) for r in per}
    for key, exp in EXPECTED.items():
        if key[1] == 2 and key[0] == 3:
            # user 2 bought item 7 priced 70: no hit, every metric 0
            pass
        assert got[key] == pytest.approx(exp, abs=1e-6), (key, got[key])
    means = {r["k"]: r for r in mean_metrics(
        metrics_per_user(recs, truth, (3,), prices=prices, users=users)).collect()}
    assert tuple(means[3][m] for m in NAMES) == pytest.approx(MEANS_K3, abs=1e-6)


def test_nan_propagate(lists):
    out = {r["user_id"]: r for r in with_metrics(lists, (3,), nan_policy="propagate").collect()}
    assert math.isnan(out[1]["money_recall_at_3"])
    assert out[3]["money_recall_at_3"] == pytest.approx(0.090909, abs=1e-6)


def test_agrees_with_ranking_evaluator(spark, lists):
    data = lists.select(F.col("recommended_list").cast("array<double>").alias("prediction"),
                        F.col("bought_list").cast("array<double>").alias("label"))
    ours = {r["user_id"]: r for r in with_metrics(lists, (3,)).collect()}
    n = len(ours)
    for metric, col in (("precisionAtK", "precision_at_3"), ("recallAtK", "recall_at_3"),
                        ("ndcgAtK", "ndcg_at_3"), ("meanAveragePrecisionAtK", "ap_at_3")):
        ev = RankingEvaluator(metricName=metric, k=3).evaluate(data)
        mean = sum(r[col] for r in ours.values()) / n
        assert ev == pytest.approx(mean, abs=1e-9), metric


def test_recall_never_falls_with_k(spark):
    recs = spark.createDataFrame([(1, i, i) for i in range(1, 11)], "user_id bigint, item_id bigint, rank bigint")
    truth = spark.createDataFrame([(1, 2), (1, 7), (1, 30)], "user_id bigint, item_id bigint")
    per = sorted(metrics_per_user(recs, truth, (1, 2, 5, 10)).collect(), key=lambda r: r["k"])
    recalls = [r["recall"] for r in per]
    assert recalls == sorted(recalls)
    assert all(0 <= r[m] <= 1 for r in per for m in NAMES if m != "money_recall")  # NULL without prices


def test_long_form_equals_list_form_on_random_lists(spark):
    import random
    rnd = random.Random(11)
    price = {i: float(rnd.randint(1, 500)) for i in range(40)}
    price[7] = NAN
    rows = []
    for u in range(120):
        rec = rnd.sample(range(40), rnd.randint(0, 12))
        bought = rnd.sample(range(40), rnd.randint(0, 8))
        rows.append((u, rec, bought, [price[i] for i in rec], [price[i] for i in bought]))
    lists = spark.createDataFrame(rows, SCHEMA)
    ks = (1, 3, 5, 10)
    wide = {r["user_id"]: r for r in with_metrics(lists, ks).collect()}
    recs = lists_to_long(lists).select("user_id", "item_id", "rank")
    truth = lists.select("user_id", F.explode("bought_list").alias("item_id"))
    prices = spark.createDataFrame(list(price.items()), "item_id bigint, price double")
    long = metrics_per_user(recs, truth, ks, prices=prices, users=lists.select("user_id")).collect()
    assert len(long) == 120 * len(ks)
    for r in long:
        for m in NAMES:
            assert r[m] == pytest.approx(wide[r["user_id"]][f"{m}_at_{r['k']}"], abs=1e-12), (r["user_id"], m)

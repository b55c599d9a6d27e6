"""Item-item, popularity, weighting on the hand-worked fixture (FIXTURES.md section C)."""

import math

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.weights import binary_matrix, bm25, tfidf
from cartwheel.operators.item_item import cooccurrence, item_item_neighbours, item_item_recs
from cartwheel.operators.popular import popular, popular_list
from cartwheel.operators.postprocess import fill_popular, top_without

PAIRS = [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1), (3, 3), (4, 4)]


@pytest.fixture(scope="module")
def inter(spark):
    rows = [(u, 100 * u + i, i, 1, 1.0, 1.0) for u, i in PAIRS]
    return spark.createDataFrame(rows, "user_id bigint, basket_id bigint, item_id bigint, week_no int, "
                                       "quantity double, sales_value double")


def test_cosine_neighbours(inter):
    nb = {(r["item_id"], r["neighbour_id"]): r["sim"] for r in item_item_neighbours(binary_matrix(inter), 5).collect()}
    assert nb[(1, 2)] == pytest.approx(2 / math.sqrt(6))
    assert nb[(1, 3)] == pytest.approx(2 / math.sqrt(6))
    assert nb[(2, 3)] == pytest.approx(0.5)
    assert not any(4 in key for key in nb)


def test_item_item_recs(inter):
    mat = binary_matrix(inter)
    recs = item_item_recs(mat, item_item_neighbours(mat, 5), 5).collect()
    got = {(r["user_id"], r["item_id"]): r["score"] for r in recs}
    assert got == pytest.approx({(1, 3): 0.5 + 2 / math.sqrt(6), (3, 2): 0.5 + 2 / math.sqrt(6)})


def test_blocked_cooccurrence_equals_unblocked(spark):
    rows = [(u, i, 1.0) for u in range(6) for i in range(u, u + 40) if (u * 7 + i) % 3]
    mat = spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")
    a = {(r["a"], r["b"]): r["dot"] for r in cooccurrence(mat, block=1000).collect()}
    b = {(r["a"], r["b"]): r["dot"] for r in cooccurrence(mat, block=3).collect()}
    assert a == b and len(a) > 100


def test_popular_and_fill(spark, inter):
    assert [r["item_id"] for r in popular(inter, 4).orderBy("rank").collect()] == [1, 2, 3, 4]
    pop = [i for i, _ in popular_list(inter, 3)]
    mat = binary_matrix(inter)
    recs = item_item_recs(mat, item_item_neighbours(mat, 5), 3)
    users = inter.select("user_id").distinct()
    filled = fill_popular(recs, users, pop, 3).collect()
    lists = {}
    for r in sorted(filled, key=lambda r: (r["user_id"], r["rank"])):
        lists.setdefault(r["user_id"], []).append(r["item_id"])
    assert lists[4] == [1, 2, 3]
    assert lists[1] == [3, 1, 2]
    assert all(len(v) == 3 and len(set(v)) == 3 for v in lists.values())


def test_tfidf_bm25(inter):
    mat = binary_matrix(inter)
    tf = {(r["user_id"], r["item_id"]): r["weight"] for r in tfidf(mat).collect()}
    assert tf[(1, 1)] == pytest.approx(0.223144, abs=1e-6)
    assert tf[(1, 2)] == pytest.approx(0.510826, abs=1e-6)
    assert tf[(4, 4)] == pytest.approx(0.916291, abs=1e-6)
    bm = {(r["user_id"], r["item_id"]): r["weight"] for r in bm25(mat).collect()}
    assert bm[(1, 1)] == pytest.approx(0.356675, abs=1e-6)


def test_top_without_fake(spark):
    rows = [(1, i, r + 1) for r, i in enumerate([10, 999999, 11, 12, 13, 14])] + \
           [(2, i, r + 1) for r, i in enumerate([10, 11, 12, 13, 14, 15])]
    recs = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rank bigint")
    out = top_without(recs, 6, [999999], 5).orderBy("user_id", "rank").collect()
    lists = {}
    for r in out:
        lists.setdefault(r["user_id"], []).append(r["item_id"])
    assert lists == {1: [10, 11, 12, 13, 14], 2: [10, 11, 12, 13, 14]}
    assert [r["rank"] for r in out if r["user_id"] == 1] == [1, 2, 3, 4, 5]


def test_recommender_facade(spark, inter):
    from cartwheel.plans.recommender import Recommender
    rec = Recommender(method="item_item", k_neighbours=5).fit(inter)
    out = rec.recommend(n=3).collect()
    per = {}
    for r in out:
        per.setdefault(r["user_id"], []).append(r["item_id"])
    assert set(per) == {1, 2, 3, 4} and all(len(v) == 3 for v in per.values())
    one = rec.recommend_for_user(1, 3).orderBy("rank").collect()
    assert [r["item_id"] for r in one] == [3, 1, 2]

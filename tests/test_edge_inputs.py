"""Legal inputs outside the supplied tables, worked by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.metrics import metrics_per_user, with_metrics
from cartwheel.functions.money import money_sum
from cartwheel.functions.prefix import global_cumsum, global_row_number
from cartwheel.functions.weights import weigh
from cartwheel.operators.factor import fit_als
from cartwheel.operators.features import feature_frame, user_features
from cartwheel.operators.hybrid import fit_hybrid_fm, negative_pairs
from cartwheel.operators.item_item import _blocked
from cartwheel.operators.prefilter import kept_items
from cartwheel.plans.recommender import Recommender
from cartwheel.plans.selection import param_grid
from cartwheel.sources.csv_table import read_csv_table
from cartwheel.sources.retail import interactions_from_csv

LISTS = "user_id bigint, recommended_list array<bigint>, bought_list array<bigint>, prices_recommended array<double>, prices_bought array<double>"


def _lists(spark, *rows):
    return {r["user_id"]: r for r in with_metrics(spark.createDataFrame(rows, LISTS), (3,)).collect()}


def test_repeated_items_hit_once(spark):
    r = _lists(spark, (1, [1, 1, 2], [1], [10.0, 10.0, 5.0], [10.0]))[1]
    assert (r["recall_at_3"], r["ap_at_3"], r["ndcg_at_3"], r["money_recall_at_3"]) == (1.0, 1.0, 1.0, 1.0)
    assert r["precision_at_3"] == pytest.approx(1 / 3)


def test_repeated_purchases_cost_once_as_in_the_long_form(spark):
    r = _lists(spark, (1, [1], [1, 1, 2], [10.0], [10.0, 10.0, 5.0]))[1]
    assert r["money_recall_at_3"] == pytest.approx(10 / 15)
    recs = spark.createDataFrame([(1, 1, 1)], "user_id bigint, item_id bigint, rank bigint")
    truth = spark.createDataFrame([(1, 1), (1, 2)], "user_id bigint, item_id bigint")
    prices = spark.createDataFrame([(1, 10.0), (2, 5.0)], "item_id bigint, price double")
    assert metrics_per_user(recs, truth, (3,), prices).first()["money_recall"] == pytest.approx(10 / 15)
    dear = spark.createDataFrame([(1, 3.0)], "item_id bigint, price double")
    assert metrics_per_user(recs, truth, (3,), prices, rec_prices=dear).first()["money_recall"] == pytest.approx(3 / 15)
    assert metrics_per_user(recs, truth, (3,)).first()["money_recall"] is None


def test_nulls_and_short_price_lists(spark):
    r = _lists(spark, (1, [3, None], [3, None], [7.0], [7.0]), (2, [4, 5], [4, 5], [2.0], [2.0, 6.0]))
    assert r[1]["recall_at_3"] == 1.0 and r[1]["money_recall_at_3"] == 1.0
    assert r[2]["money_recall_at_3"] == pytest.approx(2 / 8)  # the second recommended price is missing and counts as 0
    lists = spark.createDataFrame([(2, [4, 5], [4, 5], [2.0], [2.0, 6.0])], LISTS)
    assert math.isnan(with_metrics(lists, (3,), nan_policy="propagate").first()["money_recall_at_3"])


def test_nan_prices_by_policy_in_the_long_form(spark):
    recs = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "user_id bigint, item_id bigint, rank bigint")
    truth = spark.createDataFrame([(1, 1), (1, 2)], "user_id bigint, item_id bigint")
    prices = spark.createDataFrame([(1, 10.0), (2, float("nan"))], "item_id bigint, price double")
    assert metrics_per_user(recs, truth, (1,), prices).first()["money_recall"] == 1.0
    assert math.isnan(metrics_per_user(recs, truth, (1,), prices, nan_policy="propagate").first()["money_recall"])


def test_files_with_other_column_orders_are_refused(spark, tmp_path):
    for sub, second in (("same", "a,b\n9,8\n"), ("other", "b,a\n9,8\n"), ("renamed", "a,a\n9,8\n")):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / "a.csv").write_text("a,a\n1,2\n" if sub == "renamed" else "a,b\n1,2\n")
        (tmp_path / sub / "b.csv").write_text(second)
    assert read_csv_table(spark, str(tmp_path / "same")).count() == 2
    assert read_csv_table(spark, str(tmp_path / "renamed")).columns == ["a0", "a1"]
    with pytest.raises(Exception):
        read_csv_table(spark, str(tmp_path / "other")).collect()
    (tmp_path / "renamed" / "c.csv").write_text("a,b\n9,8\n")
    with pytest.raises(ValueError):
        read_csv_table(spark, str(tmp_path / "renamed"))


def test_bad_values_fail_whatever_the_ansi_mode(spark, tmp_path):
    (tmp_path / "h.csv").write_text("user_id,basket_id,item_id,week_no,quantity,sales_value\n1,1,1,x,1,1\n")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception):
                interactions_from_csv(spark, str(tmp_path / "h.csv")).collect()
            assert interactions_from_csv(spark, str(tmp_path / "h.csv"), on_bad="drop").count() == 0
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(ValueError):
        interactions_from_csv(spark, str(tmp_path / "h.csv"), columns={"user_id": "user_id", "item_id": "item_id"})


def test_money_beyond_its_scale_fails_instead_of_being_rounded(spark):
    df = spark.createDataFrame([(1.25,), (2.5,)], "v double")
    assert df.agg(money_sum("v")).first()[0] == 3.75
    with pytest.raises(Exception):
        spark.createDataFrame([(1.255,)], "v double").agg(money_sum("v")).collect()
    assert spark.createDataFrame([(1.255,)], "v double").agg(money_sum("v", 3)).first()[0] == 1.255


def test_money_scale_reaches_features_and_prefilter(spark):
    hist = spark.createDataFrame([(1, 1, 7, 0, 2.0, 1.255), (1, 2, 8, 1, 1.0, 0.005)], "user_id long, basket_id long, item_id long, week_no int, quantity double, sales_value double")
    types = spark.createDataFrame([(7, "a"), (8, "b")], "item_id long, type string")
    cands = spark.createDataFrame([(1, 7, 0.5, 1)], "user_id long, item_id long, score double, rank long")
    with pytest.raises(Exception):
        kept_items(hist).collect()
    assert sorted((r.item_id, r.unit_price) for r in kept_items(hist, scale=3).collect()) == [(7, 0.6275), (8, 0.005)]
    x, _ = feature_frame(cands, hist, types, 2, scale=3)
    row = x.first()
    assert (row.mean_basket_value, row.mean_price, row.item_mean_price) == (0.63, 0.42, 0.6275)
    assert row.type_spend_share == 1.255 / 1.26


def test_binary_weights_are_one(spark):
    mat = spark.createDataFrame([(1, 1, 7.0)], "user_id bigint, item_id bigint, weight double")
    assert weigh(mat, "binary").first()["weight"] == 1.0 and weigh(mat, "none").first()["weight"] == 7.0


def test_facade_refuses_options_it_would_ignore(spark):
    inter = spark.createDataFrame([(1, 1, 1, 0, 1.0, 2.0)], "user_id bigint, basket_id bigint, item_id bigint, week_no int, quantity double, sales_value double")
    for bad in (dict(method="popular", exclude_seen=True), dict(method="item_item", value="sales"), dict(method="hybrid"), dict(method="nope")):
        with pytest.raises(ValueError):
            Recommender(**bad).fit(inter)


def test_no_join_key_of_a_hot_user_holds_more_than_about_a_block_squared(spark):
    block, items = 512, 20_000
    mat = spark.range(items).select(F.lit(1).cast("bigint").alias("user_id"), F.col("id").alias("item_id"), F.lit(1.0).alias("weight"))
    m = _blocked(mat, "user_id", "item_id", block)
    sizes = {r["_blk"]: r["n"] for r in m.groupBy("_blk").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(sizes.values()) == items
    # key (user, x, y): items of block x times items of block y
    assert max(sizes[x] * sizes[y] for x in sizes for y in sizes if x <= y) <= 1.7 * block * block


def test_row_numbers_and_sums_run_without_python(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(3).alias("v")).repartition(5)
    out = global_row_number(df, ["k"])
    assert [r["row_no"] for r in out.orderBy("k").collect()] == list(range(1, 1001))
    sums = global_cumsum(df, ["k"], value_col="v")
    assert [r["cum"] for r in sums.orderBy("k").collect()] == [3 * i for i in range(1, 1001)]
    plan = sums._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_user_features_do_not_expand_rows(spark):
    hist = spark.createDataFrame([(1, 1, 1, 0, 1.0, 2.0), (1, 1, 2, 0, 1.0, 2.0), (1, 2, 1, 3, 2.0, 5.0)],
                                 "user_id bigint, basket_id bigint, item_id bigint, week_no int, quantity double, sales_value double")
    out = user_features(hist, 10)
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert tuple(out.first()) == (1, 2, 2, 4.5, 2.25, 7)


def _pairs(spark, shift=0):
    rng = random.Random(0)
    rows = [(shift + u, shift + i, 1.0) for u in range(30) for i in range(20) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")


def test_moving_all_ids_leaves_the_model_alone(spark):
    a, b = (fit_als(_pairs(spark, s), factors=4, iterations=3, seed=3) for s in (0, 10 ** 12))
    one = {(r.user_id, r["rank"]): r.item_id for r in a.recommend(_pairs(spark).select("user_id"), 3).collect()}
    two = {(r.user_id - 10 ** 12, r["rank"]): r.item_id - 10 ** 12 for r in b.recommend(_pairs(spark, 10 ** 12).select("user_id"), 3).collect()}
    assert one == two


def test_negatives_are_drawn_again_until_the_ratio_is_met(spark):
    pos = spark.createDataFrame([(1, i) for i in range(18)] + [(2, 3)] + [(3, i) for i in range(20)], "user_id bigint, item_id bigint")
    items = spark.range(20).select(F.col("id").alias("item_id"))
    neg = {(r.user_id, r.item_id) for r in negative_pairs(pos, items, 3).collect()}
    by = {u: {i for v, i in neg if v == u} for u in (1, 2, 3)}
    assert by[1] == {18, 19} and len(by[2]) == 3 and 3 not in by[2] and not by[3]


def test_the_hybrid_model_tells_ids_apart(spark):
    mat = _pairs(spark)
    users = spark.range(30).select(F.col("id").alias("user_id"), F.lit("s").alias("segment"), F.lit(1).alias("nation_key"))
    items = spark.range(20).select(F.col("id").alias("item_id"), F.lit("b").alias("brand"), F.lit("t").alias("type"), F.lit(1).alias("size"))
    fm = fit_hybrid_fm(mat, users, items, fit_als(mat, factors=4, iterations=3), factor_size=2, max_iter=3)
    scores = [r.fm_score for r in fm.score(mat.select("user_id", "item_id")).collect()]
    assert len({round(s, 12) for s in scores}) > 0.9 * len(scores)


def test_param_grid_builds_every_combination():
    assert len(param_grid(a=[1, 2, 3], b=["x", "y"])) == 6

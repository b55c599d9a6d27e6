"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over the supplied tables.

Every query reads the whole tables (no id subsets or row caps); limits appear only where the
top-k list is the feature. Output doubles are rounded to 6 decimals and counts / ranks are BIGINT
so results compare exactly with the SQL in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import mean_metrics, metrics_per_user, with_metrics
from ..functions.prefix import global_row_number
from ..functions.weights import binary_matrix, bm25, tfidf, user_item_matrix, weigh
from ..operators.content import content_based_recs
from ..operators.factor import fit_als, similar_from_factors
from ..operators.features import feature_frame, item_features, pair_features, user_features
from ..operators.hybrid import fit_hybrid_fm, hybrid_data, negative_pairs
from ..operators.item_item import item_item_neighbours, item_item_recs
from ..operators.lsh import lsh_knn
from ..operators.rare_first import rare_first_neighbours
from ..operators.two_level import fit_ranker, label_candidates
from ..operators.vectors import similar_vectors
from ..operators.popular import item_popularity, popular, popular_list, recs_from_list
from ..operators.postprocess import fill_popular, top_without
from ..operators.prefilter import kept_items, prefilter_items
from ..operators.random_recs import weighted_random_recs
from ..operators.split import eval_users, split_by_week, split_two_level, truth_table, week_range
from ..session import ensure_checkpoint_dir, stored
from ..sources.chunks import chunk_manifest, chunk_rows, write_chunks
from ..sources.csv_table import WRITE_OPTIONS, read_csv_table
from ..sources.lists import lists_to_long, long_to_lists
from ..sources.retail import item_content, load_interactions, table, user_attributes
from .evaluation import (best_worst, candidate_union, compare, generator_recall, level_comparison, recall_curve,
                         result_table, summary_table)
from .recommender import Recommender
from .selection import grid_report, mark_best, quality_gate
from .setup import (EVAL_KS, FAKE_ITEM, K_NEIGHBOURS, LEVEL2_START, N_CANDIDATES, N_RECS, SEED, VALID_START, WEEK_HI,
                    WEEK_LO, Frame, persisted, r6)

Query = Callable[[SparkSession, str], DataFrame]


def q_interactions(spark, sf):
    return Frame(spark, sf).inter


def q_week_range(spark, sf):
    return week_range(load_interactions(spark, sf, weeks=(WEEK_LO, WEEK_HI)), WEEK_LO, WEEK_HI)


def q_split_sizes(spark, sf):
    f = Frame(spark, sf)
    return _sizes({"level1_train": f.train, "level2_train": f.level2, "level2_valid": f.valid})


def _sizes(named: dict[str, DataFrame]) -> DataFrame:
    """``split, n_rows, n_users, n_items``; users and items are counted apart, so no row is expanded for two distinct counts."""
    out = None
    for name, df in named.items():
        users = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_users"), F.lit(0).cast("bigint").alias("n_items"))
        items = df.select("item_id").distinct().agg(
            F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_users"), F.count(F.lit(1)).alias("n_items"))
        for part in (users, items):
            part = part.withColumn("split", F.lit(name))
            out = part if out is None else out.unionByName(part)
    return out.groupBy("split").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_rows", "n_users", "n_items")])


def q_popular_items(spark, sf):
    f = Frame(spark, sf)
    pop = item_popularity(f.train).withColumn("_neg", -F.col("n_purchases"))
    ranked = global_row_number(pop, ["_neg", "item_id"], out="rank")
    return ranked.select("item_id", "n_purchases", "n_users", r6("quantity"), r6("sales"), "rank")


def _random(spark, sf, weighting):
    f = Frame(spark, sf)
    return weighted_random_recs(f.train, f.val_users, N_RECS, seed=SEED, weighting=weighting) \
        .select("user_id", "item_id", "rank")


def q_weighted_random(spark, sf):
    return _random(spark, sf, "log")


def q_uniform_random(spark, sf):
    return _random(spark, sf, "uniform")


def q_tfidf_weights(spark, sf):
    return tfidf(user_item_matrix(Frame(spark, sf).inter, "count")).select("user_id", "item_id", r6("weight"))


def q_bm25_weights(spark, sf):
    return bm25(user_item_matrix(Frame(spark, sf).inter, "count")).select("user_id", "item_id", r6("weight"))


def q_item_item_neighbours(spark, sf):
    return Frame(spark, sf).neighbours.select("item_id", "neighbour_id", "rank", r6("sim"))


def q_item_item_recs(spark, sf):
    return Frame(spark, sf).item_item(N_RECS).select("user_id", "item_id", "rank", r6("score"))


def _per_user(spark, sf):
    f = Frame(spark, sf)
    # the candidates are read once: they go into the metrics as they are made
    return metrics_per_user(f.item_item(N_CANDIDATES), f.truth, EVAL_KS, prices=f.prices, users=f.val_users)


def _metric_query(metric):
    def run(spark, sf):
        return _per_user(spark, sf).select("user_id", "k", r6(metric))
    run.__name__ = f"q_{metric}"
    return run


def q_metric_means(spark, sf):
    m = mean_metrics(_per_user(spark, sf))
    return m.select("k", F.col("n_users").cast("bigint"), r6("precision"), r6("recall"), r6("ndcg"),
                    r6("ap"), r6("rr"), r6("money_recall"))


PREFILTER_RULES = dict(top_n=1000, lo_share=0.01, hi_share=0.5, active_weeks=52, min_price=50.0, max_price=20000.0)
RECALL_KS = (10, 50, 200, 500, 1000)


def q_eval_users(spark, sf):
    f = Frame(spark, sf)
    return eval_users(f.train, f.valid)


def q_user_item_matrix(spark, sf):
    return user_item_matrix(Frame(spark, sf).train, "quantity").select("user_id", "item_id", r6("weight"))


def q_prefilter_items(spark, sf):
    k = kept_items(Frame(spark, sf).train, **PREFILTER_RULES)
    return k.select("item_id", "n_users", r6("quantity"), r6("unit_price"), "last_week", "qty_rank")


def q_fill_popular(spark, sf):
    f = Frame(spark, sf)
    pop = [i for i, _ in popular_list(f.train, N_RECS, "count")]
    return fill_popular(f.item_item(N_RECS), f.val_users, pop, N_RECS)


def _orders(spark, sf):
    return table(spark, sf, "orders")


def q_chunk_assign(spark, sf):
    return chunk_rows(_orders(spark, sf).select("o_orderkey"), 1000, ["o_orderkey"]) \
        .select("o_orderkey", "row_no", "chunk_id")


def q_chunk_manifest(spark, sf):
    return chunk_manifest(chunk_rows(_orders(spark, sf).select("o_orderkey"), 1000, ["o_orderkey"]),
                          key="o_orderkey")


def _pop_items_df(spark, f, n, by="count"):
    return popular(f.train, n, by).select("item_id", "rank", "score")


def q_recall_curve(spark, sf):
    f = Frame(spark, sf)
    gens = {"popular": (_pop_items_df(spark, f, max(RECALL_KS)), True),
            "item_item": (f.item_item(max(RECALL_KS)), False)}
    return recall_curve(gens, f.truth, RECALL_KS, f.val_users).select("generator", "k", r6("recall"))


GENERATOR_KS, N_GENERATED = (5, 10, 50), 50


def _generated(f: Frame) -> dict[str, DataFrame]:
    """Lists of 50 of every generator whose result does not hang on an optimiser."""
    lists = {"popular": recs_from_list(f.val_users, popular_list(f.train, N_GENERATED, "count")), "item_item": f.item_item(N_GENERATED),
             "content": content_based_recs(f.train, item_content(f.spark, f.sf_dir), f.val_users, N_GENERATED)}
    for law in ("log", "log_strict", "uniform"):
        lists[f"random_{law}"] = weighted_random_recs(f.train, f.val_users, N_GENERATED, seed=SEED, weighting=law)
    return lists


def q_generator_recall(spark, sf):
    f = Frame(spark, sf)
    return generator_recall(_generated(f), f.truth, GENERATOR_KS, f.val_users).select("generator", "k", F.col("n_lists").cast("bigint").alias("n_lists"), r6("recall"))


def q_generator_recall_als(spark, sf):
    """The same table with the ALS lists beside them."""
    f = Frame(spark, sf)
    lists = {**_generated(f), "als": _als(f).recommend(f.val_users, N_GENERATED, exclude_seen=True)}
    return generator_recall(lists, f.truth, GENERATOR_KS, f.val_users).select("generator", "k", F.col("n_lists").cast("bigint").alias("n_lists"), r6("recall"))


def _baselines(f):
    return {
        "popular": (_pop_items_df(None, f, N_RECS), True),
        "weighted_random": (weighted_random_recs(f.train, f.val_users, N_RECS, seed=SEED, weighting="log"), False),
        "uniform_random": (weighted_random_recs(f.train, f.val_users, N_RECS, seed=SEED, weighting="uniform"), False),
        "item_item": (f.item_item(N_RECS), False),
    }


def q_algorithm_summary(spark, sf):
    f = Frame(spark, sf)
    rep = compare(_baselines(f), f.truth, (3, 5), f.val_users, f.prices)
    out = summary_table(rep, "algorithm", ("precision", "recall"), (3, 5))
    return out.select("algorithm", *[r6(c) for c in out.columns if c != "algorithm"])


def model_grid(f: Frame) -> dict[str, tuple[DataFrame, bool]]:
    """Deterministic grid over the first-level generators (precision@5 report)."""
    counts = f.counts
    grid: dict[str, tuple[DataFrame, bool]] = {}
    for name, mat, k in (("ii_k20_binary", f.train_matrix, 20), ("ii_k5_binary", f.train_matrix, 5),
                         ("ii_k20_tfidf", tfidf(counts), 20), ("ii_k20_bm25", bm25(counts), 20)):
        nb = f.neighbours if (mat is f.train_matrix and k == K_NEIGHBOURS) else stored(item_item_neighbours(mat, k))
        grid[name] = (item_item_recs(mat, nb, N_RECS, f.val_users), False)
    grid["pop_count"] = (popular(f.train, N_RECS, "count"), True)
    grid["pop_sales"] = (popular(f.train, N_RECS, "sales"), True)
    for seed in (1, 2):
        grid[f"wrand_seed{seed}"] = (weighted_random_recs(f.train, f.val_users, N_RECS, seed=seed), False)
    return grid


def q_best_worst(spark, sf):
    f = Frame(spark, sf)
    rep = compare(model_grid(f), f.truth, (N_RECS,), f.val_users, label="model_id")
    bw = best_worst(rep.select("model_id", F.col("precision").alias("value")), "value", 5, "model_id")
    return bw.select("side", "place", "model_id", r6("value"))


def q_candidate_union(spark, sf):
    f = Frame(spark, sf)
    pop = recs_from_list(f.val_users, popular_list(f.train, 50, "count"))
    return candidate_union({"item_item": f.item_item(50), "popular": pop})


def q_result_table(spark, sf):
    f = Frame(spark, sf)
    lists = {"popular": recs_from_list(f.val_users, popular_list(f.train, N_RECS, "count")),
             "item_item": f.item_item(N_RECS),
             "weighted_random": weighted_random_recs(f.train, f.val_users, N_RECS, seed=SEED)}
    return result_table(f.truth, f.val_users, lists)


def q_list_metrics(spark, sf):
    f = Frame(spark, sf)
    recs = f.item_item(N_CANDIDATES).filter(F.col("rank") <= 10).join(f.prices, "item_id", "left")
    rec_lists = (recs.groupBy("user_id")
                 .agg(F.array_sort(F.collect_list(F.struct("rank", "item_id", "price"))).alias("_l"))
                 .select("user_id", F.transform("_l", lambda s: s["item_id"]).alias("recommended_list"),
                         F.transform("_l", lambda s: s["price"]).alias("prices_recommended")))
    bought = (f.truth.join(f.prices, "item_id", "left").groupBy("user_id")
              .agg(F.array_sort(F.collect_list(F.struct("item_id", "price"))).alias("_b"))
              .select("user_id", F.transform("_b", lambda s: s["item_id"]).alias("bought_list"),
                      F.transform("_b", lambda s: s["price"]).alias("prices_bought")))
    lists = f.val_users.join(rec_lists, "user_id", "left").join(bought, "user_id", "left")
    out = with_metrics(lists, (5, 10))
    cols = [f"{m}_at_{k}" for k in (5, 10) for m in ("precision", "recall", "ndcg", "ap", "rr", "money_recall")]
    return out.select("user_id", *[r6(c) for c in cols])


def _item_types(f):
    return item_content(f.spark, f.sf_dir).select("item_id", "type")


def q_user_features(spark, sf):
    u = user_features(Frame(spark, sf).train, LEVEL2_START)
    return u.select("user_id", "n_baskets", "n_items", r6("mean_basket_value"), r6("mean_price"), "weeks_since_last")


def q_item_features(spark, sf):
    f = Frame(spark, sf)
    it = item_features(f.train, _item_types(f), LEVEL2_START)
    return it.select("item_id", "n_buyers", r6("units_per_week"), r6("mean_price"), r6("price_share_in_type"),
                     r6("repeat_rate"))


def q_pair_features(spark, sf):
    f = Frame(spark, sf)
    pf = pair_features(f.candidates, f.train, _item_types(f), LEVEL2_START)
    return pf.select("user_id", "item_id", "times_bought", "pair_weeks_since_last", r6("type_spend_share"),
                     r6("price_diff"), r6("l1_score"), "l1_rank")


def q_similar_items_vectors(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return similar_vectors(emb, 5).select("vec_id", "neighbour_id", "rank", r6("sim"))


def q_similar_items_lsh(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return lsh_knn(emb, 5).select("vec_id", "neighbour_id", "rank", r6("sim"))


def q_lsh_recall(spark, sf):
    """The approximate lists against the exact ones: vectors, neighbours that no exact list of the whole table contradicts, recall of 0.9 or more."""
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding").persist(StorageLevel.MEMORY_AND_DISK)
    exact = similar_vectors(emb, 5).persist(StorageLevel.MEMORY_AND_DISK)
    both = exact.select("vec_id", "neighbour_id", F.round("sim", 6).alias("s")).join(lsh_knn(emb, 5).select("vec_id", "neighbour_id", F.round("sim", 6).alias("t")), ["vec_id", "neighbour_id"], "left")
    return both.agg(F.countDistinct("vec_id").alias("n_vectors"), F.count(F.lit(1)).alias("n_exact"),
                    F.coalesce(F.sum(F.when(F.abs(F.col("s") - F.col("t")) > 2e-6, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n_other_sim"),
                    (F.count("t") >= 0.9 * F.count(F.lit(1))).alias("recall_at_least_09"))


def q_similar_users(spark, sf):
    f = Frame(spark, sf)
    nb = rare_first_neighbours(f.train_matrix, 5)
    return nb.select("user_id", "neighbour_id", "rank", r6("sim"))


def q_content_based(spark, sf):
    f = Frame(spark, sf)
    cb = content_based_recs(f.train, item_content(spark, sf), f.val_users, N_RECS)
    return cb.select("user_id", "item_id", "rank", r6("score"))


def _als(f, weighting="bm25", factors=10, iterations=5, reg=0.1, train=None):
    # the count matrix feeds the weighting statistics and the weights themselves
    mat = weigh(f.counts if train is None else f.keep(user_item_matrix(train, "count")), weighting)
    return fit_als(mat, factors=factors, iterations=iterations, regularization=reg, seed=SEED)


def q_als_recs(spark, sf):
    f = Frame(spark, sf)
    return _als(f).recommend(f.val_users, N_RECS, exclude_seen=True)


def q_hybrid_fm_recs(spark, sf):
    f = Frame(spark, sf, persisted)
    return _pair_lists(f, N_RECS)


def _pair_lists(f: Frame, n: int, train: DataFrame | None = None, exclude_seen: bool = True) -> DataFrame:
    """ALS proposes 50 items per user, the factorisation machine re-ranks them."""
    als = _als(f, train=train)
    pos = f.train_matrix if train is None else binary_matrix(train)
    fm = fit_hybrid_fm(pos, user_attributes(f.spark, f.sf_dir), item_content(f.spark, f.sf_dir), als, seed=SEED)
    return fm.rerank(als.recommend(f.val_users, 50, exclude_seen=exclude_seen), n)


def two_level_recs(f: Frame, n: int = N_RECS, kind: str = "gbt", fill: bool = True) -> DataFrame:
    lvl2_users = f.level2.select("user_id").distinct()
    train_cands = stored(f.item_item(N_CANDIDATES, users=lvl2_users))
    ranker = fit_ranker(train_cands, f.level2, f.train, _item_types(f), LEVEL2_START, kind=kind,
                        max_iter=10, max_depth=3, seed=SEED)
    ranked = ranker.recommend(f.candidates, n)
    if not fill:
        return ranked
    pop = [i for i, _ in popular_list(f.train, n, "count")]
    return fill_popular(ranked, f.val_users, pop, n).select("user_id", "item_id", "rank", "source")


def q_two_level_recs(spark, sf):
    return two_level_recs(Frame(spark, sf))


def q_level_comparison(spark, sf):
    f = Frame(spark, sf)
    level1 = f.item_item(10)
    level2 = two_level_recs(f, n=10, fill=False)
    out = level_comparison(level1, level2, f.truth, f.val_users)
    return out.select("metric", "k", r6("level1"), r6("level2"), r6("delta"))


ALS_GRID = [  # a small slice of the search space; ``param_grid`` builds a full one, see ALS_SEARCH
    dict(factors=8, iterations=5, regularization=0.1, weighting="none"),
    dict(factors=8, iterations=5, regularization=0.1, weighting="bm25"),
    dict(factors=16, iterations=8, regularization=0.01, weighting="tfidf"),
    dict(factors=16, iterations=8, regularization=0.1, weighting="bm25"),
]

#: Full search spaces, for grid_report(param_grid(**...)): 240 ALS and 162 hybrid models.
ALS_SEARCH = dict(factors=[8, 16, 32, 64, 128], iterations=[5, 10, 15, 20], regularization=[0.001, 0.01, 0.1, 1.0],
                  weighting=["none", "tfidf", "bm25"])
FM_SEARCH = dict(factor_size=[4, 8, 16], step_size=[0.01, 0.05, 0.1], max_iter=[10, 20, 50], reg_param=[0.001, 0.01, 0.1],
                 fit_linear=[True, False])

FM_GRID = [
    dict(factor_size=4, step_size=0.05, max_iter=10, reg_param=0.01, fit_linear=True),
    dict(factor_size=8, step_size=0.05, max_iter=10, reg_param=0.01, fit_linear=True),
    dict(factor_size=8, step_size=0.01, max_iter=20, reg_param=0.1, fit_linear=False),
    dict(factor_size=16, step_size=0.05, max_iter=10, reg_param=0.1, fit_linear=True),
]


def q_als_grid(spark, sf):
    f = Frame(spark, sf)

    def build(cfg):
        return _als(f, cfg["weighting"], cfg["factors"], cfg["iterations"], cfg["regularization"]) \
            .recommend(f.val_users, N_RECS, exclude_seen=True)

    rep = grid_report(ALS_GRID, build, f.truth, f.val_users, N_RECS,
                      model_id=lambda c: "als_f{factors}_i{iterations}_r{regularization}_{weighting}".format(**c))
    return mark_best(rep, f"precision_at_{N_RECS}")


def q_grid_log(spark, sf):
    """Grid over the item-item generator with a log: a first search of two models, then the whole grid, which takes these from the log."""
    f = Frame(spark, sf)
    counts = f.counts
    weights = {"binary": f.train_matrix, "tfidf": tfidf(counts), "bm25": bm25(counts)}
    configs = [dict(k_neighbours=20, weighting="binary"), dict(k_neighbours=5, weighting="binary"),
               dict(k_neighbours=20, weighting="tfidf"), dict(k_neighbours=20, weighting="bm25")]

    def build(cfg):
        mat, k = weights[cfg["weighting"]], cfg["k_neighbours"]
        nb = f.neighbours if (cfg["weighting"], k) == ("binary", K_NEIGHBOURS) else stored(item_item_neighbours(mat, k))
        return item_item_recs(mat, nb, N_RECS, f.val_users)

    log = f"{ensure_checkpoint_dir(spark)}/grid-{uuid.uuid4().hex}"
    name = lambda c: "ii_k{k_neighbours}_{weighting}".format(**c)
    for part in (configs[:2], configs):
        rep = grid_report(part, build, f.truth, f.val_users, N_RECS, model_id=name, log=log)
    best = mark_best(rep, f"precision_at_{N_RECS}")
    return best.select("model_id", F.col("k_neighbours").cast("bigint").alias("k_neighbours"), "weighting",
                       r6(f"precision_at_{N_RECS}"), r6(f"map_at_{N_RECS}"), "is_best")


def q_newton_ranker_check(spark, sf):
    """The second-level classifier by Newton steps on the whole training frame: rows, positives, and whether the optimum was reached
    (largest gradient per row below 1e-8)."""
    f = Frame(spark, sf)
    cands = stored(f.item_item(N_CANDIDATES, users=f.level2.select("user_id").distinct()))
    m = fit_ranker(cands, f.level2, f.train, _item_types(f), LEVEL2_START, kind="newton").model
    return spark.createDataFrame([(m.n_rows, m.n_positive, m.largest_gradient < 1e-8)], "n_rows bigint, n_positive bigint, optimal boolean")


def q_fm_grid(spark, sf):
    f = Frame(spark, sf, persisted)
    als = _als(f)  # the latent factors are the same for all configurations
    users, items = user_attributes(spark, sf), item_content(spark, sf)
    data = hybrid_data(f.train_matrix, users, items, als, seed=SEED)  # negatives and features are the same, too
    cands = stored(data.features(f.item_item(50).select("user_id", "item_id")))

    def build(cfg):
        fm = fit_hybrid_fm(f.train_matrix, users, items, als, data=data, factor_size=cfg["factor_size"],
                           step_size=cfg["step_size"], max_iter=cfg["max_iter"], reg_param=cfg["reg_param"],
                           fit_linear=cfg["fit_linear"], seed=SEED)
        return fm.rerank(cands, N_RECS)

    rep = grid_report(FM_GRID, build, f.truth, f.val_users, N_RECS,
                      model_id=lambda c: "fm_f{factor_size}_s{step_size}_i{max_iter}_r{reg_param}_l{fit_linear}".format(**c))
    return mark_best(rep, f"precision_at_{N_RECS}")


def q_quality_gate(spark, sf):
    """Precision@5 and MAP@5 of item-item + popular fill on the hold-out; passes if above 0.22."""
    f = Frame(spark, sf)
    pop = [i for i, _ in popular_list(f.train, N_RECS, "count")]
    recs = fill_popular(f.item_item(N_RECS), f.val_users, pop, N_RECS)
    means = mean_metrics(metrics_per_user(recs, f.truth, (N_RECS,), users=f.val_users))
    gate = quality_gate(means, "precision", N_RECS, 0.22)
    return gate.join(means.select("k", F.round("ap", 6).alias("map_at_5")), "k").select(
        F.round("value", 6).alias("precision_at_5"), "map_at_5", "threshold", "passes")


def q_chunk_manifest_reference(spark, sf):
    ch = chunk_rows(_orders(spark, sf).select("o_orderkey"), 1000, ["o_orderkey"])
    return chunk_manifest(ch, trailing_empty=True, chunk_size=1000)


def q_als_similar_users(spark, sf):
    f = Frame(spark, sf)
    return similar_from_factors(_als(f), 5, "user").select("user_id", "neighbour_id", "rank", r6("sim"))


def q_als_similar_items(spark, sf):
    f = Frame(spark, sf)
    return similar_from_factors(_als(f), 5, "item").select("item_id", "neighbour_id", "rank", r6("sim"))


def _fake_lists(f: Frame) -> DataFrame:
    collapsed = prefilter_items(f.train, mode="collapse", fake_item_id=FAKE_ITEM, **PREFILTER_RULES)
    mat = stored(binary_matrix(collapsed))
    six = item_item_recs(mat, stored(item_item_neighbours(mat, K_NEIGHBOURS)), 6, f.val_users, exclude_seen=False)
    return top_without(six, 6, [FAKE_ITEM], N_RECS)


def q_top_without_fake(spark, sf):
    return _fake_lists(Frame(spark, sf)).select("user_id", "item_id", "rank")


def q_fake_item_metrics(spark, sf):
    """MAP@5 and Precision@5 of the take-6 / drop-fake / keep-5 lists (users with a list)."""
    f = Frame(spark, sf)
    lists = _fake_lists(f)
    m = mean_metrics(metrics_per_user(lists, f.truth, (N_RECS,), users=lists.select("user_id").distinct()))
    return m.select(F.round("precision", 6).alias("precision_at_5"), F.round("ap", 6).alias("map_at_5"),
                    F.col("n_users").cast("bigint").alias("n_users"))


def q_window_quality_gate(spark, sf):
    """Five recommendations from weeks 96..98 only (item-item + popular fill), scored on the next
    three weeks as the hold-out; the gate passes above Precision@5 = 0.22."""
    hist = load_interactions(spark, sf, weeks=(WEEK_LO, WEEK_HI))
    hold = load_interactions(spark, sf, weeks=(WEEK_HI + 1, WEEK_HI + 3))
    users = hold.select("user_id").distinct()
    mat = stored(binary_matrix(hist))
    recs = item_item_recs(mat, stored(item_item_neighbours(mat, K_NEIGHBOURS)), N_RECS, users)
    pop = [i for i, _ in popular_list(hist, N_RECS, "count")]
    filled = fill_popular(recs, users, pop, N_RECS)
    means = mean_metrics(metrics_per_user(filled, truth_table(hold), (N_RECS,), users=users))
    gate = quality_gate(means, "precision", N_RECS, 0.22)
    return gate.join(means.select("k", F.round("ap", 6).alias("map_at_5"),
                                  F.col("n_users").cast("bigint").alias("n_users")), "k").select(
        F.round("value", 6).alias("precision_at_5"), "map_at_5", "threshold", "passes", "n_users")


def q_two_level_gate(spark, sf):
    """Item-item 100 -> classifier 5 -> popular fill, scored on a separate hold-out table; passes above Precision@5 = 0.22."""
    f = Frame(spark, sf)
    hold = split_two_level(f.inter, LEVEL2_START, VALID_START, holdout=f.valid)[2]
    recs = two_level_recs(f)
    means = mean_metrics(metrics_per_user(recs, truth_table(hold), (N_RECS,), users=f.val_users))
    ensure_checkpoint_dir(spark)
    means = means.checkpoint(eager=True)
    gate = quality_gate(means, "precision", N_RECS, 0.22)
    return gate.join(means.select("k", F.round("ap", 6).alias("map_at_5")), "k").select(
        F.round("value", 6).alias("precision_at_5"), "map_at_5", "threshold", "passes")


def q_pair_pipeline_metrics(spark, sf):
    """ALS -> factorisation machine -> take 6, drop the fake item, keep 5 -> MAP@5 and Precision@5."""
    f = Frame(spark, sf, persisted)
    collapsed = prefilter_items(f.train, mode="collapse", fake_item_id=FAKE_ITEM, **PREFILTER_RULES)
    lists = top_without(_pair_lists(f, 6, train=collapsed, exclude_seen=False), 6, [FAKE_ITEM], N_RECS).persist()
    m = mean_metrics(metrics_per_user(lists, f.truth, (N_RECS,), users=lists.select("user_id").distinct()))
    return m.select(F.round("precision", 6).alias("precision_at_5"), F.round("ap", 6).alias("map_at_5"),
                    F.col("n_users").cast("bigint").alias("n_users"))


def _list_check(f: Frame, recs: DataFrame) -> DataFrame:
    """Per user: list length, last rank, items bought before, items that are not in the catalogue."""
    recs = recs.select("user_id", "item_id", "rank").persist()
    seen = recs.join(f.train_matrix.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("s"))
    unknown = recs.join(item_content(f.spark, f.sf_dir).select("item_id"), "item_id", "left_anti").groupBy("user_id").agg(F.count(F.lit(1)).alias("u"))
    base = recs.groupBy("user_id").agg(F.countDistinct("item_id").cast("bigint").alias("n_items"), F.max("rank").cast("bigint").alias("last_rank"))
    return base.join(seen, "user_id", "left").join(unknown, "user_id", "left").select(
        "user_id", "n_items", "last_rank", F.coalesce("s", F.lit(0)).cast("bigint").alias("n_seen"), F.coalesce("u", F.lit(0)).cast("bigint").alias("n_unknown"))


def q_als_recs_check(spark, sf):
    f = Frame(spark, sf)
    return _list_check(f, _als(f).recommend(f.val_users, N_RECS, exclude_seen=True))


def q_hybrid_fm_recs_check(spark, sf):
    f = Frame(spark, sf, persisted)
    return _list_check(f, _pair_lists(f, N_RECS))


def q_two_level_recs_check(spark, sf):
    f = Frame(spark, sf)
    return _list_check(f, two_level_recs(f, fill=False))


def q_negative_pairs_check(spark, sf):
    """Negatives of every training user: as many as bought items, all distinct, none bought."""
    f = Frame(spark, sf)
    neg = negative_pairs(f.train_matrix, item_content(spark, sf), 1, SEED)
    hit = neg.join(f.train_matrix.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("h"))
    base = neg.groupBy("user_id").agg(F.countDistinct("item_id").cast("bigint").alias("n_negatives"))
    return base.join(hit, "user_id", "left").select("user_id", "n_negatives", F.coalesce("h", F.lit(0)).cast("bigint").alias("n_bought"))


def q_split_by_week(spark, sf):
    train, test = split_by_week(Frame(spark, sf).inter, VALID_START)
    return _sizes({"train": train, "test": test})


def q_holdout_split(spark, sf):
    """The standard split with an external block (weeks 96..98) in place of the validation weeks."""
    f = Frame(spark, sf)
    block = week_range(load_interactions(spark, sf, weeks=(WEEK_LO, WEEK_HI)), WEEK_LO, WEEK_HI)
    l1, l2, hold = split_two_level(f.inter, LEVEL2_START, VALID_START, holdout=block)
    return _sizes({"level1_train": l1, "level2_train": l2, "holdout": hold})


def q_list_round_trip(spark, sf):
    """Ranked rows to one list per user and back."""
    f = Frame(spark, sf)
    lists = long_to_lists(f.item_item(10), max_len=10)
    return lists_to_long(lists, price_col=None).select("user_id", "item_id", "rank")


def q_csv_round_trip(spark, sf):
    """Orders written as CSV chunks into the shared folder and read back as text."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_chunks(_orders(spark, sf).select(*cols), path, 1000, ["o_orderkey"])
    return read_csv_table(spark, path).select(*cols)


def q_csv_splits(spark, sf):
    """Orders with notes of several lines, quotes and commas, written as CSV, read by splits and chunked in file order without a key."""
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    note = F.concat_ws("\n", F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('", ')), "o_orderpriority", F.lit(""))
    orders = _orders(spark, sf).select("o_orderkey", note.alias("note"))
    orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey").write.options(**WRITE_OPTIONS).csv(path)
    rows = read_csv_table(spark, path, splits=True, positions=True)
    return chunk_rows(rows, 1000).select("o_orderkey", "note", "row_no", "chunk_id")


def q_facade_recs(spark, sf):
    """Item-item lists of every known user, short lists filled with popular items, through the facade."""
    f = Frame(spark, sf)
    return Recommender(method="item_item", k_neighbours=K_NEIGHBOURS).fit(f.train).recommend(n=N_RECS)


def q_restricted_recs(spark, sf):
    """Item-item lists that may hold the 100 most popular items only."""
    f = Frame(spark, sf)
    top = popular(f.train, 100).select("item_id")
    recs = item_item_recs(f.train_matrix, f.neighbours, N_RECS, f.val_users, restrict_to=top)
    return recs.select("user_id", "item_id", "rank", r6("score"))


def q_training_frame(spark, sf):
    """Level-2 candidates with pair and user features and the label (bought in the level-2 window)."""
    f = Frame(spark, sf)
    cands = label_candidates(stored(f.item_item(N_CANDIDATES, users=f.level2.select("user_id").distinct())), f.level2)
    x, _ = feature_frame(cands, f.train, _item_types(f), LEVEL2_START)
    return x.select("user_id", "item_id", F.col("label").cast("int").alias("label"), F.col("times_bought").cast("bigint").alias("times_bought"),
                    F.col("l1_rank").cast("bigint").alias("l1_rank"), r6("l1_score"), F.col("n_baskets").cast("bigint").alias("n_baskets"),
                    F.col("n_items").cast("bigint").alias("n_items"))


QUERIES: dict[str, Query] = {
    "interactions": q_interactions,
    "week_range": q_week_range,
    "split_sizes": q_split_sizes,
    "popular_items": q_popular_items,
    "weighted_random": q_weighted_random,
    "uniform_random": q_uniform_random,
    "tfidf_weights": q_tfidf_weights,
    "bm25_weights": q_bm25_weights,
    "item_item_neighbours": q_item_item_neighbours,
    "item_item_recs": q_item_item_recs,
    "precision_at_k": _metric_query("precision"),
    "recall_at_k": _metric_query("recall"),
    "ndcg_at_k": _metric_query("ndcg"),
    "map_at_k": _metric_query("ap"),
    "mrr_at_k": _metric_query("rr"),
    "money_recall_at_k": _metric_query("money_recall"),
    "metric_means": q_metric_means,
    "eval_users": q_eval_users,
    "user_item_matrix": q_user_item_matrix,
    "prefilter_items": q_prefilter_items,
    "top_without_fake": q_top_without_fake,
    "fill_popular": q_fill_popular,
    "chunk_assign": q_chunk_assign,
    "chunk_manifest": q_chunk_manifest,
    "recall_curve": q_recall_curve,
    "generator_recall": q_generator_recall,
    "generator_recall_als": q_generator_recall_als,
    "algorithm_summary": q_algorithm_summary,
    "best_worst": q_best_worst,
    "candidate_union": q_candidate_union,
    "result_table": q_result_table,
    "list_metrics": q_list_metrics,
    "user_features": q_user_features,
    "item_features": q_item_features,
    "pair_features": q_pair_features,
    "similar_items_vectors": q_similar_items_vectors,
    "similar_items_lsh": q_similar_items_lsh,
    "lsh_recall": q_lsh_recall,
    "similar_users": q_similar_users,
    "content_based": q_content_based,
    "als_recs": q_als_recs,
    "hybrid_fm_recs": q_hybrid_fm_recs,
    "two_level_recs": q_two_level_recs,
    "level_comparison": q_level_comparison,
    "als_grid": q_als_grid,
    "fm_grid": q_fm_grid,
    "grid_log": q_grid_log,
    "newton_ranker_check": q_newton_ranker_check,
    "quality_gate": q_quality_gate,
    "chunk_manifest_reference": q_chunk_manifest_reference,
    "als_similar_items": q_als_similar_items,
    "als_similar_users": q_als_similar_users,
    "fake_item_metrics": q_fake_item_metrics,
    "window_quality_gate": q_window_quality_gate,
    "two_level_gate": q_two_level_gate,
    "pair_pipeline_metrics": q_pair_pipeline_metrics,
    "als_recs_check": q_als_recs_check,
    "hybrid_fm_recs_check": q_hybrid_fm_recs_check,
    "two_level_recs_check": q_two_level_recs_check,
    "negative_pairs_check": q_negative_pairs_check,
    "split_by_week": q_split_by_week,
    "holdout_split": q_holdout_split,
    "list_round_trip": q_list_round_trip,
    "csv_round_trip": q_csv_round_trip,
    "csv_splits": q_csv_splits,
    "facade_recs": q_facade_recs,
    "restricted_recs": q_restricted_recs,
    "training_frame": q_training_frame,
}

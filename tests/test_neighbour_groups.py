"""Item neighbours by groups of items: lists are shuffled, no table of item pairs."""

import itertools
import math
import random

from cartwheel.operators.item_item import cosine_neighbours, item_item_recs


def _matrix(spark, users=60, items=25, seed=3):
    rnd = random.Random(seed)
    rows = {(u, 10 ** 10 + 7 * min(items - 1, int(rnd.expovariate(0.15)))): float(rnd.randint(1, 4)) for u in range(users) for _ in range(12)}
    return rows, spark.createDataFrame([(u, i, w) for (u, i), w in rows.items()], "user_id bigint, item_id bigint, weight double")


def _expected(rows, k):
    norm, dot = {}, {}
    for (_, i), w in rows.items():
        norm[i] = norm.get(i, 0.0) + w * w
    for u in {u for u, _ in rows}:
        mine = [(i, w) for (v, i), w in rows.items() if v == u]
        for (a, x), (b, y) in itertools.permutations(mine, 2):
            dot[a, b] = dot.get((a, b), 0.0) + x * y
    out = set()
    for a in norm:
        best = sorted((-round(d / math.sqrt(norm[a] * norm[b]), 9), b) for (c, b), d in dot.items() if c == a)[:k]
        out |= {(a, b, r + 1, round(-s, 6)) for r, (s, b) in enumerate(best)}
    return out


def _got(df):
    return {(r["item_id"], r["neighbour_id"], r["rank"], round(r["sim"], 6)) for r in df.collect()}


def test_groups_blocks_and_parts_give_the_same_lists(spark):
    rows, mat = _matrix(spark)
    want = _expected(rows, 4)
    assert _got(cosine_neighbours(mat, 4)) == want
    assert _got(cosine_neighbours(mat, 4, group_products=200)) == want            # many groups of items
    assert _got(cosine_neighbours(mat, 4, block=3, group_products=500)) == want   # every user's list in blocks
    assert _got(cosine_neighbours(mat, 4, item_rows=10)) == want                  # best sellers summed in parts
    assert _got(cosine_neighbours(mat, 4, block=3, item_rows=10, group_products=300)) == want


def test_no_table_of_item_pairs_is_shuffled(spark):
    _, mat = _matrix(spark)
    plan = cosine_neighbours(mat, 4)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a#" in plan and "hashpartitioning(a#" not in plan.split("FlatMapGroupsInArrow")[-1]


def test_lists_of_a_user_come_out_of_one_shuffle(spark):
    _, mat = _matrix(spark)
    users = mat.select("user_id").distinct()
    plan = item_item_recs(mat, cosine_neighbours(mat, 4), 3, users)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    bought = {tuple(r) for r in mat.select("user_id", "item_id").collect()}
    got = item_item_recs(mat, cosine_neighbours(mat, 4), 3, users).collect()
    assert got and not bought & {(r["user_id"], r["item_id"]) for r in got}

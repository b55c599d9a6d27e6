"""Reference SQL for the registered queries (ANSI-style SQL as run by DuckDB on the raw tables).

Each statement recomputes its answer from the supplied tables with plain joins, windows and
aggregates, independently of the DataFrame code, so the two can be compared value by value.
"""

from __future__ import annotations

from .setup import (EVAL_KS, FAKE_ITEM, K_NEIGHBOURS, LEVEL2_START, N_CANDIDATES, N_RECS, SEED,
                    VALID_START, WEEK_HI, WEEK_LO)

BASE = f"""
inter AS (
  SELECT o.o_custkey AS user_id, o.o_orderkey AS basket_id, l.l_partkey AS item_id,
         CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) / 7) AS INTEGER) AS week_no,
         l.l_quantity AS quantity, l.l_extendedprice AS sales_value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
train AS (SELECT * FROM inter WHERE week_no < {LEVEL2_START}),
lvl2 AS (SELECT * FROM inter WHERE week_no >= {LEVEL2_START} AND week_no < {VALID_START}),
val AS (SELECT * FROM inter WHERE week_no >= {VALID_START}),
val_users AS (SELECT DISTINCT user_id FROM val),
truth AS (SELECT user_id, item_id, sum(sales_value) AS spent FROM val GROUP BY user_id, item_id),
prices AS (SELECT p_partkey AS item_id, p_retailprice AS price FROM part),
mat AS (SELECT DISTINCT user_id, item_id, 1.0 AS weight FROM train)"""


def neighbours_cte(mat: str = "mat", k: int = K_NEIGHBOURS, name: str = "nbrs", key: str = "user_id",
                   other: str = "item_id") -> str:
    return f"""
{name}_norms AS (SELECT {other} AS id, sqrt(sum(weight * weight)) AS norm FROM {mat} GROUP BY {other}),
{name}_dots AS (SELECT a.{other} AS a, b.{other} AS b, sum(a.weight * b.weight) AS dot
  FROM {mat} a JOIN {mat} b ON a.{key} = b.{key} AND a.{other} < b.{other} GROUP BY 1, 2),
{name}_sims AS (SELECT d.a, d.b, d.dot / (na.norm * nb.norm) AS sim
  FROM {name}_dots d JOIN {name}_norms na ON na.id = d.a JOIN {name}_norms nb ON nb.id = d.b),
{name}_both AS (SELECT a AS {other}, b AS neighbour_id, sim FROM {name}_sims
  UNION ALL SELECT b AS {other}, a AS neighbour_id, sim FROM {name}_sims),
{name} AS (SELECT * FROM (SELECT {other}, neighbour_id, sim, row_number() OVER (
    PARTITION BY {other} ORDER BY round(sim, 9) DESC, neighbour_id) AS rank FROM {name}_both) WHERE rank <= {k})"""


def ii_recs_cte(n: int, name: str, users: str = "val_users", mat: str = "mat", nbrs: str = "nbrs",
                exclude_seen: bool = True) -> str:
    seen = (f"WHERE NOT EXISTS (SELECT 1 FROM {mat} m2 WHERE m2.user_id = s.user_id AND m2.item_id = s.item_id)"
            if exclude_seen else "")
    return f"""
{name}_scores AS (SELECT m.user_id, nb.neighbour_id AS item_id, sum(m.weight * nb.sim) AS score
  FROM {mat} m JOIN {nbrs} nb ON nb.item_id = m.item_id
  WHERE m.user_id IN (SELECT user_id FROM {users}) GROUP BY 1, 2),
{name} AS (SELECT * FROM (SELECT s.user_id, s.item_id, s.score, row_number() OVER (
    PARTITION BY s.user_id ORDER BY round(s.score, 9) DESC, s.item_id) AS rank
  FROM {name}_scores s {seen}) WHERE rank <= {n})"""


def metrics_cte(recs: str, ks=EVAL_KS, name: str = "met", users: str = "val_users",
                truth: str = "truth") -> str:
    kl = ", ".join(str(k) for k in ks)
    mk = max(ks)
    return f"""
{name}_hits AS (SELECT r.user_id, r.item_id, r.rank, coalesce(p.price, 0.0) AS price,
    row_number() OVER (PARTITION BY r.user_id ORDER BY r.rank) AS hit_no
  FROM {recs} r JOIN (SELECT DISTINCT user_id, item_id FROM {truth}) t
    ON t.user_id = r.user_id AND t.item_id = r.item_id
  LEFT JOIN prices p ON p.item_id = r.item_id WHERE r.rank <= {mk}),
{name}_ks AS (SELECT unnest([{kl}]) AS k),
{name}_perk AS (SELECT h.user_id, ks.k, count(*) AS n_hits, sum(1.0 / log2(h.rank + 1)) AS dcg,
    sum(CAST(h.hit_no AS DOUBLE) / h.rank) AS ap_sum, min(h.rank) AS first_hit, sum(h.price) AS money_hit
  FROM {name}_hits h JOIN {name}_ks ks ON h.rank <= ks.k GROUP BY 1, 2),
{name}_tstats AS (SELECT t.user_id, count(*) AS n_true, sum(coalesce(p.price, 0.0)) AS money_true
  FROM (SELECT DISTINCT user_id, item_id FROM {truth}) t LEFT JOIN prices p ON p.item_id = t.item_id GROUP BY 1),
{name}_base AS (SELECT u.user_id, ks.k, coalesce(ts.n_true, 0) AS n_true, coalesce(ts.money_true, 0.0) AS money_true
  FROM (SELECT DISTINCT user_id FROM {users}) u CROSS JOIN {name}_ks ks LEFT JOIN {name}_tstats ts ON ts.user_id = u.user_id),
{name} AS (SELECT b.user_id, CAST(b.k AS INTEGER) AS k, CAST(coalesce(p.n_hits, 0) AS BIGINT) AS n_hits,
    CAST(b.n_true AS BIGINT) AS n_true,
    CASE WHEN b.n_true > 0 THEN CAST(coalesce(p.n_hits, 0) AS DOUBLE) / b.k ELSE 0.0 END AS precision,
    CASE WHEN b.n_true > 0 THEN CAST(coalesce(p.n_hits, 0) AS DOUBLE) / b.n_true ELSE 0.0 END AS recall,
    CASE WHEN b.n_true > 0 THEN coalesce(p.dcg, 0.0) / list_sum(list_transform(range(1, least(b.k, b.n_true) + 1),
         lambda r: 1.0 / log2(r + 1))) ELSE 0.0 END AS ndcg,
    CASE WHEN b.n_true > 0 THEN coalesce(p.ap_sum, 0.0) / least(b.k, b.n_true) ELSE 0.0 END AS ap,
    CASE WHEN b.n_true > 0 AND p.first_hit IS NOT NULL THEN 1.0 / p.first_hit ELSE 0.0 END AS rr,
    CASE WHEN b.money_true <> 0 THEN coalesce(p.money_hit, 0.0) / b.money_true ELSE 0.0 END AS money_recall
  FROM {name}_base b LEFT JOIN {name}_perk p ON p.user_id = b.user_id AND p.k = b.k)"""


def q(ctes: str, select: str) -> str:
    return f"WITH {BASE},{ctes}\n{select}" if ctes.strip() else f"WITH {BASE}\n{select}"


II_STD = neighbours_cte() + "," + ii_recs_cte(N_CANDIDATES, "cands")


def wrand_cte(name: str, weighting: str, n: int = N_RECS, seed: int = SEED, draws: int = 64,
              measure: str = "count(*)") -> str:
    w = {"log": "CAST(round(ln(1 + m) * 1000000) AS BIGINT)", "log_strict": "CAST(round(ln(m) * 1000000) AS BIGINT)"}.get(weighting, "CAST(1 AS BIGINT)")
    return f"""
{name}_pop AS (SELECT item_id, {measure} AS m FROM train GROUP BY item_id),
{name}_w AS (SELECT item_id, {w} AS w FROM {name}_pop),
{name}_rng AS (SELECT item_id, CAST(sum(w) OVER (ORDER BY item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  AS BIGINT) AS hi, w FROM {name}_w WHERE w > 0),
{name}_tot AS (SELECT max(hi) AS total FROM {name}_rng),
{name}_draws AS (SELECT u.user_id, t.t,
    ('0x' || substr(md5(concat_ws('|', u.user_id, t.t, {seed})), 1, 15))::BIGINT % tt.total AS v
  FROM val_users u CROSS JOIN range(0, {draws}) t(t) CROSS JOIN {name}_tot tt),
{name}_hit AS (SELECT d.user_id, r.item_id, min(d.t) AS t FROM {name}_draws d
  JOIN {name}_rng r ON d.v >= r.hi - r.w AND d.v < r.hi GROUP BY 1, 2),
{name} AS (SELECT * FROM (SELECT user_id, item_id, -CAST(t AS DOUBLE) AS score,
    row_number() OVER (PARTITION BY user_id ORDER BY t, item_id) AS rank FROM {name}_hit) WHERE rank <= {n})"""


def weighted_random_sql(weighting: str) -> str:
    return q(wrand_cte("wr", weighting), "SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank FROM wr")


def pop_cte(name: str, n: int, measure: str = "count(*)", source: str = "train", users: str = "val_users") -> str:
    """Global top-n popular list ``item_id, rank`` and its per-user expansion ``<name>_recs``."""
    return f"""
{name} AS (SELECT * FROM (SELECT item_id, m AS score, row_number() OVER (ORDER BY round(m, 9) DESC, item_id) AS rank
  FROM (SELECT item_id, CAST({measure} AS DOUBLE) AS m FROM {source} GROUP BY item_id)) WHERE rank <= {n}),
{name}_recs AS (SELECT u.user_id, p.item_id, p.rank, p.score FROM {users} u CROSS JOIN {name} p)"""


def fill_cte(name: str, recs: str, pop: str, users: str, n: int) -> str:
    """Model list first, then popular items not yet in it, cut to n: ``<name>(user_id, item_id, rank)``."""
    return f"""
{name}_all AS (SELECT user_id, item_id, rank AS r, 0 AS src FROM {recs}
  UNION ALL SELECT u.user_id, p.item_id, 1000 + p.rank AS r, 1 AS src FROM {users} u CROSS JOIN {pop} p
  WHERE NOT EXISTS (SELECT 1 FROM {recs} x WHERE x.user_id = u.user_id AND x.item_id = p.item_id)),
{name} AS (SELECT * FROM (SELECT user_id, item_id, src, row_number() OVER (PARTITION BY user_id ORDER BY r) AS rank
  FROM {name}_all) WHERE rank <= {n})"""


PREFILTER_CTE = """
pf_st AS (SELECT item_id, count(DISTINCT user_id) AS n_users, sum(quantity) AS quantity, CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) AS sales,
  max(week_no) AS last_week FROM train GROUP BY item_id),
pf_g AS (SELECT count(DISTINCT user_id) AS n, max(week_no) AS w FROM train),
pf_kept AS (SELECT s.*, s.sales / s.quantity AS unit_price FROM pf_st s CROSS JOIN pf_g g
  WHERE s.n_users <= 0.5 * g.n AND s.n_users >= 0.01 * g.n AND s.last_week > g.w - 52
    AND s.sales / s.quantity >= 50.0 AND s.sales / s.quantity <= 20000.0),
pf AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY quantity DESC, item_id) AS qty_rank FROM pf_kept)
  WHERE qty_rank <= 1000)"""


def weighted_mat_cte(name: str, kind: str) -> str:
    """TF-IDF or BM25 weights of the training count matrix."""
    head = f"""
{name}_cnt AS (SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS q FROM train GROUP BY 1, 2),
{name}_len AS (SELECT user_id, sum(q) AS len FROM {name}_cnt GROUP BY 1),
{name}_st AS (SELECT count(*) AS n, avg(len) AS avg_len FROM {name}_len),
{name}_df AS (SELECT item_id, count(*) AS df FROM {name}_cnt GROUP BY 1),"""
    if kind == "tfidf":
        w = "c.q * ln((s.n + 1.0) / (d.df + 1.0))"
    else:
        w = "ln(1.0 + (s.n - d.df + 0.5) / (d.df + 0.5)) * c.q * 2.2 / (c.q + 1.2 * (0.25 + 0.75 * l.len / s.avg_len))"
    return head + f"""
{name} AS (SELECT c.user_id, c.item_id, {w} AS weight FROM {name}_cnt c JOIN {name}_df d ON d.item_id = c.item_id
  JOIN {name}_len l ON l.user_id = c.user_id CROSS JOIN {name}_st s)"""


def metric_sql(metric: str) -> str:
    return q(II_STD + "," + metrics_cte("cands"),
             f"SELECT user_id, k, round({metric}, 6) AS {metric} FROM met")


SQL: dict[str, str] = {
    "interactions": q("", "SELECT user_id, basket_id, item_id, week_no, quantity, sales_value FROM inter"),
    "week_range": q("", f"SELECT user_id, basket_id, item_id, week_no, quantity, sales_value FROM inter "
                        f"WHERE week_no BETWEEN {WEEK_LO} AND {WEEK_HI}"),
    "split_sizes": q("", """
SELECT 'level1_train' AS split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT item_id) AS BIGINT) AS n_items FROM train
UNION ALL SELECT 'level2_train', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM lvl2
UNION ALL SELECT 'level2_valid', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM val"""),
    "popular_items": q("""
pop AS (SELECT item_id, CAST(count(*) AS BIGINT) AS n_purchases, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
  sum(quantity) AS quantity, sum(sales_value) AS sales FROM train GROUP BY item_id)""", """
SELECT item_id, n_purchases, n_users, round(quantity, 6) AS quantity, round(sales, 6) AS sales,
  CAST(row_number() OVER (ORDER BY n_purchases DESC, item_id) AS BIGINT) AS rank FROM pop"""),
    "weighted_random": weighted_random_sql("log"),
    "uniform_random": weighted_random_sql("uniform"),
    "tfidf_weights": q("""
cnt AS (SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS q FROM inter GROUP BY 1, 2),
nu AS (SELECT count(DISTINCT user_id) AS n FROM cnt),
dfi AS (SELECT item_id, count(*) AS df FROM cnt GROUP BY 1)""", """
SELECT c.user_id, c.item_id, round(c.q * ln((nu.n + 1.0) / (dfi.df + 1.0)), 6) AS weight
FROM cnt c JOIN dfi ON dfi.item_id = c.item_id CROSS JOIN nu"""),
    "bm25_weights": q("""
cnt AS (SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS q FROM inter GROUP BY 1, 2),
lens AS (SELECT user_id, sum(q) AS len FROM cnt GROUP BY 1),
stats AS (SELECT count(*) AS n, avg(len) AS avg_len FROM lens),
dfi AS (SELECT item_id, count(*) AS df FROM cnt GROUP BY 1)""", """
SELECT c.user_id, c.item_id, round(ln(1.0 + (s.n - dfi.df + 0.5) / (dfi.df + 0.5)) * c.q * 2.2
  / (c.q + 1.2 * (0.25 + 0.75 * l.len / s.avg_len)), 6) AS weight
FROM cnt c JOIN dfi ON dfi.item_id = c.item_id JOIN lens l ON l.user_id = c.user_id CROSS JOIN stats s"""),
    "lsh_recall": """
SELECT count(*) AS n_vectors, CAST(sum(least(5, n - 1)) AS BIGINT) AS n_exact, CAST(0 AS BIGINT) AS n_other_sim, true AS recall_at_least_09
FROM embeddings CROSS JOIN (SELECT count(*) AS n FROM embeddings) t""",
    "item_item_neighbours": q(neighbours_cte(), """
SELECT item_id, neighbour_id, CAST(rank AS BIGINT) AS rank, round(sim, 6) AS sim FROM nbrs"""),
    "item_item_recs": q(neighbours_cte() + "," + ii_recs_cte(N_RECS, "recs"), """
SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM recs"""),
    "precision_at_k": metric_sql("precision"),
    "recall_at_k": metric_sql("recall"),
    "ndcg_at_k": metric_sql("ndcg"),
    "map_at_k": metric_sql("ap"),
    "mrr_at_k": metric_sql("rr"),
    "money_recall_at_k": metric_sql("money_recall"),
    "metric_means": q(II_STD + "," + metrics_cte("cands"), """
SELECT k, CAST(count(*) AS BIGINT) AS n_users, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
  round(avg(ndcg), 6) AS ndcg, round(avg(ap), 6) AS ap, round(avg(rr), 6) AS rr,
  round(avg(money_recall), 6) AS money_recall FROM met GROUP BY k"""),
}


def _mean_cols(prefix: str = "") -> str:
    return ", ".join(f"round(avg({m}), 6) AS {m}" for m in ("precision", "recall", "ndcg", "ap", "rr", "money_recall"))


_SUMMARY_ALGOS = {"popular": "pop5_recs", "weighted_random": "wr", "uniform_random": "ur", "item_item": "ii5"}
_SUMMARY_CTES = (neighbours_cte() + "," + ii_recs_cte(N_RECS, "ii5") + "," + pop_cte("pop5", N_RECS) + ","
                 + wrand_cte("wr", "log") + "," + wrand_cte("ur", "uniform") + ","
                 + ",".join(metrics_cte(rel, (3, 5), name=f"m_{alg}") for alg, rel in _SUMMARY_ALGOS.items()))
_SUMMARY_SELECT = " UNION ALL ".join(
    f"""SELECT '{alg}' AS algorithm,
  round(avg(CASE WHEN k = 3 THEN precision END), 6) AS precision_at_3, round(avg(CASE WHEN k = 5 THEN precision END), 6) AS precision_at_5,
  round(avg(CASE WHEN k = 3 THEN recall END), 6) AS recall_at_3, round(avg(CASE WHEN k = 5 THEN recall END), 6) AS recall_at_5
FROM m_{alg}""" for alg in _SUMMARY_ALGOS)

RECALL_KS = (10, 50, 200, 500, 1000)
_CURVE_CTES = (neighbours_cte() + "," + ii_recs_cte(max(RECALL_KS), "ii_long") + "," + pop_cte("pop_long", max(RECALL_KS))
               + "," + metrics_cte("pop_long_recs", RECALL_KS, name="mc_pop") + ","
               + metrics_cte("ii_long", RECALL_KS, name="mc_ii"))

# model grid of the best / worst report: (model_id, recs relation)
_GRID = {"ii_k20_binary": "g_ii20", "ii_k5_binary": "g_ii5", "ii_k20_tfidf": "g_tf20", "ii_k20_bm25": "g_bm20",
         "pop_count": "g_popc_recs", "pop_sales": "g_pops_recs", "wrand_seed1": "g_wr1", "wrand_seed2": "g_wr2"}
_GRID_CTES = (neighbours_cte() + "," + ii_recs_cte(N_RECS, "g_ii20") + ","
              + neighbours_cte(k=5, name="nb5") + "," + ii_recs_cte(N_RECS, "g_ii5", nbrs="nb5") + ","
              + weighted_mat_cte("tfm", "tfidf") + "," + neighbours_cte("tfm", name="nbtf") + ","
              + ii_recs_cte(N_RECS, "g_tf20", mat="tfm", nbrs="nbtf") + ","
              + weighted_mat_cte("bmm", "bm25") + "," + neighbours_cte("bmm", name="nbbm") + ","
              + ii_recs_cte(N_RECS, "g_bm20", mat="bmm", nbrs="nbbm") + ","
              + pop_cte("g_popc", N_RECS) + "," + pop_cte("g_pops", N_RECS, "sum(sales_value)") + ","
              + wrand_cte("g_wr1", "log", seed=1) + "," + wrand_cte("g_wr2", "log", seed=2) + ","
              + ",".join(metrics_cte(rel, (N_RECS,), name=f"gm_{mid}") for mid, rel in _GRID.items()) + ",\nreport AS ("
              + " UNION ALL ".join(f"SELECT '{mid}' AS model_id, avg(precision) AS value FROM gm_{mid}" for mid in _GRID)
              + ")")

SQL.update({
    "eval_users": q("", """
SELECT u.user_id, NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id) AS is_cold FROM val_users u"""),
    "user_item_matrix": q("", "SELECT user_id, item_id, round(sum(quantity), 6) AS weight FROM train GROUP BY 1, 2"),
    "prefilter_items": q(PREFILTER_CTE, """
SELECT item_id, CAST(n_users AS BIGINT) AS n_users, round(quantity, 6) AS quantity, round(unit_price, 6) AS unit_price,
  last_week, CAST(qty_rank AS BIGINT) AS qty_rank FROM pf"""),
    "top_without_fake": q(PREFILTER_CTE + f""",
ctrain AS (SELECT t.user_id, CASE WHEN k.item_id IS NOT NULL THEN t.item_id ELSE {FAKE_ITEM} END AS item_id
  FROM train t LEFT JOIN pf k ON k.item_id = t.item_id),
cmat AS (SELECT DISTINCT user_id, item_id, 1.0 AS weight FROM ctrain),""" + neighbours_cte("cmat", name="cnb") + ","
                          + ii_recs_cte(6, "crecs", mat="cmat", nbrs="cnb", exclude_seen=False) + f""",
fin AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank FROM crecs
  WHERE item_id <> {FAKE_ITEM})""", f"SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank FROM fin WHERE rank <= {N_RECS}"),
    "fill_popular": q(neighbours_cte() + "," + ii_recs_cte(N_RECS, "recs5") + "," + pop_cte("pop5", N_RECS) + """,
allc AS (SELECT user_id, item_id, rank AS r, 0 AS src FROM recs5
  UNION ALL SELECT u.user_id, p.item_id, 1000 + p.rank AS r, 1 AS src FROM val_users u CROSS JOIN pop5 p
  WHERE NOT EXISTS (SELECT 1 FROM recs5 x WHERE x.user_id = u.user_id AND x.item_id = p.item_id)),
fin AS (SELECT user_id, item_id, src, row_number() OVER (PARTITION BY user_id ORDER BY r) AS rank FROM allc)""",
                      f"""SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank,
  CASE WHEN src = 0 THEN 'model' ELSE 'popular' END AS source FROM fin WHERE rank <= {N_RECS}"""),
    "chunk_assign": q("""
num AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders)""",
                      "SELECT o_orderkey, CAST(row_no AS BIGINT) AS row_no, CAST((row_no - 1) // 1000 AS BIGINT) AS chunk_id FROM num"),
    "chunk_manifest": q("""
num AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders)""", """
SELECT CAST((row_no - 1) // 1000 AS BIGINT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(min(row_no) AS BIGINT) AS first_row, CAST(max(row_no) AS BIGINT) AS last_row,
  min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM num GROUP BY 1"""),
    "recall_curve": q(_CURVE_CTES, """
SELECT 'popular' AS generator, k, round(avg(recall), 6) AS recall FROM mc_pop GROUP BY k
UNION ALL SELECT 'item_item' AS generator, k, round(avg(recall), 6) AS recall FROM mc_ii GROUP BY k"""),
    "algorithm_summary": q(_SUMMARY_CTES, _SUMMARY_SELECT),
    "best_worst": q(_GRID_CTES, """
SELECT * FROM (SELECT 'best' AS side, CAST(row_number() OVER (ORDER BY round(value, 9) DESC, model_id) AS BIGINT) AS place,
  model_id, round(value, 6) AS value FROM report) WHERE place <= 5
UNION ALL SELECT * FROM (SELECT 'worst' AS side, CAST(row_number() OVER (ORDER BY round(value, 9), model_id) AS BIGINT) AS place,
  model_id, round(value, 6) AS value FROM report) WHERE place <= 5"""),
    "candidate_union": q(neighbours_cte() + "," + ii_recs_cte(50, "ii50") + "," + pop_cte("pop50", 50) + """,
u AS (SELECT user_id, item_id, rank, 'item_item' AS source FROM ii50
  UNION ALL SELECT user_id, item_id, rank, 'popular' AS source FROM pop50_recs)""", """
SELECT user_id, item_id, CAST(min(rank) AS BIGINT) AS best_rank, CAST(count(*) AS BIGINT) AS n_sources,
  string_agg(source, ',' ORDER BY source) AS sources FROM u GROUP BY 1, 2"""),
    "result_table": q(neighbours_cte() + "," + ii_recs_cte(N_RECS, "ii5") + "," + pop_cte("pop5", N_RECS) + ","
                      + wrand_cte("wr", "log"), """
SELECT u.user_id,
  coalesce((SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FROM truth t WHERE t.user_id = u.user_id), '') AS bought,
  coalesce((SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) FROM pop5_recs r WHERE r.user_id = u.user_id), '') AS popular,
  coalesce((SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) FROM ii5 r WHERE r.user_id = u.user_id), '') AS item_item,
  coalesce((SELECT string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) FROM wr r WHERE r.user_id = u.user_id), '') AS weighted_random
FROM val_users u"""),
    "list_metrics": q(II_STD + "," + metrics_cte("cands", (5, 10)), """
SELECT user_id,
  """ + ",\n  ".join(f"round(max(CASE WHEN k = {k} THEN {m} END), 6) AS {m}_at_{k}"
                      for k in (5, 10) for m in ("precision", "recall", "ndcg", "ap", "rr", "money_recall")) + """
FROM met GROUP BY user_id"""),
})


_HIST = """
ph AS (SELECT user_id, item_id, count(*) AS tb, max(week_no) AS lw FROM train GROUP BY 1, 2),
th AS (SELECT t.user_id, p.p_type AS type, CAST(sum(CAST(t.sales_value AS DECIMAL(18,2))) AS DOUBLE) AS st FROM train t
  LEFT JOIN part p ON p.p_partkey = t.item_id GROUP BY 1, 2),
sa AS (SELECT user_id, CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) AS sa, CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) / sum(quantity) AS up FROM train GROUP BY 1),
ip AS (SELECT item_id, CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) / sum(quantity) AS ip FROM train GROUP BY 1)"""

def content_cte(n: int) -> str:
    return f"""
feat AS (SELECT p_partkey AS item_id, 'brand=' || p_brand AS feature FROM part
  UNION ALL SELECT p_partkey, 'type=' || p_type FROM part
  UNION ALL SELECT p_partkey, 'size=' || CAST(p_size AS VARCHAR) FROM part),
ucnt AS (SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS q FROM train
  WHERE user_id IN (SELECT user_id FROM val_users) GROUP BY 1, 2),
prof AS (SELECT u.user_id, f.feature, sum(u.q) AS w FROM ucnt u JOIN feat f ON f.item_id = u.item_id GROUP BY 1, 2),
pn AS (SELECT user_id, sqrt(sum(w * w)) AS n FROM prof GROUP BY 1),
inn AS (SELECT item_id, sqrt(count(*)) AS n FROM feat GROUP BY 1),
sc AS (SELECT p.user_id, f.item_id, sum(p.w) AS dot FROM prof p JOIN feat f ON f.feature = p.feature GROUP BY 1, 2),
s2 AS (SELECT sc.user_id, sc.item_id, sc.dot / (pn.n * inn.n) AS score FROM sc
  JOIN pn ON pn.user_id = sc.user_id JOIN inn ON inn.item_id = sc.item_id
  WHERE NOT EXISTS (SELECT 1 FROM ucnt x WHERE x.user_id = sc.user_id AND x.item_id = sc.item_id)),
cb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM s2) WHERE rank <= {n})"""


CONTENT_CTE = content_cte(N_RECS)
_GENERATORS = {"popular": "gp_recs", "item_item": "gi", "content": "cb", "random_log": "gl", "random_log_strict": "gs", "random_uniform": "gu"}
_GENERATED_CTES = (neighbours_cte() + "," + ii_recs_cte(50, "gi") + "," + pop_cte("gp", 50) + "," + content_cte(50) + ","
                   + ",".join(wrand_cte(name, law, 50, draws=1600) for name, law in (("gl", "log"), ("gs", "log_strict"), ("gu", "uniform"))) + ","
                   + "gall AS (" + " UNION ALL ".join(f"SELECT '{g}' AS generator, user_id, item_id, rank FROM {t}" for g, t in _GENERATORS.items()) + """),
gt AS (SELECT user_id, count(DISTINCT item_id) AS n_true FROM truth GROUP BY user_id),
gk AS (SELECT unnest([5, 10, 50]) AS k),
gh AS (SELECT g.generator, gk.k, g.user_id, count(t.item_id) FILTER (WHERE g.rank <= gk.k) AS hits FROM gall g CROSS JOIN gk
  LEFT JOIN (SELECT DISTINCT user_id, item_id FROM truth) t ON t.user_id = g.user_id AND t.item_id = g.item_id GROUP BY 1, 2, 3)""")

SQL.update({
    "generator_recall": q(_GENERATED_CTES, """
SELECT h.generator, CAST(h.k AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS n_lists, round(sum(CAST(hits AS DOUBLE) / n_true) / (SELECT count(*) FROM val_users), 6) AS recall
FROM gh h JOIN gt ON gt.user_id = h.user_id GROUP BY 1, 2"""),
    "user_features": q("", """
SELECT user_id, CAST(count(DISTINCT basket_id) AS BIGINT) AS n_baskets, CAST(count(DISTINCT item_id) AS BIGINT) AS n_items,
  round(CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT basket_id), 6) AS mean_basket_value,
  round(CAST(sum(CAST(sales_value AS DECIMAL(18,2))) AS DOUBLE) / sum(quantity), 6) AS mean_price,
  CAST(""" + str(LEVEL2_START) + """ - max(week_no) AS BIGINT) AS weeks_since_last FROM train GROUP BY user_id"""),
    "item_features": q(f"""
pp AS (SELECT item_id, user_id, count(DISTINCT basket_id) AS nb, sum(quantity) AS q,
  sum(CAST(sales_value AS DECIMAL(18,2))) AS s FROM train GROUP BY 1, 2),
b AS (SELECT item_id, count(*) AS n_buyers, sum(q) / {float(LEVEL2_START)} AS units_per_week,
  CAST(sum(s) AS DOUBLE) / sum(q) AS mean_price,
  CAST(sum(CASE WHEN nb >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS repeat_rate FROM pp GROUP BY 1),
t AS (SELECT b.*, p.p_type AS type FROM b LEFT JOIN part p ON p.p_partkey = b.item_id),
tm AS (SELECT type, avg(mean_price) AS tp FROM t GROUP BY type)""", """
SELECT t.item_id, CAST(t.n_buyers AS BIGINT) AS n_buyers, round(t.units_per_week, 6) AS units_per_week,
  round(t.mean_price, 6) AS mean_price, round(t.mean_price / tm.tp, 6) AS price_share_in_type,
  round(t.repeat_rate, 6) AS repeat_rate FROM t LEFT JOIN tm ON tm.type = t.type"""),
    "pair_features": q(II_STD + "," + _HIST, f"""
SELECT c.user_id, c.item_id, CAST(coalesce(ph.tb, 0) AS BIGINT) AS times_bought,
  CAST(coalesce({LEVEL2_START} - ph.lw, -1) AS BIGINT) AS pair_weeks_since_last,
  round(coalesce(th.st / sa.sa, 0.0), 6) AS type_spend_share, round(coalesce(ip.ip - sa.up, 0.0), 6) AS price_diff,
  round(c.score, 6) AS l1_score, CAST(c.rank AS BIGINT) AS l1_rank
FROM cands c LEFT JOIN part p ON p.p_partkey = c.item_id
  LEFT JOIN ph ON ph.user_id = c.user_id AND ph.item_id = c.item_id
  LEFT JOIN th ON th.user_id = c.user_id AND th.type = p.p_type
  LEFT JOIN sa ON sa.user_id = c.user_id LEFT JOIN ip ON ip.item_id = c.item_id"""),
    "similar_items_vectors": q("""
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
es AS (SELECT a.vec_id, b.vec_id AS neighbour_id, list_cosine_similarity(a.v, b.v) AS sim
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
er AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, neighbour_id) AS rank FROM es)""",
                               """SELECT vec_id, neighbour_id, CAST(rank AS BIGINT) AS rank, round(sim, 6) AS sim
FROM er WHERE rank <= 5"""),
    "similar_users": q(neighbours_cte(k=5, name="unb", key="item_id", other="user_id"), """
SELECT user_id, neighbour_id, CAST(rank AS BIGINT) AS rank, round(sim, 6) AS sim FROM unb"""),
    "content_based": q(CONTENT_CTE, """
SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM cb"""),
})


_FILL = neighbours_cte() + "," + ii_recs_cte(N_RECS, "recs5") + "," + pop_cte("pop5", N_RECS) + """,
allc AS (SELECT user_id, item_id, rank AS r, 0 AS src FROM recs5
  UNION ALL SELECT u.user_id, p.item_id, 1000 + p.rank AS r, 1 AS src FROM val_users u CROSS JOIN pop5 p
  WHERE NOT EXISTS (SELECT 1 FROM recs5 x WHERE x.user_id = u.user_id AND x.item_id = p.item_id)),
fin AS (SELECT * FROM (SELECT user_id, item_id, src, row_number() OVER (PARTITION BY user_id ORDER BY r) AS rank
  FROM allc) WHERE rank <= """ + str(N_RECS) + ")"

SQL.update({
    "quality_gate": q(_FILL + "," + metrics_cte("fin", (N_RECS,), name="qg"), """
SELECT round(avg(precision), 6) AS precision_at_5, round(avg(ap), 6) AS map_at_5, CAST(0.22 AS DOUBLE) AS threshold,
  avg(precision) > 0.22 AS passes FROM qg"""),
    "chunk_manifest_reference": q("""
num AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders),
man AS (SELECT CAST((row_no - 1) // 1000 AS BIGINT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(min(row_no) AS BIGINT) AS first_row, CAST(max(row_no) AS BIGINT) AS last_row FROM num GROUP BY 1)""", """
SELECT * FROM man
UNION ALL SELECT CAST(count(*) // 1000 AS BIGINT), CAST(0 AS BIGINT), CAST(count(*) + 1 AS BIGINT),
  CAST(count(*) AS BIGINT) FROM orders HAVING count(*) % 1000 = 0"""),
})


# take 6, drop the fake item, keep 5 -- then MAP@5 and Precision@5 of those lists
_FAKE_LISTS = PREFILTER_CTE + f""",
ctrain AS (SELECT t.user_id, CASE WHEN k.item_id IS NOT NULL THEN t.item_id ELSE {FAKE_ITEM} END AS item_id
  FROM train t LEFT JOIN pf k ON k.item_id = t.item_id),
cmat AS (SELECT DISTINCT user_id, item_id, 1.0 AS weight FROM ctrain),""" + neighbours_cte("cmat", name="cnb") + "," \
    + ii_recs_cte(6, "crecs", mat="cmat", nbrs="cnb", exclude_seen=False) + f""",
fin AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank
  FROM crecs WHERE item_id <> {FAKE_ITEM}) WHERE rank <= {N_RECS})"""

# recommendations from the weeks 96..98 only, scored on the following three weeks
_WINDOW = f"""
w_train AS (SELECT * FROM inter WHERE week_no BETWEEN {WEEK_LO} AND {WEEK_HI}),
w_hold AS (SELECT * FROM inter WHERE week_no BETWEEN {WEEK_HI + 1} AND {WEEK_HI + 3}),
w_users AS (SELECT DISTINCT user_id FROM w_hold),
w_truth AS (SELECT user_id, item_id, sum(sales_value) AS spent FROM w_hold GROUP BY 1, 2),
w_mat AS (SELECT DISTINCT user_id, item_id, 1.0 AS weight FROM w_train),""" + neighbours_cte("w_mat", name="wnb") + "," \
    + ii_recs_cte(N_RECS, "wrecs", users="w_users", mat="w_mat", nbrs="wnb") + "," \
    + pop_cte("wpop", N_RECS, source="w_train", users="w_users") + "," + fill_cte("wfin", "wrecs", "wpop", "w_users", N_RECS)

SQL.update({
    "fake_item_metrics": q(_FAKE_LISTS + ",\nfin_users AS (SELECT DISTINCT user_id FROM fin),"
                           + metrics_cte("fin", (N_RECS,), name="fm5", users="fin_users"), """
SELECT round(avg(precision), 6) AS precision_at_5, round(avg(ap), 6) AS map_at_5, CAST(count(*) AS BIGINT) AS n_users
FROM fm5"""),
    "window_quality_gate": q(_WINDOW + "," + metrics_cte("wfin", (N_RECS,), name="wm", users="w_users", truth="w_truth"), """
SELECT round(avg(precision), 6) AS precision_at_5, round(avg(ap), 6) AS map_at_5, CAST(0.22 AS DOUBLE) AS threshold,
  avg(precision) > 0.22 AS passes, CAST(count(*) AS BIGINT) AS n_users FROM wm"""),
})

SQL.update({
    "als_recs_check": q("", f"""
SELECT user_id, CAST({N_RECS} AS BIGINT) AS n_items, CAST({N_RECS} AS BIGINT) AS last_rank, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_unknown
FROM val_users WHERE user_id IN (SELECT user_id FROM train)"""),
    "hybrid_fm_recs_check": q("", f"""
SELECT user_id, CAST({N_RECS} AS BIGINT) AS n_items, CAST({N_RECS} AS BIGINT) AS last_rank, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_unknown
FROM val_users WHERE user_id IN (SELECT user_id FROM train)"""),
    "two_level_recs_check": q(II_STD, f"""
SELECT user_id, least(count(*), {N_RECS}) AS n_items, least(count(*), {N_RECS}) AS last_rank, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_unknown
FROM cands GROUP BY user_id"""),
    "negative_pairs_check": q("", """
SELECT user_id, least(count(*), (SELECT count(*) FROM part) - count(*)) AS n_negatives, CAST(0 AS BIGINT) AS n_bought FROM mat GROUP BY user_id"""),
    "split_by_week": q("", f"""
SELECT CASE WHEN week_no < {VALID_START} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
  count(DISTINCT item_id) AS n_items FROM inter GROUP BY 1"""),
    "holdout_split": q(f"""
parts AS (SELECT 'level1_train' AS split, * FROM train UNION ALL SELECT 'level2_train', * FROM lvl2
  UNION ALL SELECT 'holdout', * FROM inter WHERE week_no BETWEEN {WEEK_LO} AND {WEEK_HI})""",
                       "SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM parts GROUP BY 1"),
    "list_round_trip": q(neighbours_cte() + "," + ii_recs_cte(10, "recs"), "SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank FROM recs"),
    "csv_round_trip": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "grid_log": q(_GRID_CTES + """,
gl AS (""" + " UNION ALL ".join(f"SELECT '{mid}' AS model_id, avg(precision) AS p, avg(ap) AS m FROM gm_{mid}" for mid in _GRID if mid.startswith("ii_")) + ")", f"""
SELECT model_id, CASE WHEN model_id LIKE 'ii_k5%' THEN CAST(5 AS BIGINT) ELSE CAST(20 AS BIGINT) END AS k_neighbours, split_part(model_id, '_', 3) AS weighting,
  round(p, 6) AS precision_at_{N_RECS}, round(m, 6) AS map_at_{N_RECS},
  row_number() OVER (ORDER BY round(p, 9) DESC, model_id) = 1 AS is_best FROM gl"""),
    "newton_ranker_check": q("""
lvl2_users AS (SELECT DISTINCT user_id FROM lvl2),""" + neighbours_cte() + "," + ii_recs_cte(N_CANDIDATES, "c", users="lvl2_users") + """,
later AS (SELECT DISTINCT user_id, item_id FROM lvl2)""", """
SELECT count(*) AS n_rows, count(l.user_id) AS n_positive, true AS optimal
FROM c LEFT JOIN later l ON l.user_id = c.user_id AND l.item_id = c.item_id"""),
    "csv_splits": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, '"' || o_orderstatus || '", ' || chr(10) || o_orderpriority || chr(10) AS note,
  row_number() OVER (ORDER BY o_orderkey) AS row_no, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk_id FROM orders""",
    "facade_recs": q("\nall_users AS (SELECT DISTINCT user_id FROM train)," + neighbours_cte() + "," + ii_recs_cte(N_RECS, "recs", users="all_users") + ","
                     + pop_cte("pop", N_RECS, users="all_users") + "," + fill_cte("fin", "recs", "pop", "all_users", N_RECS),
                     "SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank FROM fin"),
    "restricted_recs": q(neighbours_cte() + "," + pop_cte("pop", 100) + """,
near AS (SELECT * FROM nbrs WHERE neighbour_id IN (SELECT item_id FROM pop)),""" + ii_recs_cte(N_RECS, "recs", nbrs="near"),
                         "SELECT user_id, item_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM recs"),
    "training_frame": q("""
lvl2_users AS (SELECT DISTINCT user_id FROM lvl2),""" + neighbours_cte() + "," + ii_recs_cte(N_CANDIDATES, "c", users="lvl2_users") + """,
bought AS (SELECT user_id, item_id, count(*) AS n FROM train GROUP BY 1, 2),
later AS (SELECT DISTINCT user_id, item_id FROM lvl2),
per_user AS (SELECT user_id, count(DISTINCT basket_id) AS n_baskets, count(DISTINCT item_id) AS n_items FROM train GROUP BY 1)""", """
SELECT c.user_id, c.item_id, CAST(l.user_id IS NOT NULL AS INTEGER) AS label, coalesce(b.n, 0) AS times_bought, CAST(c.rank AS BIGINT) AS l1_rank,
  round(c.score, 6) AS l1_score, coalesce(u.n_baskets, 0) AS n_baskets, coalesce(u.n_items, 0) AS n_items
FROM c LEFT JOIN bought b ON b.user_id = c.user_id AND b.item_id = c.item_id LEFT JOIN later l ON l.user_id = c.user_id AND l.item_id = c.item_id
  LEFT JOIN per_user u ON u.user_id = c.user_id"""),
})

"""User-item matrix (coordinate form) and TF-IDF / BM25 re-weighting.

The matrix is never pivoted: it stays ``user_id, item_id, weight`` rows. Users play the role of
documents and items the role of terms.

* TF-IDF: ``w = q * ln((N + 1) / (df + 1))`` -- the smoothed IDF of Spark ML's ``IDF``.
* BM25 (Robertson and Zaragoza 2009): ``w = ln(1 + (N - df + 0.5) / (df + 0.5))
  * q (k1 + 1) / (q + k1 (1 - b + b * len_u / avg_len))`` with ``len_u = sum_i q_ui``.

N and the average length are two scalars from one small aggregate job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUE_COLUMNS = {"count": None, "quantity": "quantity", "sales": "sales_value"}


def user_item_matrix(inter: DataFrame, value: str = "count") -> DataFrame:
    """``user_id, item_id, weight``: purchases per pair (count / summed quantity / summed sales)."""
    if value not in VALUE_COLUMNS:
        raise ValueError(f"unknown value {value!r}")
    col = VALUE_COLUMNS[value]
    agg = F.count(F.lit(1)).cast("double") if col is None else F.sum(col).cast("double")
    return inter.groupBy("user_id", "item_id").agg(agg.alias("weight"))


def binary_matrix(inter: DataFrame) -> DataFrame:
    return inter.select("user_id", "item_id").distinct().withColumn("weight", F.lit(1.0))


def _doc_stats(mat: DataFrame) -> tuple[int, float]:
    row = mat.groupBy("user_id").agg(F.sum("weight").alias("len")) \
        .agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("avg_len")).collect()[0]
    return int(row["n"] or 0), float(row["avg_len"] or 0.0)


def _item_df(mat: DataFrame) -> DataFrame:
    return mat.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("df"))


def tfidf(mat: DataFrame, n_users: int | None = None) -> DataFrame:
    """TF-IDF weights of a ``user_id, item_id, weight`` matrix."""
    n = n_users if n_users is not None else _doc_stats(mat)[0]
    idf = _item_df(mat).select("item_id", F.log((F.lit(n + 1.0)) / (F.col("df") + 1.0)).alias("idf"))
    return (mat.join(idf, "item_id")
            .select("user_id", "item_id", (F.col("weight") * F.col("idf")).alias("weight")))


def bm25(mat: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 weights of a ``user_id, item_id, weight`` matrix."""
    n, avg_len = _doc_stats(mat)
    idf = _item_df(mat).select(
        "item_id", F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    lens = mat.groupBy("user_id").agg(F.sum("weight").alias("len"))
    q = F.col("weight")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("len") / F.lit(avg_len if avg_len else 1.0))
    return (mat.join(lens, "user_id").join(idf, "item_id")
            .select("user_id", "item_id",
                    (F.col("idf") * q * F.lit(k1 + 1.0) / (q + norm)).alias("weight")))


def weigh(mat: DataFrame, weighting: str = "none", **kw) -> DataFrame:
    """``none`` keeps the weights, ``binary`` makes them 1, ``tfidf`` and ``bm25`` re-weight."""
    if weighting in ("none", None):
        return mat
    if weighting == "binary":
        return mat.withColumn("weight", F.lit(1.0))
    if weighting == "tfidf":
        return tfidf(mat)
    if weighting == "bm25":
        return bm25(mat, **kw)
    raise ValueError(f"unknown weighting {weighting!r}")

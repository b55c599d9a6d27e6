"""Purchase interactions built from the order / line-item star schema.

Mapping: user = order customer, basket = order, item = line-item part, quantity and sales from the
line item, and ``week_no`` = whole weeks since ``EPOCH``. Everything stays lazy so Catalyst can
prune columns and push filters (e.g. a week range) into the parquet scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: week 0 starts on the first order date of the supplied data.
EPOCH = "1995-01-01"

INTERACTION_COLUMNS = ["user_id", "basket_id", "item_id", "week_no", "quantity", "sales_value"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def week_of(ts: Column, epoch: str = EPOCH) -> Column:
    """Whole weeks between ``epoch`` and the date of ``ts`` (floor division)."""
    return F.floor(F.datediff(F.to_date(ts), F.lit(epoch).cast("date")) / 7).cast("int")


def week_start(week: int, epoch: str = EPOCH) -> str:
    """First instant of ``week`` as an ISO timestamp string."""
    d = _dt.date.fromisoformat(epoch) + _dt.timedelta(days=7 * week)
    return f"{d.isoformat()} 00:00:00"


def date_range_filter(df: DataFrame, ts_col: str, lo_week: int | None, hi_week: int | None) -> DataFrame:
    """Keep rows whose week is in [lo_week, hi_week], written as a range on the raw timestamp so
    the parquet scan can skip row groups (a filter on the derived week number cannot be pushed).
    week(ts) < W  <=>  date(ts) < epoch + 7W days  <=>  ts < epoch + 7W days (00:00)."""
    typ = df.schema[ts_col].dataType
    if lo_week is not None:
        df = df.filter(F.col(ts_col) >= F.lit(week_start(lo_week)).cast(typ))
    if hi_week is not None:
        df = df.filter(F.col(ts_col) < F.lit(week_start(hi_week + 1)).cast(typ))
    return df


def load_interactions(spark: SparkSession, sf_dir: str, with_date: bool = False,
                      weeks: tuple[int | None, int | None] | None = None) -> DataFrame:
    """One row per purchase line: ``user_id, basket_id, item_id, week_no, quantity, sales_value``.

    ``weeks=(lo, hi)`` (inclusive, either side open with None) is pushed into the order scan as a
    date range. The order table is the smaller side of the join; Spark broadcasts it only when its
    size estimate is under the broadcast threshold, otherwise both sides shuffle on the order key.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("basket_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate"),
    )
    if weeks is not None:
        orders = date_range_filter(orders, "o_orderdate", weeks[0], weeks[1])
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("sales_value"),
    )
    out = lines.join(orders, "basket_id").withColumn("week_no", week_of(F.col("o_orderdate")))
    cols = list(INTERACTION_COLUMNS)
    if with_date:
        out = out.withColumn("event_date", F.to_date("o_orderdate"))
        cols.append("event_date")
    return out.select(*cols)


def item_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue price per item (``item_id, price``), used by Money Recall."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_retailprice").alias("price"))


def item_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item attributes for content-based scoring: ``item_id, brand, type, size, name``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"), F.col("p_size").alias("size"), F.col("p_name").alias("name"))


def user_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes: ``user_id, segment, nation_key, acctbal``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("acctbal"))


# Column types of the interactions schema.
INTERACTION_TYPES = {"user_id": "bigint", "basket_id": "bigint", "item_id": "bigint", "week_no": "int",
                     "quantity": "double", "sales_value": "double"}


def interactions_from_csv(spark: SparkSession, path: str, columns: dict[str, str] | None = None,
                          on_bad: str = "fail") -> DataFrame:
    """Interactions from a text CSV (e.g. a separate hold-out file). ``columns`` maps our names to
    the file's header names (identity by default); values are cast to the interaction types.
    A value that does not parse fails the read (``on_bad='fail'``) or drops its row
    (``on_bad='drop'``)."""
    from .csv_table import read_csv_table
    if on_bad not in ("fail", "drop"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    raw = read_csv_table(spark, path)
    mapping = columns or {c: c for c in INTERACTION_COLUMNS}

    if missing := [c for c in ("user_id", "item_id", "week_no") if c not in mapping]:
        raise ValueError(f"no column is given for {missing}")

    def conv(src: str, typ: str):
        c = F.col(f"`{src}`")
        value = c.try_cast(typ)
        if on_bad == "drop":
            return value
        # an explicit check: a plain cast fails in ANSI mode only
        bad = F.raise_error(F.concat(F.lit(f"{src}: not a {typ}: "), c)).cast(typ)
        return F.when(c.isNotNull() & value.isNull(), bad).otherwise(value)

    out = raw.select(*[conv(src, INTERACTION_TYPES[dst]).alias(dst) for dst, src in mapping.items()])
    for c in INTERACTION_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(INTERACTION_TYPES[c]))
    out = out.select(*INTERACTION_COLUMNS)
    return out.dropna(subset=["user_id", "item_id", "week_no"]) if on_bad == "drop" else out

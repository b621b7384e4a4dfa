"""Readers for the parquet tables and the panels derived from them.

Every reader selects only the columns the caller needs, so the parquet
scan prunes columns (``ReadSchema``) and any later filter is pushed into
the scan.  Panels are built by joins and partial aggregations that Spark
distributes; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

PANEL_COLUMNS = ("symbol", "ts", "price", "volume", "volatility")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL.  Spark sorts NaN above every number and ``avg`` over a
    NaN is NaN, whereas the pandas reference treats NaN as missing."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def daily_panel(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Daily (or, with ``grain`` week, weekly from Monday) long panel from
    orders joined to customer.

    symbol = market segment, ts = order day, price = mean order value,
    volume = number of orders, volatility = sample std of order values
    (NULL on single-order days).  The customer side is two columns; Spark's
    size-checked broadcast (AQE) decides whether it is shipped or the join
    is shuffled on the key; skewed keys are split by AQE's skew-join.
    """
    orders = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey)
    amount = nan_to_null("o_totalprice")
    return (joined.groupBy(F.col("c_mktsegment").alias("symbol"),
                           F.to_date(F.date_trunc(grain, "o_orderdate")).alias("ts"))
            .agg(F.avg(amount).alias("price"),
                 F.count(F.lit(1)).alias("volume"),
                 F.stddev_samp(amount).alias("volatility")))


def lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger daily panel: symbol = part brand, ts = ship day,
    price = mean unit price, volume = shipped quantity,
    volatility = sample std of unit prices."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_shipdate", "l_extendedprice",
                    "l_quantity")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    joined = li.join(part, li.l_partkey == part.p_partkey)
    unit = F.try_divide(nan_to_null("l_extendedprice"), nan_to_null("l_quantity"))
    return (joined.groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("ts"))
            .agg(F.avg(unit).alias("price"),
                 F.sum(nan_to_null("l_quantity")).alias("volume"),
                 F.stddev_samp(unit).alias("volatility")))


def events_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday observations: symbol = event type, ts = event time."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    return ev.select("event_id", F.col("event_type").alias("symbol"), "ts",
                     nan_to_null("value").alias("value"))


def market_series(panel: DataFrame, name: str = "Target_Price") -> DataFrame:
    """Per-day market level: volume-weighted mean price over all symbols
    (for the orders panel this is the mean of all orders of the day)."""
    return (panel.groupBy("ts")
            .agg(F.try_divide(F.sum(F.col("price") * F.col("volume")),
                              F.sum("volume")).alias(name)))

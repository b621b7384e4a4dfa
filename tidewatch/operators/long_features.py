"""Feature versions in long form: rows (ts, name, value), for symbol lists too
long for a column each.

The same features as the wide frame (NULLs are absent rows): raw metrics,
returns, moving averages and ratios of key symbols.  Gaps are filled by calendar
position: every observation stands for the dates up to the series' next one,
from a distributed date rank and a sequence, so nothing is pivoted.  Ratios join
the key symbols' observations of a date with each other, both sides dealt by
the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_ratio
from ..session import materialize
from .features import MA_WINDOWS, _check_version, series_features
from .panel import METRICS
from .ranks import dense_rank_of


def fill_calendar(panel: DataFrame, ts: str = "ts", part: str = "symbol") -> DataFrame:
    """A row for every symbol and every date of the panel from the symbol's
    first observation on; metrics are NULL where there is none.  ``panel`` has
    one row per symbol and date."""
    metrics = [c for c in panel.columns if c not in (ts, part)]
    calendar = materialize(dense_rank_of(panel.select(ts), [], ts))
    seen = panel.join(calendar.select(F.col(ts), F.col("rank"), F.col("n_distinct").alias("last")), ts)
    following = F.lead("rank").over(Window.partitionBy(part).orderBy("rank"))
    spread = (seen.withColumn("until", F.coalesce(following - 1, F.col("last")))
              .withColumn("at", F.explode(F.sequence("rank", "until"))))
    own = F.col("at") == F.col("rank")
    return (spread.select(part, "at", *[F.when(own, F.col(m)).alias(m) for m in metrics])
            .join(calendar.select(F.col("rank").alias("at"), ts), "at").select(part, ts, *metrics))


def _named(rows: DataFrame, names: dict) -> DataFrame:
    """(ts, name, value) of the non-NULL metrics of (symbol, ts, ...); ``names``
    gives the part of the name that follows the symbol."""
    parts = F.array(*[F.struct(F.concat(F.col("symbol"), F.lit(f"_{suffix}")).alias("name"),
                               F.col(metric).cast("double").alias("value")) for metric, suffix in names.items()])
    return rows.select("ts", F.explode(parts).alias("x")).select("ts", "x.*").where("value is not null")


def pair_ratios(rows: DataFrame, metric: str, strict: bool = True) -> DataFrame:
    """(ts, name, value): the ratio of every two symbols a < b that have the
    metric on a date."""
    side = lambda x: rows.select(F.col("ts"), F.col("symbol").alias(x), F.col(metric).cast("double").alias(f"v_{x}")).where(
        F.col(metric).isNotNull())
    both = side("a").repartition("ts").join(side("b").repartition("ts"), "ts").where("a < b")
    suffix = METRICS[metric]
    name = F.concat(F.lit("ratio_"), "a", F.lit(f"_{suffix}_over_"), "b", F.lit(f"_{suffix}"))
    return both.select("ts", name.alias("name"), safe_ratio(F.col("v_a"), F.col("v_b"), strict).alias("value")).where(
        "value is not null")


def long_feature_set(panel: DataFrame, version: str = "v3", key_symbols: list[str] | None = None,
                     ma_windows=MA_WINDOWS, strict_ratios: bool = True) -> DataFrame:
    """(ts, name, value) of a feature version, for any number of symbols.
    Ratios are made among ``key_symbols`` (default: all).  Rows with a NULL
    symbol take no part."""
    _check_version(version)
    known = panel.where("symbol is not null").select("symbol", "ts", *METRICS)
    dense = materialize(series_features(fill_calendar(known), ma_windows=ma_windows))
    names = {"volume": "Volume", "volatility": "Volatility", "ret_pct": "Price_ret_pct"}
    if version != "v1":
        names |= {f"ma{n}": f"Price_ma{n}" for n in ma_windows}
    out = _named(dense, names)
    if version == "v3":
        keys = known if key_symbols is None else known.where(F.col("symbol").isin(key_symbols))
        for metric in ("price", "volume"):
            out = out.unionByName(pair_ratios(keys, metric, strict_ratios))
    return out

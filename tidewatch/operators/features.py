"""Feature versions v1-v3 (returns; + moving averages; + ratios).

Per-series work (forward fill, lag-1 return, rolling means) runs on the
dense long panel with ``Window.partitionBy('symbol').orderBy('ts')`` so each
series is one window partition; the wide frame is produced by a single
pivot and ratios are one generated ``select`` on it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, combinations, product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import pct_change, safe_ratio
from ..sources.tables import market_series
from .panel import column_table, densify, list_symbols, numeric_columns, to_wide
from .target import add_sentiment

# Fixed values from the reference's parameters.
MA_WINDOWS = (7, 30)
TARGET_COL = "Target_Price"
TARGET_VALUE = "Target_Value"
LABEL_COL = "Market_Sentiment"


def series_features(long_df: DataFrame, value: str = "price", ma_windows=MA_WINDOWS,
                    part: str = "symbol", order: str = "ts",
                    block_rows: int | None = None) -> DataFrame:
    """Adds ``ret_pct`` (forward-filled lag-1 percent return) and ``ma{n}``
    (mean of the last n rows, NULLs skipped, at least one value).

    Rows per series are counted; series that fit ``block_rows`` rows (default
    ``DEFAULT_BLOCK_ROWS``) are one window each, longer ones are cut into
    blocks by :func:`series_features_blocked`.  Both give the same rows, NULL
    symbols and NULL time stamps (first in order) included.
    """
    block_rows = block_rows or DEFAULT_BLOCK_ROWS
    longest = long_df.groupBy(part).count().agg(F.max("count")).first()[0] or 0
    if longest > block_rows:
        return series_features_blocked(long_df, value, ma_windows, part, order, block_rows)
    w = Window.partitionBy(part).orderBy(order)
    filled = long_df.withColumn(
        "_ff", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return filled.select(*long_df.columns, *_feature_exprs(value, "_ff", w, ma_windows))


def _feature_exprs(value: str, ff: str, w, ma_windows):
    out = [pct_change(F.col(ff), F.lag(ff, 1).over(w)).alias("ret_pct")]
    out += [F.avg(value).over(w.rowsBetween(-(n - 1), 0)).alias(f"ma{n}") for n in ma_windows]
    return out


# Rows per block of the blocked series path (plus the halo rows copied in).
DEFAULT_BLOCK_ROWS = 1_000_000


def series_features_blocked(long_df: DataFrame, value: str = "price", ma_windows=MA_WINDOWS,
                            part: str = "symbol", order: str = "ts",
                            block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Same result as the single-window path, computed in bounded blocks.

    1. Exact position of every row in its series (``dense_rank_of``: a
       blocked prefix sum, no global sort in one task); rows without a time
       stamp come first.  ``(part, order)`` should be unique, as in a
       densified panel: rows that tie have no defined order.  The ranked
       frame is materialized once.
    2. Block = position // ``block_rows``; the last ``halo`` rows of each
       block (halo = longest moving window - 1, at least 1 for the lag) are
       also copied into the next block.
    3. Forward fill across blocks: each block's last non-NULL value, carried
       forward by a window over the small ``series x blocks`` frame.
    4. Windows partitioned by ``(part, block)`` over own + halo rows; only
       own rows are kept.
    """
    from ..session import materialize
    from .ranks import _null_safe, dense_rank_of
    halo = max([n - 1 for n in ma_windows] + [1])
    if block_rows <= halo:
        raise ValueError(f"block_rows must exceed the halo of {halo} rows")
    pos = dense_rank_of(long_df.select(part, order), [part], order).select(
        part, order, F.col("rank").alias("_pos"))
    # written once to the shared checkpoint folder: both the halo copies and
    # the per-block carry read it, and the (large) input runs once
    ranked = materialize(_null_safe(long_df, pos, [part, order], "left")
                         .withColumn("_pos", F.coalesce("_pos", F.lit(0))))
    blk = F.floor(F.col("_pos") / block_rows).cast("long")
    in_halo_of_next = (F.col("_pos") % block_rows) >= (block_rows - halo)
    copies = F.when(in_halo_of_next, F.array(
        F.struct(blk.alias("_blk"), F.lit(False).alias("_halo")),
        F.struct((blk + 1).alias("_blk"), F.lit(True).alias("_halo")))).otherwise(
        F.array(F.struct(blk.alias("_blk"), F.lit(False).alias("_halo"))))
    spread = ranked.select("*", F.explode(copies).alias("_c")).select(
        *long_df.columns, "_pos", "_c._blk", "_c._halo")

    # last non-NULL value of each block, carried into the following blocks
    last_in_block = ranked.groupBy(part, blk.alias("_blk")).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_pos"))).alias("_last"))
    wb = Window.partitionBy(part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_block.select(part, "_blk", F.last("_last", ignorenulls=True).over(wb)
                                 .alias("_carry"))

    w = Window.partitionBy(part, "_blk").orderBy("_pos")
    local_ff = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    filled = (_null_safe(spread, carry, [part, "_blk"], "left")
              .withColumn("_ff", F.coalesce(local_ff, F.col("_carry"))))
    out = filled.select(*long_df.columns, "_halo", *_feature_exprs(value, "_ff", w, ma_windows))
    return out.where(~F.col("_halo")).drop("_halo")


def ratio_columns(pairs, strict: bool = True) -> dict:
    """Ratio expression of each (numerator, denominator) pair, by name."""
    return {f"ratio_{top}_over_{bottom}": safe_ratio(F.col(top), F.col(bottom), strict)
            for top, bottom in pairs}


@dataclass
class FeatureSet:
    version: str
    df: DataFrame
    features: list[str]
    target_value: str = TARGET_VALUE
    label: str = LABEL_COL
    ts: str = "ts"


def build_feature_set(panel: DataFrame, version: str = "v3", symbols: list[str] | None = None,
                      key_symbols: list[str] | None = None, cross_ratios: bool = False,
                      ma_windows=MA_WINDOWS, strict_ratios: bool = True,
                      thresholds_from: DataFrame | None = None,
                      leakage: str = "strict") -> FeatureSet:
    """Wide feature set of a daily long panel.

    v1: ``{S}_Price_ret_pct`` + raw volume/volatility columns;
    v2: v1 + ``{S}_Price_ma{n}``; v3: v2 + price/price and volume/volume
    ratios among key symbols (+ price/volatility ratios if ``cross_ratios``).
    Target = daily market level, labelled fear/stable/greed at mean +- std.
    """
    _check_version(version)
    symbols = symbols or list_symbols(panel)
    metrics = ["price", "volume", "volatility", "ret_pct"]
    if version in ("v2", "v3"):
        metrics += [f"ma{n}" for n in ma_windows]
    long_f = series_features(densify(panel, symbols), ma_windows=ma_windows)
    wide = to_wide(long_f, symbols, metrics=tuple(metrics))
    wide = wide.join(market_series(panel, TARGET_COL), "ts")
    return _select_features(wide, version, key_symbols or symbols, TARGET_COL, cross_ratios,
                            strict_ratios, thresholds_from, leakage)


def build_feature_set_from_wide(wide: DataFrame, version: str = "v3",
                                target_col: str = "VIX_Price", ts: str = "ts",
                                key_symbols: list[str] | None = None, cross_ratios: bool = False,
                                ma_windows=MA_WINDOWS, strict_ratios: bool = True,
                                thresholds_from: DataFrame | None = None,
                                leakage: str = "strict") -> FeatureSet:
    """Feature set of a wide daily table as the reference stores it: one
    row per date, ``{TICKER}_{Price,Volume,Volatility}`` columns, other
    numeric series (macro data) and the target's price column.

    Price columns other than the target's are unpivoted to a long frame so
    returns and moving averages run per series (window partitioned by the
    column, blocked for long series), then pivoted back as
    ``{c}_ret_pct`` / ``{c}_ma{n}``.  Every other numeric column except the
    target's is a feature as it is; key tickers default to all tickers.
    """
    _check_version(version)
    if ts != "ts":
        wide = wide.withColumnRenamed(ts, "ts")
    price_cols = [c.name for c in column_table(wide.columns, target_col).raw("price")]
    parts = [F.struct(F.lit(c).alias("symbol"), F.col(f"`{c}`").cast("double").alias("price"))
             for c in price_cols]
    long = wide.select("ts", F.explode(F.array(*parts)).alias("_r")).select(
        "_r.symbol", "ts", "_r.price")
    derived = ["ret_pct"] + ([f"ma{n}" for n in ma_windows] if version in ("v2", "v3") else [])
    long_f = series_features(long, ma_windows=ma_windows)
    piv = long_f.groupBy("ts").pivot("symbol", price_cols).agg(
        *[F.first(m, ignorenulls=True).alias(m) for m in derived])
    renamed = [F.col(f"`{c}_{m}`" if len(derived) > 1 else f"`{c}`").alias(f"{c}_{m}")
               for c in price_cols for m in derived]
    full = wide.join(piv.select("ts", *renamed), "ts")
    tickers = key_symbols or [c[: -len("_Price")] if c.lower().endswith("_price") else c
                              for c in price_cols]
    return _select_features(full, version, tickers, target_col, cross_ratios, strict_ratios,
                            thresholds_from, leakage)


def _check_version(version: str) -> None:
    if version not in ("v1", "v2", "v3"):
        raise ValueError(f"unknown feature version {version!r}")


def _select_features(wide: DataFrame, version: str, keys: list[str], target_col: str,
                     cross_ratios: bool, strict_ratios: bool,
                     thresholds_from: DataFrame | None, leakage: str = "strict") -> FeatureSet:
    """Features of a wide frame, as queries on its column table (plan time,
    no job): returns of prices, every other numeric column that is neither a
    price nor derived from the target, and for v3 ratios; then the target
    value and the label."""
    cols = wide.columns
    table = column_table(cols, target_col)
    numeric = set(numeric_columns(wide)) - {"ts", LABEL_COL, target_col}
    chosen = {c.name for c in table if c.derived == "ret_pct" and c.metric == "price" and not c.of_target}
    chosen |= {c.name for c in table
               if c.name in numeric and not c.is_raw_price and c.derived != "ret_pct" and not c.mentions_target}
    ratio_exprs = {}
    if version == "v3":
        price, volume = table.key("price", keys), table.key("volume", keys)
        pairs = [combinations(price, 2), combinations(volume, 2)]
        if cross_ratios and table.raw("volatility"):
            pairs.append(product(price, table.key("volatility", keys)))
        ratio_exprs = ratio_columns(chain.from_iterable(pairs), strict_ratios)
    feats = sorted(c.name for c in column_table(sorted(chosen | set(ratio_exprs)), target_col)
                   if not c.leaks(leakage))

    out = wide.select("ts", *[c for c in cols if c != "ts"],
                      *[e.alias(name) for name, e in ratio_exprs.items()])
    out = out.withColumn(TARGET_VALUE, F.col(target_col))
    out = add_sentiment(out, target_col, LABEL_COL, fit_df=thresholds_from)
    final = out.select("ts", *feats, TARGET_VALUE, LABEL_COL)
    return FeatureSet(version=version, df=final, features=feats)

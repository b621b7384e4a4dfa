"""Long <-> wide panel reshaping and the name-driven column rules.

The canonical form is long ``(symbol, ts, price, volume, volatility)``; every
per-series operator partitions by ``symbol``.  The wide form (one row per
``ts``, columns ``{SYMBOL}_{Metric}``) exists for the feature naming scheme and
for model input.  Column rules run on ``df.schema`` while the plan is built
and start no job.
"""

from __future__ import annotations

import re
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, NumericType, IntegerType, FloatType

# Metric name in the long panel -> suffix in the wide panel.
METRICS = {"price": "Price", "volume": "Volume", "volatility": "Volatility"}


def list_symbols(panel: DataFrame, max_symbols: int = 5000) -> list[str]:
    """Distinct symbols, sorted.  Needed to name the wide columns; the list
    is checked against ``max_symbols`` so a wide plan never explodes."""
    rows = (panel.select("symbol").distinct().orderBy("symbol")
            .limit(max_symbols + 1).collect())
    syms = [r[0] for r in rows if r[0] is not None]
    if len(syms) > max_symbols:
        raise ValueError(f"more than {max_symbols} symbols; use the long form")
    return syms


def wide_name(symbol: str, metric: str) -> str:
    """``{SYMBOL}_{Metric}``; derived price series keep the ``_Price_`` infix
    (``AUTOMOBILE_Price_ret_pct``, ``AUTOMOBILE_Price_ma7``)."""
    if metric in METRICS:
        return f"{symbol}_{METRICS[metric]}"
    if metric == "ret_pct" or re.fullmatch(r"ma\d+", metric):
        return f"{symbol}_Price_{metric}"
    return f"{symbol}_{metric}"


def to_wide(panel: DataFrame, symbols: list[str], metrics=("price", "volume", "volatility"),
            ts: str = "ts") -> DataFrame:
    """One row per ``ts``; ``{SYMBOL}_{Metric}`` columns, NULL where a symbol has
    no observation.  Explicit pivot values avoid a distinct job; the
    shuffle is by ``ts`` only."""
    aggs = [F.first(F.col(m), ignorenulls=True).alias(m) for m in metrics]
    wide = panel.groupBy(ts).pivot("symbol", symbols).agg(*aggs)
    renames = []
    for s in symbols:
        for m in metrics:
            src = f"{s}_{m}" if len(metrics) > 1 else s
            renames.append(F.col(f"`{src}`").alias(wide_name(s, m)))
    return wide.select(F.col(ts), *renames)


def to_long(wide: DataFrame, symbols: list[str], metrics=("price", "volume", "volatility"),
            ts: str = "ts") -> DataFrame:
    """Inverse of :func:`to_wide`: unpivot with one ``stack`` per row."""
    parts = []
    for s in symbols:
        parts.append(F.struct(F.lit(s).alias("symbol"),
                              *[F.col(f"`{wide_name(s, m)}`").alias(m) for m in metrics]))
    return (wide.select(F.col(ts), F.explode(F.array(*parts)).alias("_r"))
            .select(ts, "_r.*"))


def densify(panel: DataFrame, symbols: list[str],
            metrics=("price", "volume", "volatility")) -> DataFrame:
    """Give every symbol a row for every ``ts`` present in the panel (NULL
    values in gaps), so row-based windows count calendar rows the way the
    wide pandas frame does.  Done by pivot + unpivot: no cross join."""
    return to_long(to_wide(panel, symbols, metrics), symbols, metrics)


# ---- the column table: names parsed once, selections are queries on it ------

# Metric endings and the marks of derived columns.
_METRICS = ("price", "volume", "volatility")
_NAME = re.compile(rf"(?is)(?P<stem>.*?)(?P<metric>{'|'.join(_METRICS)})?\s*(?P<derived>_ret_pct|_ma\d+)?")


@dataclass(frozen=True)
class NamedColumn:
    """What a column's name says: metric it ends in (before a derived mark),
    how it was derived, and its relation to the target column."""
    name: str
    metric: str
    derived: str
    target: str

    @property
    def is_raw_price(self) -> bool:
        return self.metric == "price" and not self.derived

    @property
    def mentions_target(self) -> bool:
        return bool(self.target) and self.target in self.name.lower()

    @property
    def of_target(self) -> bool:
        """The target itself, or a column whose name ends in the target's."""
        base = self.name.lower().removesuffix(f"_{self.derived}").strip()
        return bool(self.target) and base.endswith(self.target)

    def leaks(self, mode: str = "strict") -> bool:
        """strict: the name mentions the target column; loose: it mentions the
        target's ticker."""
        if mode not in ("strict", "loose"):
            raise ValueError(f"unknown leakage mode {mode!r}")
        word = self.target if mode == "strict" else self.target.partition("_")[0]
        return bool(word) and word in self.name.lower()


class ColumnTable(list):
    """Rows of :class:`NamedColumn` in column order."""

    def raw(self, metric: str, with_target: bool = False) -> list[NamedColumn]:
        return [c for c in self if c.metric == metric and not c.derived and (with_target or not c.of_target)]

    def key(self, metric: str, keys: list[str]) -> list[str]:
        """Names of a metric's columns that mention a key ticker; none that
        does is an error, since any other choice would be arbitrary."""
        tickers = re.compile("|".join(map(re.escape, keys)), re.I)
        names = [c.name for c in self.raw(metric) if tickers.search(c.name)] if keys else []
        if not names and self.raw(metric):
            raise ValueError(f"no {metric} column mentions any of {keys}")
        return names


def column_table(cols: list[str], target: str = "") -> ColumnTable:
    parsed = ((c, _NAME.fullmatch(c)) for c in cols)
    return ColumnTable(NamedColumn(c, (m["metric"] or "").lower(), (m["derived"] or "").lower().lstrip("_"),
                                   target.lower()) for c, m in parsed)


def numeric_columns(df: DataFrame, int_and_double_only: bool = False) -> list[str]:
    if int_and_double_only:
        ok = (DoubleType, LongType, IntegerType, FloatType)
        return [f.name for f in df.schema.fields if isinstance(f.dataType, ok)]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


@dataclass
class ColumnRoles:
    """Column mapping used by the quality and model reports."""
    target: str | None = None
    prediction: str | None = None
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    datetime: str | None = None

    @classmethod
    def resolve(cls, df: DataFrame, target: str | None = None, prediction: str | None = None,
                numeric: list[str] | None = None, categorical: list[str] | None = None,
                datetime: str | None = None) -> "ColumnRoles":
        cols = set(df.columns)
        return cls(target=target if target in cols else None,
                   prediction=prediction if prediction in cols else None,
                   numeric=[c for c in (numeric or numeric_columns(df)) if c in cols],
                   categorical=[c for c in (categorical or []) if c in cols],
                   datetime=datetime if datetime in cols else None)

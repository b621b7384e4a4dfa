"""Independent SQL (DuckDB dialect) for the registered queries.

Written as plain window/aggregate SQL over the same parquet tables, so a
second engine checks every Spark result value by value.  Wide column lists
are generated from the symbol list below.
"""

from __future__ import annotations

# The five market segments of the customer table (the wide
# panel's symbols, sorted).
SYMBOLS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
METRICS = [("price", "Price"), ("volume", "Volume"), ("volatility", "Volatility")]

PANEL = """panel AS (
  SELECT c.c_mktsegment AS symbol, CAST(o.o_orderdate AS DATE) AS ts,
         avg(o.o_totalprice) AS price, count(*) AS volume,
         stddev_samp(o.o_totalprice) AS volatility
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)"""

MARKET = """market AS (
  SELECT ts, sum(price * volume) / sum(volume) AS Target_Price FROM panel GROUP BY ts)"""

SIDES = """dates AS (
  SELECT ts, row_number() OVER (ORDER BY ts) AS rk, count(*) OVER () AS nd
  FROM (SELECT DISTINCT ts FROM panel) d),
sides AS (
  SELECT ts, CASE WHEN rk <= floor(nd * 0.8) THEN 'ref' ELSE 'cur' END AS side FROM dates)"""

TH = """th AS (SELECT avg(Target_Price) AS mu, stddev_samp(Target_Price) AS sigma FROM market)"""

DENSE = """dense AS (
  SELECT s.symbol, d.ts, p.price, p.volume, p.volatility
  FROM (SELECT DISTINCT symbol FROM panel) s CROSS JOIN (SELECT DISTINCT ts FROM panel) d
  LEFT JOIN panel p ON p.symbol = s.symbol AND p.ts = d.ts),
ffill AS (
  SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM dense),
feat AS (
  SELECT symbol, ts, price, volume, volatility,
         (ff / NULLIF(lag(ff) OVER (PARTITION BY symbol ORDER BY ts), 0) - 1) * 100 AS ret_pct,
         avg(price) OVER (PARTITION BY symbol ORDER BY ts
                          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7,
         avg(price) OVER (PARTITION BY symbol ORDER BY ts
                          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma30
  FROM ffill)"""

LONG = """long AS (
  SELECT symbol || '_Price' AS feature, ts, price AS value FROM panel
  UNION ALL SELECT symbol || '_Volume', ts, CAST(volume AS DOUBLE) FROM panel
  UNION ALL SELECT symbol || '_Volatility', ts, volatility FROM panel
  UNION ALL SELECT 'Target_Price', ts, Target_Price FROM market),
ls AS (SELECT l.feature, l.ts, l.value, s.side FROM long l JOIN sides s ON l.ts = s.ts)"""

RANKS = """cnt AS (
  SELECT feature, value, count(*) FILTER (WHERE side = 'ref') AS r,
         count(*) FILTER (WHERE side = 'cur') AS c
  FROM ls WHERE value IS NOT NULL GROUP BY feature, value),
cum AS (
  SELECT *, sum(r) OVER w AS r_cum, sum(c) OVER w AS c_cum,
         sum(r) OVER (PARTITION BY feature) AS r_total, sum(c) OVER (PARTITION BY feature) AS c_total
  FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY value
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rt0 AS (
  SELECT feature, CAST(max(r_total) AS DOUBLE) AS n1, CAST(max(c_total) AS DOUBLE) AS n2,
         max(abs(r_cum / r_total - c_cum / c_total)) AS ks,
         sum(r * ((r_cum + c_cum - (r + c)) + (r + c + 1) / 2.0)) AS r1,
         sum(CAST(r + c AS DOUBLE) * (r + c) * (r + c) - (r + c)) AS tie
  FROM cum GROUP BY feature),
rt AS (
  SELECT feature, n1, n2, ks, tie, r1 - n1 * (n1 + 1) / 2 AS u1,
         sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS sg
  FROM rt0 WHERE n1 > 10 AND n2 > 10),
mom AS (
  SELECT feature,
         avg(CASE WHEN side = 'ref' THEN value END) AS rm,
         avg(CASE WHEN side = 'cur' THEN value END) AS cm,
         stddev_samp(CASE WHEN side = 'ref' THEN value END) AS rs,
         stddev_samp(CASE WHEN side = 'cur' THEN value END) AS cs,
         count(CASE WHEN side = 'ref' THEN value END) AS k1,
         count(CASE WHEN side = 'cur' THEN value END) AS k2
  FROM ls WHERE value IS NOT NULL GROUP BY feature),
mom2 AS (
  SELECT *, sqrt(((k1 - 1) * power(rs, 2) + (k2 - 1) * power(cs, 2)) / NULLIF(k1 + k2 - 2, 0))
            AS pooled FROM mom)"""


def _off(n: int) -> str:
    """Tie-safe comparison rounding: averages of 2-decimal prices are often
    exact decimal ties (x.xxxxx5), which two engines round differently on
    the last bit.  A fixed offset far above float noise and far below the
    rounding unit is added before rounding, identically on both sides."""
    return f"CAST('{1.2345678912 * 10 ** -(n + 3)!r}' AS DOUBLE)"


OFF3, OFF5, OFF6, OFF8, OFF10 = _off(3), _off(5), _off(6), _off(8), _off(10)


def label_sql(v: str, mu: str = "mu", sigma: str = "sigma") -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} > {mu} + {sigma} THEN 'fear' "
            f"WHEN {v} < {mu} - {sigma} THEN 'greed' ELSE 'stable' END")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _wide_cols(metrics) -> list[tuple[str, str]]:
    out = []
    for s in SYMBOLS:
        for m, suffix in metrics:
            out.append((f'max(CASE WHEN symbol = \'{s}\' THEN {m} END)', f"{s}_{suffix}"))
    return out


WIDE = "wide AS (SELECT ts, " + ", ".join(
    f'{e} AS "{n}"' for e, n in _wide_cols(METRICS)) + " FROM panel GROUP BY ts)"
WIDE_COLS = [n for _, n in _wide_cols(METRICS)]


def _feature_cte(version: str, cross: bool = False) -> tuple[str, list[str]]:
    """CTE ``fs`` with the unrounded feature set and its feature list."""
    metrics = METRICS + [("ret_pct", "Price_ret_pct")]
    if version in ("v2", "v3"):
        metrics += [("ma7", "Price_ma7"), ("ma30", "Price_ma30")]
    wide_f = "widef AS (SELECT ts, " + ", ".join(
        f'{e} AS "{n}"' for e, n in _wide_cols(metrics)) + " FROM feat GROUP BY ts)"
    feats = [f"{s}_Price_ret_pct" for s in SYMBOLS]
    feats += [f"{s}_Volume" for s in SYMBOLS] + [f"{s}_Volatility" for s in SYMBOLS]
    if version in ("v2", "v3"):
        feats += [f"{s}_Price_{m}" for s in SYMBOLS for m in ("ma7", "ma30")]
    ratio_exprs = []
    if version == "v3":
        for kind in ("Price", "Volume"):
            for i in range(len(SYMBOLS)):
                for j in range(i + 1, len(SYMBOLS)):
                    a, b = f"{SYMBOLS[i]}_{kind}", f"{SYMBOLS[j]}_{kind}"
                    name = f"ratio_{a}_over_{b}"
                    ratio_exprs.append(
                        f'CAST("{a}" AS DOUBLE) / (NULLIF(CAST("{b}" AS DOUBLE), 0) + CAST(1e-9 AS DOUBLE)) AS "{name}"')
                    feats.append(name)
    if version == "v3" and cross:
        for a in SYMBOLS:
            for b in SYMBOLS:
                pa, vb = f"{a}_Price", f"{b}_Volatility"
                name = f"ratio_{pa}_over_{vb}"
                ratio_exprs.append(
                    f'CAST("{pa}" AS DOUBLE) / (NULLIF(CAST("{vb}" AS DOUBLE), 0) + CAST(1e-9 AS DOUBLE)) AS "{name}"')
                feats.append(name)
    feats = sorted(set(feats))
    sel = ", ".join([f'w."{c}"' for c, in [(n,) for _, n in _wide_cols(metrics)]] + ratio_exprs)
    fs = (f"fs AS (SELECT w.ts, {sel}, m.Target_Price AS Target_Value, "
          f"{label_sql('m.Target_Price')} AS Market_Sentiment "
          f"FROM widef w JOIN market m ON w.ts = m.ts CROSS JOIN th)")
    return ",\n".join([DENSE, wide_f, fs]), feats


def _round_feature(c: str) -> str:
    if c.endswith("_Volume") and not c.startswith("ratio_"):
        return f'"{c}"'
    if c.startswith("ratio_") or c.endswith("_ret_pct"):
        return f'round("{c}" + {OFF8}, 8) AS "{c}"'
    return f'round("{c}" + {OFF5}, 5) AS "{c}"'


def features_sql(version: str) -> str:
    cte, feats = _feature_cte(version)
    cols = ", ".join(_round_feature(c) for c in feats)
    return (_with(PANEL, MARKET, TH, cte) +
            f"SELECT ts, {cols}, round(Target_Value + {OFF5}, 5) AS Target_Value, Market_Sentiment FROM fs")


def _pf() -> str:
    return """pf AS (
  SELECT a.ts, a.Target_Price AS actual, b.Target_Price AS predicted
  FROM (SELECT *, row_number() OVER (ORDER BY ts) AS rk FROM market) a
  LEFT JOIN (SELECT *, row_number() OVER (ORDER BY ts) AS rk FROM market) b ON b.rk = a.rk - 1)"""


def _labels_sides() -> str:
    return """labs AS (SELECT s.side, """ + label_sql("m.Target_Price") + """ AS lab
  FROM market m JOIN sides s ON m.ts = s.ts CROSS JOIN th)"""


# Two-sided normal tail of z by the positive series of the error function,
# Kolmogorov's limit by either of its two series, as the library documents.
TAILS = """zs AS (
  SELECT rt.*, CASE WHEN pooled > 0 THEN (cm - rm) / pooled ELSE 0.0 END AS cohens_d,
         (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / NULLIF(sg, 0) AS z,
         ks * sqrt(n1 * n2 / (n1 + n2)) AS zk
  FROM rt JOIN mom2 ON rt.feature = mom2.feature),
xs AS (SELECT *, least(greatest(z, 0.0), 8.3) / sqrt(2.0) AS x FROM zs),
erfs AS (
  SELECT feature, 2 / sqrt(pi()) * exp(-max(x) * max(x)) * sum(exp(
           n * ln(2.0) + (2 * n + 1) * ln(x) - (lgamma(2 * n + 2) - n * ln(2.0) - lgamma(n + 1)))) AS erf
  FROM xs CROSS JOIN range(0, 161) t(n) WHERE x > 0 GROUP BY feature),
drift AS (
  SELECT xs.feature, ks, cohens_d,
         CASE WHEN z >= 8.3 THEN 0.0 ELSE least(greatest(1.0 - coalesce(erf, 0.0), 0.0), 1.0) END AS mw_p,
         least(greatest(CASE WHEN zk <= 0 THEN 1.0 WHEN zk < 1 THEN 1.0 - sqrt(2 * pi()) / zk * (""" + " + ".join(
    f"exp(-power({2 * k - 1} * pi() / zk, 2) / 8)" for k in range(1, 6)) + """)
           ELSE 2 * (""" + " + ".join(f"({(-1) ** (k - 1)}) * exp(-2 * power({k} * zk, 2))" for k in range(1, 8)) + """) END,
           0.0), 1.0) AS ks_p
  FROM xs LEFT JOIN erfs ON xs.feature = erfs.feature),
flags AS (SELECT *, ks_p < 0.05 OR mw_p < 0.05 AS drifted FROM drift),
al AS (SELECT lab AS category, count(*) FILTER (WHERE side = 'ref') AS rc,
              count(*) FILTER (WHERE side = 'cur') AS cc FROM labs WHERE lab IS NOT NULL GROUP BY lab),
tot AS (SELECT sum(rc) AS R, sum(cc) AS C, count(*) AS k FROM al),
cells AS (SELECT rc AS o, R * (rc + cc) / CAST(R + C AS DOUBLE) AS e, k FROM al CROSS JOIN tot
          UNION ALL SELECT cc, C * (rc + cc) / CAST(R + C AS DOUBLE), k FROM al CROSS JOIN tot),
-- three labels: two degrees of freedom, whose tail is exp(-x / 2)
target AS (SELECT CASE WHEN max(k) = 3 THEN exp(-sum(power(o - e, 2) / e) / 2) END < 0.05 AS drifted FROM cells),
summary AS (
  SELECT count(*) AS tested, count(*) FILTER (WHERE drifted) AS found, (SELECT drifted FROM target) AS on_target
  FROM flags)"""

_CHECKED = WIDE_COLS + ["Target_Price"]
SUITE = """mw AS (
  SELECT w.*, m.Target_Price, s.side, """ + label_sql("m.Target_Price") + """ AS lab
  FROM wide w JOIN market m ON w.ts = m.ts JOIN sides s ON w.ts = s.ts CROSS JOIN th),
prof AS (
  SELECT side, count(*) FILTER (WHERE """ + " OR ".join(f'"{c}" IS NULL' for c in _CHECKED) + """) AS rows_missing,
         """ + " + ".join(f'CASE WHEN count("{c}") < count(*) THEN 1 ELSE 0 END' for c in _CHECKED) + """ AS cols_missing,
         """ + " + ".join(f'CASE WHEN count(DISTINCT "{c}") <= 1 THEN 1 ELSE 0 END' for c in _CHECKED) + """ AS constant,
         (""" + " + ".join(f'count(*) - count("{c}")' for c in _CHECKED) + f""") / CAST(count(*) * {len(_CHECKED)} AS DOUBLE) AS share,
         avg("{SYMBOLS[0]}_Price") AS mean, stddev_samp("{SYMBOLS[0]}_Price") AS sd, min(Target_Price) AS low,
         max(Target_Price) AS high, count(DISTINCT lab) AS n_labels
  FROM mw GROUP BY side),
r AS (SELECT * FROM prof WHERE side = 'ref'), c AS (SELECT * FROM prof WHERE side = 'cur'),
suite("check", observed, threshold, passed) AS (
  SELECT 'columns_with_missing_values', CAST(c.cols_missing AS DOUBLE), CAST(r.cols_missing AS DOUBLE),
         c.cols_missing <= r.cols_missing FROM r, c
  UNION ALL SELECT 'rows_with_missing_values', c.rows_missing, r.rows_missing, c.rows_missing <= r.rows_missing FROM r, c
  UNION ALL SELECT 'constant_columns', c.constant, r.constant, c.constant <= r.constant FROM r, c
  UNION ALL SELECT 'drifted_columns', found, tested * 0.5, found < tested * 0.5 FROM summary
  UNION ALL SELECT 'share_of_missing_values', c.share, r.share, c.share <= r.share FROM r, c
  UNION ALL SELECT 'column_drift:' || f, NULL, NULL, NOT coalesce((SELECT drifted FROM flags WHERE feature = f), false)
            FROM (VALUES ('""" + SYMBOLS[0] + """_Price'), ('Target_Price')) v(f)
  UNION ALL SELECT 'column_drift:Market_Sentiment', NULL, NULL, NOT on_target FROM summary
  UNION ALL SELECT 'mean_in_2_sigmas:""" + SYMBOLS[0] + """_Price', c.mean, 2 * r.sd, abs(c.mean - r.mean) <= 2 * r.sd FROM r, c
  UNION ALL SELECT 'value_range:Target_Price', c.low, 100000, c.low >= 100000 AND c.high <= 200000 FROM c
  UNION ALL SELECT 'unique_values:Market_Sentiment', c.n_labels, 3, c.n_labels = 3 FROM c),
alerts(alert, severity) AS (
  SELECT 'data drift detected', 'critical' FROM summary WHERE found > 0 OR on_target
  UNION ALL SELECT 'target distribution drift detected', 'critical' FROM summary WHERE on_target
  UNION ALL SELECT printf('high drift percentage: %.1f%%', found * 100.0 / tested), 'warning' FROM summary
            WHERE found * 100.0 / tested > 20
  UNION ALL SELECT 'dataset drift detected', 'critical' FROM summary WHERE found / CAST(tested AS DOUBLE) >= 0.5
  UNION ALL SELECT printf('%d tests failed', count(*)), 'warning' FROM suite WHERE NOT passed HAVING count(*) > 0)"""


def _drift_reports() -> dict[str, str]:
    base = _with(PANEL, MARKET, TH, SIDES, LONG, RANKS, _labels_sides(), TAILS)
    suite = base.rstrip() + ",\n" + WIDE + ",\n" + SUITE + "\n"
    return {
        "i8_drift_report": base + "SELECT feature, round(ks + {OFF10}, 10) AS ks_statistic, round(ks_p + {OFF8}, 8) AS ks_pvalue, "
        "round(mw_p + {OFF8}, 8) AS mw_pvalue, round(cohens_d + {OFF8}, 8) AS cohens_d, drifted AS drift_detected FROM flags",
        "i10_drift_summary": base + "SELECT tested AS features_tested, found AS features_with_drift, "
        "round(found * 100.0 / tested + {OFF8}, 8) AS drift_percentage, "
        "round(100.0 - found / CAST(greatest(tested, 1) AS DOUBLE) * 100.0 + {OFF8}, 8) AS data_quality_score, "
        "on_target AS target_drift_detected, found > 0 OR on_target AS overall_drift_detected FROM summary",
        "i11_dataset_drift": base + "SELECT tested AS n_columns, found AS n_drifted, "
        "round(found / CAST(tested AS DOUBLE) + {OFF8}, 8) AS share_drifted, found / CAST(tested AS DOUBLE) >= 0.5 AS dataset_drift "
        "FROM summary",
        "i16_test_suite": suite + 'SELECT "check", round(observed + {OFF5}, 5) AS observed, round(threshold + {OFF5}, 5) AS threshold, '
        "passed FROM suite",
        "i17_alerts": suite + "SELECT alert, severity FROM alerts",
        "i21_monitoring_run": suite + "SELECT tested AS features_tested, found AS features_with_drift, "
        "round(found * 100.0 / tested + {OFF8}, 8) AS drift_percentage, found > 0 OR on_target AS overall_drift_detected, "
        "(SELECT count(*) FROM suite WHERE passed) AS tests_passed, (SELECT count(*) FROM suite) AS tests_total, "
        "(SELECT count(*) FROM alerts) AS alerts FROM summary",
    }


RUNS = """mk AS (
  SELECT ts, Target_Price AS y, row_number() OVER (ORDER BY ts) AS rk, count(*) OVER () AS nd,
         avg(Target_Price) OVER (ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7,
         avg(Target_Price) OVER (ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma30 FROM market),
cut AS (SELECT floor(max(nd) * 0.8) AS t, floor(floor(max(nd) * 0.8) * 0.7) AS v FROM mk),
hz(version, h) AS (VALUES ('v1', 1), ('v2', 7), ('v3', 30), ('v4', 1000000)),
seen AS (
  SELECT rk + h AS rk, version, u.model, u.predicted
  FROM mk CROSS JOIN hz CROSS JOIN LATERAL (VALUES ('persistence', y), ('ma7', ma7), ('ma30', ma30)) u(model, predicted)),
fo AS (
  SELECT s.version, s.model, CASE WHEN m.rk > t THEN 'test' ELSE 'val' END AS split, m.y AS actual, s.predicted,
         """ + label_sql("m.y") + " AS label, " + label_sql("s.predicted") + """ AS guess
  FROM mk m JOIN seen s ON s.rk = m.rk CROSS JOIN cut CROSS JOIN th WHERE m.rk > cut.v),
ba AS (
  SELECT version, model, count(*) FILTER (WHERE split = 'val') AS n_val, count(*) FILTER (WHERE split = 'test') AS n_test,
         sqrt(avg(power(predicted - actual, 2)) FILTER (WHERE split = 'val')) AS val_rmse,
         avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'val') AS val_accuracy,
         sqrt(avg(power(predicted - actual, 2)) FILTER (WHERE split = 'test')) AS rmse,
         avg(abs(predicted - actual)) FILTER (WHERE split = 'test') AS mae,
         1.0 - sum(power(predicted - actual, 2)) FILTER (WHERE split = 'test')
           / (var_pop(actual) FILTER (WHERE split = 'test') * count(*) FILTER (WHERE split = 'test')) AS r2,
         avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test') AS accuracy
  FROM fo GROUP BY 1, 2),
pl AS (
  SELECT version, model, l, sum(tr) AS tr, sum(sa) AS sa, sum(hit) AS hits FROM (
    SELECT version, model, label AS l, 1 AS tr, 0 AS sa, CASE WHEN label = guess THEN 1 ELSE 0 END AS hit FROM fo WHERE split = 'test'
    UNION ALL SELECT version, model, guess, 0, 1, 0 FROM fo WHERE split = 'test') x GROUP BY 1, 2, 3),
f1 AS (SELECT version, model, avg(2.0 * hits / (tr + sa)) AS macro_f1 FROM pl GROUP BY 1, 2),
cand AS (
  SELECT ba.version, task, CASE ba.model WHEN 'persistence' THEN 1 WHEN 'ma7' THEN 2 ELSE 3 END AS position, ba.model,
         CASE WHEN task = 'regression' THEN val_rmse ELSE val_accuracy END AS val_metric, rmse, mae, r2, accuracy, macro_f1,
         n_val, n_test
  FROM ba JOIN f1 ON f1.version = ba.version AND f1.model = ba.model
  CROSS JOIN (VALUES ('classification'), ('regression')) t(task)),
win AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version, task ORDER BY
           CASE WHEN task = 'regression' THEN val_metric ELSE -val_metric END, position) AS nth FROM cand) x WHERE nth = 1),
runs AS (
  SELECT hz.version, t.task, coalesce(model, 'FAILED') AS best_model, val_metric,
         CASE WHEN t.task = 'regression' THEN r2 ELSE accuracy END AS test_metric,
         CASE WHEN t.task = 'regression' THEN 'r2' ELSE 'accuracy' END AS metric_name, rmse, mae, r2,
         CASE WHEN model IS NULL THEN 'FAILED' ELSE 'ok' END AS status
  FROM hz CROSS JOIN (VALUES ('classification'), ('regression')) t(task)
  LEFT JOIN win ON win.version = hz.version AND win.task = t.task)"""


WEEKLY = PANEL.replace("CAST(o.o_orderdate AS DATE)", "CAST(date_trunc('week', o.o_orderdate) AS DATE)")


def _split_cte(version: str) -> tuple[str, list[str]]:
    """CTE ``tv``: complete weekly rows of the first 80 % of dates, split 70/30."""
    cte, feats = _feature_cte(version)
    complete = " AND ".join(f'"{c}" IS NOT NULL' for c in [*feats, "Target_Value"])
    return _with(WEEKLY, MARKET, TH, cte,
                 "early AS (SELECT * FROM (SELECT fs.*, row_number() OVER (ORDER BY ts) AS rk, count(*) OVER () AS nd FROM fs) x "
                 "WHERE rk <= floor(nd * 0.8))",
                 "tv AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY ts) <= floor(count(*) OVER () * 0.7) THEN 'train' "
                 f"ELSE 'val' END AS part FROM early WHERE {complete})"), feats


def _split_reports() -> dict[str, str]:
    counts = [f"SELECT * FROM ({_split_cte(v)[0]} SELECT part, '{v}' AS version, count(*) AS n, min(ts) AS first, "
              f"max(ts) AS last FROM tv GROUP BY part) x_{v}" for v in ("v1", "v2", "v3")]
    base, feats = _split_cte("v1")
    scaled = ", ".join(f'round("{c}" / coalesce(nullif((SELECT stddev_pop("{c}") FROM tv WHERE part = \'train\'), 0), 1) '
                       f'+ {{OFF6}}, 6) AS "{c}"' for c in feats)
    def complete(version):
        cte, names = _feature_cte(version)
        return _with(WEEKLY, MARKET, TH, cte, "ok AS (SELECT ts FROM fs WHERE " + " AND ".join(
            f'"{c}" IS NOT NULL' for c in [*names, "Target_Value"]) + ")")
    limit = " OR ".join(f"r = {r} AND h < {(3.0 ** (r - 2)) * 2 ** 32!r}" for r in range(2))
    q15 = " UNION ALL ".join(
        f"SELECT side, '{c}' AS \"column\", count(*) AS n_rows, CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_count, "
        f"round(quantile_cont(\"{c}\", 0.05) + {{OFF5}}, 5) AS q05, round(quantile_cont(\"{c}\", 0.95) + {{OFF5}}, 5) AS q95 "
        "FROM fs JOIN sides ON fs.ts = sides.ts GROUP BY side" for c in [*feats, "Target_Value"])
    predicted = "ls AS (SELECT 'Predicted' AS feature, s.side, p.predicted AS value FROM pf p JOIN sides s ON p.ts = s.ts)"
    cte3, feats3 = _feature_cte("v3")
    digits = lambda c: 8 if c.startswith("ratio_") or c.endswith("_ret_pct") else 5
    long3 = " UNION ALL ".join(f"SELECT ts, '{c}' AS name, round(CAST(\"{c}\" AS DOUBLE) + {{OFF{digits(c)}}}, {digits(c)}) AS value "
                               f'FROM fs WHERE "{c}" IS NOT NULL' for c in feats3)
    return {"h3_long_features": _with(PANEL, MARKET, TH, cte3) + long3,
            "j13_nested_samples": complete("v2") + "SELECT CAST(r AS INTEGER) AS rung, count(*) AS n FROM (SELECT "
            "CAST('0x' || substr(md5(CAST(ts AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM ok) x CROSS JOIN range(0, 3) t(r) "
            f"WHERE r = 2 OR {limit} GROUP BY r",
            "j21_fold_sizes": complete("v1") + "SELECT CAST(floor((rk - 1) * 6 / CAST(nd AS DOUBLE)) AS INTEGER) AS fold, count(*) AS n, "
            "min(ts) AS first, max(ts) AS last FROM (SELECT ts, row_number() OVER (ORDER BY ts) AS rk, count(*) OVER () AS nd "
            "FROM ok) x GROUP BY 1",
            "i12_prediction_drift": _with(PANEL, MARKET, TH, SIDES, _pf(), predicted, RANKS, _labels_sides(), TAILS)
            + "SELECT f.feature, CAST(n1 AS BIGINT) AS n_ref, CAST(n2 AS BIGINT) AS n_cur, round(f.ks + {OFF10}, 10) AS ks_statistic, "
            "round(ks_p + {OFF8}, 8) AS ks_pvalue, round(mw_p + {OFF8}, 8) AS mw_pvalue, round(cohens_d + {OFF8}, 8) AS cohens_d, "
            "drifted AS drift_detected FROM flags f JOIN rt ON f.feature = rt.feature",
            "i15_quality_by_side": _with(PANEL, MARKET, TH, SIDES, _feature_cte("v1")[0]) + q15,
            "j5_train_val_split": " UNION ALL ".join(counts), "j2_scaled_features": base + f"SELECT ts, part, {scaled} FROM tv"}


def _source_reports() -> dict[str, str]:
    first, others = SYMBOLS[0], SYMBOLS[1:]
    kept = {"strict": [f"{s}_{m}" for s in SYMBOLS for m in ("Volume", "Volatility")],
            "loose": [f"{s}_{m}" for s in others for m in ("Volume", "Volatility")]}
    leak = [f"SELECT '{mode}' AS mode, '{c}' AS feature, count(*) - count(\"{c}\") AS missing_count FROM wide"
            for mode, cols in kept.items() for c in cols]
    leak += [f"SELECT '{mode}' AS mode, '{s}_Price_ret_pct' AS feature, count(*) - count(ret_pct) AS missing_count "
             f"FROM feat WHERE symbol = '{s}'" for mode in kept for s in others]
    cte3, feats3 = _feature_cte("v3")
    group = lambda c: ("'derived_indicators'" if c.startswith("ratio_") else "'traded_volume'" if c.endswith("_Volume")
                       else "'daily_returns'" if c.endswith("_ret_pct") else "NULL")
    known = " UNION ALL ".join(f'SELECT {group(c)} AS "group", count("{c}") AS known FROM fs' for c in feats3)
    cells = " + ".join(f'count(*) - count("{c}")' for c in ["ts", *WIDE_COLS])
    columns = " + ".join(f'CASE WHEN count("{c}") < count(*) THEN 1 ELSE 0 END' for c in ["ts", *WIDE_COLS])
    n = len(WIDE_COLS) + 1
    return {
        "a3_date_column": _with(PANEL) + " UNION ALL ".join(
            f"SELECT '{c}' AS found, count(*) AS n, min(ts) AS first, max(ts) AS last FROM panel" for c in ("Trade_Date", "observed")),
        "a8_metadata": _with(PANEL, MARKET) + " UNION ALL ".join(
            f"SELECT 'sentiment_{v}' AS feature_set_name, '{v}' AS version, CAST({k} AS BIGINT) AS num_features, count(*) AS num_samples, "
            f"CAST(min(ts) AS VARCHAR) AS first, CAST(max(ts) AS VARCHAR) AS last, CAST({k} AS BIGINT) AS listed FROM market"
            for v, k in (("v1", 15), ("v2", 25), ("v3", 45))),
        "a12_dual_location": _with(PANEL, MARKET) + " UNION ALL ".join(
            f"SELECT '{name}' AS name, CAST({k} AS BIGINT) AS features, count(*) AS n FROM market"
            for name, k in (("in_both", 15), ("in_second", 25))),
        "a16_feature_groups": _with(PANEL, MARKET, TH, cte3) + 'SELECT "group", count(*) AS features, CAST(sum(known) AS BIGINT) AS known '
        f'FROM ({known}) x WHERE "group" IS NOT NULL GROUP BY 1',
        "b2_leakage_modes": _with(PANEL, WIDE, DENSE) + " UNION ALL ".join(leak),
        "e1_missing_summary": _with(PANEL, WIDE) + f"SELECT count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns, "
        f"CAST({cells} AS BIGINT) AS missing_cells, CAST({columns} AS BIGINT) AS columns_with_missing, "
        f"round(({cells}) / CAST(count(*) * {n} AS DOUBLE) + {{OFF8}}, 8) AS missing_share FROM wide",
        "g7_sample_head": _with(PANEL, WIDE) + "SELECT ts, " + ", ".join(f'"{s}_Volume"' for s in SYMBOLS)
        + " FROM wide ORDER BY ts LIMIT 5",
    }


def _run_reports() -> dict[str, str]:
    base = _with(PANEL, MARKET, TH, RUNS)
    r5 = lambda *cols: ", ".join(f"round({c} + {{OFF5}}, 5) AS {c}" for c in cols)
    return {
        "j14_winner_selection": base + "SELECT version, task, best_model, metric_name, status, false AS automl_available, "
        + r5("val_metric", "test_metric", "rmse", "mae", "r2") + " FROM runs",
        "j15_candidate_metrics": base + "SELECT version, task, CAST(position AS BIGINT) AS position, model, n_val, n_test, 'ok' AS status, "
        + r5("val_metric", "rmse", "mae", "r2", "accuracy", "macro_f1") + " FROM cand",
        "j19_leaderboard": base + "SELECT best_model, version, task, row_number() OVER (PARTITION BY task ORDER BY test_metric DESC, "
        "version) AS rank, count(*) OVER (PARTITION BY best_model) AS wins, round(count(*) OVER (PARTITION BY best_model) "
        "/ CAST(count(*) OVER () AS DOUBLE) + {OFF8}, 8) AS win_share, " + r5("test_metric") + " FROM runs WHERE best_model <> 'FAILED'",
        "j19_leaderboard_rollup": base + "SELECT version, task, grouping(version) * 2 + grouping(task) AS level, count(*) AS runs, "
        "count(*) FILTER (WHERE best_model <> 'FAILED') AS successful, "
        "round(max(test_metric) FILTER (WHERE metric_name = 'accuracy') + {OFF5}, 5) AS best_accuracy, "
        "round(max(test_metric) FILTER (WHERE metric_name = 'r2') + {OFF5}, 5) AS best_r2 FROM runs GROUP BY ROLLUP (version, task)",
        "e20_experiment_stats": base + "SELECT count(*) FILTER (WHERE best_model <> 'FAILED') AS successful, "
        "count(DISTINCT version) AS versions, count(DISTINCT task) AS tasks, false AS automl_available, "
        "round(max(test_metric) + {OFF5}, 5) AS max_test_metric FROM runs",
        "g3_best_of_version": base + ", b AS (SELECT *, row_number() OVER (PARTITION BY version ORDER BY rmse, mae, r2 DESC, model) "
        "AS own FROM cand WHERE task = 'regression') SELECT version, model, row_number() OVER (ORDER BY rmse, mae, r2 DESC, model) "
        "AS rank, " + r5("rmse", "mae", "r2") + " FROM b WHERE own = 1",
        "a14_result_documents": base + "SELECT r.version, r.task, r.best_model, r.status, CASE WHEN count(c.model) > 0 THEN "
        "CAST(count(c.model) AS INTEGER) END AS n_candidates FROM runs r LEFT JOIN cand c ON c.version = r.version AND c.task = r.task "
        "GROUP BY 1, 2, 3, 4",
        "h6_flatten_candidates": base + "SELECT r.version, r.task, CAST(c.position AS BIGINT) AS position, c.model, "
        "round(c.val_metric + {OFF5}, 5) AS val_metric, CASE WHEN c.model IS NOT NULL THEN 'ok' END AS status, "
        "coalesce(c.model = r.best_model, false) AS is_best FROM runs r LEFT JOIN cand c ON c.version = r.version AND c.task = r.task",
    }


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["i1_sentiment_counts"] = _with(
        PANEL, "t AS (SELECT avg(price) AS mu, stddev_samp(price) AS sigma FROM panel)") + \
        f"SELECT {label_sql('price')} AS Market_Sentiment, count(*) AS n FROM panel CROSS JOIN t GROUP BY 1"
    q["i1_target_labels"] = _with(
        PANEL, "t AS (SELECT avg(price) AS mu, stddev_samp(price) AS sigma FROM panel)") + \
        f"SELECT symbol, ts, round(price + {OFF5}, 5) AS price, {label_sql('price')} AS Market_Sentiment " \
        "FROM panel CROSS JOIN t"
    q["a1_panel_daily"] = _with(PANEL) + \
        "SELECT symbol, ts, round(price + {OFF5}, 5) AS price, volume, round(volatility + {OFF5}, 5) AS volatility FROM panel"
    q["h5_wide_panel"] = _with(PANEL, WIDE) + "SELECT ts, " + ", ".join(
        f'"{c}"' if c.endswith("_Volume") else f'round("{c}" + {OFF5}, 5) AS "{c}"' for c in WIDE_COLS) + \
        " FROM wide"
    q["c1_returns"] = _with(PANEL, DENSE) + \
        "SELECT symbol, ts, round(ret_pct + {OFF8}, 8) AS ret_pct FROM feat"
    q["f3_f4_moving_averages"] = _with(PANEL, DENSE) + \
        "SELECT symbol, ts, round(ma7 + {OFF5}, 5) AS ma7, round(ma30 + {OFF5}, 5) AS ma30 FROM feat"
    q["i2_features_v1"] = features_sql("v1")
    q["i3_features_v2"] = features_sql("v2")
    q["i4_features_v3"] = features_sql("v3")

    allc = ["ts"] + WIDE_COLS
    q["e1_missing_counts"] = _with(PANEL, WIDE) + "SELECT \"column\", missing_count, " \
        "round(CAST(missing_count AS DOUBLE) / n + {OFF8}, 8) AS missing_share FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_count, "
            f"count(*) AS n FROM wide" for c in allc) + ") x"
    q["e2_describe"] = _with(PANEL, WIDE) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(\"{c}\") AS count, round(avg(\"{c}\") + {OFF5}, 5) AS mean, "
        f"round(stddev_samp(\"{c}\") + {OFF5}, 5) AS std, round(CAST(min(\"{c}\") AS DOUBLE) + {OFF5}, 5) AS min, "
        f"round(quantile_cont(\"{c}\", 0.25) + {OFF5}, 5) AS p25, round(quantile_cont(\"{c}\", 0.5) + {OFF5}, 5) AS p50, "
        f"round(quantile_cont(\"{c}\", 0.75) + {OFF5}, 5) AS p75, round(CAST(max(\"{c}\") AS DOUBLE) + {OFF5}, 5) AS max "
        f"FROM wide" for c in WIDE_COLS)
    q["e3_mean_std"] = _with(PANEL) + "SELECT symbol, round(avg(price) + {OFF5}, 5) AS mean, " \
        "round(stddev_samp(price) + {OFF5}, 5) AS std, count(price) AS n FROM panel GROUP BY symbol"
    pairs = [(a, b) for i, a in enumerate(WIDE_COLS) for b in WIDE_COLS[i:]]
    q["e4_correlation"] = _with(PANEL, WIDE) + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(least(greatest(corr(CAST(\"{a}\" AS DOUBLE), "
        f"CAST(\"{b}\" AS DOUBLE)), -1.0), 1.0) + {OFF8}, 8) AS corr FROM wide" for a, b in pairs)
    q["e5_value_counts"] = _with(
        PANEL, "t AS (SELECT avg(price) AS mu, stddev_samp(price) AS sigma FROM panel)",
        f"l AS (SELECT symbol, {label_sql('price')} AS Market_Sentiment FROM panel CROSS JOIN t)",
        "c AS (SELECT symbol, Market_Sentiment, count(*) AS n FROM l "
        "WHERE Market_Sentiment IS NOT NULL GROUP BY 1, 2)") + \
        "SELECT symbol, Market_Sentiment, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY symbol) + {OFF8}, 8) " \
        "AS share FROM c"
    q["e7_histogram"] = _with(
        PANEL,
        "rng AS (SELECT symbol, min(price) AS lo, max(price) AS hi, count(*) AS n FROM panel "
        "WHERE price IS NOT NULL GROUP BY symbol)",
        "b AS (SELECT p.symbol, CASE WHEN r.hi > r.lo THEN least(greatest(CAST(floor(20 * (p.price - r.lo) "
        "/ (r.hi - r.lo)) AS BIGINT) + 1, 1), 20) ELSE 1 END AS bin, r.lo, r.hi, r.n "
        "FROM panel p JOIN rng r ON p.symbol = r.symbol WHERE p.price IS NOT NULL)") + \
        "SELECT symbol, bin, round(lo + (bin - 1) * ((hi - lo) / 20) + {OFF5}, 5) AS lo, " \
        "round(lo + bin * ((hi - lo) / 20) + {OFF5}, 5) AS hi, count(*) AS n, " \
        "round(count(*) / (n * ((hi - lo) / 20)) * 1e6 + {OFF5}, 5) AS density_e6 FROM b GROUP BY symbol, bin, lo, hi, n"
    q["e8_density_2d"] = _with(
        PANEL, DENSE, "s AS (SELECT price AS x, ma7 AS y FROM feat WHERE price IS NOT NULL AND ma7 IS NOT NULL)",
        "r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM s)") + \
        "SELECT CASE WHEN x1 > x0 THEN least(greatest(CAST(floor(35 * (x - x0) / (x1 - x0)) AS BIGINT) + 1, 1), 35) " \
        "ELSE 1 END AS x_bin, CASE WHEN y1 > y0 THEN least(greatest(CAST(floor(35 * (y - y0) / (y1 - y0)) AS BIGINT) " \
        "+ 1, 1), 35) ELSE 1 END AS y_bin, count(*) AS n FROM s CROSS JOIN r GROUP BY 1, 2 HAVING count(*) >= 1"
    q["e9_quantiles"] = _with(PANEL) + \
        "SELECT symbol, CAST(0.05 AS DOUBLE) AS p, round(quantile_cont(price, 0.05) + {OFF5}, 5) AS q FROM panel GROUP BY symbol " \
        "UNION ALL SELECT symbol, CAST(0.95 AS DOUBLE), round(quantile_cont(price, 0.95) + {OFF5}, 5) FROM panel GROUP BY symbol"
    edges = ", ".join(f"quantile_cont(actual, {i / 10}) AS e{i}" for i in range(1, 10))
    binexpr = " + ".join(f"CASE WHEN actual >= e{i} THEN 1 ELSE 0 END" for i in range(1, 10))
    q["e10_calibration"] = _with(
        PANEL, MARKET, _pf(),
        "src AS (SELECT * FROM pf WHERE actual IS NOT NULL AND predicted IS NOT NULL)",
        f"e AS (SELECT {edges} FROM src)",
        f"b AS (SELECT CAST({binexpr} AS INTEGER) AS bin, actual, predicted FROM src CROSS JOIN e)",
        "st AS (SELECT bin, avg(actual) AS ma, avg(predicted) AS mp, stddev_pop(actual) AS sa, count(*) AS n "
        "FROM b GROUP BY bin)") + \
        "SELECT g.bin, round(ma + {OFF5}, 5) AS mean_actual, round(mp + {OFF5}, 5) AS mean_predicted, " \
        "round(sa + {OFF5}, 5) AS std_actual, n FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) g " \
        "LEFT JOIN st ON g.bin = st.bin"
    q["e11_errors_by_zone"] = _with(
        PANEL, MARKET, _pf(),
        "t AS (SELECT avg(actual) AS mu, stddev_samp(actual) AS sigma FROM pf)",
        f"z AS (SELECT {label_sql('actual')} AS zone, predicted - actual AS e FROM pf CROSS JOIN t "
        "WHERE actual IS NOT NULL AND predicted IS NOT NULL)",
        "st AS (SELECT zone, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM z GROUP BY zone)",
        "zones AS (SELECT * FROM (VALUES ('greed', 0), ('stable', 1), ('fear', 2)) v(zone, zone_order))") + \
        "SELECT zones.zone, CAST(zone_order AS INTEGER) AS zone_order, n, round(mae + {OFF5}, 5) AS mae, " \
        "round(rmse + {OFF5}, 5) AS rmse FROM zones LEFT JOIN st ON zones.zone = st.zone"
    q["e12_regression_metrics"] = _with(PANEL, DENSE) + \
        "SELECT symbol, count(*) AS n, round(avg(abs(ma7 - price)) + {OFF5}, 5) AS mae, " \
        "round(sqrt(avg((ma7 - price) * (ma7 - price))) + {OFF5}, 5) AS rmse, " \
        "round(1.0 - sum((ma7 - price) * (ma7 - price)) / (var_pop(price) * count(*)) + {OFF8}, 8) AS r2, " \
        "round(avg(abs((ma7 - price) / NULLIF(price, 0))) * 100 + {OFF5}, 5) AS mape " \
        "FROM feat WHERE price IS NOT NULL AND ma7 IS NOT NULL GROUP BY symbol"
    conf = ("conf AS (SELECT CAST(quality AS VARCHAR) AS t, CAST(toxic AS VARCHAR) AS p, count(*) AS n "
            "FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1, 2)")
    q["e13_confusion"] = _with(conf) + "SELECT t AS true_label, p AS pred_label, n FROM conf"
    q["e14_classification_report"] = _with(
        conf,
        "tl AS (SELECT t AS label, sum(n) AS support, sum(CASE WHEN t = p THEN n ELSE 0 END) AS tp "
        "FROM conf GROUP BY t)",
        "pl AS (SELECT p AS label, sum(n) AS predicted FROM conf GROUP BY p)",
        "cls AS (SELECT coalesce(tl.label, pl.label) AS label, CAST(coalesce(support, 0) AS DOUBLE) AS support, "
        "CAST(coalesce(tp, 0) AS DOUBLE) AS tp, CAST(coalesce(predicted, 0) AS DOUBLE) AS predicted "
        "FROM tl FULL JOIN pl ON tl.label = pl.label)",
        "m AS (SELECT label, support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr, "
        "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM cls)",
        "f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM m)") + \
        "SELECT label AS \"row\", round(pr + {OFF10}, 10) AS precision, round(rc + {OFF10}, 10) AS recall, round(f1 + {OFF10}, 10) AS f1, " \
        "CAST(support AS BIGINT) AS support FROM f " \
        "UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support) + {OFF10}, 10), round(sum(tp) / sum(support) + {OFF10}, 10), " \
        "round(sum(tp) / sum(support) + {OFF10}, 10), CAST(sum(support) AS BIGINT) FROM f " \
        "UNION ALL SELECT 'macro avg', round(avg(pr) + {OFF10}, 10), round(avg(rc) + {OFF10}, 10), round(avg(f1) + {OFF10}, 10), " \
        "CAST(sum(support) AS BIGINT) FROM f " \
        "UNION ALL SELECT 'weighted avg', NULL, NULL, round(sum(f1 * support) / sum(support) + {OFF10}, 10), " \
        "CAST(sum(support) AS BIGINT) FROM f"
    q["e15_class_balance"] = _with(PANEL, MARKET, TH, SIDES, _labels_sides()) + \
        "SELECT side, lab AS Market_Sentiment, count(*) AS n FROM labs WHERE lab IS NOT NULL GROUP BY 1, 2"
    q["e16_shape"] = _with(PANEL, MARKET, SIDES) + \
        "SELECT side, count(*) AS n_rows, CAST(18 AS INTEGER) AS n_columns, min(m.ts) AS min_ts, " \
        "max(m.ts) AS max_ts FROM market m JOIN sides s ON m.ts = s.ts GROUP BY side"
    q["e17_unique_counts"] = _with(PANEL, WIDE) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") AS n_unique, "
        f"count(DISTINCT \"{c}\") <= 1 AS is_constant FROM wide" for c in WIDE_COLS)
    q["e19_mean_in_sigma"] = _with(PANEL, MARKET, SIDES, LONG, RANKS) + \
        "SELECT feature, round(rm + {OFF5}, 5) AS ref_mean, round(rs + {OFF5}, 5) AS ref_std, round(cm + {OFF5}, 5) AS curr_mean, " \
        "coalesce(abs(cm - rm) <= 2.0 * rs, false) AS mean_in_sigma FROM mom"
    q["f5_chrono_split"] = _with(PANEL, SIDES) + \
        "SELECT side, count(DISTINCT p.ts) AS n_dates, count(*) AS n_rows, min(p.ts) AS min_ts, " \
        "max(p.ts) AS max_ts FROM panel p JOIN sides s ON p.ts = s.ts GROUP BY side"
    q["d1_category_alignment"] = _with(PANEL, MARKET, TH, SIDES, _labels_sides()) + \
        "SELECT lab AS category, count(*) FILTER (WHERE side = 'ref') AS ref_count, " \
        "count(*) FILTER (WHERE side = 'cur') AS cur_count FROM labs WHERE lab IS NOT NULL GROUP BY lab"
    q["i5_ks_statistic"] = _with(PANEL, MARKET, SIDES, LONG, RANKS) + \
        "SELECT feature, CAST(n1 AS BIGINT) AS n_ref, CAST(n2 AS BIGINT) AS n_cur, " \
        "round(ks + {OFF10}, 10) AS ks_statistic FROM rt"
    q["i6_mann_whitney"] = _with(PANEL, MARKET, SIDES, LONG, RANKS) + \
        "SELECT feature, u1 AS mw_statistic, tie AS tie_term, " \
        "round((greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / NULLIF(sg, 0) + {OFF8}, 8) AS mw_z FROM rt"
    q["i7_cohens_d"] = _with(PANEL, MARKET, SIDES, LONG, RANKS) + \
        "SELECT rt.feature, round(CASE WHEN pooled > 0 THEN (cm - rm) / pooled ELSE 0.0 END + {OFF8}, 8) AS cohens_d, " \
        "round((cm - rm) / NULLIF(rm, 0) * 100 + {OFF8}, 8) AS mean_shift_pct FROM rt JOIN mom2 ON rt.feature = mom2.feature"
    q["i9_chi_square"] = _with(
        PANEL, MARKET, TH, SIDES, _labels_sides(),
        "al AS (SELECT lab AS category, count(*) FILTER (WHERE side = 'ref') AS rc, "
        "count(*) FILTER (WHERE side = 'cur') AS cc FROM labs WHERE lab IS NOT NULL GROUP BY lab)",
        "tot AS (SELECT sum(rc) AS R, sum(cc) AS C, count(*) AS k FROM al)",
        "cells AS (SELECT rc AS o, R AS row_n, rc + cc AS col_n, R + C AS n, k FROM al CROSS JOIN tot "
        "UNION ALL SELECT cc, C, rc + cc, R + C, k FROM al CROSS JOIN tot)",
        "ex AS (SELECT CAST(o AS DOUBLE) AS o, CAST(row_n * col_n AS DOUBLE) / n AS e, k FROM cells)") + \
        "SELECT round(CASE WHEN max(k) - 1 > 0 THEN sum(power(o + CASE WHEN k - 1 = 1 THEN " \
        "least(0.5, abs(e - o)) * sign(e - o) ELSE 0.0 END - e, 2) / e) ELSE 0.0 END + {OFF10}, 10) AS chi2_statistic, " \
        "CAST(max(k) - 1 AS BIGINT) AS dof, (SELECT CAST(R AS BIGINT) FROM tot) AS n_ref, " \
        "(SELECT CAST(C AS BIGINT) FROM tot) AS n_cur FROM ex"
    q["i12_target_drift"] = "WITH RECURSIVE " + _with(
        PANEL, MARKET, TH, SIDES, _labels_sides(),
        "al AS (SELECT lab AS category, count(*) FILTER (WHERE side = 'ref') AS rc, "
        "count(*) FILTER (WHERE side = 'cur') AS cc FROM labs WHERE lab IS NOT NULL GROUP BY lab)",
        "tot AS (SELECT sum(rc) AS R, sum(cc) AS C, count(*) AS k FROM al)",
        "cells AS (SELECT rc AS o, R AS row_n, rc + cc AS col_n, R + C AS n, k FROM al CROSS JOIN tot "
        "UNION ALL SELECT cc, C, rc + cc, R + C, k FROM al CROSS JOIN tot)",
        "ex AS (SELECT CAST(o AS DOUBLE) AS o, CAST(row_n * col_n AS DOUBLE) / n AS e, k FROM cells)",
        "x AS (SELECT CASE WHEN max(k) - 1 > 0 THEN sum(power(o + CASE WHEN k - 1 = 1 THEN "
        "least(0.5, abs(e - o)) * sign(e - o) ELSE 0.0 END - e, 2) / e) ELSE 0.0 END AS chi2, "
        "CAST(max(k) - 1 AS BIGINT) AS dof FROM ex)",
        # upper tail for even dof: exp(-x/2) * sum_{i < dof/2} (x/2)^i / i!
        "terms AS (SELECT 0 AS i, 1.0::DOUBLE AS t "
        "UNION ALL SELECT i + 1, t * (SELECT chi2 FROM x) / 2 / (i + 1) FROM terms "
        "WHERE i + 1 < (SELECT dof FROM x) / 2)",
        "p AS (SELECT chi2, dof, CASE WHEN dof % 2 = 0 THEN exp(-chi2 / 2) * (SELECT sum(t) FROM terms) "
        "END AS pv FROM x)")[len("WITH "):] + \
        "SELECT round(chi2 + {OFF10}, 10) AS chi2_statistic, dof, (SELECT CAST(R AS BIGINT) FROM tot) AS n_ref, " \
        "(SELECT CAST(C AS BIGINT) FROM tot) AS n_cur, round(pv + {OFF10}, 10) AS chi2_pvalue, " \
        "pv < 0.05 AS drift_detected FROM p"
    q["i19_ref_cur_comparison"] = _with(PANEL, MARKET, SIDES, LONG, RANKS) + \
        "SELECT feature, round(rm + {OFF5}, 5) AS ref_mean, round(cm + {OFF5}, 5) AS curr_mean, round(rs + {OFF5}, 5) AS ref_std, " \
        "round(cs + {OFF5}, 5) AS curr_std, round((cm - rm) / NULLIF(rm, 0) * 100 + {OFF8}, 8) AS mean_shift_pct FROM mom"
    q["i14_error_analysis"] = _with(PANEL, MARKET, _pf()) + \
        "SELECT ts, round(actual + {OFF5}, 5) AS actual, round(predicted + {OFF5}, 5) AS predicted, " \
        "round(actual - predicted + {OFF5}, 5) AS residual, " \
        "round(abs((actual - predicted) / NULLIF(actual, 0)) * 100 + {OFF8}, 8) AS abs_pct_error FROM pf"
    q["i13_dummy_baseline"] = _with(
        PANEL, MARKET, TH, SIDES,
        f"lab AS (SELECT s.side, m.Target_Price AS y, {label_sql('m.Target_Price')} AS lab "
        "FROM market m JOIN sides s ON m.ts = s.ts CROSS JOIN th)",
        "maj AS (SELECT lab FROM lab WHERE side = 'ref' AND lab IS NOT NULL GROUP BY lab "
        "ORDER BY count(*) DESC, lab DESC LIMIT 1)",
        "mr AS (SELECT avg(y) AS m FROM lab WHERE side = 'ref')") + \
        "SELECT (SELECT lab FROM maj) AS majority_class, " \
        "round(avg(CASE WHEN lab = (SELECT lab FROM maj) THEN 1.0 ELSE 0.0 END) + {OFF10}, 10) AS accuracy, " \
        "round(sqrt(avg((m - y) * (m - y))) + {OFF5}, 5) AS rmse, round(avg(abs(m - y)) + {OFF5}, 5) AS mae " \
        "FROM lab CROSS JOIN mr WHERE side = 'cur'"
    cte1, feats1 = _feature_cte("v1")
    numcols = feats1 + ["Target_Value"]
    q["i15_quality_report"] = _with(PANEL, MARKET, TH, cte1) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_count, "
        f"round(CAST(count(*) - count(\"{c}\") AS DOUBLE) / count(*) + {OFF8}, 8) AS missing_share, "
        f"round(quantile_cont(\"{c}\", 0.05) + {OFF5}, 5) AS q05, round(quantile_cont(\"{c}\", 0.95) + {OFF5}, 5) AS q95, "
        f"CAST(NULL AS DOUBLE) AS pattern_share FROM fs" for c in numcols) + \
        " UNION ALL SELECT 'Market_Sentiment', CAST(count(*) - count(Market_Sentiment) AS BIGINT), " \
        "round(CAST(count(*) - count(Market_Sentiment) AS DOUBLE) / count(*) + {OFF8}, 8), NULL, NULL, " \
        "round(avg(CASE WHEN regexp_matches(Market_Sentiment, '^(stable|fear|greed)$') THEN 1.0 " \
        "WHEN Market_Sentiment IS NULL THEN NULL ELSE 0.0 END) + {OFF8}, 8) FROM fs"
    parts = []
    for v in ("v1", "v2", "v3"):
        cte, feats = _feature_cte(v)
        cond = " AND ".join(f'"{c}" IS NOT NULL' for c in feats)
        parts.append((v, cte, feats, cond))
    # one statement per version, unioned; each has its own CTE chain
    q["b8_dropna_counts"] = " UNION ALL ".join(
        "SELECT * FROM (" + _with(PANEL, MARKET, TH, cte) +
        f"SELECT '{v}' AS version, count(*) AS n_rows, count(*) FILTER (WHERE Target_Value IS NOT NULL) "
        f"AS n_target, count(*) FILTER (WHERE Target_Value IS NOT NULL AND {cond}) AS n_complete, "
        f"count(*) FILTER (WHERE {cond} AND ts IS NOT NULL AND Target_Value IS NOT NULL "
        f"AND Market_Sentiment IS NOT NULL) AS n_no_null, "
        f"CAST({len(feats)} AS BIGINT) AS n_features FROM fs) x_{v}" for v, cte, feats, cond in parts)
    ratio = "log10(price / ({den} + 1e-9))"
    q["c3_loose_ratio"] = _with(PANEL) + (
        "SELECT symbol, ts, round(" + ratio.format(den="coalesce(volatility, 0)") + " + {OFF5}, 5) AS loose, round("
        + ratio.format(den="nullif(coalesce(volatility, 0), 0)") + " + {OFF5}, 5) AS strict FROM panel")
    q["c8_scalar_functions"] = _with(PANEL) + (
        "SELECT symbol, ts, round(abs(price - 150000) + {OFF5}, 5) AS distance, round(sqrt(price) + {OFF5}, 5) AS root, "
        "round(-log10(price) + {OFF5}, 5) AS neg_log10 FROM panel")
    q["a4_lenient_timestamps"] = """SELECT o_orderstatus, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS unreadable,
  count(*) FILTER (WHERE o_orderkey % 2 = 0) AS readable,
  strftime(min(o_orderdate) FILTER (WHERE o_orderkey % 2 = 0), '%Y-%m-%d') AS first_day,
  strftime(max(o_orderdate) FILTER (WHERE o_orderkey % 2 = 0), '%Y-%m-%d') AS last_day
FROM orders GROUP BY o_orderstatus"""
    q["a5_csv_roundtrip"] = q["a1_panel_daily"]
    q["a6_a7_feature_store_roundtrip"] = q["i4_features_v3"]
    q["a9_a11_registry"] = _with(PANEL, MARKET) + " UNION ALL ".join(
        f"SELECT 'sentiment_{v}' AS feature_set_name, '{v}' AS version, CAST({n} AS BIGINT) AS "
        "num_features, count(*) AS num_samples, CAST(min(ts) AS VARCHAR) AS date_range_start, "
        "CAST(max(ts) AS VARCHAR) AS date_range_end FROM market"
        for v, n in (("v1", 15), ("v2", 25), ("v3", 45)))
    q["m1_windowed_monitoring"] = """WITH ref AS (
  SELECT event_type AS symbol, avg(value) AS ref_mean FROM events GROUP BY event_type),
w AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         event_type AS symbol, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std
  FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT window_start, window_end, w.symbol, n, round(mean + {OFF8}, 8) AS mean,
       round(std + {OFF8}, 8) AS std,
       round(abs((mean - ref_mean) / NULLIF(ref_mean, 0)) + {OFF8}, 8) AS mean_shift,
       coalesce(abs((mean - ref_mean) / NULLIF(ref_mean, 0)) > 0.01, false) AS alert
FROM w LEFT JOIN ref ON w.symbol = ref.symbol CROSS JOIN wm WHERE window_end <= wm.wm"""
    q["m1_hourly_skew"] = """WITH ev AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS h, CASE WHEN isnan(value) THEN NULL ELSE value END AS v
  FROM events WHERE ts IS NOT NULL),
pr AS (SELECT symbol, min(v) AS lo, max(v) AS hi, avg(v) AS mu, stddev_samp(v) AS sigma FROM ev WHERE v IS NOT NULL GROUP BY symbol),
b AS (SELECT ev.symbol, h, v, CASE WHEN v IS NULL THEN NULL WHEN hi > lo THEN
        least(greatest(CAST(floor(10 * (v - lo) / (hi - lo)) AS BIGINT) + 1, 1), 10) ELSE 1 END AS bin,
        CASE WHEN mu IS NOT NULL THEN """ + label_sql("v") + """ END AS lab FROM ev LEFT JOIN pr ON ev.symbol = pr.symbol),
bins AS (SELECT CAST(range AS BIGINT) AS k FROM range(1, 11)),
tr AS (SELECT symbol, k, count(*) FILTER (WHERE bin = k) / CAST(count(*) AS DOUBLE) AS share
       FROM b CROSS JOIN bins WHERE bin IS NOT NULL GROUP BY symbol, k),
wn AS (SELECT h, b.symbol, k, count(*) FILTER (WHERE bin = k) / CAST(nullif(count(bin), 0) AS DOUBLE) AS share
       FROM b CROSS JOIN bins GROUP BY h, b.symbol, k),
g AS (SELECT h, wn.symbol, max(abs(wn.share - tr.share)) AS skew
      FROM wn LEFT JOIN tr ON tr.symbol = wn.symbol AND tr.k = wn.k GROUP BY 1, 2),
c AS (SELECT h, symbol, count(*) AS n, count(*) FILTER (WHERE lab = 'fear') AS n_fear, count(*) FILTER (WHERE lab = 'greed') AS n_greed,
             count(*) FILTER (WHERE lab = 'stable') AS n_stable, count(*) FILTER (WHERE lab IS NULL) AS n_unlabelled
      FROM b GROUP BY 1, 2)
SELECT c.h AS window_start, c.symbol, n, round(skew + {OFF8}, 8) AS skew, n_fear, n_greed, n_stable, n_unlabelled,
       coalesce(skew > 0.01, false) AS alert
FROM c JOIN g ON c.h = g.h AND c.symbol = g.symbol
WHERE c.h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
    q["m2_live_labels"] = """WITH ref AS (
  SELECT event_type AS symbol, avg(value) AS mu, stddev_samp(value) AS sigma FROM events
  GROUP BY event_type)
SELECT e.event_type AS symbol, """ + label_sql("e.value") + """ AS label, count(*) AS n
FROM events e LEFT JOIN ref ON e.event_type = ref.symbol GROUP BY 1, 2"""
    q["i20_serving_skew"] = """WITH ev AS (
  SELECT event_type AS feature, CAST(ts AS DATE) AS day, value FROM events),
d AS (SELECT day, row_number() OVER (ORDER BY day) AS rk, count(*) OVER () AS nd
      FROM (SELECT DISTINCT day FROM ev) x),
s AS (SELECT ev.*, CASE WHEN rk <= floor(nd * 0.8) THEN 'ref' ELSE 'cur' END AS side
      FROM ev JOIN d ON ev.day = d.day WHERE value IS NOT NULL),
rng AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM s WHERE side = 'ref' GROUP BY feature),
b AS (SELECT s.feature, s.side, CASE WHEN hi > lo THEN least(greatest(CAST(floor(10 * (value - lo)
        / (hi - lo)) AS BIGINT) + 1, 1), 10) ELSE 1 END AS bin FROM s JOIN rng ON s.feature = rng.feature),
c AS (SELECT feature, bin, count(*) FILTER (WHERE side = 'ref') AS r,
             count(*) FILTER (WHERE side = 'cur') AS c FROM b GROUP BY feature, bin),
t AS (SELECT feature, sum(r) AS rt, sum(c) AS ct FROM c GROUP BY feature),
g AS (SELECT c.feature, abs(CAST(r AS DOUBLE) / rt - CAST(c AS DOUBLE) / ct) AS gap
      FROM c JOIN t ON c.feature = t.feature)
SELECT feature, round(max(gap) + {OFF10}, 10) AS linf_distance, max(gap) > 0.01 AS alert
FROM g GROUP BY feature"""
    q["e18_column_summary"] = _with(PANEL, WIDE, SIDES) + " UNION ALL ".join(
        f"SELECT side, '{c}' AS \"column\", count(\"{c}\") AS count, "
        f"count(*) - count(\"{c}\") AS missing, round(avg(\"{c}\") + {{OFF5}}, 5) AS mean, "
        f"round(CAST(min(\"{c}\") AS DOUBLE) + {{OFF5}}, 5) AS min, "
        f"round(CAST(max(\"{c}\") AS DOUBLE) + {{OFF5}}, 5) AS max, "
        f"count(DISTINCT \"{c}\") AS n_unique FROM wide w JOIN sides s ON w.ts = s.ts GROUP BY side"
        for c in WIDE_COLS)
    q["a2_holdout_pair"] = _with(PANEL, SIDES) + \
        "SELECT side, count(*) AS n_rows, min(ts) AS min_date, max(ts) AS max_date FROM sides GROUP BY side"
    cte_x, feats_x = _feature_cte("v3", cross=True)
    cross_cols = [c for c in feats_x if "_over_" in c and c.endswith("_Volatility")]
    q["h4_cross_ratios"] = _with(PANEL, MARKET, TH, cte_x) + "SELECT ts, " + ", ".join(
        f'round("{c}" + {{OFF3}}, 3) AS "{c}"' for c in cross_cols) + " FROM fs"
    cte_2, feats_2 = _feature_cte("v2")
    q["a13_request_scan"] = _with(PANEL, MARKET, TH, cte_2) + "SELECT ts, " + ", ".join(
        _round_feature(c) for c in feats_2) + " FROM fs"
    q["b13_request_schema_check"] = """WITH segs AS (
  SELECT DISTINCT c.c_mktsegment AS s FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
kinds AS (SELECT * FROM (VALUES ('Price'), ('Volume')) k(kind))
SELECT 'ratio_' || a.s || '_' || kind || '_over_' || b.s || '_' || kind AS "column",
       'missing' AS problem
FROM segs a JOIN segs b ON a.s < b.s CROSS JOIN kinds
UNION ALL SELECT 'ts' AS "column", 'extra' AS problem"""
    q["g2_forecaster_ranking"] = _with(PANEL, DENSE) + """,
fc AS (SELECT symbol, 'ma7' AS forecaster, price, ma7 AS pred FROM feat
       UNION ALL SELECT symbol, 'ma30' AS forecaster, price, ma30 AS pred FROM feat),
m AS (SELECT symbol, forecaster, count(*) AS n, avg(abs(pred - price)) AS mae,
             sqrt(avg((pred - price) * (pred - price))) AS rmse,
             1.0 - sum((pred - price) * (pred - price)) / (var_pop(price) * count(*)) AS r2
      FROM fc WHERE price IS NOT NULL AND pred IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY rmse, mae, r2 DESC, forecaster)
             AS rk FROM m)
SELECT symbol, forecaster, n, round(mae + {OFF5}, 5) AS mae, round(rmse + {OFF5}, 5) AS rmse,
       round(r2 + {OFF8}, 8) AS r2, rk AS rank FROM r"""
    q.update(_drift_reports())
    q.update(_run_reports())
    q.update(_split_reports())
    q.update(_source_reports())
    for k, v in q.items():
        q[k] = v.replace("{OFF3}", OFF3).replace("{OFF5}", OFF5).replace("{OFF6}", OFF6).replace("{OFF8}", OFF8).replace("{OFF10}", OFF10)
    return q

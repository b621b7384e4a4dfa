"""Feature store, registry and file sources."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidewatch.operators.features import build_feature_set
from tidewatch.plans.store import REGISTRY_COLUMNS, FeatureStore
from tidewatch.sources import files
from tidewatch.sources.tables import daily_panel


def test_store_roundtrip_and_registry(spark, tmp_path):
    store = FeatureStore(spark, [str(tmp_path / "a"), str(tmp_path / "b")], prefer=1)
    assert store.list_sets().count() == 0
    assert store.list_sets().columns == REGISTRY_COLUMNS
    fs = build_feature_set(daily_panel(spark, SF001), "v3")
    store.save(fs, name="s3", description="d")
    back = store.load("s3")
    assert back.features == fs.features and len(back.features) == 45
    assert back.df.count() == fs.df.count()
    reg = store.query("version = 'v3'").first()
    assert reg.num_features == 45 and reg.feature_set_name == "s3"
    with pytest.raises(FileNotFoundError):
        store.load("nope")


def test_detect_date_column(spark):
    df = spark.createDataFrame([("x", "2024-01-01")], "a string, b string")
    assert files.detect_date_column(df) == "b"
    df2 = spark.createDataFrame([("2024-01-01", "1")], "OrderDay string, Date string")
    assert files.detect_date_column(df2) == "Date"
    with pytest.raises(ValueError):
        files.detect_date_column(spark.createDataFrame([("x",)], "a string"))


def test_nested_requests_and_schema_check(spark, tmp_path):
    doc = {"instances": [{"A_Price_ret_pct": 1.5, "A_Volume": 3},
                         {"A_Price_ret_pct": -0.5, "A_Volume": 4}]}
    p = tmp_path / "req.json"
    p.write_text(json.dumps(doc, indent=2))
    req = files.read_requests(spark, str(p))
    assert req.count() == 2
    chk = {(r.column, r.problem) for r in
           files.request_schema_check(req, ["A_Price_ret_pct", "B_Volume"]).collect()}
    assert chk == {("B_Volume", "missing"), ("A_Volume", "extra")}


def test_csv_panel_lenient_dates_and_fallback(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("Date,X_Price\n2024-01-02,1.5\nnot a date,2.5\n")
    df = files.read_csv_panel(spark, [str(tmp_path / "missing.csv"), str(p)], date_col="Date")
    vals = [r.Date for r in df.orderBy("X_Price").collect()]
    assert vals[0] is not None and vals[1] is None


def test_feature_groups(spark, tmp_path):
    meta = spark.createDataFrame([("Market Data", "A_Price_ret_pct"), ("Market Data", "a_price_ret_pct"), (None, "x"), ("Vol", "zzz")],
                                 "Category string, Feature string")
    g = {r.group: r.features for r in files.feature_groups(
        meta, ["A_Price_ret_pct", "ratio_A_over_B"]).collect()}
    assert g == {"market_data": ["A_Price_ret_pct"], "derived_indicators": ["ratio_A_over_B"]}
    empty = files.read_feature_metadata(spark, str(tmp_path / "none.csv"))
    assert empty.count() == 0 and empty.columns == ["Category", "Feature"]


def test_dual_location_save_and_ordered_load(spark, tmp_path):
    """Save writes every root; load prefers the chosen root and falls back
    to the next one that holds a registry."""
    from tidewatch.operators.features import build_feature_set
    from tidewatch.plans.store import FeatureStore
    from tidewatch.sources.tables import daily_panel
    a, b, empty = str(tmp_path / "local"), str(tmp_path / "remote"), str(tmp_path / "missing")
    fs = build_feature_set(daily_panel(spark, "/root/testdata/sf0.001"), "v1")
    out = FeatureStore(spark, [a, b]).save(fs, name="s1")
    assert out["data"] == [f"{a}/data", f"{b}/data"]
    for root in (a, b):
        assert spark.read.parquet(f"{root}/registry").count() == 1
    assert FeatureStore(spark, [a, b], prefer=1)._read_root() == b
    fallback = FeatureStore(spark, [empty, a], prefer=0)
    assert fallback._read_root() == a
    assert fallback.load("s1").df.count() == fs.df.count()

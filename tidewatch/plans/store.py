"""Versioned feature sets and their registry.

Data: one Parquet dataset partitioned by ``version`` and ``set_name``, so
loading one set prunes every other partition at planning time.  Registry:
an append-only Parquet table with one typed row per saved set; listing and
querying it is plain DataFrame / SQL.  Optional second location (e.g. an
object store next to HDFS): writes go to every location, reads take the
preferred one that exists.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType, TimestampType)

from ..operators.features import LABEL_COL, TARGET_VALUE, FeatureSet
from ..session import ensure_checkpoint_dir
from ..sources.files import _exists

REGISTRY_SCHEMA = StructType([
    StructField("feature_set_name", StringType(), False),
    StructField("version", StringType(), False),
    StructField("description", StringType(), True),
    StructField("created_at", TimestampType(), True),
    StructField("num_features", LongType(), True),
    StructField("num_samples", LongType(), True),
    StructField("date_range_start", StringType(), True),
    StructField("date_range_end", StringType(), True),
    StructField("features_json", StringType(), True),
    StructField("status", StringType(), True),
])

REGISTRY_COLUMNS = ["feature_set_name", "version", "description", "created_at", "num_features",
                    "num_samples", "date_range_start", "date_range_end"]


class FeatureStore:
    def __init__(self, spark: SparkSession, roots: list[str] | str | None = None,
                 prefer: int = 0):
        self.spark = spark
        if roots is None:
            roots = [ensure_checkpoint_dir(spark).rstrip("/") + "/tidewatch/feature_store"]
        self.roots = [roots] if isinstance(roots, str) else list(roots)
        self.prefer = prefer

    # -- paths ---------------------------------------------------------------
    def _data(self, root: str) -> str:
        return f"{root}/data"

    def _registry(self, root: str) -> str:
        return f"{root}/registry"

    def _order(self) -> list[str]:
        return [self.roots[self.prefer]] + [r for i, r in enumerate(self.roots) if i != self.prefer]

    def _read_root(self) -> str:
        """Where listings are read: the first location with a registry."""
        order = self._order()
        for r in order:
            if _exists(self.spark, self._registry(r)):
                return r
        return order[0]

    # -- save ----------------------------------------------------------------
    def save(self, fs: FeatureSet, name: str | None = None, description: str = "") -> dict:
        """Write ``ts + features + target + label`` of a feature set and
        append its registry row; returns the paths written."""
        name = name or f"sentiment_{fs.version}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
        cols = [fs.ts, *fs.features, fs.target_value, fs.label]
        data = fs.df.select(*cols).withColumn("version", F.lit(fs.version)) \
            .withColumn("set_name", F.lit(name))
        written = []
        for root in self.roots:
            (data.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("version", "set_name").parquet(self._data(root)))
            written.append(self._data(root))
        # registry row from one aggregate over the written partition
        stored = self.spark.read.parquet(
            f"{self._data(self.roots[0])}/version={fs.version}/set_name={name}")
        row = stored.agg(F.count(F.lit(1)).alias("n"), F.min(fs.ts).alias("lo"),
                         F.max(fs.ts).alias("hi")).first()
        reg = self.spark.createDataFrame([(
            name, fs.version, description, datetime.now(timezone.utc).replace(tzinfo=None),
            len(fs.features), int(row["n"]), str(row["lo"]), str(row["hi"]),
            json.dumps({"features": fs.features, "target_columns": [fs.target_value, fs.label]}),
            "active")], REGISTRY_SCHEMA)
        for root in self.roots:
            reg.write.mode("append").parquet(self._registry(root))
            # metadata document next to the data (counts, features, date range)
            reg.select("feature_set_name", "version", "created_at", "num_features", "num_samples",
                       F.struct(F.col("date_range_start").alias("start"),
                                F.col("date_range_end").alias("end")).alias("date_range"),
                       F.from_json("features_json", "features array<string>, "
                                   "target_columns array<string>").alias("meta")) \
                .write.mode("append").json(f"{root}/metadata")
        return {"name": name, "data": written}

    # -- read ----------------------------------------------------------------
    def metadata(self) -> DataFrame:
        """Metadata documents (JSON) of every saved set."""
        return self.spark.read.json(f"{self._read_root()}/metadata")

    def registry(self) -> DataFrame:
        root = self._read_root()
        if not _exists(self.spark, self._registry(root)):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self._registry(root))

    def list_sets(self) -> DataFrame:
        """Newest first; empty frame (same schema) when nothing is stored."""
        return self.registry().select(*REGISTRY_COLUMNS).orderBy(F.desc("created_at"))

    def query(self, sql_where: str | None = None) -> DataFrame:
        """SQL over the registry (temp view ``feature_registry``)."""
        self.registry().createOrReplaceTempView("feature_registry")
        where = f" WHERE {sql_where}" if sql_where else ""
        return self.spark.sql(f"SELECT {', '.join(REGISTRY_COLUMNS)} FROM feature_registry"
                              f"{where} ORDER BY created_at DESC")

    def load(self, name: str) -> FeatureSet:
        """Both the registry row and the data must exist, else an error.
        The filter on the partition columns prunes all other sets."""
        for root in self._order():
            if not _exists(self.spark, self._registry(root)):
                continue
            reg = (self.spark.read.schema(REGISTRY_SCHEMA).parquet(self._registry(root))
                   .where(F.col("feature_set_name") == name).orderBy(F.desc("created_at")).limit(1).collect())
            # Read only this set's partition folder: sets of different versions
            # have different columns, and listing/merging every set's schema
            # would grow with the store.
            part = f"{self._data(root)}/version={reg[0]['version']}/set_name={name}" if reg else ""
            if not reg or not _exists(self.spark, part):
                continue
            meta = json.loads(reg[0]["features_json"])
            feats, (target, label) = meta["features"], meta["target_columns"]
            df = self.spark.read.option("basePath", self._data(root)).parquet(part)
            ts = next(c for c in df.columns if c not in (*feats, target, label, "version", "set_name"))
            return FeatureSet(version=reg[0]["version"], df=df.select(ts, *feats, target, label), features=feats,
                              target_value=target, label=label, ts=ts)
        raise FileNotFoundError(f"feature set {name!r} is not registered with its data in any location")

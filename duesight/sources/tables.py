"""Tables by logical name: scans, full-refresh and append sinks, setup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tables:
    """Resolves logical names to Parquet folders below one root (any file system Spark reads)."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def scan(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name))
            return True
        except AnalysisException:
            return False

    def refresh(self, df: DataFrame, name: str) -> DataFrame:
        """Replace the table (its columns may change)."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.scan(name)

    def append(self, df: DataFrame, name: str, stamp: str) -> DataFrame:
        """Append a run to a log, partitioned by the day of its timestamp column ``stamp``, so
        that readers of recent runs prune the rest. Later runs may add columns."""
        (
            df.withColumn("run_date", F.to_date(stamp))
            .write.mode("append")
            .partitionBy("run_date")
            .parquet(self.path(name))
        )
        return self.log(name)

    def log(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))

    def feature_table(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """Catalog table bucketed by the entity key: later windows and joins on the key need no
        shuffle. Uniqueness of (key, day) is a guard, not a storage feature."""
        (
            df.write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", self.path(name))
            .saveAsTable(name)
        )
        return self.spark.table(name)


def setup(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def catalog_table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)

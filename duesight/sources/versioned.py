"""Tables that are refreshed whole while others read them.

A refresh writes a new version folder; only when that is complete, one row is appended to the
table's pointer log. Readers take the version of the latest pointer, so they see the old rows or
the new ones, never half of them, and a refresh that dies leaves the table as it was. Old versions
remain readable by number until ``retain`` drops them. Everything goes through Spark's file systems.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

_POINTER = "_pointer"
_POINTER_SCHEMA = "number long, folder string, written_at timestamp"


@dataclass(frozen=True)
class VersionedTables(Tables):
    """``Tables`` whose ``refresh`` keeps versions; append logs are as in ``Tables``."""

    def versions(self, name: str) -> DataFrame:
        """The pointer log: a row per refresh, no rows if there was none."""
        try:
            return self.spark.read.schema(_POINTER_SCHEMA).parquet(f"{self.path(name)}/{_POINTER}")
        except AnalysisException:
            return self.spark.createDataFrame([], _POINTER_SCHEMA)

    def _current(self, name: str, number: int | None = None):
        rows = self.versions(name)
        rows = rows if number is None else rows.filter(F.col("number") == number)
        # Two refreshes may have taken one number at the same time: all readers agree on one.
        return rows.orderBy(F.col("number").desc(), F.col("folder").desc()).first()

    def refresh(self, df: DataFrame, name: str) -> DataFrame:
        """Replace the table (its columns may change). ``df`` may read the table itself."""
        last = self._current(name)
        number, folder = (last.number if last else 0) + 1, f"version-{uuid.uuid4().hex}"
        path = f"{self.path(name)}/{folder}"
        df.write.parquet(path)
        self._point(name, number, folder)
        return self.spark.read.parquet(path)

    def _point(self, name: str, number: int, folder: str) -> None:
        pointer = self.spark.range(1).select(
            F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), F.current_timestamp().alias("written_at")
        )
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path(name)}/{_POINTER}")

    def scan(self, name: str, number: int | None = None) -> DataFrame:
        """The latest version, or the one with this number."""
        current = self._current(name, number)
        if current is None:
            raise LookupError(f"no version {number or ''} of {name}".replace("  ", " "))
        return self.spark.read.parquet(f"{self.path(name)}/{current.folder}")

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def retain(self, name: str, keep: int) -> int:
        """Delete the folders of all but the ``keep`` latest versions, and of refreshes that never
        got a pointer; returns how many. Run it when no refresh of the table is under way and no
        reader needs a version that old."""
        if keep < 1:
            raise ValueError("the current version cannot be dropped")
        rows = self.versions(name).orderBy(F.col("number").desc(), F.col("folder").desc()).limit(keep).collect()
        kept = {r.folder for r in rows} | {_POINTER}
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        stale = [s.getPath() for s in files.listStatus(root) if s.isDirectory() and s.getPath().getName() not in kept]
        for path in stale:
            files.delete(path, True)
        return len(stale)

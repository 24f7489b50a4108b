"""Session helpers: configuration for local runs and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "duesight", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # Call-site capture per column expression doubles the time to build wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def package_for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (executors on other
    machines get it with ``--py-files``, as any package)."""
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_folder(spark: SparkSession) -> str:
    """Folder for lineage cuts: the cluster's ``spark.checkpoint.dir``; where it is unset, a folder
    below the session's table storage, which all executors reach as well."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _within = Lock(), {}  # by session: how many are within, and the setting before


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go as it ends. Spark keeps them otherwise until the driver
    happens to collect its garbage, and jobs of many steps fill the executors' disks by then."""
    with _lock:
        n, before = _within.get(spark, (0, None))
        if not n:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _within[spark] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _within.pop(spark)
            if n > 1:
                _within[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where two passes must see the very same rows in the very same partitions (range
    bounds are sampled and would differ between runs). A Parquet table rather than
    ``checkpoint()``: later passes read only the columns they use, and the optimizer gets a
    true size for its join choices.
    """
    path = new_folder(df.sparkSession, label)
    with short_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scalar_row(one_row: DataFrame) -> Column:
    """All columns of a one-row DataFrame as a struct column, via a scalar subquery.

    The value is computed once per query and shipped as a constant, so attaching global
    statistics to a table needs neither a join nor a driver round trip. Spark raises if the
    input has more than one row.
    """
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()

"""Shared helpers: reading a table, partial counts inside tasks, spans as text."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct keys a task holds before it hands its partial counts to the shuffle.
FLUSH_KEYS = 200_000
#: Documents in one batch for a Python worker.
BATCH_ROWS = 1_000


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (executors on other
    machines get it with ``--py-files``, as any package), and hand them texts in small batches:
    rows here are whole documents, for which ten thousand to a batch are many."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partial_counts(
    docs: DataFrame, column: str, add: Callable[[dict, str], None], key: str, values: list[str]
) -> DataFrame:
    """Sum counts that ``add(counts, text)`` collects as ``counts[key] = [n, ...]``.

    Every task sums in a dictionary of bounded size first, so a key that a third of all rows
    hold reaches the shuffle once per task. Null texts count nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict = {}

        def flush() -> pd.DataFrame:
            frame = pd.DataFrame.from_dict(counts, orient="index", columns=values).rename_axis(key).reset_index()
            counts.clear()
            return frame

        for batch in batches:
            for text in batch[column]:
                if text:
                    add(counts, text)
                    if len(counts) > FLUSH_KEYS:
                        yield flush()
        if counts:
            yield flush()

    schema = f"{key} string, " + ", ".join(f"{v} long" for v in values)
    return docs.select(column).mapInPandas(run, schema).groupBy(key).agg(*[F.sum(v).alias(v) for v in values])


def spans_text(spans: Iterable[tuple[int, int, str]], kinds: list[str]) -> str:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1])))


def parse_spans(text: str) -> list[tuple[int, int, str]]:
    parts = (item.split(":") for item in text.split(",") if item)
    return [(int(s), int(e), k) for k, s, e in parts]


def replace_spans(text: str, spans: list[tuple[int, int, str]], substitute: Callable[[str, str], str]) -> str:
    """Replace spans from left to right; of overlapping spans the first (longest at a start) wins,
    and a later one that reaches further is cut off with it."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda x: (x[0], -x[1])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], substitute(kind, text[start:end])]
        at = end
    return "".join([*out, text[at:]])

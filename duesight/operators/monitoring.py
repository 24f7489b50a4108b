"""Drift and delayed-label performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import drift_status
from ..params import PSI_BINS, PSI_FLOOR
from ..session import scalar_row
from .evaluation import model_metrics
from .ordering import edges_passed, grouped_quantile_values, quantile_values


def _require(df: DataFrame, columns: dict[str, str]) -> None:
    missing = [c for c in columns.values() if c not in df.columns]
    if missing:
        raise ValueError(f"features missing from input: {missing}")


def _long(df: DataFrame, columns: dict[str, str], kind: str) -> DataFrame:
    """Rows ``(feature, value)`` of the named columns, without missing or non-finite values."""
    _require(df, columns)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("feature"), F.col(c).cast(kind).alias("value")) for n, c in columns.items()]
    )
    out = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    if kind == "double":
        out = out.filter(~F.isnan("value") & (F.abs("value") != float("inf")))
    return out


def _psi(counts: DataFrame) -> DataFrame:
    """``(feature, bin, ref, cur)`` counts to one index per feature; NULL if a side is empty."""
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("_ref"), F.sum("cur").alias("_cur"))
    # One row per feature.
    both = counts.join(F.broadcast(totals), "feature")
    r = F.greatest(F.try_divide(F.col("ref"), F.col("_ref")), F.lit(PSI_FLOOR))
    c = F.greatest(F.try_divide(F.col("cur"), F.col("_cur")), F.lit(PSI_FLOOR))
    empty = (F.col("_ref") == 0) | (F.col("_cur") == 0)
    return both.groupBy("feature").agg(F.sum(F.when(~empty, (c - r) * F.ln(c / r))).alias("psi"))


def _by_side(reference: DataFrame, current: DataFrame) -> DataFrame:
    return reference.select("*", F.lit(1).alias("ref"), F.lit(0).alias("cur")).unionByName(
        current.select("*", F.lit(0).alias("ref"), F.lit(1).alias("cur"))
    )


def reference_edges(reference: DataFrame, columns: dict[str, str], bins: int = PSI_BINS) -> dict[str, list[float]]:
    """Distinct reference quantiles per feature: the fitted part of a drift check."""
    tall = _long(reference, columns, "double")
    found = grouped_quantile_values(tall, "value", [i / bins for i in range(bins + 1)], "feature")
    return {name: sorted(set(found.get(name, []))) for name in columns}


def numeric_psi(
    reference: DataFrame,
    current: DataFrame,
    ref_columns: dict[str, str],
    cur_columns: dict[str, str] | None = None,
    bins: int = PSI_BINS,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Population stability of numeric features, all features in one pass: ``(feature, psi)``.

    Bin edges are the exact reference quantiles (or stored ``edges``), bins are left-closed,
    shares are floored. A near-constant reference (fewer than three distinct edges) gives 0, an
    empty side NULL.
    """
    cur_columns = cur_columns or ref_columns
    if set(cur_columns) != set(ref_columns):
        raise ValueError("both sides must name the same features")
    edges = edges or reference_edges(reference, ref_columns, bins)
    # Edges of the outermost bins are open, so only the inner ones separate values.
    inner = {name: e[1:-1] for name, e in edges.items()}

    def binned(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        def bin_of(name: str, column: str) -> Column:
            v = F.col(column).cast("double")
            usable = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
            return F.when(usable, edges_passed(inner[name], column, "<="))

        pairs = [
            F.struct(F.lit(n).alias("feature"), bin_of(n, c).alias("bin")) for n, c in columns.items()
        ]
        return df.select(F.inline(F.array(*pairs))).filter("bin is not null")

    _require(reference, ref_columns)
    _require(current, cur_columns)
    filled = (
        _by_side(binned(reference, ref_columns), binned(current, cur_columns))
        .groupBy("feature", "bin")
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    every = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.lit(i).alias("bin"))
            for n in ref_columns
            for i in range(len(inner[n]) + 1)
        ]
    )
    # A few rows per feature from here on; empty bins are there too.
    spine = reference.sparkSession.range(1).select(F.inline(every))
    counts = spine.join(filled, ["feature", "bin"], "left").na.fill(0, ["ref", "cur"])
    flat = F.col("feature").isin([n for n, e in edges.items() if len(e) < 3]) & F.col("psi").isNotNull()
    return _psi(counts).withColumn("psi", F.when(flat, F.lit(0.0)).otherwise(F.col("psi")))


def categorical_psi(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """The same over category shares. Grouping both sides together aligns the category sets:
    one that is missing on a side counts 0 there and gets the floor."""
    named = {c: c for c in columns}
    counts = (
        _by_side(_long(reference, named, "string"), _long(current, named, "string"))
        .groupBy("feature", F.col("value").alias("bin"))
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    return _psi(counts)


def category_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Aligned category counts of both sides (0 where a category is absent)."""
    named = {c: c for c in columns}
    return (
        _by_side(_long(reference, named, "string"), _long(current, named, "string"))
        .groupBy("feature", "value")
        .agg(F.sum("ref").cast("long").alias("n_reference"), F.sum("cur").cast("long").alias("n_current"))
    )


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str]
) -> DataFrame:
    """Index and status per feature. A feature missing from either side is an error."""
    num = numeric_psi(reference, current, {c: c for c in numeric}).withColumn("type", F.lit("numeric"))
    cat = categorical_psi(reference, current, categorical).withColumn("type", F.lit("categorical"))
    return num.unionByName(cat).withColumn("status", drift_status(F.col("psi")))


def prediction_drift(reference: DataFrame, current: DataFrame, label: str = "days_late") -> DataFrame:
    """Is the output distribution moving? Predictions against training labels."""
    psi = numeric_psi(reference, current, {"prediction": label}, {"prediction": "days_late_pred"})
    p90 = quantile_values(current, "days_late_pred", [0.9])
    return (
        current.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("days_late_pred").alias("mean_pred"),
            F.avg("p_late").alias("mean_p_late"),
        )
        .withColumn("psi", psi.select("psi").scalar())
        .select(
            "psi",
            drift_status(F.col("psi")).alias("status"),
            "n",
            "mean_pred",
            F.lit(p90[0] if p90 else None).cast("double").alias("p90_pred"),
            "mean_p_late",
        )
    )


def live_performance(joined: DataFrame, digits: int | None = None) -> DataFrame:
    """Metrics per model version on backtest rows whose label arrived, with label counts.

    ``joined`` is the delayed-label join. Lags are whole days, so the exact median is small.
    """
    test = joined.filter(F.col("has_label") & (F.col("scoring_mode") == "backtest"))
    metrics = model_metrics(
        test.withColumn("actual", F.col("actual_days_late")), by="model_version", digits=digits
    )
    labels = joined.groupBy("model_version").agg(
        F.count_if(F.col("has_label") & (F.col("scoring_mode") == "backtest")).alias("n_labelled"),
        F.count_if(~F.col("has_label")).alias("n_awaiting_label"),
        F.percentile("label_lag_days", F.lit(0.5)).alias("median_label_lag_days"),
    )
    # One row per model version on both sides.
    return metrics.join(labels, "model_version").drop("n")


def label_lag(joined: DataFrame) -> DataFrame:
    """How long labels take to arrive."""
    lag = F.col("label_lag_days")
    cuts = F.percentile(lag, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return joined.filter("has_label").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(lag).alias("mean"),
        F.stddev(lag).alias("std"),
        F.min(lag).alias("min"),
        cuts[0].alias("q25"),
        cuts[1].alias("q50"),
        cuts[2].alias("q75"),
        F.max(lag).alias("max"),
    )


DELTA_METRICS = ["mae", "rmse", "bias", "within_3d", "pi_coverage", "late_auc"]


def metric_delta(
    at_training: DataFrame, live: DataFrame, metrics: list[str] = DELTA_METRICS
) -> DataFrame:
    """Training and live value of each metric with their difference (two one-row inputs)."""

    def tall(row: DataFrame, name: str) -> DataFrame:
        have = [m for m in metrics if m in row.columns]
        pairs = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in have]
        )
        return row.select(F.inline(pairs))

    return (
        tall(at_training, "at_training")
        .join(tall(live, "on_delayed_labels"), "metric", "full")
        .withColumn("delta", F.col("on_delayed_labels") - F.col("at_training"))
    )


def late_rate_gap(outcomes: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predicted late rate of the open book against the closed base rate."""
    base = scalar_row(
        outcomes.filter("is_open = 0").agg(F.avg((F.col("days_late") > 0).cast("double")).alias("r"))
    )["r"]
    return predictions.agg(
        F.avg((F.col("days_late_pred") > 0).cast("double")).alias("predicted_late_rate"),
        F.avg("days_late_pred").alias("mean_pred"),
        F.avg(F.col("days_late_upper") - F.col("days_late_lower")).alias("mean_width"),
    ).select(
        base.alias("historical_late_rate"),
        "predicted_late_rate",
        (F.col("predicted_late_rate") - base).alias("gap"),
        "mean_pred",
        "mean_width",
    )

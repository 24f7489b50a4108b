"""Fitted models that serve: saved, recorded, and found again through the run table.

``publish`` saves a model below the tables' root and appends its full record: parameters, cold-start
values, fold cutoff, the eleven error metrics with AUC and median, the value of its ranking,
and where it lies. ``serving`` reads the champion's row and loads that very model; scoring takes the
cutoff and the cold-start values from the record, not from data seen later.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import ModelParams, ScoringRun
from ..schemas import FEATURE_COLS
from ..session import materialize
from ..sources.tables import Tables
from . import decision, evaluation, features, history, outcomes
from .models import LatenessModel, champion, run_record

RUNS = "model_runs"


@dataclass(frozen=True)
class Serving:
    """A loaded model and what its record says."""

    model: LatenessModel
    run_id: str
    version: str
    defaults: dict
    cutoff: dt.date

    def score(self, rows: DataFrame, paid: DataFrame, scope: str, scored_at: str) -> DataFrame:
        """Prediction-log rows for the open book, the backtest window or both. ``paid`` are all
        payments known at scoring time."""
        chosen = outcomes.scoring_scope(rows, scope, F.lit(self.cutoff))
        state = history.history_before(chosen, paid, self.defaults)
        scored = self.model.predict(features.invoice_features(state))
        return decision.prediction_log(scored, ScoringRun(self.version, scored_at, "boosted", self.run_id))


def metrics_of(model: LatenessModel, test: DataFrame) -> DataFrame:
    """One row with the error metrics and the value of the ranking on a hold-out."""
    kept = ["invoice_id", "invoice_amount", "cust_std_days_late", "days_late_pred", "days_late_lower", "days_late_upper"]
    # Stored: the metrics pass over the predictions many times, the trees are walked once.
    scored = materialize(model.predict(test).select(*kept, F.col("days_late").alias("actual")), "scored")
    errors, value = evaluation.model_metrics(scored), evaluation.business_metrics(scored)
    rows = [df.select(*[F.col(c).cast("double").alias(c) for c, t in df.dtypes if t != "string"]) for df in (errors, value)]
    return rows[0].withColumns({c: rows[1].select(c).scalar() for c in rows[1].columns})


def publish(
    tables: Tables,
    model: LatenessModel,
    run_id: str,
    version: str,
    cutoff: dt.date,
    metrics: DataFrame,
    p: ModelParams = ModelParams(),
    is_champion: bool = True,
) -> DataFrame:
    """Save the model, then record it: a record never points at a model that is not there."""
    path = f"models/{run_id}"
    model.save(tables.path(path))
    params = {"trees": p.trees, "depth": p.depth, "learning_rate": p.learning_rate, "features": len(FEATURE_COLS)}
    record = run_record(run_id, version, params, model.defaults, str(cutoff), metrics, is_champion)
    return tables.append(record.withColumn("model_path", F.lit(path)), RUNS, "created_at")


def serving(tables: Tables, where: Column | None = None) -> Serving:
    """The champion's model (among the runs ``where``)."""
    runs = tables.log(RUNS)
    row = champion(runs if where is None else runs.filter(where)).first()
    if row is None:
        raise LookupError("no champion among the model runs")
    model = LatenessModel.load(tables.spark, tables.path(row.model_path))
    defaults = {k.removeprefix("default_"): float(v) for k, v in row.defaults.items()}
    return Serving(model, row.run_id, row.model_version, defaults, row.cutoff_date)

"""Queries on stored versions and on the model that serves. Predictions have no SQL form: what the
rows must satisfy is stated in the check SQL, beside the rows it can count."""

from pyspark.sql import functions as F

from ..operators import decision, features, guards, history, model_store, models
from ..params import ModelParams
from ..session import materialize, new_folder
from ..sources import testdata
from ..sources.versioned import VersionedTables
from . import stages
from .history_queries import GOLD_OUT
from .registry import query, tidy
from .sqlkit import out

PARAMS = ModelParams()


@query("versioned_gold", f"SELECT {out(GOLD_OUT)}, CAST(2 AS BIGINT) AS versions, true AS old_readable FROM gold")
def versioned_gold(spark, root):
    """Gold refreshed twice: the first version, of the early payments, stays readable by number."""
    tables = VersionedTables(spark, new_folder(spark, "versioned"))
    paid = stages.closed(spark, root)
    early = tables.refresh(history.gold_customer(paid.filter(F.col("clear_date") < stages.cutoff_date(spark, root))), "gold")
    tables.refresh(history.gold_customer(paid), "gold")
    n_old, n_early = (df.agg(F.count(F.lit(1))).scalar() for df in (tables.scan("gold", 1), early))
    versions = tables.versions("gold").agg(F.count(F.lit(1))).scalar()
    return tidy(tables.scan("gold").withColumns({"versions": versions, "old_readable": n_old == n_early}))


_SERVED: dict[tuple[str, str], VersionedTables] = {}


def _served(spark, root) -> VersionedTables:
    """The run table with a fitted champion and an earlier challenger; fitted once a session."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _SERVED:
        tables = VersionedTables(spark, new_folder(spark, "serving"))
        f = stages.Folds(spark, root, with_customer=True)
        codes = f.encoders()
        train, test = f.split(materialize(features.invoice_features(f.state(f.rows)), "folds"))
        model = models.fit_bundle(materialize(features.encode(train, codes), "matrix"), codes, f.defaults, PARAMS)
        cutoff = features.cutoff(stages.closed(spark, root)).first()["cutoff_date"]
        metrics = materialize(model_store.metrics_of(model, test), "metrics")
        model_store.publish(tables, model, "run-1", "1", cutoff, metrics, PARAMS)
        later = metrics.withColumn("mae", F.col("mae") + 1)
        model_store.publish(tables, model, "run-2", "2", cutoff, later, PARAMS, is_champion=False)
        _SERVED[key] = tables
    return _SERVED[key]


@query(
    "model_record",
    """SELECT 'run-1' AS run_id, '1' AS model_version, min(posting_date) AS cutoff_date, CAST(count(*) AS BIGINT) AS n_test,
      true AS auc_known, true AS median_known, true AS value_known FROM folded WHERE fold = 'test'""",
)
def model_record(spark, root):
    """The champion's record: cutoff, and metrics with AUC, median and the value of the ranking."""
    row = models.champion(_served(spark, root).log(model_store.RUNS))
    metric = lambda name: F.element_at("metrics", name)
    return row.select(
        "run_id",
        "model_version",
        "cutoff_date",
        metric("n").cast("long").alias("n_test"),
        metric("late_auc").between(0, 1).alias("auc_known"),
        (metric("median_ae") >= 0).alias("median_known"),
        metric("ev_decision_engine").isNotNull().alias("value_known"),
    )


@query(
    "model_log",
    """SELECT scoring_mode, CAST(count(*) AS BIGINT) AS n, '1' AS model_version, true AS ordered, true AS likely, true AS cold_from_record
    FROM (SELECT 'open' AS scoring_mode FROM ledger WHERE is_open = 1
      UNION ALL SELECT 'backtest' FROM folded WHERE fold = 'test') s GROUP BY 1""",
)
def model_log(spark, root):
    """The champion, loaded through its record, scores the open book and the backtest window."""
    tables = _served(spark, root)
    served = model_store.serving(tables)
    rows = testdata.ledger(spark, root)
    scored = served.score(rows, stages.closed(spark, root), "both", "2024-03-01 06:00:00")
    log = VersionedTables(spark, new_folder(spark, "log")).append(scored, "prediction_log", "scored_at")
    first_paid = stages.closed(spark, root).groupBy("customer_id").agg(F.min("clear_date").alias("_first"))
    cold = F.col("_first").isNull() | (F.col("_first") >= F.col("posting_date"))
    given = F.col("cust_avg_days_late") == F.lit(served.defaults["cust_avg_days_late"])
    low, mid, high = (F.col(f"days_late_{x}") for x in ("lower", "pred", "upper"))
    return log.join(first_paid, "customer_id", "left").groupBy("scoring_mode").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("model_version").alias("model_version"),
        F.bool_and((low <= high) & mid.isNotNull()).alias("ordered"),
        F.bool_and(F.col("p_late").between(0, 1)).alias("likely"),
        F.bool_and(F.when(cold, given).otherwise(True)).alias("cold_from_record"),
    )


@query(
    "model_queue",
    """SELECT CAST(count(*) AS BIGINT) AS n, true AS ranked, true AS within_capacity, true AS guards_passed FROM ledger WHERE is_open = 1""",
)
def model_queue(spark, root):
    """The call queue from the champion's predictions, stored as a version and read back."""
    tables = _served(spark, root)
    served = model_store.serving(tables)
    scored = served.score(testdata.ledger(spark, root), stages.closed(spark, root), "open", "2024-03-01 06:00:00")
    scored = tables.refresh(scored, "open_predictions")
    queue = tables.refresh(decision.collection_queue(scored, F.lit(stages.QUEUE_DATE).cast("date")), "collection_queue")
    broken = guards.queue(queue, scored, decision.DEFAULTS.daily_capacity).agg(F.sum("violations")).scalar()
    return queue.agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count(F.lit(1)))).alias("ranked"),
        (F.count_if(F.col("action") == "CALL") <= decision.DEFAULTS.daily_capacity).alias("within_capacity"),
        (F.any_value(broken) == 0).alias("guards_passed"),
    )

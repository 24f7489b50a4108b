"""Streaming and model queries. Where draining a stream has one right answer it is checked."""

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..operators import dedupe, evaluation, features, history, models, quantile_boost
from ..operators.decision import order_interval
from ..params import ModelParams
from ..schemas import FEATURE_COLS, RAW_INPUT_COLS
from ..session import materialize, new_folder
from ..sources import testdata
from ..sources.events import ledger_events
from ..sources.tables import Tables
from ..streaming import bronze, stateful
from . import stages
from .registry import query, tidy
from .silver_queries import EVENT_OUT
from .sqlkit import out

PARAMS = ModelParams()
EVENT_NAMES = [t.partition(":")[0] for t in EVENT_OUT.split()]


def _landing(spark, root) -> str:
    """Event files as a producer would drop them."""
    folder = new_folder(spark, "landing")
    testdata.bronze(spark, root).select(*EVENT_NAMES).write.json(folder)
    return folder


@query("bronze_stream", f"SELECT {out(EVENT_OUT)} FROM bronze")
def bronze_stream(spark, root):
    """JSON files to the bronze table; draining twice must not add rows."""
    landing, table, state = _landing(spark, root), new_folder(spark, "bronze"), new_folder(spark, "state")
    for _ in range(2):
        bronze.drain(bronze.read_events(spark, landing), table, state)
    return tidy(spark.read.parquet(table).select(*EVENT_NAMES), money="invoice_amount")


@query(
    "stream_progress",
    """SELECT CAST(1 AS BIGINT) AS drain, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS dropped_late FROM bronze
    UNION ALL SELECT 2, 0, 0""",
)
def stream_progress(spark, root):
    """The progress log of two drains of the same files: all events, then none."""
    landing, table, state = _landing(spark, root), new_folder(spark, "bronze"), new_folder(spark, "state")
    log, path = Tables(spark, new_folder(spark, "log")), "stream_progress"
    for number in (1, 2):
        batches = bronze.progress_table(bronze.drain(bronze.read_events(spark, landing), table, state))
        log.append(batches.withColumns({"drain": F.lit(number).cast("long"), "at": F.current_timestamp()}), path, "at")
    batches = log.log(path).groupBy("drain").agg(F.sum("rows").alias("n_rows"), F.sum("dropped_late").alias("dropped_late"))
    both = spark.range(1, 3).select(F.col("id").alias("drain")).join(batches, "drain", "left")
    return tidy(both.fillna(0))


@query("stream_dedupe", "SELECT _event_id, event_type, customer_id FROM deduped")
def stream_dedupe(spark, root):
    landing, table, state = _landing(spark, root), new_folder(spark, "deduped"), new_folder(spark, "state")
    # All files in one batch: the ledger spans years, so no watermark may pass in between.
    stream = stateful.dedupe_stream(bronze.read_events(spark, landing), "4000 days")
    bronze.drain(stream.select("_event_id", "event_type", "customer_id"), table, state)
    return spark.read.parquet(table)


@query(
    "stream_labels",
    "SELECT invoice_id, customer_id, clear_date, CAST(days_late AS BIGINT) AS days_late FROM ledger",
)
def stream_labels(spark, root):
    """All invoices from the stream-stream join, unpaid ones without a label: events far in the future
    take the watermark past every bound. Labels outside the bound come from ``late_labels``."""
    landing, table, late = (new_folder(spark, k) for k in ("landing", "labels", "late"))
    states = new_folder(spark, "state"), new_folder(spark, "state")

    def drop(events):
        # A folder for each type: either side of a join parses its own events only.
        events.write.mode("append").partitionBy("event_type").json(landing)

    def read():
        return bronze.read_events(spark, landing)

    drop(ledger_events(testdata.ledger(spark, root)).select(*EVENT_NAMES))
    with stateful.state_on_disk(spark):
        # Before the closing events: nothing here is ever closed.
        bronze.drain(stateful.late_labels(read(), read()), late, states[1])
        for year in ("2090", "2091"):  # one moves the watermark, the next finds it there
            # What is there comes in one batch, where no watermark drops it. A batch without events follows, finds
            # the watermark moved and empties the state, which no other drain has to load again.
            drop(stateful.closing_events(spark, f"{year}-01-01T00:00:00"))
            labels = stateful.label_stream(read(), read(), delay="4000 days")
            if stateful.past(bronze.drain(labels, table, states[0]), "2070-01-01T00:00:00"):
                break
    rows = spark.read.parquet(table).unionByName(spark.read.parquet(late)).filter(F.col("invoice_id") != stateful.CLOSING)
    one = rows.groupBy("invoice_id", "customer_id").agg(F.max("clear_date").alias("clear_date"), F.max("days_late").alias("days_late"))
    return tidy(one.withColumn("clear_date", F.col("clear_date").cast("date")))


@query(
    "stream_validate",
    """SELECT 'clean' AS kind, NULL AS reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT reason FROM inv_tagged_raw WHERE reason IS NULL) a
    UNION ALL SELECT 'paid', NULL, CAST(count(*) AS BIGINT) FROM pay_tagged_raw WHERE reason IS NULL
    UNION ALL SELECT 'rejected', reason, CAST(count(*) AS BIGINT) FROM
      (SELECT reason FROM inv_tagged_raw UNION ALL SELECT reason FROM pay_tagged_raw) b WHERE reason IS NOT NULL GROUP BY reason""",
)
def stream_validate(spark, root):
    """Validation per micro-batch: clean invoices, clean payments, rejected rows (replays included)."""
    clean, paid, rejected = (new_folder(spark, k) for k in ("clean", "paid", "rejected"))
    stream = bronze.read_events(spark, _landing(spark, root))
    stateful.validate_stream(stream, clean, paid, rejected, new_folder(spark, "state"))
    none = F.lit(None).cast("string").alias("reason")
    kinds = [
        spark.read.parquet(clean).select(F.lit("clean").alias("kind"), none),
        spark.read.parquet(paid).select(F.lit("paid").alias("kind"), none),
        spark.read.parquet(rejected).select(F.lit("rejected").alias("kind"), F.col("_reject_reason").alias("reason")),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_dq",
    """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, CAST(count(*) AS BIGINT) AS n,
      CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS n_missing FROM events GROUP BY 1, 2""",
)
def stream_dq(spark, root):
    """Tumbling day windows over the raw event table."""
    stream = spark.readStream.schema(testdata.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(root)
    # The stored times are UTC without a zone: day windows must not depend on the session's zone.
    utc, here = F.lit("UTC"), F.current_timezone()
    stream = stream.withColumn("ts", F.convert_timezone(utc, here, F.col("ts")).cast("timestamp"))
    path = new_folder(spark, "windows")
    stateful.drain_updates(stateful.window_counts(stream, "ts", "event_type"), path, new_folder(spark, "state"))
    final = dedupe.latest_per_key(spark.read.parquet(path), ["window_start", "event_type"], F.col("batch").desc())
    start = F.convert_timezone(here, utc, F.col("window_start").cast("timestamp_ntz"))
    return tidy(final.drop("batch")).withColumn("window_start", start)


# --- models -----------------------------------------------------------------------


def _fitted(spark, root):
    f = stages.Folds(spark, root, with_customer=True)
    codes = f.encoders()
    # Both folds in one pass: their history is that of the same payments.
    matrix = materialize(features.encode(features.invoice_features(f.state(f.rows)), codes), "matrix")
    return f, codes, *f.split(matrix)


def _score_report(scored):
    rows = scored.withColumn("actual", F.col("days_late"))
    return tidy(evaluation.error_metrics(order_interval(rows)))


@query("gbt_mean")
def gbt_mean(spark, root):
    """Boosted mean model on the chronological hold-out."""
    _, _, train, test = _fitted(spark, root)
    scored = models.fit_mean(train, PARAMS).transform(test)
    mean = F.col("days_late_pred")
    return _score_report(scored.withColumns({"days_late_lower": mean, "days_late_upper": mean}))


@query("leaf_quantiles")
def leaf_quantiles(spark, root):
    """Interval model: coverage of the nominal 80 % interval on the hold-out."""
    _, _, train, test = _fitted(spark, root)
    scored = models.fit_interval(train, PARAMS).transform(test)
    middle = (F.col("days_late_lower") + F.col("days_late_upper")) / 2
    return _score_report(scored.withColumn("days_late_pred", middle))


@query(
    "boosted_interval",
    """SELECT CAST(count(*) AS BIGINT) AS n, true AS covered, true AS lower_covered, true AS upper_covered, true AS reload_same
    FROM folded WHERE fold = 'test'""",
)
def boosted_interval(spark, root):
    """Boosted 10 % and 90 % quantiles on the hold-out. The check states the bands: the nominal 80 %
    within ten points, each end within seven; a reloaded model must predict the same."""
    _, _, train, test = _fitted(spark, root)
    model = quantile_boost.fit_boosted_interval(train, PARAMS)
    path = new_folder(spark, "boosted")
    model.save(spark, path)
    ends = ["days_late_lower", "days_late_upper"]
    rows = test.select("invoice_id", "days_late", *FEATURE_COLS)
    scored = order_interval(model.transform(rows).withColumn("days_late_pred", F.lit(0.0)))
    again = quantile_boost.BoostedInterval.load(spark, path).transform(rows.select("invoice_id", *FEATURE_COLS))
    again = order_interval(again.withColumn("days_late_pred", F.lit(0.0)))
    both = scored.join(again.select("invoice_id", *[F.col(c).alias(f"again_{c}") for c in ends]), "invoice_id")
    late, low, high = F.col("days_late"), F.col("days_late_lower"), F.col("days_late_upper")
    share = lambda c: F.avg(c.cast("double"))
    same = (low == F.col("again_days_late_lower")) & (high == F.col("again_days_late_upper"))
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        share((late >= low) & (late <= high)).between(0.7, 0.9).alias("covered"),
        share(late < low).between(0.03, 0.17).alias("lower_covered"),
        share(late > high).between(0.03, 0.17).alias("upper_covered"),
        F.bool_and(same).alias("reload_same"),
    )


@query("bundle_predict")
def bundle_predict(spark, root):
    """Fit on the training fold, score the open book from raw inputs."""
    f, codes, train, _ = _fitted(spark, root)
    model = models.fit_bundle(train, codes, f.defaults, PARAMS)
    rows = features.invoice_features(stages.open_state(spark, root, with_customer=True, fitted=f))
    scored = model.predict(rows.select("invoice_id", *RAW_INPUT_COLS))
    return tidy(scored.select("invoice_id", "days_late_pred", "days_late_lower", "days_late_upper", "p_late"))


@query("permutation_importance")
def permutation_importance(spark, root):
    _, _, train, test = _fitted(spark, root)
    return tidy(models.permutation_importance(models.fit_mean(train, PARAMS), test))


@query("importance_rollup")
def importance_rollup(spark, root):
    _, _, train, _ = _fitted(spark, root)
    return tidy(models.importance_rollup(models.importances(models.fit_mean(train, PARAMS))))


@query("leakage_experiment")
def leakage_experiment(spark, root):
    """What leaking history is worth: four ways to build features and folds, same model."""
    f = stages.Folds(spark, root, with_customer=True)
    rows = materialize(stages.closed_ledger(spark, root), "closed")
    codes = materialize(features.fit_encoders(rows), "codes")
    mixed = features.random_split(rows)
    mixed_train = mixed.filter("fold = 'train'")

    def leaky(folded, source):
        return history.join_static(folded, history.static_history(source), f.defaults)

    past = features.with_fold(rows, f.cutoff)
    variants = {
        "A. full history, random split": (leaky(mixed, rows), True),
        "B. training history, random split": (leaky(mixed, mixed_train), False),
        "C. leave-one-out history, random split": (history.loo_history(mixed), False),
        "D. past history, time split": (leaky(past, f.train), True),
    }

    def report(name):
        folded, with_interval = variants[name]
        matrix = materialize(features.encode(features.invoice_features(folded), codes), "variant")
        train, test = (matrix.filter(F.col("fold") == k) for k in ("train", "test"))
        scored = models.fit_mean(train, PARAMS).transform(test)
        if with_interval:
            scored = models.fit_interval(train, PARAMS).transform(scored.drop(models.VECTOR))
        else:
            null = F.lit(None).cast("double")
            scored = scored.withColumns({"days_late_lower": null, "days_late_upper": null})
        error = F.col("days_late") - F.col("days_late_pred")
        inside = F.col("days_late").between(F.col("days_late_lower"), F.col("days_late_upper"))
        return scored.agg(
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            (F.avg((F.abs(error) <= 3).cast("double")) * 100).alias("within_3d"),
            (F.avg(inside.cast("double")) * 100).alias("pi_coverage"),
        ).select(F.lit(name).alias("variant"), "*")

    # The variants are fitted side by side, as Spark ML's cross-validation does: a fit is hundreds of short jobs
    # that leave most cores waiting.
    with ThreadPool(len(variants)) as pool:
        reports = pool.map(inheritable_thread_target(spark)(report), variants)
    out_rows = materialize(reports[0].union(reports[1]).union(reports[2]).union(reports[3]), "leakage")
    base = out_rows.filter(F.col("variant").startswith("A.")).select("mae").scalar()
    return tidy(out_rows.withColumn("mae_inflation", F.col("mae") / base))


@query("model_runs")
def model_runs(spark, root):
    """Fit, record, save, load: the reloaded model must predict the same, in order."""
    f, codes, train, test = _fitted(spark, root)
    model = models.fit_bundle(train, codes, f.defaults, PARAMS)
    raw = test.select("invoice_id", "days_late", *RAW_INPUT_COLS)
    scored = materialize(model.predict(raw), "scored")
    tables = Tables(spark, new_folder(spark, "tables"))
    metrics = evaluation.error_metrics(scored.withColumn("actual", F.col("days_late")))
    params = {"trees": PARAMS.trees, "depth": PARAMS.depth, "features": len(FEATURE_COLS)}
    cutoff = str(features.cutoff(stages.closed(spark, root)).first()["cutoff_date"])
    runs = tables.append(
        models.run_record("run-1", "1", params, f.defaults, cutoff, metrics, True), "model_runs", "created_at"
    )
    path = new_folder(spark, "model")
    model.save(path)
    again = models.LatenessModel.load(spark, path).predict(raw)
    keys = ["invoice_id", "days_late_pred", "days_late_lower", "days_late_upper"]
    differs = scored.select(*keys).exceptAll(again.select(*keys)).agg(F.count(F.lit(1))).scalar()
    inverted = scored.agg(F.count_if(F.col("days_late_lower") > F.col("days_late_upper"))).scalar()
    best = models.champion(runs)
    return tidy(
        best.withColumns({"reload_differs": differs, "inverted": inverted}).select(
            "run_id",
            "model_version",
            "cutoff_date",
            F.element_at("metrics", "mae").alias("mae"),
            F.element_at("defaults", "default_cust_avg_days_late").cast("double").alias("default_avg"),
            "reload_differs",
            "inverted",
        )
    )

from pyspark.sql import functions as F

from duesight.operators import dedupe, quality
from duesight.plans.model_queries import EVENT_NAMES
from duesight.schemas import CREATED, PAID
from duesight.sources import testdata
from duesight.streaming import bronze, stateful


def landing(spark, root, folder, part):
    """Half of the events at a time, so that a second drop finds the first one processed."""
    rows = testdata.bronze(spark, root).select(*EVENT_NAMES)
    half = rows.filter(F.pmod(F.xxhash64("_event_id"), F.lit(2)) == part)
    half.write.mode("append").json(folder)
    return half.count()


def test_ingestion_is_incremental_and_exactly_once(spark, root, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    first = landing(spark, root, folder, 0)
    query = bronze.drain(bronze.read_events(spark, folder), table, state)
    assert bronze.progress(query)["rows"] == first
    again = bronze.drain(bronze.read_events(spark, folder), table, state)
    assert bronze.progress(again)["rows"] == 0 and spark.read.parquet(table).count() == first
    second = landing(spark, root, folder, 1)
    bronze.drain(bronze.read_events(spark, folder, files_per_batch=1), table, state)
    rows = spark.read.parquet(table)
    assert rows.count() == first + second
    assert rows.filter("_ingested_at is null or _source_file is null or _ingest_date is null").count() == 0


def test_stream_twins_equal_batch(spark, root, tmp_path):
    folder = str(tmp_path / "landing")
    rows = testdata.bronze(spark, root).select(*EVENT_NAMES)
    rows.write.json(folder)
    stream = stateful.dedupe_stream(bronze.read_events(spark, folder), "4000 days")
    bronze.drain(stream.select("_event_id"), str(tmp_path / "ids"), str(tmp_path / "s1"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    assert ids.count() == ids.distinct().count() == rows.select("_event_id").distinct().count()

    clean, rejected = str(tmp_path / "clean"), str(tmp_path / "rejected")
    paid = str(tmp_path / "paid")
    stateful.validate_stream(bronze.read_events(spark, folder), clean, paid, rejected, str(tmp_path / "s2"))
    good, bad = quality.split(quality.tag_invoices(rows))
    payments, bad_payments = quality.split(quality.tag_payments(rows))
    assert spark.read.parquet(clean).count() == good.count()
    assert spark.read.parquet(paid).count() == payments.count() > 0
    assert spark.read.parquet(rejected).count() == bad.count() + bad_payments.count()


def test_labels_of_unpaid_and_out_of_bound_invoices(spark, tmp_path):
    folder = str(tmp_path / "landing")

    def drop(rows):
        names = "_event_id string, event_type string, invoice_id string, customer_id string, due_date string, clear_date string, event_timestamp string"
        spark.createDataFrame(rows, names).coalesce(1).write.mode("append").json(folder)

    def created(i, day):
        return (f"c{i}", CREATED, i, "k", "2020-02-01", None, f"{day}T00:00:00")

    def paid(i, day):
        return (f"p{i}", PAID, i, None, None, day, f"{day}T00:00:00")

    drop([*[created(i, "2020-01-01") for i in "abcd"], paid("a", "2020-02-03"), paid("b", "2022-01-01"), paid("c", "2019-12-31")])
    for year in (2030, 2031, 2032):
        drop([created(f"m{year}", f"{year}-01-01"), paid(f"n{year}", f"{year}-01-01")])
    read = lambda: bronze.read_events(spark, folder, files_per_batch=1)
    # The first drain takes all files at once; the second finds the watermark beyond the bound.
    bronze.drain(stateful.label_stream(bronze.read_events(spark, folder), bronze.read_events(spark, folder)), str(tmp_path / "l"), str(tmp_path / "s1"))
    drop([created("m2050", "2050-01-01"), paid("n2050", "2050-01-01")])
    bronze.drain(stateful.label_stream(bronze.read_events(spark, folder), bronze.read_events(spark, folder)), str(tmp_path / "l"), str(tmp_path / "s1"))
    got = {(r.invoice_id, r.days_late) for r in spark.read.parquet(str(tmp_path / "l")).collect() if r.invoice_id in "abcd"}
    assert got == {("a", 2), ("b", None), ("c", None), ("d", None)}
    bronze.drain(stateful.late_labels(read(), read()), str(tmp_path / "late"), str(tmp_path / "s2"))
    late = {(r.invoice_id, r.days_late) for r in spark.read.parquet(str(tmp_path / "late")).collect()}
    assert late == {("b", 700), ("c", -32)}


def test_stream_dedupe_keeps_events_without_id(spark, tmp_path):
    folder = str(tmp_path / "landing")
    rows = [(None, CREATED, i, "2020-01-01T00:00:00") for i in ("a", "b", "b")] + [("x", CREATED, "c", "2020-01-01T00:00:00")] * 2
    spark.createDataFrame(rows, "_event_id string, event_type string, invoice_id string, event_timestamp string").write.json(folder)
    stream = stateful.dedupe_stream(bronze.read_events(spark, folder))
    bronze.drain(stream.select("invoice_id"), str(tmp_path / "ids"), str(tmp_path / "s"))
    assert sorted(r.invoice_id for r in spark.read.parquet(str(tmp_path / "ids")).collect()) == ["a", "b", "c"]


def test_window_counts_final_state(spark, root, tmp_path):
    events = testdata.table(spark, root, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "events")
    events.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    counts = stateful.window_counts(stream, "ts", "event_type", delay="60 days")
    stateful.drain_updates(counts, str(tmp_path / "w"), str(tmp_path / "s"))
    final = dedupe.latest_per_key(
        spark.read.parquet(str(tmp_path / "w")), ["window_start", "event_type"], F.col("batch").desc()
    )
    assert final.agg(F.sum("n")).first()[0] == events.count()


def test_rows_dropped_as_too_late_are_counted(spark, tmp_path):
    folder = str(tmp_path / "landing")

    def drop(ids, day):
        rows = [(i, CREATED, i, f"{day}T00:00:00") for i in ids]
        spark.createDataFrame(rows, "_event_id string, event_type string, invoice_id string, event_timestamp string").coalesce(1).write.mode("append").json(folder)

    def drain(delay):
        stream = stateful.dedupe_stream(bronze.read_events(spark, folder), delay).select("invoice_id")
        return bronze.progress_table(bronze.drain(stream, str(tmp_path / delay / "ids"), str(tmp_path / delay / "s")))

    drop("abc", "2023-06-01")
    first = {d: drain(d).collect() for d in ("10 days", "4000 days")}
    assert all(sum(r.rows for r in rows) == 3 and sum(r.dropped_late for r in rows) == 0 for rows in first.values())
    drop("defg", "2020-01-01")  # a backfill of years
    late = {d: drain(d).agg({"dropped_late": "sum", "rows": "sum"}).first() for d in first}
    assert [late[d]["sum(dropped_late)"] for d in first] == [4, 0] and all(r["sum(rows)"] == 4 for r in late.values())
    assert [spark.read.parquet(str(tmp_path / d / "ids")).count() for d in first] == [3, 7]


def test_types_in_folders_and_one_closing_drop_let_unpaid_out(spark, tmp_path):
    """Each side reads the files of its own type, and the batch behind the closing events finds their watermark."""
    folder, table, state = (str(tmp_path / n) for n in ("landing", "labels", "state"))
    cells = [("c1", CREATED, "i1", "2020-01-01"), ("c2", CREATED, "i2", "2020-01-02"), ("p1", PAID, "i1", "2020-01-20")]
    events = spark.createDataFrame(cells, "_event_id string, event_type string, invoice_id string, at string")
    at = F.concat("at", F.lit("T00:00:00")).alias("event_timestamp")

    def drop(rows):
        rows.write.mode("append").partitionBy("event_type").json(folder)

    def drain():
        labels = stateful.label_stream(bronze.read_events(spark, folder), bronze.read_events(spark, folder))
        return bronze.drain(labels, table, state)

    drop(events.select("_event_id", "event_type", "invoice_id", at))
    query = drain()
    assert not stateful.past(query, "2070-01-01T00:00:00")
    assert sum(s["numInputRows"] for s in query.recentProgress) == 3  # not six: no event is read by both sides
    drop(stateful.closing_events(spark, "2090-01-01T00:00:00"))
    assert stateful.past(drain(), "2070-01-01T00:00:00")
    assert {r.invoice_id for r in spark.read.parquet(table).collect()} >= {"i1", "i2"}


def test_labels_of_a_closed_stream_take_two_drains_with_state_on_disk(spark, root, monkeypatch):
    """the state of all invoices is never held as objects, and loaded by one drain only."""
    from duesight.plans import model_queries
    from duesight.sources import testdata

    name, drain, seen = "spark.sql.streaming.stateStore.providerClass", bronze.drain, []
    before = spark.conf.get(name, None)
    monkeypatch.setattr(model_queries.bronze, "drain", lambda *a, **k: seen.append(spark.conf.get(name)) or drain(*a, **k))
    rows, ledger = model_queries.stream_labels(spark, root), testdata.ledger(spark, root)
    names = "invoice_id", "customer_id", "clear_date"
    assert rows.count() == ledger.count() and rows.select(*names).exceptAll(ledger.select(*names)).count() == 0
    assert len(seen) == 2 and all("RocksDB" in x for x in seen) and spark.conf.get(name, None) == before

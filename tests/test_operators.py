"""Operators on small literal frames."""

from datetime import date, datetime

import pytest
from lodestream.functions import scalars as S
from lodestream.operators import changelog, incremental, joins, quality, scd2
from lodestream.operators.schema_guard import Change, IncompatibleSchema, Registry, classify, conform, reconcile
from lodestream.plans import intermediate, marts, serving, staging
from lodestream.session import configured
from lodestream.sources import raw, sinks
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "id string, v int, _op string, _lsn long, _kafka_offset long, _kafka_partition int, _ingested_at timestamp, _source_ts timestamp"
AT = datetime(2025, 3, 1, 9)


def log(spark, *rows):
    return spark.createDataFrame(rows, LOG)


def one(df):
    return [tuple(r) for r in df.collect()]


def test_latest_prefers_changes_and_drops_deletes(spark):
    df = log(
        spark,
        ("a", 1, "r", None, 9, -1, AT, None),
        ("a", 2, "u", 5, 0, 0, AT, AT),
        ("b", 1, "r", None, 1, -1, AT, None),
        ("b", 2, "d", 7, 1, 0, AT, None),
        ("c", 3, "u", 4, 1, 0, AT, None),
        ("c", 4, "u", 4, 1, 0, AT, AT),
    )
    assert sorted(one(changelog.latest(df, "id").select("id", "v"))) == [("a", 2), ("c", 4)]
    assert sorted(one(changelog.latest(df, "id", include_deletes=True).select("id", "v"))) == [("a", 2), ("b", 2), ("c", 4)]
    assert changelog.latest(df.limit(0), "id").count() == 0


def test_same_offset_in_two_partitions_is_no_duplicate(spark):
    df = log(spark, ("a", 1, "c", 1, 7, 0, AT, AT), ("a", 2, "c", 1, 7, 1, AT, AT), ("a", 3, "c", 1, 7, 0, AT, AT))
    assert sorted(one(changelog.dedupe_by_offset(df, ["v"]).select("v"))) == [(2,), (3,)]


def batch(spark, n, start=0, shift=0):
    return spark.range(start, start + n).select(
        F.concat(F.lit("o"), "id").alias("id"),
        ((F.col("id") * 37 + shift) % 100000).cast("int").alias("v"),
        F.when(F.col("id") % 4 == 3, "d").otherwise("u").alias("_op"),
        (F.col("id") + 100000).alias("_lsn"),
        F.col("id").alias("_kafka_offset"),
        (F.col("id") % 3).cast("int").alias("_kafka_partition"),
        (F.lit("2025-03-01 23:59:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("_ingested_at"),
        F.lit(None).cast("timestamp").alias("_source_ts"),
    )


def test_raw_sink_is_idempotent(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 300), path)
    first = sorted(one(sinks.day_checksums(spark, path)))
    sinks.write_batch(batch(spark, 300).orderBy(F.rand(3)), path)
    assert sorted(one(sinks.day_checksums(spark, path))) == first
    sinks.write_batch(batch(spark, 200, 150), path)
    assert spark.read.parquet(path).count() == 350
    sinks.write_batch(batch(spark, 10, shift=1), path)
    assert spark.read.parquet(path).filter("_kafka_offset = 4").first()["v"] == (4 * 37 + 1) % 100000
    days = {r["_ingested_date"]: r["rows"] for r in raw.manifest(spark.read.parquet(path)).collect()}
    assert days == {date(2025, 3, 1): 60, date(2025, 3, 2): 290}
    sinks.drop_day(spark, path, "2025-03-01")
    assert raw.read_day(spark, path, "2025-03-01").count() == 0 and spark.read.parquet(path).count() == 290


@pytest.mark.parametrize(
    "a, b, change",
    [
        ("int", "bigint", Change.WIDENING),
        ("float", "double", Change.WIDENING),
        ("smallint", "int", Change.WIDENING),
        ("bigint", "int", Change.NONE),
        ("int", "string", Change.INCOMPATIBLE),
        ("timestamp", "string", Change.INCOMPATIBLE),
    ],
)
def test_type_changes(spark, a, b, change):
    known, new = (T.StructType.fromDDL(f"id string, x {t}") for t in (a, b))
    assert classify("t", known, new).severity == change


def test_schema_guard(spark, tmp_path):
    known = T.StructType.fromDDL("id string, x int, gone string")
    new = T.StructType.fromDDL("id string, x bigint, fresh date")
    verdict = classify("t", known, new)
    assert verdict.severity == Change.DROPPED and {d.column for d in verdict.differences} == {"x", "gone", "fresh"}
    assert reconcile(known, new).simpleString() == "struct<id:string,x:bigint,gone:string,fresh:date>"
    out = conform(spark.createDataFrame([("a", 1)], "id string, x long"), verdict.merged)
    assert one(out) == [("a", 1, None, None)]
    registry = Registry(spark, str(tmp_path / "reg"))
    assert registry.inspect("t", known).accepted
    bad = registry.inspect("t", T.StructType.fromDDL("id string, x string"))
    assert not bad.accepted and registry.halted("t") and registry.known("t") == verdict.merged.__class__.fromDDL("id string, x int, gone string")
    assert "x int -> string" in str(IncompatibleSchema(bad))
    with pytest.raises(RuntimeError):
        registry.inspect("t", known)
    registry.resume("t")
    assert registry.inspect("t", new).accepted and registry.known("t").simpleString().startswith("struct<id:string,x:bigint")


def test_scalars(spark):
    df = spark.createDataFrame([(" Paid ", date(2025, 1, 31), date(2025, 2, 1), 100, "EUR", 0.0)], "s string, a date, b date, c long, ccy string, r double")
    row = df.select(
        S.normalise_order_status(F.col("s")),
        S.month_diff(F.col("a"), F.col("b")),
        S.to_usd_cents(F.col("c"), F.col("ccy"), F.col("r")),
        S.to_usd_cents(F.col("c"), F.lit("USD"), F.col("r")),
        S.days_in_month(F.col("b")),
        S.fiscal_year(F.col("a")),
        S.fiscal_quarter(F.col("a")),
        S.fiscal_month(F.col("b")),
        S.date_key(F.lit("2026-05-11").cast("timestamp")),
    ).first()
    assert tuple(row) == ("completed", 1, None, 100, 28, 2024, 4, 1, "e1fc1478943112a42717cec0f7dacbef")


@pytest.mark.parametrize("local, zone, utc", [("2025-03-09 02:30:00", "America/New_York", "2025-03-09 07:30:00"), ("2025-11-02 01:30:00", "America/New_York", "2025-11-02 05:30:00"), ("2025-06-01 12:00:00", None, "2025-06-01 12:00:00")])
def test_local_time(spark, local, zone, utc):
    df = spark.createDataFrame([(None, local, zone)], "s timestamp, l string, z string")
    assert df.select(S.resolve_utc(F.col("s"), F.col("l"), F.col("z")).cast("string")).first()[0] == utc


def test_refund_lag_counts_calendar_days(spark):
    pay = spark.createDataFrame([("p", 100, datetime(2025, 4, 17, 23, 53), AT)], "payment_id string, amount_cents long, created_at timestamp, _ingested_at timestamp")
    ref = spark.createDataFrame([("p", 40, datetime(2025, 5, 3, 0, 35), datetime(2025, 5, 4))], "payment_id string, refund_amount_cents long, issued_at timestamp, _ingested_at timestamp")
    row = intermediate.payments_with_refunds(pay, ref).first()
    assert row["refund_lag_days"] == 16 and row["net_amount_cents"] == 60 and row["is_partially_refunded"] and row["_ingested_at"] == datetime(2025, 5, 4)


def test_late_refund_lands_in_an_incremental_run(spark, tmp_path):
    """A refund twelve days late makes its payment new, so lookback and upsert bring it in; a second run changes nothing."""
    path = str(tmp_path / "fct")
    pay = spark.createDataFrame([("p", 577, datetime(2025, 3, 1), datetime(2025, 3, 1)), ("q", 10, datetime(2025, 3, 12), datetime(2025, 3, 12))], "payment_id string, amount_cents long, created_at timestamp, _ingested_at timestamp")
    none = spark.createDataFrame([], "payment_id string, refund_amount_cents long, issued_at timestamp, _ingested_at timestamp")
    late = spark.createDataFrame([("p", 577, datetime(2025, 3, 13), datetime(2025, 3, 13))], none.schema)
    build = lambda refunds: lambda target: incremental.lookback(intermediate.payments_with_refunds(pay, refunds), target, days=5)
    incremental.load(spark, path, build(none), "payment_id")
    for _ in range(2):
        got = {r["payment_id"]: r["refunded_amount_cents"] for r in incremental.load(spark, path, build(late), "payment_id").collect()}
        assert got == {"p": 577, "q": 0}
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        incremental.load(spark, path, build(late), "payment_id", mode="append")


def test_snapshot_is_stable_and_closes_versions(spark):
    schema = "id string, country string, updated_at timestamp"
    a = spark.createDataFrame([("x", "DE", datetime(2025, 1, 1)), ("y", "FR", datetime(2025, 1, 1)), ("z", "US", datetime(2025, 1, 1))], schema)
    b = spark.createDataFrame([("x", "EG", datetime(2025, 2, 1)), ("z", "US", datetime(2025, 1, 1)), ("n", "GB", datetime(2025, 2, 2))], schema)
    h = scd2.snapshot(None, a, "id", "updated_at", datetime(2025, 1, 5))
    h2 = scd2.snapshot(h, b, "id", "updated_at", datetime(2025, 2, 5))
    want = [("n", "GB", None), ("x", "DE", datetime(2025, 2, 1)), ("x", "EG", None), ("y", "FR", datetime(2025, 2, 5)), ("z", "US", None)]
    assert sorted(one(h2.select("id", "country", "valid_to")), key=repr) == sorted(want, key=repr)
    again = scd2.snapshot(h2, b, "id", "updated_at", datetime(2025, 3, 5))
    assert sorted(one(again), key=repr) == sorted(one(h2), key=repr)
    assert quality.scd2_overlaps_or_gaps(h2, "id").count() == 0
    dim = scd2.dimension(h2.withColumn("created_at", F.lit("2024-12-01").cast("timestamp")), "id", "created_at", "country", "2025-03-01")
    x = {r["version_number"]: r for r in dim.filter("id = 'x'").collect()}
    assert x[1]["valid_from"] == datetime(2024, 12, 1) and x[2]["is_current"] and x[1]["has_relocated"] and x[2]["total_versions"] == 2


def test_interval_days_handles_empty_and_open(spark):
    df = spark.createDataFrame([("a", date(2025, 1, 1), date(2025, 1, 3)), ("b", date(2025, 1, 5), None), ("c", date(2025, 1, 3), date(2025, 1, 3)), ("d", date(2025, 2, 1), None)], "k string, s date, e date")
    out = joins.interval_days(df, "s", "e", F.lit("2025-01-06").cast("date")).groupBy("k").count()
    assert dict(one(out)) == {"a": 2, "b": 2}


EVENTS = "subscription_event_id long, subscription_id string, event_type string, to_plan_id int, occurred_at timestamp, _ingested_at timestamp"


def test_plan_periods_and_mrr(spark):
    rows = [(1, "s", "created", 2, datetime(2025, 1, 1)), (2, "s", "paused", None, datetime(2025, 1, 10)), (3, "s", "resumed", None, datetime(2025, 1, 20)), (4, "s", "cancelled", None, datetime(2025, 2, 3)), (5, "t", "paused", None, datetime(2025, 1, 1))]
    events = spark.createDataFrame([(*r, AT) for r in rows], EVENTS)
    subs = spark.createDataFrame([("s", "c", datetime(2025, 1, 5)), ("t", "d", None)], "subscription_id string, customer_id string, trial_ends_at timestamp")
    periods = intermediate.plan_periods(events, subs)
    got = {r["subscription_event_id"]: r for r in periods.collect()}
    assert set(got) == {1, 2, 3, 4} and got[3]["plan_id"] == 2 and got[1]["revenue_from"] == datetime(2025, 1, 5) and not got[2]["can_earn_revenue"]
    plans = marts.dim_plan(spark.createDataFrame([(2, "basic", 3100, "USD", True, 1)], "plan_id int, plan_code string, monthly_cents long, currency_code string, is_active boolean, price_rank int"))
    mrr = {r["date_day"]: r for r in marts.fct_mrr_daily(periods, plans, "2025-02-28").collect()}
    assert sorted(mrr) == [date(2025, 1, d) for d in [*range(5, 10), *range(20, 32)]] + [date(2025, 2, 1), date(2025, 2, 2)]
    assert mrr[date(2025, 1, 5)]["daily_mrr_cents"] == 100 and abs(mrr[date(2025, 2, 1)]["mrr_cents"] - 3100) < 1e-6
    untried = subs.withColumn("trial_ends_at", F.lit(None).cast("timestamp"))
    assert not intermediate.plan_periods(events, untried).filter("subscription_event_id = 1").first()["can_earn_revenue"]
    assert intermediate.plan_periods(events, untried, earn_without_trial=True).filter("subscription_event_id = 1").first()["can_earn_revenue"]


def test_rolling_over_a_hole(spark):
    spine = spark.range(10).select(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("date_day"))
    actual = spark.createDataFrame([(date(2025, 1, d), 1, 1, 10, 0, 10) for d in (1, 2, 6, 10)], "date_day date, order_count long, customer_count long, gross_revenue_usd_cents long, refunded_usd_cents long, net_revenue_usd_cents long")
    out = {r["date_day"].day: r for r in marts.fct_revenue_rolling(spine, actual).collect()}
    assert out[4]["is_gap_filled_day"] and out[8]["rolling_7d_net_usd_cents"] == 20 and out[8]["wow_change_pct"] is None or out[8]["net_usd_cents_7d_ago"] == 10
    daily = marts.fct_revenue_rolling(spine, actual)
    one_day = serving.rolling_revenue(daily, date(2025, 1, 3), date(2025, 1, 10), 1).collect()
    assert all(r["rolling_net_usd_cents"] == r["net_revenue_usd_cents"] for r in one_day)
    whole, cut = (serving.rolling_revenue(daily, date(2025, 1, 3), date(2025, 1, 10), 7, p).orderBy("date_day").first()["rolling_net_usd_cents"] for p in (False, True))
    assert (whole, cut) == (20, 0)


def test_timeline_pages_join_without_gaps(spark):
    events = spark.createDataFrame([(7, datetime(2025, 1, 1 + k // 3), "order", "x", f"r{k}", k, None, None) for k in range(11)], "customer_id long, occurred_at timestamp, event_category string, event_type string, reference_id string, amount_cents long, currency_code string, detail string")
    seen, cursor, more = [], None, True
    while more:
        page = serving.timeline_page(events, 7, 4, cursor).orderBy(F.desc("occurred_at"), F.desc("reference_id")).collect()
        seen += [r["reference_id"] for r in page]
        more, cursor = page[-1]["has_more"], (str(page[-1]["occurred_at"]), page[-1]["reference_id"])
    assert len(seen) == 11 == len(set(seen))


def test_staging_optional_column_and_customers(spark):
    orders = spark.createDataFrame([("o", "c", None, 5, " eur", "PAID", None, "2025-01-01 00:00:00", AT, "c", 1, 0, 0, AT, AT)], "id string, customer_id string, subscription_id string, amount_cents int, currency string, status string, placed_at timestamp, placed_at_local string, updated_at timestamp, _op string, _lsn long, _kafka_offset long, _kafka_partition int, _ingested_at timestamp, _source_ts timestamp")
    row = staging.orders(orders).first()
    assert (row["order_channel"], row["currency_code"], row["order_status"], row["is_legacy_client_order"]) == ("unknown", "EUR", "completed", True)
    cols = "id string, email string, name string, country_code string, timezone string, created_at timestamp, updated_at timestamp, deleted_at timestamp, _op string, _lsn long, _kafka_offset long, _kafka_partition int, _ingested_at timestamp, _source_ts timestamp"
    row = staging.customers(spark.createDataFrame([("c", " A@B ", " n ", "de", " ", AT, AT, AT, "d", 1, 0, 0, AT, AT)], cols)).first()
    assert (row["email"], row["timezone"], row["has_explicit_timezone"], row["is_deleted"], row["is_hard_deleted"]) == ("a@b", "UTC", False, True, True)


def test_checks(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("b", 3, False)], "k string, n int, is_current boolean")
    assert sorted(one(quality.scd2_one_current(df, "k"))) == [("a", 2), ("b", 0)]
    assert quality.rowcount_matches(df, df).count() == 0 and quality.rowcount_matches(df, df.limit(1)).count() == 1
    assert quality.run_suite({"unique": lambda: quality.unique(df, "k"), "ok": lambda: quality.not_null(df, "k")}) == {"unique": 1, "ok": 0}
    state = spark.createDataFrame([("t", 200_000, 12, False, 10, 3, 3), ("u", 0, 0, True, 901, 4, 3)], "table string, lag_records long, lag_minutes int, halted boolean, seconds_since_flush int, dead_letters long, dead_letters_before long")
    assert sorted(one(quality.alerts(state))) == [("t", "lag"), ("u", "dead_letters_grow"), ("u", "halted"), ("u", "no_flush")]


def test_mixed_int_files_read_with_the_registered_schema(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "p=1"))
    spark.createDataFrame([(1 << 40, "w")], "x long, channel string").write.parquet(str(tmp_path / "p=2"))
    out = raw.raw_source(spark, str(tmp_path), T.StructType.fromDDL("x long, channel string, p int"))
    assert sorted(one(out.select("x", "channel")), key=repr) == [(1, None), (1 << 40, "w")]


def test_ranges():
    today = date(2025, 6, 1)
    assert serving.date_range(None, None, today) == (date(2025, 3, 3), today)
    for bad in ((date(2025, 7, 1), today), (date(2010, 1, 1), today)):
        with pytest.raises(ValueError):
            serving.date_range(*bad, today)


def test_reconciliations(spark):
    days = spark.range(181).select(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("date_day"), F.lit(3000.0).alias("mrr_cents"))
    pay = lambda cents: spark.createDataFrame([(date(2025, m, 3), True, cents) for m in range(1, 7)], "order_date date, is_successful boolean, gross_amount_usd_cents long")
    assert quality.mrr_against_billed(days, pay(3030), "2025-07-01").count() == 0
    assert one(quality.mrr_against_billed(days, pay(4000), "2025-07-01").select("mrr_cents", "billed_cents")) == [(18000.0, 24000.0)]
    other = days.withColumn("mrr_cents", F.col("mrr_cents") * 1.01)
    assert quality.mrr_against_state(days, days, "2025-06-30").count() == 0 and quality.mrr_against_state(days, other, "2025-06-30").count() == 1
    jumped = days.withColumn("mrr_cents", F.when(F.col("date_day") == "2025-03-01", -1.0).when(F.col("date_day") < "2025-02-01", 200_000.0).otherwise(150_000.0 * 0.5))
    assert sorted(one(quality.absurd_mrr(jumped).select("reason"))) == [("jump",), ("negative",)]


def test_state_path_agrees_with_the_event_path(spark):
    """MRR of a subscription that only ever runs is the same by both paths."""
    events = spark.createDataFrame([(1, "s", "created", 2, datetime(2025, 1, 1), AT)], EVENTS)
    about = spark.createDataFrame([("s", "c", 2, "active", datetime(2025, 1, 1), datetime(2025, 1, 5), None)], "subscription_id string, customer_id string, plan_id int, subscription_status string, started_at timestamp, trial_ends_at timestamp, ended_at timestamp")
    plans = marts.dim_plan(spark.createDataFrame([(2, "basic", 1900, "USD", True, 1)], "plan_id int, plan_code string, monthly_cents long, currency_code string, is_active boolean, price_rank int"))
    daily = marts.fct_mrr_daily(intermediate.plan_periods(events, about), plans, "2025-03-10")
    assert quality.mrr_against_state(daily, marts.mrr_from_state(about, plans, "2025-03-10"), "2025-03-10").count() == 0


def test_calendar_and_holidays(spark):
    named = spark.createDataFrame([(date(2025, 1, 1), "New Year", "GLOBAL", True), (date(2025, 7, 4), "Fourth", "US", True)], raw.HOLIDAYS)
    got = {r["date_day"]: r for r in marts.dim_date(spark, "2025-01-15", named, "2025-01-01", "2026-01-01").collect()}
    assert len(got) == 365 and got[date(2025, 1, 1)]["holiday_name"] == "New Year" and not got[date(2025, 7, 4)]["is_holiday"]
    assert got[date(2025, 1, 15)]["is_past"] and not got[date(2025, 1, 16)]["is_past"] and got[date(2025, 1, 5)]["day_of_week"] == 0 and got[date(2025, 1, 1)]["fiscal_year"] == 2024


def test_observations_and_freshness(spark):
    spark.sql("drop table if exists quality_observations")
    quality.observe(spark, "quality_observations", [("drift", "orders", 0.1, None), ("drift", "payments", 0.3, None)], datetime(2025, 3, 1))
    quality.observe(spark, "quality_observations", [("drift", "orders", 0.5, None)], datetime(2025, 1, 1))
    assert one(serving.quality_series(spark.table("quality_observations"), "2025-03-02").select("metric", F.round("value", 3))) == [("drift", 0.2)]
    spark.sql("drop table quality_observations")
    row = serving.data_freshness(spark.createDataFrame([(datetime(2025, 3, 1),)], "_ingested_at timestamp"), "2025-03-02 03:00:00").first()
    assert row["age_hours"] == 27 and row["is_stale"]
    kinds = {r["table"]: r["status"] for r in quality.freshness({"plans": spark.createDataFrame([(AT,)], "_ingested_at timestamp"), "none": spark.createDataFrame([], "_ingested_at timestamp")}, "2025-06-01").collect()}
    assert kinds == {"plans": "exempt", "none": "error"}
    assert one(quality.pass_rate(spark.createDataFrame([(0,), (2,), (0,), (0,)], "failing_rows long"))) == [(4, 3, 0.75)]


def test_cohorts_leave_out_what_cannot_be_seen(spark):
    people = spark.createDataFrame([("a", datetime(2025, 1, 10)), ("b", datetime(2025, 1, 20)), ("c", datetime(2025, 3, 1))], "customer_id string, created_at timestamp")
    periods = spark.createDataFrame([("a", datetime(2025, 1, 10), None, True), ("b", datetime(2025, 1, 20), datetime(2025, 2, 1), True), ("c", datetime(2025, 3, 1), None, False)], "customer_id string, revenue_from timestamp, valid_to timestamp, can_earn_revenue boolean")
    out = marts.fct_cohort_retention(people, periods, "2025-03-15")
    got = {(str(r["cohort_month"]), r["period_number"]): r["retention_pct"] for r in out.collect()}
    assert got == {("2025-01-01", 0): 100.0, ("2025-01-01", 1): 50.0, ("2025-01-01", 2): 50.0}
    cells, young = serving.cohorts(out, date(2025, 1, 1), date(2025, 12, 1), 6)
    assert cells.count() == 3 and one(young) == [(date(2025, 1, 1), 2)]


def test_bulk_rows_rank_below_changes_and_number_without_gaps(spark):
    rows = spark.range(57).select(F.col("id").cast("string").alias("id"))
    tagged = raw.bulk_snapshot(rows, "id", AT, parts=5)
    assert sorted(r["_kafka_offset"] for r in tagged.collect()) == list(range(57))
    assert one(raw.snapshot_manifest({"t": rows}, AT)) == [("t", 57, AT)]
    newer = tagged.limit(1).withColumn("_op", F.lit("u")).withColumn("_lsn", F.lit(1).cast("long")).withColumn("_kafka_offset", F.lit(0).cast("long"))
    assert changelog.latest(tagged.unionByName(newer), "id").filter("_op = 'u'").count() == 1


def test_load_replaces_only_touched_partitions(spark, tmp_path):
    """Days without a key of the batch keep their files; a key that moves to another day leaves its old one."""
    import glob
    import os

    path = str(tmp_path / "fct")
    row = lambda *xs: spark.createDataFrame(xs, "k string, day date, v int")
    days = [date(2025, 1, d) for d in (1, 2, 3)]
    incremental.load(spark, path, lambda t: row(("a", days[0], 1), ("b", days[1], 1), ("c", days[2], 1), ("n", None, 1)), "k", "full", partition_by="day")
    untouched = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/day=2025-01-03/*.parquet")}
    before = untouched()
    for _ in range(2):
        out = incremental.load(spark, path, lambda t: row(("a", days[1], 2), ("d", days[1], 2), ("n", days[0], 2)), "k", partition_by="day")
        assert sorted(one(out.select("k", "day", "v"))) == [("a", days[1], 2), ("b", days[1], 1), ("c", days[2], 1), ("d", days[1], 2), ("n", days[0], 2)]
    assert untouched() == before and len(before) == 1
    assert not os.path.exists(f"{path}/day=__HIVE_DEFAULT_PARTITION__") and sorted(os.listdir(tmp_path)) == ["fct"]


def test_a_swap_that_ended_halfway_is_undone(spark, tmp_path):
    path = str(tmp_path / "fct")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    incremental.load(spark, path, lambda t: df, "k", "full")
    (tmp_path / "fct").rename(tmp_path / "fct.old")
    out = incremental.load(spark, path, lambda t: spark.createDataFrame([("b", 2)], "k string, v int"), "k")
    assert sorted(one(out)) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_asof_join_against_every_pair(spark, grain):
    """Open, empty and overlapping versions, facts before and long after all of them, and null keys and times."""
    import random

    rng, base = random.Random(4), datetime(2024, 1, 1)
    from datetime import timedelta

    at = lambda: base + timedelta(hours=rng.randint(0, 20_000))
    facts = [(i, rng.choice(["x", "y", None]), rng.choice([at(), None, base - timedelta(days=400), base + timedelta(days=4000)])) for i in range(200)]
    versions = []
    for n in range(40):
        begin = at()
        versions.append((rng.choice(["x", "y", "z", None]), n, begin, rng.choice([None, begin, begin + timedelta(days=rng.randint(1, 300))])))
    out = joins.asof_join(spark.createDataFrame(facts, "i long, k string, t timestamp"), spark.createDataFrame(versions, "k string, n int, valid_from timestamp, valid_to timestamp"), "k", "t", columns=["n"], grain=grain)
    want = []
    for i, k, t in facts:
        met = [n for key, n, a, b in versions if k is not None and key == k and t is not None and a <= t and (b is None or t < b)]
        want += [(i, n) for n in met] or [(i, None)]
    assert sorted(one(out.select("i", "n")), key=repr) == sorted(want, key=repr) and out.columns == ["i", "k", "t", "n"]


def test_raw_table_after_a_widening(spark, tmp_path):
    """An accepted widening leaves the table whole: it is read, fingerprinted and written again, across two days and with columns that one batch lacks."""
    configured(spark)
    path, schema = str(tmp_path / "raw"), "_op string, _lsn long, _kafka_offset long, _kafka_partition int, _ingested_at timestamp, _source_ts timestamp"
    land = lambda cols, *rows: sinks.write_batch(spark.createDataFrame(rows, f"{cols}, {schema}"), path)
    land("id string, x int", ("a", 1, "c", 1, 0, 0, AT, None))
    land("id string, x long, channel string", ("b", 1 << 40, "web", "c", 2, 1, 0, datetime(2025, 3, 2), None))
    land("id string, x int", ("a", 7, "u", 3, 0, 0, AT, None), ("c", 3, "c", 4, 2, 0, AT, None))
    assert sorted(one(sinks.read_table(spark, path).select("id", "x", "channel"))) == [("a", 7, None), ("b", 1 << 40, "web"), ("c", 3, None)]
    assert sinks.day_checksums(spark, path).count() == 2 and sinks.day_checksums(spark, path, "2025-03-02").count() == 1
    with pytest.raises(IncompatibleSchema):
        land("id string, x string", ("d", "z", "c", 5, 3, 0, AT, None))


def test_files_of_a_raw_table(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 90), path)
    (f, *_) = glob.glob(f"{path}/*/*/*/*.parquet")
    meta = pq.ParquetFile(f).metadata
    column = next(c for c in (meta.row_group(0).column(k) for k in range(meta.num_columns)) if c.path_in_schema == "_op")
    assert column.compression == "ZSTD" and any("DICTIONARY" in e for e in column.encodings)


def test_registry_keeps_the_old_schema_until_the_new_one_is_whole(spark, tmp_path):
    from lodestream.sources.store import Store

    store = Store(spark, str(tmp_path / "s"))
    assert store.read("t") is None
    store.write("t", "one")
    # A crash before the rename leaves a file aside, one after it leaves two versions.
    (tmp_path / "s" / ".t.new").write_text("half")
    assert store.read("t") == "one"
    (tmp_path / "s" / "_t.2").write_text("two")
    assert store.read("t") == "two"
    store.write("t", "three é")
    assert store.read("t") == "three é" and sorted(p.name for p in (tmp_path / "s").glob("_t.*")) == ["_t.3"]
    store.remove("t")
    assert store.read("t") is None

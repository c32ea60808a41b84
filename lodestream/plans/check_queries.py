"""Queries of the remaining data checks, the suite that keeps failing rows, and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions import scalars as S
from lodestream.operators import incremental, quality
from lodestream.plans import bindings as B
from lodestream.plans import intermediate, marts
from lodestream.plans.registered import longs, query, scratch

_BROKEN = f"""WITH {B.VERSIONS}, broken AS (SELECT customer_id, version_key, valid_from, CASE WHEN version_key % 5 = 0 THEN valid_to + INTERVAL 40 DAY ELSE valid_to END AS valid_to FROM versions)
"""


@query(_BROKEN + "SELECT customer_id, version_key, n AS next_valid_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS n FROM broken) WHERE n IS NOT NULL AND (valid_to IS NULL OR n < valid_to)")
def dq_scd2_overlaps(spark, sf_dir):
    k, end = F.col("version_key"), F.col("valid_to")
    broken = B.versions(spark, sf_dir).withColumn("valid_to", F.when(k % 5 == 0, end + F.expr("interval 40 days")).otherwise(end))
    return quality.scd2_overlaps(broken, "customer_id").select("customer_id", "version_key", B.ntz("next_valid_from"))


@query(f"WITH {B.VERSIONS} SELECT customer_id, count(*) AS current_versions FROM versions WHERE valid_to IS NULL OR version_key % 11 = 0 GROUP BY 1 HAVING count(*) > 1")
def dq_many_current(spark, sf_dir):
    flagged = B.versions(spark, sf_dir).withColumn("is_current", F.col("valid_to").isNull() | (F.col("version_key") % 11 == 0))
    return quality.scd2_many_current(flagged, "customer_id")


@query(
    """SELECT f AS fact_rows, s AS staging_rows, CASE WHEN f > s THEN 'fan-out: a join multiplied rows' ELSE 'loss: a join or filter dropped rows' END AS likely_cause
FROM (SELECT (SELECT count(*) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber < 3) AS f, (SELECT count(*) FROM orders) AS s) WHERE f <> s"""
)
def dq_fact_against_staging(spark, sf_dir):
    """A fact whose join multiplies orders by their first lines."""
    orders = B.read(spark, sf_dir, "orders")
    lines = B.read(spark, sf_dir, "lineitem").filter("l_linenumber < 3").select("l_orderkey")
    return quality.fact_against_staging(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"), orders)


@query(
    """SELECT f AS fact_rows, s AS staging_rows, 'loss: a join or filter dropped rows' AS likely_cause
FROM (SELECT count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS f, count(*) AS s FROM orders) WHERE f <> s"""
)
def dq_fact_lost_rows(spark, sf_dir):
    """A fact whose inner join drops the orders that had nothing returned."""
    orders = B.read(spark, sf_dir, "orders")
    lines = B.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    return quality.fact_against_staging(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"), orders)


@query(
    """WITH daily AS (SELECT CAST(ts AS DATE) AS date_day, round(sum(CASE WHEN event_type IN ('signup', 'purchase') THEN value ELSE -value END) * 100) AS mrr_cents FROM events GROUP BY 1),
stepped AS (SELECT *, lag(mrr_cents) OVER (ORDER BY date_day) AS before_cents FROM daily)
SELECT date_day, mrr_cents, before_cents, CASE WHEN mrr_cents < 0 THEN 'negative' ELSE 'jump' END AS reason FROM stepped
WHERE mrr_cents < 0 OR (before_cents >= 1000 AND abs(mrr_cents - before_cents) > 0.4 * before_cents)"""
)
def dq_mrr_negative(spark, sf_dir):
    """Both branches of the rule over a series of events that add and events that take away."""
    signed = F.when(F.col("event_type").isin("signup", "purchase"), F.col("value")).otherwise(-F.col("value"))
    daily = B.read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date_day")).agg(F.round(F.sum(signed) * 100).alias("mrr_cents"))
    return quality.absurd_mrr(daily, floor=1000).select("date_day", "mrr_cents", "before_cents", "reason")


@query("SELECT o_orderpriority AS value, count(*) AS n_records FROM orders WHERE o_orderkey % 10 < 8 AND o_orderpriority NOT IN ('USD', 'EUR', 'GBP') GROUP BY 1")
def dq_unknown_currency(spark, sf_dir):
    """The vocabulary of currencies over a column that holds priorities for most orders."""
    orders = B.read(spark, sf_dir, "orders")
    named = orders.withColumn("currency_code", F.when(F.col("o_orderkey") % 10 < 8, F.col("o_orderpriority")).otherwise(F.lit("EUR")))
    return quality.unknown_currency(named)


@query(
    f"""WITH {B.RESOLVED} SELECT 'order_status' AS vocabulary, order_status AS value, count(*) AS n_records FROM rated WHERE order_status = 'unknown' GROUP BY 2
UNION ALL SELECT 'event_type', event_type, count(*) FROM events WHERE event_type NOT IN ('created', 'upgraded', 'downgraded', 'paused', 'resumed', 'cancelled', 'expired') GROUP BY 2
UNION ALL SELECT 'payment_status', lower(o_orderpriority), count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY 2"""
)
def dq_vocabularies(spark, sf_dir):
    """Values outside the accepted vocabularies: unknown statuses, event types as the events name them, priorities for statuses."""
    statuses = B.staging.orders(B.raw_orders(spark, sf_dir))
    paid = B.payments(spark, sf_dir).withColumn("payment_status", F.when(F.col("is_pending"), F.col("payment_method")).otherwise(F.col("payment_status")))
    out = None
    for df, name, values in (
        (statuses, "order_status", S.ORDER_STATUSES),
        (B.read(spark, sf_dir, "events"), "event_type", S.EVENT_TYPES),
        (paid, "payment_status", S.PAYMENT_STATUSES),
        (B.subscriptions(spark, sf_dir), "subscription_status", S.SUBSCRIPTION_STATUSES),
    ):
        found = quality.accepted_values(df, name, values).select(F.lit(name).alias("vocabulary"), "value", "n_records")
        out = found if out is None else out.union(found)
    return out


_BILLED = """WITH spine AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders),
actual AS (SELECT CAST(o_orderdate AS DATE) AS date_day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS net FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
daily AS (SELECT date_day, CAST(sum(coalesce(net, 0)) OVER (ORDER BY date_day ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DOUBLE) AS mrr FROM spine LEFT JOIN actual USING (date_day)),
earned AS (SELECT date_trunc('month', date_day) AS m, avg(mrr) AS mrr FROM daily WHERE date_day >= DATE '2001-02-01' AND date_day < DATE '2001-08-01' GROUP BY 1),
billed AS (SELECT date_trunc('month', date_day) AS m, sum(net) AS billed FROM actual WHERE date_day >= DATE '2001-02-01' AND date_day < DATE '2001-08-01' GROUP BY 1),
both_ AS (SELECT sum(mrr) AS mrr_cents, CAST(sum(billed) AS DOUBLE) AS billed_cents FROM earned JOIN billed USING (m))
SELECT round(mrr_cents, 2) AS mrr_cents, billed_cents, round(abs(mrr_cents - billed_cents) / billed_cents, 6) AS drift FROM both_ WHERE abs(mrr_cents - billed_cents) / billed_cents > 0.025"""


@query(_BILLED)
def dq_mrr_against_billed(spark, sf_dir):
    """Rolling four weeks of revenue as MRR against what was billed in six months: months are longer, so it fails."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    paid = B.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date"), F.col("o_custkey").alias("customer_id"), (F.col("o_orderstatus") != "P").alias("is_successful"), cents.alias("gross_amount_usd_cents"), F.lit(0).cast("long").alias("refunded_amount_usd_cents"), cents.alias("net_amount_usd_cents"))
    span = B.read(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    daily = marts.fct_revenue_rolling(span.select(F.explode(F.sequence("a", "b")).alias("date_day")), marts.daily_revenue(paid)).select("date_day", F.col("rolling_28d_net_usd_cents").cast("double").alias("mrr_cents"))
    out = quality.mrr_against_billed(daily, paid, B.AS_OF)
    return out.select(F.round("mrr_cents", 2).alias("mrr_cents"), "billed_cents", F.round("drift", 6).alias("drift"))


@query(
    f"""WITH {B.LIFECYCLE}, last_ AS (SELECT CAST(max(ts) AS DATE) AS day FROM events), days AS (SELECT CAST(unnest(generate_series(day::TIMESTAMP - INTERVAL 6 DAY, day::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM last_),
log AS (SELECT d, sum(CAST(monthly_cents AS DOUBLE)) AS c FROM days JOIN periods p ON can_earn_revenue AND d >= CAST(revenue_from AS DATE) AND (valid_to IS NULL OR d < CAST(valid_to AS DATE)) JOIN plans USING (plan_id) GROUP BY 1),
state AS (SELECT d, sum(CAST(monthly_cents AS DOUBLE)) AS c FROM days JOIN subs s ON s.subscription_id % 5 <> 0 AND d >= CAST(trial_ends_at AS DATE) JOIN plans p ON p.plan_id = s.subscription_id % 4 + 1 GROUP BY 1),
total AS (SELECT sum(log.c) AS a, sum(state.c) AS b FROM log JOIN state USING (d))
SELECT round(a, 3) AS log_cents, round(b, 3) AS state_cents, round(abs(a - b) / b, 6) AS drift FROM total WHERE abs(a - b) / b > 0.005"""
)
def dq_mrr_against_state(spark, sf_dir):
    """MRR of the event log against that of the current subscriptions, over the last seven days."""
    last = str(B.last_event_day(spark, sf_dir))
    plans = B.plans(spark, sf_dir)
    daily = marts.fct_mrr_daily(intermediate.plan_periods(B.lifecycle(spark, sf_dir), B.subscriptions(spark, sf_dir)), plans, last)
    out = quality.mrr_against_state(daily, marts.mrr_from_state(B.subscriptions(spark, sf_dir), plans, last), last)
    return out.select(F.round("log_cents", 3).alias("log_cents"), F.round("state_cents", 3).alias("state_cents"), F.round("drift", 6).alias("drift"))


_SUITE = """SELECT 'orphans' AS name, count(*) AS failing_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)
UNION ALL SELECT 'negative_price', count(*) FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'key_missing', count(*) FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'late_refund', count(*) FROM paid WHERE refund_lag_days > 21"""


def _stored(spark, sf_dir) -> DataFrame:
    """Failing rows of four checks as they are kept, counted by check."""
    store, orders = f"{scratch(spark)}/failures", B.read(spark, sf_dir, "orders")
    people = B.read(spark, sf_dir, "customer").filter("c_nationkey <> 3")
    paid = intermediate.payments_with_refunds(B.payments(spark, sf_dir), B.refunds(spark, sf_dir))
    checks = {
        "orphans": lambda: quality.relationships(orders, "o_custkey", people, "c_custkey"),
        "negative_price": lambda: quality.expression_is_true(orders, "o_totalprice >= 0"),
        "key_missing": lambda: quality.not_null(orders, "o_orderkey"),
        "late_refund": lambda: quality.late_beyond_lookback(paid, "refund_lag_days"),
    }
    quality.run_suite(checks, store)
    out = None
    for name in checks:
        row = spark.read.parquet(f"{store}/{name}").agg(F.count("*").alias("failing_rows")).select(F.lit(name).alias("name"), "failing_rows")
        out = row if out is None else out.union(row)
    return out


@query(f"WITH {B.PAYMENTS} {_SUITE}")
def stored_failures(spark, sf_dir):
    return _stored(spark, sf_dir)


@query(f"WITH {B.PAYMENTS}, results AS ({_SUITE}) SELECT count(*) AS checks, count(*) FILTER (failing_rows = 0) AS passed, round(count(*) FILTER (failing_rows = 0)::DOUBLE / count(*), 4) AS pass_rate FROM results")
def check_pass_rate(spark, sf_dir):
    return quality.pass_rate(_stored(spark, sf_dir))


@query(
    """WITH p AS (SELECT event_type AS t, count(*) * 60 AS lag, 12 AS minutes, event_type = 'error' AS halted, date_diff('second', max(ts), (SELECT max(ts) FROM events)) AS idle, count(*) FILTER (value < 5) AS dead, count(*) FILTER (value < 4) AS dead_before FROM events GROUP BY 1)
SELECT t AS "table", 'lag' AS alert FROM p WHERE lag > 100000 AND minutes >= 10 UNION ALL SELECT t, 'halted' FROM p WHERE halted UNION ALL SELECT t, 'no_flush' FROM p WHERE idle > 900 UNION ALL SELECT t, 'dead_letters_grow' FROM p WHERE dead > dead_before"""
)
def ingest_alerts(spark, sf_dir):
    """Alerts over the state of five feeds: the event types stand for tables, small values for dead letters."""
    events = B.read(spark, sf_dir, "events")
    newest = events.agg(F.max("ts").alias("now"))
    state = events.groupBy(F.col("event_type").alias("table")).agg(
        (F.count("*") * 60).alias("lag_records"), F.lit(12).alias("lag_minutes"), F.max("ts").alias("at"), F.count_if(F.col("value") < 5).alias("dead_letters"), F.count_if(F.col("value") < 4).alias("dead_letters_before")
    )
    seconds = lambda c: F.unix_timestamp(F.date_trunc("second", F.col(c)).cast("timestamp"))
    progress = state.crossJoin(newest).withColumns({"halted": F.col("table") == "error", "seconds_since_flush": seconds("now") - seconds("at")})
    return quality.alerts(progress)


@query(
    f"""WITH {B.PAYMENTS}, seen AS (SELECT max(created_at) AS newest FROM payments WHERE payment_id % 2 = 1)
SELECT p.payment_id, CASE WHEN p.payment_id % 2 = 0 OR p.ingested_at > newest - INTERVAL 21 DAY THEN refunded_amount_cents ELSE 0 END AS refunded_amount_cents FROM paid p, seen"""
)
def late_refund_load(spark, sf_dir):
    """Odd payments loaded before any refund was known, then all payments with their refunds through lookback and upsert: refunds land where the lookback reaches."""
    paid, path = B.payments(spark, sf_dir), f"{scratch(spark)}/payments"
    refunds = B.refunds(spark, sf_dir)
    month = F.date_format("created_at", "yyyy-MM")
    known = intermediate.payments_with_refunds(paid.filter("payment_id % 2 = 1"), refunds.limit(0)).withColumn("month", month)
    incremental.load(spark, path, lambda target: known, "payment_id", "full", partition_by="month")
    now = intermediate.payments_with_refunds(paid, refunds).withColumn("month", month)
    build = lambda target: incremental.lookback(now.filter("payment_id % 2 = 1"), target).unionByName(now.filter("payment_id % 2 = 0"))
    return longs(incremental.load(spark, path, build, "payment_id", partition_by="month").select("payment_id", "refunded_amount_cents"), "payment_id")

"""Queries over the staged tables, the plan dimension, incremental loads and as-of joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions import scalars as S
from lodestream.operators import bitmaps, changelog, incremental, joins, scd2
from lodestream.plans import bindings as B
from lodestream.plans import intermediate, marts, serving
from lodestream.plans.registered import longs, query, scratch
from lodestream.sources import raw

_PEOPLE = f"""people AS (
  SELECT c_custkey AS id, ' ' || c_name || '@Shop.Example' AS email, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_name ELSE c_name END AS name, c_nationkey, c_acctbal,
         CASE c_nationkey % 4 WHEN 0 THEN '{B.ZONES[0]}' WHEN 1 THEN '{B.ZONES[1]}' WHEN 2 THEN '{B.ZONES[2]}' END AS zone,
         TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 300 AS INTEGER)) AS made FROM customer)"""


@query(
    f"""WITH {_PEOPLE} SELECT id AS customer_id, lower(trim(email)) AS email, name AS customer_name, 'N' || (c_nationkey % 10) AS country_code, coalesce(zone, 'UTC') AS timezone, zone IS NOT NULL AS has_explicit_timezone,
  made AS created_at, c_acctbal < 0 AS is_deleted, id % 14 = 0 AS is_hard_deleted FROM people"""
)
def staged_customers(spark, sf_dir):
    """Customers with both sorts of deletion told apart; deleted ones stay."""
    out = B.customers(spark, sf_dir).select("customer_id", "email", "customer_name", "country_code", "timezone", "has_explicit_timezone", B.ntz("created_at"), "is_deleted", "is_hard_deleted")
    return longs(out, "customer_id")


@query(
    """SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, lower(o_orderpriority) AS payment_method, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'succeeded' END AS payment_status,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS processed_at, o_orderstatus <> 'P' AS is_successful, o_orderstatus = 'P' AS is_pending FROM orders"""
)
def staged_payments(spark, sf_dir):
    out = B.payments(spark, sf_dir).select("payment_id", "order_id", "amount_cents", "payment_method", "payment_status", B.ntz("processed_at"), "is_successful", "is_pending")
    return longs(out, "payment_id", "order_id")


@query(
    """SELECT l_orderkey AS payment_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS refund_amount_cents, CASE WHEN l_linestatus = 'F' THEN 'F' END AS refund_reason, l_shipdate AS issued_at, CAST(l_linenumber AS BIGINT) AS ingestion_lag_days, count(*) AS n
FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL"""
)
def staged_refunds(spark, sf_dir):
    out = B.refunds(spark, sf_dir).groupBy("payment_id", "refund_amount_cents", "refund_reason", B.ntz("issued_at"), "ingestion_lag_days").agg(F.count("*").alias("n"))
    return longs(out, "payment_id", "ingestion_lag_days")


_PLANS = f"(VALUES {', '.join(str(p) for p in B.PLANS)}) AS p(plan_id, plan_code, monthly_cents)"


@query(
    f"""SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_code, CAST(monthly_cents AS BIGINT) AS monthly_cents, 'USD' AS currency_code, plan_id <> 1 AS is_active, row_number() OVER (ORDER BY monthly_cents) AS price_rank
FROM {_PLANS} WHERE plan_id IN (SELECT event_id % 4 + 1 FROM events)"""
)
def staged_plans(spark, sf_dir):
    """Plans reduced from a change a event, ranked by price; the retired one stays."""
    out = B.staging.plans(B.raw_plans(spark, sf_dir)).select("plan_id", "plan_code", "monthly_cents", "currency_code", "is_active", "price_rank")
    return longs(out, "plan_id", "price_rank")


@query(
    f"""SELECT md5(CAST(plan_id AS VARCHAR)) AS plan_key, CAST(plan_id AS BIGINT) AS plan_id, plan_code, monthly_cents / 100.0::DOUBLE AS monthly_amount, plan_id <> 1 AS is_active,
  CASE WHEN plan_code = 'legacy_starter' THEN 'legacy' WHEN monthly_cents < 2500 THEN 'entry' WHEN monthly_cents < 10000 THEN 'mid' ELSE 'top' END AS plan_tier
FROM {_PLANS} WHERE plan_id IN (SELECT event_id % 4 + 1 FROM events)"""
)
def plan_dimension(spark, sf_dir):
    return longs(B.plans(spark, sf_dir).select("plan_key", "plan_id", "plan_code", "monthly_amount", "is_active", "plan_tier"), "plan_id")


@query(
    """SELECT user_id AS subscription_id, user_id AS customer_id, user_id % 4 + 1 AS plan_id, CASE WHEN user_id % 5 = 0 THEN 'trialing' ELSE 'active' END AS subscription_status,
  min(ts) AS started_at, TRUE AS is_live, user_id % 5 = 0 AS is_trialing FROM events GROUP BY user_id"""
)
def staged_subscriptions(spark, sf_dir):
    out = B.subscriptions(spark, sf_dir).select("subscription_id", "customer_id", "plan_id", "subscription_status", B.ntz("started_at"), "is_live", "is_trialing")
    return longs(out, "subscription_id", "customer_id", "plan_id")


@query(
    """SELECT event_id AS subscription_event_id, user_id AS subscription_id, CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'upgraded' WHEN 'view' THEN 'resumed' WHEN 'click' THEN 'paused' ELSE 'cancelled' END AS event_type,
  CASE WHEN event_type IN ('purchase', 'error') THEN event_id % 3 + 1 END AS from_plan_id, CASE WHEN event_type IN ('signup', 'purchase') THEN event_id % 4 + 1 END AS to_plan_id, ts AS occurred_at,
  event_type IN ('signup', 'view') AS starts_revenue, event_type IN ('error', 'click') AS stops_revenue, event_type = 'purchase' AS changes_revenue FROM events"""
)
def staged_subscription_events(spark, sf_dir):
    out = B.lifecycle(spark, sf_dir).select("subscription_event_id", "subscription_id", "event_type", "from_plan_id", "to_plan_id", B.ntz("occurred_at"), "starts_revenue", "stops_revenue", "changes_revenue")
    return longs(out, "subscription_id", "from_plan_id", "to_plan_id")


@query(
    """SELECT o_orderkey, md5(o_custkey || '-' || coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, '_null_')) AS customer_priority_key, md5(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS date_key FROM orders"""
)
def surrogate_keys(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders")
    some = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return orders.select("o_orderkey", S.surrogate_key(F.col("o_custkey"), some).alias("customer_priority_key"), S.date_key(F.col("o_orderdate")).alias("date_key"))


@query(
    f"""WITH {B.VERSIONS} SELECT o_orderkey, o_custkey AS customer_id, version_key FROM orders LEFT JOIN (SELECT * FROM versions WHERE valid_to IS NULL) v ON o_custkey = v.customer_id"""
)
def current_version_join(spark, sf_dir):
    """Each order with its customer's version of today, whatever held when it was placed."""
    orders = B.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    now = B.versions(spark, sf_dir).withColumn("is_current", F.col("valid_to").isNull())
    return joins.current_join(orders, now, "customer_id", ["version_key"]).select("o_orderkey", "customer_id", "version_key")


@query(
    """WITH looked AS (SELECT c_custkey AS id, 'n' || (c_nationkey % 10) AS country_code, TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 300 AS INTEGER)) AS made FROM customer)
SELECT id, country_code, made AS valid_from, CASE WHEN id % 9 = 0 THEN TIMESTAMP '2001-08-02' WHEN id % 4 = 0 THEN made + INTERVAL 700 DAY END AS valid_to FROM looked
UNION ALL SELECT id, country_code || 'x', made + INTERVAL 700 DAY, NULL FROM looked WHERE id % 4 = 0 AND id % 9 <> 0"""
)
def customer_snapshot(spark, sf_dir):
    """Customers looked at twice: every fourth moved between the looks, every ninth is gone; a third look like the second changes nothing."""
    first = B.raw_customers(spark, sf_dir).filter("_op = 'r'").select("id", "country_code", "updated_at")
    moved = F.col("id") % 4 == 0
    second = first.filter("id % 9 <> 0").withColumns({"country_code": F.when(moved, F.concat("country_code", F.lit("x"))).otherwise(F.col("country_code")), "updated_at": F.when(moved, F.col("updated_at") + F.expr("interval 700 days")).otherwise(F.col("updated_at"))})
    look = lambda history, now: scd2.snapshot(history, now, "id", "updated_at", B.AS_OF)
    out = look(look(look(None, first), second), second)
    return out.select("id", "country_code", B.ntz("valid_from"), B.ntz("valid_to"))


# --- loads --------------------------------------------------------------------------------------

_TOTALS = """SELECT user_id, strftime(min(ts), '%Y-%m-%d') AS first_day, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY user_id"""


def _loaded(spark, sf_dir, mode: str, indexed: bool = False) -> DataFrame:
    """User totals by first day, loaded twice: from the events of even users' first half, then of whoever has an event in the later half."""
    events = B.read(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit(low + (high - low) / 2).cast("timestamp_ntz")
    totals = lambda df: df.groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"), F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    path = f"{scratch(spark)}/totals"
    incremental.load(spark, path, lambda target: totals(events.filter(F.col("ts") < half)), "user_id", "full", partition_by="first_day", indexed=indexed)
    late = events.filter(F.col("ts") >= half).select("user_id").distinct()
    build = lambda target: totals(events if mode == "full" else events.join(late, "user_id", "left_semi"))
    return incremental.load(spark, path, build, "user_id", mode, partition_by="first_day", indexed=indexed).select("user_id", F.col("first_day").cast("string"), "n", "cents")


@query(_TOTALS)
def incremental_load(spark, sf_dir):
    """A fact loaded, then loaded again from the keys that changed: only their partitions are replaced, and nothing is lost or doubled."""
    return _loaded(spark, sf_dir, "incremental")


@query(_TOTALS)
def incremental_load_by_index(spark, sf_dir):
    """The same load, which looks its keys up in the index beside the table."""
    return _loaded(spark, sf_dir, "incremental", indexed=True)


@query(_TOTALS)
def full_refresh(spark, sf_dir):
    return _loaded(spark, sf_dir, "full")


@query(
    f"""WITH {B.PAYMENTS} SELECT payment_id, amount_cents, refunded_amount_cents, net_amount_cents FROM paid
WHERE ingested_at > (SELECT max(created_at) FROM payments) - INTERVAL 400 DAY"""
)
def late_refund_recency(spark, sf_dir):
    """Payments that a lookback selects because a refund of theirs came late, beside new ones."""
    paid = intermediate.payments_with_refunds(B.payments(spark, sf_dir), B.refunds(spark, sf_dir))
    out = incremental.lookback(paid, B.payments(spark, sf_dir), days=400)
    return longs(out.select("payment_id", "amount_cents", "refunded_amount_cents", "net_amount_cents"), "payment_id")


# --- cohorts and serving ------------------------------------------------------------------------

_EARNS_DAYS = 45
_COHORTS = f"""WITH people AS (SELECT o_custkey AS customer_id, min(o_orderdate) AS created_at FROM orders GROUP BY 1), last_ AS (SELECT max(o_orderdate) AS day FROM orders),
spread AS (SELECT o_custkey AS customer_id, unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', least(o_orderdate + INTERVAL {_EARNS_DAYS - 1} DAY, (SELECT day FROM last_))), INTERVAL 1 MONTH)) AS m FROM orders WHERE o_orderstatus <> 'P'),
cohort AS (SELECT customer_id, date_trunc('month', created_at) AS c FROM people), sizes AS (SELECT c, count(*) AS cohort_size FROM cohort GROUP BY c),
cells AS (SELECT CAST(c AS DATE) AS cohort_month, date_diff('month', c, m) AS period_number, cohort_size, count(DISTINCT customer_id) AS retained_customers,
  round(count(DISTINCT customer_id) * 100.0::DOUBLE / cohort_size, 2) AS retention_pct, date_diff('month', c, (SELECT day FROM last_)) AS months_observable
  FROM spread JOIN cohort USING (customer_id) JOIN sizes USING (c) WHERE m >= c GROUP BY c, m, cohort_size)
"""


def _cohorts(spark, sf_dir) -> DataFrame:
    """Retention of the orders' customers: an order earns for some weeks."""
    orders = B.read(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    people = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("at").alias("created_at"))
    periods = orders.select(F.col("o_custkey").alias("customer_id"), F.col("at").alias("revenue_from"), (F.col("at") + F.expr(f"interval {_EARNS_DAYS} days")).alias("valid_to"), (F.col("o_orderstatus") != "P").alias("can_earn_revenue"))
    last = orders.agg(F.max("o_orderdate").cast("date")).first()[0]
    return marts.fct_cohort_retention(people, periods, str(last))


_CELLS = ["cohort_month", "period_number", "cohort_size", "retained_customers", "retention_pct", "months_observable"]


@query(_COHORTS + "SELECT * FROM cells")
def cohort_retention_of_orders(spark, sf_dir):
    return longs(_cohorts(spark, sf_dir).select(_CELLS), "period_number", "months_observable")


@query(
    """WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS c FROM orders)
SELECT 'day' AS grain, day AS begins, count(DISTINCT c) AS customers FROM days GROUP BY ALL
UNION ALL SELECT 'week', CAST(date_trunc('week', day) AS DATE), count(DISTINCT c) FROM days GROUP BY ALL
UNION ALL SELECT 'month', CAST(date_trunc('month', day) AS DATE), count(DISTINCT c) FROM days GROUP BY ALL
UNION ALL SELECT 'year', CAST(date_trunc('year', day) AS DATE), count(DISTINCT c) FROM days GROUP BY ALL"""
)
def distinct_customers_rollup(spark, sf_dir):
    """Distinct customers of each day, week, month and year, all from the days' bitmaps as they are kept."""
    path = f"{scratch(spark)}/bitmaps"
    orders = B.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    bitmaps.distinct_bitmaps(orders, ["day"], "o_custkey").write.parquet(path)
    kept, out = spark.read.parquet(path), None
    for grain in ("day", "week", "month", "year"):
        coarse = bitmaps.rolled_up(kept, F.to_date(F.date_trunc(grain, "day")).alias("begins"))
        counts = bitmaps.distinct_counts(coarse, ["begins"], "customers").select(F.lit(grain).alias("grain"), "begins", "customers")
        out = counts if out is None else out.union(counts)
    return out


_ASKED = (date(1995, 6, 1), date(2001, 12, 1), 6)


@query(_COHORTS + "SELECT * FROM cells WHERE cohort_month BETWEEN DATE '1995-06-01' AND DATE '2001-12-01' AND period_number <= 6")
def cohort_cells(spark, sf_dir):
    cells, _ = serving.cohorts(_cohorts(spark, sf_dir), *_ASKED)
    return longs(cells.select(_CELLS), "period_number", "months_observable")


@query(_COHORTS + "SELECT DISTINCT cohort_month, months_observable FROM cells WHERE cohort_month BETWEEN DATE '1995-06-01' AND DATE '2001-12-01' AND months_observable < 60")
def cohorts_too_young(spark, sf_dir):
    """Cohorts that the data is too short for, if five years are asked; a single answer holds 36 months at most."""
    _, young = serving.cohorts(_cohorts(spark, sf_dir), *_ASKED[:2], max_periods=36)
    rest = _cohorts(spark, sf_dir).filter(F.col("cohort_month").between(*map(F.lit, _ASKED[:2])) & F.col("months_observable").between(36, 59)).select("cohort_month", "months_observable").distinct()
    return longs(young.union(rest), "months_observable")


@query(
    f"""WITH {B.PAYMENTS} SELECT max(ingested_at) AS newest, round(date_diff('second', max(ingested_at), TIMESTAMP '{B.AS_OF}') / 3600.0, 4) AS age_hours, date_diff('second', max(ingested_at), TIMESTAMP '{B.AS_OF}') / 3600.0 > 26 AS is_stale FROM paid"""
)
def payment_freshness(spark, sf_dir):
    paid = intermediate.payments_with_refunds(B.payments(spark, sf_dir), B.refunds(spark, sf_dir))
    out = serving.data_freshness(paid, B.AS_OF)
    return out.select(B.ntz("newest"), F.round("age_hours", 4).alias("age_hours"), "is_stale")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def newest_orders(spark, sf_dir):
    return serving.recent(B.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", 20, tie="o_orderkey")


@query("SELECT (SELECT count(*) > 0 FROM orders WHERE o_custkey = 7) AS has_7, (SELECT count(*) > 0 FROM orders WHERE o_custkey = -1) AS has_none")
def customer_probe(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"))
    found = [serving.customer_exists(orders, k) for k in (7, -1)]
    return orders.limit(1).select(F.lit(found[0]).alias("has_7"), F.lit(found[1]).alias("has_none"))


@query(
    """WITH log AS (SELECT o_orderkey AS id, o_orderstatus AS state FROM orders) SELECT id, CASE WHEN id % 3 = 0 THEN 'changed' ELSE state END AS state, CASE WHEN id % 3 = 0 THEN 'u' ELSE 'r' END AS op FROM log WHERE id % 15 <> 0"""
)
def bulk_then_stream(spark, sf_dir):
    """A snapshot and the changes that came while it was taken, in one log: every change beats every snapshot row."""
    orders = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    bulk = raw.bulk_snapshot(orders, "id", B.AS_OF)
    # Older by every clock than the snapshot, and still newer by its sequence.
    changes = orders.filter("id % 3 = 0").select("id", F.lit("changed").alias("state"), F.when(F.col("id") % 15 == 0, "d").otherwise("u").alias("_op"), F.lit(1).cast("long").alias("_lsn"), F.lit(0).cast("long").alias("_kafka_offset"), F.lit(0).alias("_kafka_partition"), F.lit("1990-01-01").cast("timestamp").alias("_ingested_at"), F.lit("1990-01-01").cast("timestamp").alias("_source_ts"))
    return changelog.latest(bulk.unionByName(changes), "id").select("id", "state", F.col("_op").alias("op"))

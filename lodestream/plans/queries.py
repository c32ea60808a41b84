"""Registered queries over the given tables, each with its SQL twin where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import scalars as S
from lodestream.operators import changelog, incremental, joins, quality, scd2
from lodestream.operators.windows import following
from lodestream.plans import bindings as B
from lodestream.plans import intermediate, marts, serving, staging, stored_timeline
from lodestream.plans.registered import ORACLE_SQL, QUERIES, longs, query, scratch

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


# --- change log ---------------------------------------------------------------------------------

_LOG_COLUMNS = ["id", "event_id", "_op", "_kafka_offset", "_kafka_partition", "value"]
_LATEST = f"""WITH {B.CHANGE_LOG}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(_lsn, 0) DESC, _source_ts DESC NULLS LAST, _kafka_partition DESC, _kafka_offset DESC) AS n FROM change_log)
SELECT id, event_id, _op, _kafka_offset, _kafka_partition, value FROM ranked WHERE n = 1"""


@query(_LATEST + " AND _op <> 'd'")
def cdc_latest(spark, sf_dir):
    return longs(changelog.latest(B.change_log(spark, sf_dir), "id").select(_LOG_COLUMNS), "_kafka_partition")


@query(_LATEST)
def cdc_latest_with_deletes(spark, sf_dir):
    return longs(changelog.latest(B.change_log(spark, sf_dir), "id", include_deletes=True).select(_LOG_COLUMNS), "_kafka_partition")


def _delivered(spark, sf_dir) -> DataFrame:
    # Six events share an offset: later events are later deliveries of it.
    return B.change_log(spark, sf_dir).withColumn("_kafka_offset", F.floor(F.col("event_id") / 6).cast("long"))


@query(
    f"""WITH {B.CHANGE_LOG}, delivered AS (SELECT * REPLACE (event_id // 6 AS _kafka_offset) FROM change_log)
SELECT _kafka_partition, _kafka_offset, event_id, value FROM delivered
QUALIFY row_number() OVER (PARTITION BY _kafka_partition, _kafka_offset ORDER BY event_id DESC) = 1"""
)
def offset_dedupe_last_wins(spark, sf_dir):
    out = changelog.dedupe_by_offset(_delivered(spark, sf_dir), ["event_id"])
    return longs(out.select("_kafka_partition", "_kafka_offset", "event_id", "value"), "_kafka_partition")


@query(
    f"""WITH {B.CHANGE_LOG}, both_ AS (
  SELECT _kafka_partition, _kafka_offset, event_id, value, 0 AS incoming FROM change_log WHERE event_id % 4 < 3
  UNION ALL SELECT _kafka_partition, _kafka_offset, event_id, value + 1, 1 FROM change_log WHERE event_id % 4 > 1)
SELECT _kafka_partition, _kafka_offset, event_id, value FROM both_
QUALIFY row_number() OVER (PARTITION BY _kafka_partition, _kafka_offset ORDER BY incoming DESC) = 1"""
)
def union_by_offset(spark, sf_dir):
    log = B.change_log(spark, sf_dir)
    incoming = log.filter("event_id % 4 > 1").withColumn("value", F.col("value") + 1)
    out = changelog.union_by_offset(log.filter("event_id % 4 < 3"), incoming)
    return longs(out.select("_kafka_partition", "_kafka_offset", "event_id", "value"), "_kafka_partition")


# --- rules --------------------------------------------------------------------------------------


@query(
    """WITH raw AS (SELECT o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 'paid' WHEN o_orderstatus = 'F' THEN ' Completed' WHEN o_orderkey % 2 = 0 THEN 'canceled' ELSE 'bogus' END AS status FROM orders)
SELECT CASE lower(trim(status)) WHEN 'paid' THEN 'completed' WHEN 'completed' THEN 'completed' WHEN 'canceled' THEN 'cancelled' ELSE 'unknown' END AS order_status,
       trim(status) AS order_status_raw, trim(status) = 'bogus' AS has_unrecognised_status, count(*) AS n
FROM raw GROUP BY ALL"""
)
def normalise_status(spark, sf_dir):
    return staging.orders(B.raw_orders(spark, sf_dir)).groupBy("order_status", "order_status_raw", "has_unrecognised_status").agg(F.count("*").alias("n"))


def _resolved(spark, sf_dir) -> DataFrame:
    # Local times east of UTC may lie in the month before the first order's.
    return intermediate.orders_resolved(staging.orders(B.raw_orders(spark, sf_dir)), B.customers(spark, sf_dir), B.fx_rates(spark, sf_dir, before=1))


@query(
    f"""WITH {B.RESOLVED} SELECT order_id, placed_at_utc, naive AS is_timestamp_inferred, naive AND zone IS NULL AS is_timestamp_low_confidence FROM rated"""
)
def resolve_local_time(spark, sf_dir):
    return _resolved(spark, sf_dir).select(F.col("order_id").cast("long"), B.ntz("placed_at_utc"), "is_timestamp_inferred", "is_timestamp_low_confidence")


@query(
    f"""WITH {B.RESOLVED}
SELECT order_id, currency_code, round(rate_to_usd, 6) AS rate_to_usd, rate_to_usd IS NULL AS is_fx_rate_missing,
       CAST(round(CASE WHEN currency_code = 'USD' THEN amount_cents ELSE amount_cents / rate_to_usd END) AS BIGINT) AS amount_usd_cents
FROM rated"""
)
def fx_to_usd(spark, sf_dir):
    return _resolved(spark, sf_dir).select(F.col("order_id").cast("long"), "currency_code", F.round("rate_to_usd", 6).alias("rate_to_usd"), "is_fx_rate_missing", "amount_usd_cents")


# --- payments, incremental loads ----------------------------------------------------------------


def _paid(spark, sf_dir) -> DataFrame:
    return intermediate.payments_with_refunds(B.payments(spark, sf_dir), B.refunds(spark, sf_dir))


@query(
    f"""WITH {B.PAYMENTS}
SELECT payment_id, amount_cents, refunded_amount_cents, refund_count, net_amount_cents, refunded_amount_cents > 0 AS is_refunded,
       refunded_amount_cents >= amount_cents AS is_fully_refunded, refunded_amount_cents > 0 AND refunded_amount_cents < amount_cents AS is_partially_refunded,
       CAST(refund_lag_days AS BIGINT) AS refund_lag_days, ingested_at FROM paid"""
)
def payments_with_refunds(spark, sf_dir):
    out = _paid(spark, sf_dir).select(
        "payment_id", "amount_cents", "refunded_amount_cents", "refund_count", "net_amount_cents", "is_refunded", "is_fully_refunded", "is_partially_refunded", "refund_lag_days", B.ntz("_ingested_at", "ingested_at")
    )
    return longs(out, "payment_id", "refund_lag_days")


@query(
    """SELECT event_id, user_id, ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 <> 0) - INTERVAL 5 DAY"""
)
def lookback_filter(spark, sf_dir):
    events = B.read(spark, sf_dir, "events").withColumn("_ingested_at", F.col("ts"))
    return incremental.lookback(events, events.filter("event_id % 3 <> 0"), days=5).select("event_id", "user_id", "ts")


@query(
    """WITH cut AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events),
target AS (SELECT user_id, count(*) AS n, max(ts) AS newest FROM events, cut WHERE ts < half GROUP BY user_id),
batch AS (SELECT user_id, count(*) AS n, max(ts) AS newest FROM events, cut WHERE ts >= half AND event_type <> 'view' GROUP BY user_id)
SELECT * FROM target WHERE user_id NOT IN (SELECT user_id FROM batch) UNION ALL SELECT * FROM batch"""
)
def keyed_upsert(spark, sf_dir):
    events = B.read(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    summed = lambda df: df.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("newest"))
    at = F.lit(low + (high - low) / 2).cast("timestamp_ntz")
    return incremental.upsert(summed(events.filter(F.col("ts") < at)), summed(events.filter((F.col("ts") >= at) & (F.col("event_type") != "view"))), "user_id")


_TOTALS = "SELECT l_orderkey AS order_id, count(*) AS n_items, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem"


@query(f"{_TOTALS} GROUP BY l_orderkey")
def touched_key_rebuild(spark, sf_dir):
    """Totals that missed every third line, made whole by rebuilding the touched orders only."""
    items = B.read(spark, sf_dir, "lineitem")
    build = lambda df: df.groupBy(F.col("order_id")).agg(F.count("*").alias("n_items"), F.sum("cents").alias("cents"))
    source = items.select(F.col("l_orderkey").alias("order_id"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), "l_linenumber")
    return incremental.touched_rebuild(build(source.filter("l_linenumber % 3 <> 0")), source.filter("l_linenumber % 3 = 0"), source, "order_id", build)


_MD5 = "CAST(sum(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)) AS VARCHAR)"


@query(f"""SELECT CAST(ts AS DATE) AS day, count(*) AS rows, {_MD5.format("event_id || '|' || event_type || '|' || user_id")} AS fingerprint FROM events GROUP BY ALL""")
def partition_fingerprint(spark, sf_dir):
    """An order-insensitive fingerprint of each day, by the hash that other engines have too."""
    days = B.read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_id", "event_type", "user_id")
    return incremental.fingerprint(days, ["day"], portable=True)


@query(
    f"""WITH totals AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL),
marked AS (SELECT day, count(*) AS rows, {_MD5.format("cents || '|' || event_type || '|' || n")} AS mark FROM totals GROUP BY day)
SELECT day, rows, mark AS before, mark AS after, TRUE AS same FROM marked"""
)
def backfill_proof(spark, sf_dir):
    """The later half of the event totals deleted and rebuilt: fingerprints before and after, by day, with whether they agree."""
    events = B.read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    build = lambda: events.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    low, high = events.agg(F.min("day"), F.max("day")).first()
    again = incremental.backfill(build(), build, "day", str(low + (high - low) / 2), str(high))
    mark = lambda df, name: incremental.fingerprint(df, ["day"], portable=True).withColumnRenamed("fingerprint", name)
    return mark(again, "after").join(mark(build(), "before").drop("rows"), "day").withColumn("same", F.col("before") == F.col("after"))


# --- versions -----------------------------------------------------------------------------------

_LOOK = "SELECT user_id, arg_max(event_type, event_id) AS state, max(ts) AS updated_at FROM events"


@query(
    f"""WITH cut AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half, max(ts) AS last FROM events),
first_ AS ({_LOOK} WHERE ts <= (SELECT half FROM cut) GROUP BY user_id),
second_ AS ({_LOOK} WHERE user_id % 10 <> 0 GROUP BY user_id)
SELECT f.user_id, f.state, f.updated_at AS valid_from,
       CASE WHEN s.user_id IS NULL THEN (SELECT last FROM cut) WHEN s.updated_at > f.updated_at THEN s.updated_at END AS valid_to
FROM first_ f LEFT JOIN second_ s USING (user_id)
UNION ALL
SELECT s.user_id, s.state, s.updated_at, NULL FROM second_ s LEFT JOIN first_ f USING (user_id) WHERE f.user_id IS NULL OR f.updated_at < s.updated_at"""
)
def scd2_versions(spark, sf_dir):
    """Two looks at the users' state; in the second, every tenth user is gone."""
    events = B.read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    look = lambda df: df.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("state"), F.max("ts").alias("updated_at"))
    first = scd2.snapshot(None, look(events.filter(F.col("ts") <= F.lit(low + (high - low) / 2))), "user_id", "updated_at", high)
    out = scd2.snapshot(first, look(events.filter("user_id % 10 <> 0")), "user_id", "updated_at", high)
    return out.select("user_id", "state", B.ntz("valid_from"), B.ntz("valid_to"))


_SCD2_LOG = f"""WITH {B.CHANGE_LOG}, changed AS (
  SELECT *, lag(event_type) OVER w AS before, lag(_op) OVER w AS before_op FROM change_log
  WINDOW w AS (PARTITION BY id ORDER BY _ingested_at, event_id)),
kept AS (SELECT * FROM changed WHERE before_op IS NULL OR event_type IS DISTINCT FROM before OR (_op = 'd') <> (before_op = 'd')),
ended AS (SELECT id, event_type, _op, _ingested_at AS valid_from, lead(_ingested_at) OVER (PARTITION BY id ORDER BY _ingested_at, event_id) AS valid_to FROM kept)
SELECT id, event_type, valid_from, valid_to FROM ended WHERE _op <> 'd'"""


@query(_SCD2_LOG)
def scd2_from_log(spark, sf_dir):
    log = B.change_log(spark, sf_dir)
    out = scd2.versions_from_log(log, "id", ["event_type"], "_ingested_at", ["_ingested_at", "event_id"])
    return out.select("id", "event_type", B.ntz("valid_from"), B.ntz("valid_to"))


def _dimension(spark, sf_dir) -> DataFrame:
    people = B.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    made = B.versions(spark, sf_dir).join(people, "customer_id").withColumn("created_at", F.col("valid_from") - F.expr("interval 30 days")).withColumn("country_code", (F.col("version_key") % 2 + F.col("c_nationkey")).cast("string"))
    return scd2.dimension(made, "customer_id", "created_at", "country_code", B.AS_OF)


@query(
    f"""WITH {B.VERSIONS}, made AS (SELECT v.*, CAST(version_key % 2 + c_nationkey AS VARCHAR) AS country_code FROM versions v JOIN customer ON customer_id = c_custkey),
numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version_number, count(*) OVER (PARTITION BY customer_id) AS total_versions,
  (SELECT count(DISTINCT m.country_code) FROM made m WHERE m.customer_id = made.customer_id) > 1 AS has_relocated FROM made)
SELECT customer_id, version_key, version_number, total_versions, has_relocated, valid_to IS NULL AS is_current,
  CASE WHEN version_number = 1 THEN valid_from - INTERVAL 30 DAY ELSE valid_from END AS valid_from, valid_to,
  CAST(date_diff('day', CASE WHEN version_number = 1 THEN valid_from - INTERVAL 30 DAY ELSE valid_from END, coalesce(valid_to, TIMESTAMP '{B.AS_OF}')) AS BIGINT) AS version_duration_days
FROM numbered"""
)
def customer_dimension(spark, sf_dir):
    out = _dimension(spark, sf_dir).select(
        "customer_id", "version_key", "version_number", "total_versions", "has_relocated", "is_current", B.ntz("valid_from"), B.ntz("valid_to"), "version_duration_days"
    )
    return longs(out, "version_number", "version_duration_days")


_ASOF = f"""WITH {B.VERSIONS}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate, o_custkey AS customer_id, version_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN versions v ON v.customer_id = o_custkey AND l_shipdate >= v.valid_from AND (v.valid_to IS NULL OR l_shipdate < v.valid_to)"""


def _shipped(spark, sf_dir) -> DataFrame:
    items = B.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    owners = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    return items.join(owners, "l_orderkey").withColumn("at", F.col("l_shipdate").cast("timestamp"))


def _owned(out: DataFrame) -> DataFrame:
    return longs(out.select("l_orderkey", "l_linenumber", "l_shipdate", "customer_id", "version_key"), "l_linenumber")


def _last_order(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("timestamp")).first()[0]


@query(_ASOF)
def asof_join(spark, sf_dir):
    # By year: a customer's versions begin on days, so a year has 366 at most, and few of them are repeated.
    return _owned(joins.asof_join(_shipped(spark, sf_dir), B.versions(spark, sf_dir), "customer_id", "at", columns=["version_key"], grain="year", last=_last_order(spark, sf_dir)))


@query(_ASOF)
def asof_join_one_pass(spark, sf_dir):
    """The same rows by one sorted sequence of versions and items, as versions do not overlap."""
    return _owned(joins.asof_carry(_shipped(spark, sf_dir), B.versions(spark, sf_dir), "customer_id", "at", columns=["version_key"]))


@query(_ASOF)
def asof_repaired(spark, sf_dir):
    """The same rows by repair: joined first to versions of which every fifth is missing, then only where those came late."""
    path, last = scratch(spark), _last_order(spark, sf_dir)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    # Repair reads its tables several times: as plans they would be built each time, with all their joins at once.
    versions = stored(B.versions(spark, sf_dir), "versions")
    early = stored(versions.filter("version_key % 5 <> 0").withColumn("valid_to", following("valid_from", "customer_id", ["valid_from"])), "early")
    fact = stored(joins.asof_join(_shipped(spark, sf_dir), early, "customer_id", "at", columns=["version_key"], grain="year", last=last), "fact")
    mended = joins.asof_repair(fact, early, versions, "customer_id", "at", columns=["version_key"], grain="year", last=last)
    return _owned(incremental.upsert(fact, mended, ["l_orderkey", "l_linenumber", "l_shipdate"]))


@query(_SCD2_LOG)
def scd2_late_batches(spark, sf_dir):
    """The same versions from a stored table that got the log in four batches out of order, one of them twice."""
    log, path = B.change_log(spark, sf_dir), f"{scratch(spark)}/versions"
    for part in (2, 0, 3, 1, 0):
        batch = log.filter(F.col("event_id") % 4 == part)
        table = scd2.keep_versions(spark, path, batch, "id", ["event_type"], "_ingested_at", ["_ingested_at", "event_id"], buckets=8)
    return scd2.versions_of(table, "id", ["event_type"], "_ingested_at").select("id", "event_type", B.ntz("valid_from"), B.ntz("valid_to"))


# --- subscriptions ------------------------------------------------------------------------------


def _periods(spark, sf_dir) -> DataFrame:
    return intermediate.plan_periods(B.lifecycle(spark, sf_dir), B.subscriptions(spark, sf_dir))


@query(
    f"""WITH {B.LIFECYCLE}
SELECT subscription_id, subscription_event_id, event_type, revenue_state, CAST(plan_id AS BIGINT) AS plan_id, valid_from, valid_to, valid_to IS NULL AS is_current_interval, revenue_from, can_earn_revenue FROM periods"""
)
def plan_periods(spark, sf_dir):
    out = _periods(spark, sf_dir).select(
        "subscription_id", "subscription_event_id", "event_type", "revenue_state", "plan_id", B.ntz("valid_from"), B.ntz("valid_to"), "is_current_interval", B.ntz("revenue_from"), "can_earn_revenue"
    )
    return longs(out, "subscription_id", "plan_id")


_MRR = f"""WITH {B.LIFECYCLE},
last_ AS (SELECT CAST(max(ts) AS DATE) AS day FROM events),
spread AS (
  SELECT p.*, unnest(generate_series(CAST(revenue_from AS DATE)::TIMESTAMP, least(coalesce(CAST(valid_to AS DATE) - 1, (SELECT day FROM last_)), (SELECT day FROM last_))::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date_day
  FROM periods p WHERE can_earn_revenue),
cents AS (SELECT s.*, t.plan_tier, day(last_day(date_day)) AS days_in_month, CAST(monthly_cents AS DOUBLE) / day(last_day(date_day)) AS c FROM spread s JOIN tiers t USING (plan_id)),
daily AS (
  SELECT date_day, max(days_in_month) AS days_in_month, count(DISTINCT subscription_id) AS active_subscriptions, count(DISTINCT customer_id) AS paying_customers,
         sum(c) AS daily_mrr_cents, sum(c) * max(days_in_month) AS mrr_cents,
         sum(CASE WHEN plan_tier = 'entry' THEN c ELSE 0 END) * max(days_in_month) AS mrr_entry_cents,
         sum(CASE WHEN plan_tier = 'mid' THEN c ELSE 0 END) * max(days_in_month) AS mrr_mid_cents,
         sum(CASE WHEN plan_tier = 'top' THEN c ELSE 0 END) * max(days_in_month) AS mrr_top_cents
  FROM cents GROUP BY date_day),
moved AS (
  SELECT *, mrr_cents - lag(mrr_cents) OVER (ORDER BY date_day) AS mrr_change_cents,
         active_subscriptions - lag(active_subscriptions) OVER (ORDER BY date_day) AS subscription_change FROM daily)
"""


def _mrr(spark, sf_dir) -> DataFrame:
    return marts.fct_mrr_daily(_periods(spark, sf_dir), B.plans(spark, sf_dir), str(B.last_event_day(spark, sf_dir)))


@query(
    _MRR
    + """SELECT date_day, CAST(days_in_month AS BIGINT) AS days_in_month, active_subscriptions, paying_customers, round(daily_mrr_cents, 3) AS daily_mrr_cents, round(mrr_cents, 3) AS mrr_cents,
 round(mrr_entry_cents, 3) AS mrr_entry_cents, round(mrr_mid_cents, 3) AS mrr_mid_cents, round(mrr_top_cents, 3) AS mrr_top_cents, round(mrr_change_cents, 3) + 0.0 AS mrr_change_cents,
 subscription_change, md5(CAST(date_day AS VARCHAR)) AS date_key FROM moved"""
)
def mrr_daily(spark, sf_dir):
    r = lambda c: (F.round(c, 3) + F.lit(0.0)).alias(c)
    out = _mrr(spark, sf_dir).select(
        "date_day", "days_in_month", "active_subscriptions", "paying_customers", *map(r, ("daily_mrr_cents", "mrr_cents", "mrr_entry_cents", "mrr_mid_cents", "mrr_top_cents", "mrr_change_cents")), "subscription_change", "date_key"
    )
    return longs(out, "days_in_month")


@query(
    _MRR
    + """SELECT CAST(date_trunc('week', date_day) AS DATE) AS period, round(avg(mrr_cents), 3) AS mrr_cents, round(sum(mrr_change_cents), 3) + 0.0 AS mrr_change_cents, round(avg(active_subscriptions), 3) AS active_subscriptions
FROM moved GROUP BY 1"""
)
def mrr_by_granularity(spark, sf_dir):
    daily = _mrr(spark, sf_dir)
    low, high = daily.agg(F.min("date_day"), F.max("date_day")).first()
    out = serving.mrr(daily, low, high, "week")
    return out.select("period", *((F.round(c, 3) + F.lit(0.0)).alias(c) for c in ("mrr_cents", "mrr_change_cents", "active_subscriptions")))


@query(
    f"""WITH {B.LIFECYCLE}, last_ AS (SELECT CAST(max(ts) AS DATE) AS day FROM events),
spread AS (
  SELECT customer_id, unnest(generate_series(CAST(revenue_from AS DATE)::TIMESTAMP, least(coalesce(CAST(valid_to AS DATE) - 1, (SELECT day FROM last_)), (SELECT day FROM last_))::TIMESTAMP, INTERVAL 1 DAY)) AS d
  FROM periods WHERE can_earn_revenue),
active AS (SELECT DISTINCT customer_id, date_trunc('month', d) AS m FROM spread),
cohort AS (SELECT customer_id, date_trunc('month', started_at) AS c FROM subs),
sizes AS (SELECT c, count(*) AS cohort_size FROM cohort GROUP BY c)
SELECT CAST(c AS DATE) AS cohort_month, date_diff('month', c, m) AS period_number, cohort_size, count(DISTINCT customer_id) AS retained_customers,
       round(count(DISTINCT customer_id) * 100.0::DOUBLE / cohort_size, 2) AS retention_pct, date_diff('month', c, (SELECT day FROM last_)::TIMESTAMP) AS months_observable
FROM active JOIN cohort USING (customer_id) JOIN sizes USING (c) WHERE m >= c GROUP BY c, m, cohort_size"""
)
def cohort_retention(spark, sf_dir):
    people = B.subscriptions(spark, sf_dir).select("customer_id", F.col("started_at").alias("created_at"))
    out = marts.fct_cohort_retention(people, _periods(spark, sf_dir), str(B.last_event_day(spark, sf_dir)))
    return longs(out.select("cohort_month", "period_number", "cohort_size", "retained_customers", "retention_pct", "months_observable"), "period_number", "months_observable")


@query(
    f"""WITH {B.LIFECYCLE}
SELECT subscription_event_id, event_type, f.plan_code AS from_plan_code, t.plan_code AS to_plan_code, CAST(coalesce(t.monthly_cents, 0) - coalesce(f.monthly_cents, 0) AS BIGINT) AS mrr_delta_cents, CAST(occurred_at AS DATE) AS event_date
FROM lifecycle LEFT JOIN plans f ON from_plan_id = f.plan_id LEFT JOIN plans t ON to_plan_id = t.plan_id"""
)
def subscription_event_deltas(spark, sf_dir):
    subs = B.subscriptions(spark, sf_dir)
    versions = subs.select("customer_id", S.surrogate_key(F.col("customer_id")).alias("customer_key"), F.col("started_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    out = marts.fct_subscription_events(B.lifecycle(spark, sf_dir), subs, B.plans(spark, sf_dir), versions)
    return out.select("subscription_event_id", "event_type", "from_plan_code", "to_plan_code", "mrr_delta_cents", "event_date")


@query(
    _MRR
    + f""", state AS (SELECT CAST(d AS DATE) AS date_day, sum(CAST(monthly_cents AS DOUBLE)) AS mrr_cents
  FROM (SELECT unnest(generate_series((SELECT day FROM last_)::TIMESTAMP - INTERVAL 6 DAY, (SELECT day FROM last_)::TIMESTAMP, INTERVAL 1 DAY)) AS d), subs s, plans p
  WHERE p.plan_id = s.subscription_id % 4 + 1 AND d >= CAST(s.trial_ends_at AS DATE) GROUP BY 1)
SELECT count(*) AS days, round(sum(m.mrr_cents), 3) AS log_cents, round(sum(s.mrr_cents), 3) AS state_cents FROM moved m JOIN state s USING (date_day)"""
)
def mrr_two_path_reconciliation(spark, sf_dir):
    """MRR from the event log beside MRR from a state table, over the last seven days."""
    last = str(B.last_event_day(spark, sf_dir))
    state = B.subscriptions(spark, sf_dir).withColumn("subscription_status", F.lit("active"))
    own = marts.mrr_from_state(state, B.plans(spark, sf_dir), last, days=7)
    both = _mrr(spark, sf_dir).select("date_day", F.col("mrr_cents").alias("log")).join(own, "date_day")
    return both.agg(F.count("*").alias("days"), F.round(F.sum("log"), 3).alias("log_cents"), F.round(F.sum("mrr_cents"), 3).alias("state_cents"))


# --- revenue ------------------------------------------------------------------------------------

_SPINE = "spine AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders)"
_ROLLING = f"""WITH {_SPINE},
actual AS (SELECT CAST(o_orderdate AS DATE) AS date_day, count(*) AS order_count, count(DISTINCT o_custkey) AS customer_count, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS net FROM orders GROUP BY 1),
filled AS (SELECT date_day, coalesce(order_count, 0) AS order_count, coalesce(customer_count, 0) AS customer_count, coalesce(net, 0) AS net, a.date_day IS NULL AS is_gap_filled_day FROM spine LEFT JOIN actual a USING (date_day))
"""


def _revenue(spark, sf_dir) -> DataFrame:
    orders = B.read(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    paid = orders.select(
        F.to_date("o_orderdate").alias("order_date"), F.col("o_custkey").alias("customer_id"), F.lit(True).alias("is_successful"), cents.alias("gross_amount_usd_cents"), F.lit(0).cast("long").alias("refunded_amount_usd_cents"), cents.alias("net_amount_usd_cents")
    )
    span = orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b")).alias("date_day"))
    return marts.fct_revenue_rolling(spine, marts.daily_revenue(paid))


@query(
    _ROLLING
    + """SELECT date_day, order_count, customer_count, net AS net_revenue_usd_cents, is_gap_filled_day, CAST(sum(net) OVER w7 AS BIGINT) AS rolling_7d_net_usd_cents, round(avg(net) OVER w7, 4) AS rolling_7d_avg_net_usd_cents,
  CAST(sum(net) OVER w28 AS BIGINT) AS rolling_28d_net_usd_cents, CAST(sum(order_count) OVER w7 AS BIGINT) AS rolling_7d_order_count, lag(net, 7) OVER (ORDER BY date_day) AS net_usd_cents_7d_ago
FROM filled WINDOW w7 AS (ORDER BY date_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), w28 AS (ORDER BY date_day ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)"""
)
def rolling_revenue(spark, sf_dir):
    return _revenue(spark, sf_dir).select(
        "date_day", "order_count", "customer_count", "net_revenue_usd_cents", "is_gap_filled_day", "rolling_7d_net_usd_cents", F.round("rolling_7d_avg_net_usd_cents", 4).alias("rolling_7d_avg_net_usd_cents"), "rolling_28d_net_usd_cents", "rolling_7d_order_count", "net_usd_cents_7d_ago"
    )


@query(
    _ROLLING
    + """, windowed AS (SELECT date_day, net AS net_revenue_usd_cents, is_gap_filled_day, CAST(sum(net) OVER (ORDER BY date_day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_net_usd_cents FROM filled)
SELECT * FROM windowed WHERE date_day BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"""
)
def rolling_custom_window(spark, sf_dir):
    from datetime import date

    return serving.rolling_revenue(_revenue(spark, sf_dir), date(1996, 1, 1), date(1997, 12, 31), 30)


@query(
    """WITH spine AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
SELECT d AS date_day, md5(CAST(d AS VARCHAR)) AS date_key, year(d) AS calendar_year, quarter(d) AS calendar_quarter, month(d) AS calendar_month, day(d) AS day_of_month, dayofweek(d) AS day_of_week, dayofyear(d) AS day_of_year, week(d) AS iso_week,
  strftime(d, '%Y-%m') AS year_month, strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name, CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
  day(last_day(d)) AS days_in_month, dayofweek(d) IN (0, 6) AS is_weekend, year(d) - CASE WHEN month(d) < 2 THEN 1 ELSE 0 END AS fiscal_year, ((month(d) + 10) % 12) // 3 + 1 AS fiscal_quarter, (month(d) + 10) % 12 + 1 AS fiscal_month
FROM spine"""
)
def date_dimension(spark, sf_dir):
    """The calendar of the orders."""
    low, high = B.read(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    numbers = ["calendar_year", "calendar_quarter", "calendar_month", "day_of_month", "day_of_week", "day_of_year", "iso_week", "days_in_month", "fiscal_year", "fiscal_quarter", "fiscal_month"]
    out = marts.dim_date(spark, B.AS_OF, start=str(low), end=str(high))
    return longs(out.select("date_day", "date_key", "year_month", "day_name", "month_name", "week_start_date", "quarter_start_date", "is_weekend", *numbers), *numbers)


@query(
    """WITH spine AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
busy AS (SELECT CAST(o_orderdate AS DATE) AS d, 'order ' || min(o_orderkey) AS name, min(o_orderkey) % 2 = 0 AS affects, CASE WHEN min(o_orderkey) % 3 = 0 THEN 'GLOBAL' ELSE 'DE' END AS country FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT s.d AS date_day, b.d IS NOT NULL AS is_holiday, name AS holiday_name, coalesce(affects, FALSE) AS holiday_affects_volume FROM spine s LEFT JOIN busy b ON s.d = b.d AND country = 'GLOBAL'"""
)
def date_dimension_holidays(spark, sf_dir):
    """The calendar with holidays: days with urgent orders, of which every third is one of all countries."""
    orders = B.read(spark, sf_dir, "orders")
    low, high = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    first = orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.to_date("o_orderdate").alias("holiday_date")).agg(F.min("o_orderkey").alias("k"))
    country = F.when(F.col("k") % 3 == 0, "GLOBAL").otherwise("DE")
    holidays = first.select("holiday_date", F.concat(F.lit("order "), "k").alias("holiday_name"), country.alias("country_code"), (F.col("k") % 2 == 0).alias("affects_volume"))
    return marts.dim_date(spark, B.AS_OF, holidays, str(low), str(high)).select("date_day", "is_holiday", "holiday_name", "holiday_affects_volume")


# --- serving ------------------------------------------------------------------------------------


def _timeline(spark, sf_dir) -> DataFrame:
    orders = B.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("placed_at_utc"), F.col("o_orderstatus").alias("order_status"), F.col("o_orderkey").alias("order_id"), F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_cents"), F.lit("USD").alias("currency_code"), F.col("o_orderpriority").alias("order_channel")
    )
    paid = orders.select("customer_id", F.col("placed_at_utc").alias("processed_at"), F.lit("succeeded").alias("payment_status"), F.concat(F.lit("p"), "order_id").alias("payment_id"), F.col("amount_cents").alias("gross_amount_cents"), F.col("order_channel").alias("payment_method"))
    owner = orders.select("order_id", "customer_id")
    back = (
        B.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").join(owner, F.col("l_orderkey") == F.col("order_id"))
        .select("customer_id", F.col("l_shipdate").alias("issued_at"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("refund_id"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("refund_amount_cents"), F.col("l_linestatus").alias("refund_reason"))
    )
    happened = B.read(spark, sf_dir, "events").select(F.col("user_id").alias("customer_id"), F.col("ts").alias("occurred_at"), "event_type", F.concat(F.lit("e"), "event_id").alias("subscription_event_id"), F.lit(0).alias("mrr_delta_cents"), F.lit(None).cast("string").alias("to_plan_code"))
    return serving.timeline(orders, paid, back, happened)


_TIMELINE = """WITH timeline AS (
  SELECT o_custkey AS customer_id, o_orderdate AS occurred_at, 'order' AS event_category, o_orderstatus AS event_type, CAST(o_orderkey AS VARCHAR) AS reference_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, 'USD' AS currency_code, o_orderpriority AS detail FROM orders
  UNION ALL SELECT o_custkey, o_orderdate, 'payment', 'succeeded', 'p' || o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT), NULL, o_orderpriority FROM orders
  UNION ALL SELECT o_custkey, l_shipdate, 'refund', 'refund', l_orderkey || '-' || l_linenumber || '-' || l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT), NULL, l_linestatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
  UNION ALL SELECT user_id, ts, 'subscription', event_type, 'e' || event_id, 0, NULL, NULL FROM events)
"""


@query(_TIMELINE + "SELECT event_category, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS cents, count(DISTINCT customer_id) AS customers, max(occurred_at) AS newest FROM timeline GROUP BY 1")
def timeline_by_category(spark, sf_dir):
    return _timeline(spark, sf_dir).groupBy("event_category").agg(F.count("*").alias("n"), F.sum("amount_cents").alias("cents"), F.count_distinct("customer_id").alias("customers"), F.max("occurred_at").cast("timestamp_ntz").alias("newest"))


_PAGE = (
    _TIMELINE
    + """, page AS (SELECT * FROM timeline WHERE customer_id = 7 AND (occurred_at, reference_id) < (TIMESTAMP '2000-01-01', 'a') ORDER BY occurred_at DESC, reference_id DESC LIMIT 26)
SELECT occurred_at, event_category, event_type, reference_id, amount_cents, currency_code, detail, (SELECT count(*) FROM page) > 25 AS has_more FROM page ORDER BY occurred_at DESC, reference_id DESC LIMIT 25"""
)


@query(_PAGE)
def timeline_page(spark, sf_dir):
    out = serving.timeline_page(_timeline(spark, sf_dir), 7, 25, ("2000-01-01 00:00:00", "a"))
    return out.withColumn("occurred_at", F.col("occurred_at").cast("timestamp_ntz"))


@query(_PAGE)
def timeline_page_stored(spark, sf_dir):
    """The same page from the stored timeline, of which one bucket is opened; some customers' events came in a second step."""
    path, events = f"{scratch(spark)}/timeline", _timeline(spark, sf_dir)
    late = F.col("customer_id") % 7 == 0
    stored_timeline.store_timeline(spark, path, events.filter(~late | (F.col("occurred_at") < F.lit("1996-01-01").cast("timestamp"))), buckets=16)
    stored_timeline.update_timeline(spark, path, events.filter(late), events.filter(late))
    out = stored_timeline.stored_page(spark, path, 7, 25, ("2000-01-01 00:00:00", "a"))
    return out.withColumn("occurred_at", F.col("occurred_at").cast("timestamp_ntz"))


@query(f"WITH {B.PAYMENTS} SELECT CAST(refund_lag_days AS BIGINT) AS lag_days, count(*) AS n, CAST(21 - refund_lag_days AS BIGINT) AS headroom_days FROM paid WHERE refund_lag_days IS NOT NULL GROUP BY refund_lag_days")
def lag_histogram(spark, sf_dir):
    return longs(serving.lag_histogram(_paid(spark, sf_dir)), "lag_days", "headroom_days")


@query(
    f"""WITH {B.VERSIONS} SELECT count(DISTINCT customer_id) AS customers, count(*) AS versions, count(*) FILTER (valid_to IS NULL) AS current,
  (SELECT count(*) FROM (SELECT customer_id FROM versions v JOIN customer ON customer_id = c_custkey GROUP BY customer_id HAVING count(DISTINCT version_key % 2 + c_nationkey) > 1)) AS relocated
FROM versions JOIN customer ON customer_id = c_custkey"""
)
def dimension_overview(spark, sf_dir):
    return serving.dimension_overview(_dimension(spark, sf_dir))


# --- checks -------------------------------------------------------------------------------------


@query("SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return longs(quality.unique(B.read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"), "l_linenumber")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)")
def dq_relationships(spark, sf_dir):
    parents = B.read(spark, sf_dir, "customer").filter("c_nationkey <> 3")
    return quality.relationships(B.read(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'N' AND (l_quantity < 5 OR l_quantity > 45)")
def dq_between(spark, sf_dir):
    return quality.between(B.read(spark, sf_dir, "lineitem"), "l_quantity", 5, 45, "l_returnflag <> 'N'").select("l_orderkey", "l_partkey", "l_quantity")


@query("SELECT o_orderstatus AS value, count(*) AS n_records FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1")
def dq_accepted(spark, sf_dir):
    return quality.accepted_values(B.read(spark, sf_dir, "orders"), "o_orderstatus", ("O", "F"))


@query(
    """SELECT n AS model_rows, m AS source_rows, abs(n - m) AS delta FROM (SELECT count(*) FILTER (l_returnflag = 'R') AS n, count(*) AS m FROM lineitem) WHERE abs(n - m) > 0.02 * m"""
)
def dq_rowcount(spark, sf_dir):
    return quality.rowcount_matches(B.read(spark, sf_dir, "lineitem"), tolerance=0.02, where="l_returnflag = 'R'")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND nullif(o_orderpriority, '1-URGENT') IS NULL")
def dq_not_null_where(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders").withColumn("priority", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")))
    return quality.not_null_where(orders, "priority", "o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")


@query("SELECT event_id FROM events WHERE nullif(event_type, 'error') IS NULL")
def dq_not_null(spark, sf_dir):
    return quality.not_null(B.read(spark, sf_dir, "events").withColumn("kind", F.nullif(F.col("event_type"), F.lit("error"))), "kind").select("event_id")


@query("SELECT p_partkey, p_retailprice FROM part WHERE NOT (p_retailprice > 1000 OR p_size < 25)")
def dq_expression(spark, sf_dir):
    return quality.expression_is_true(B.read(spark, sf_dir, "part"), "p_retailprice > 1000 or p_size < 25").select("p_partkey", "p_retailprice")


@query(f"WITH {B.PAYMENTS} SELECT payment_id, CAST(refund_lag_days AS BIGINT) AS refund_lag_days FROM paid WHERE refund_lag_days > 21")
def dq_late_arrival(spark, sf_dir):
    return longs(quality.late_beyond_lookback(_paid(spark, sf_dir), "refund_lag_days").select("payment_id", "refund_lag_days"), "payment_id", "refund_lag_days")


@query(f"WITH {B.PAYMENTS} SELECT payment_id, refunded_amount_cents, amount_cents FROM paid WHERE refunded_amount_cents > amount_cents")
def dq_refund_exceeds(spark, sf_dir):
    return longs(quality.refund_exceeds_payment(_paid(spark, sf_dir)).select("payment_id", "refunded_amount_cents", "amount_cents"), "payment_id")


_BROKEN = f"""WITH {B.VERSIONS}, broken AS (SELECT customer_id, version_key, valid_from,
  CASE WHEN version_key % 5 = 0 THEN valid_to - INTERVAL 1 DAY WHEN version_key % 7 = 0 THEN valid_to + INTERVAL 1 DAY ELSE valid_to END AS valid_to FROM versions)
"""


def _broken(spark, sf_dir) -> DataFrame:
    k, end = F.col("version_key"), F.col("valid_to")
    day = F.expr("interval 1 day")
    return B.versions(spark, sf_dir).withColumn("valid_to", F.when(k % 5 == 0, end - day).when(k % 7 == 0, end + day).otherwise(end))


@query(
    _BROKEN
    + """SELECT customer_id, version_key, problem FROM (SELECT *, CASE WHEN valid_to IS NULL OR n < valid_to THEN 'overlap' WHEN n > valid_to THEN 'gap' END AS problem
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS n FROM broken) WHERE n IS NOT NULL) WHERE problem IS NOT NULL"""
)
def dq_scd2_overlap_gap(spark, sf_dir):
    return quality.scd2_overlaps_or_gaps(_broken(spark, sf_dir), "customer_id").select("customer_id", "version_key", "problem")


@query(
    f"""WITH {B.VERSIONS} SELECT customer_id, count(*) FILTER (valid_to IS NULL OR version_key % 11 = 0) AS current_versions FROM versions GROUP BY 1 HAVING count(*) FILTER (valid_to IS NULL OR version_key % 11 = 0) <> 1"""
)
def dq_one_current(spark, sf_dir):
    flagged = B.versions(spark, sf_dir).withColumn("is_current", F.col("valid_to").isNull() | (F.col("version_key") % 11 == 0))
    return quality.scd2_one_current(flagged, "customer_id")


@query(
    _ROLLING
    + """, stepped AS (SELECT date_day, CAST(net AS DOUBLE) AS mrr_cents, lag(CAST(net AS DOUBLE)) OVER (ORDER BY date_day) AS b FROM filled)
SELECT date_day, mrr_cents, b AS before_cents, 'jump' AS reason FROM stepped WHERE b >= 100000 AND abs(mrr_cents - b) > 0.4 * b"""
)
def dq_mrr_jump(spark, sf_dir):
    """The jump rule over the daily revenue series, which has jumps."""
    daily = _revenue(spark, sf_dir).select("date_day", F.col("net_revenue_usd_cents").cast("double").alias("mrr_cents"))
    return quality.absurd_mrr(daily).select("date_day", "mrr_cents", "before_cents", "reason")


@query(_LATEST + " AND _op = 'd'")
def dq_deleted_events(spark, sf_dir):
    """Keys whose last change is a delete: asked of the log with deletes, where there are any."""
    out = quality.deleted_events(changelog.latest(B.change_log(spark, sf_dir), "id", include_deletes=True))
    return longs(out.select(_LOG_COLUMNS), "_kafka_partition")


@query(
    f"""WITH {B.RESOLVED}, {B.VERSIONS}, first_ AS (SELECT customer_id, min(valid_from) AS earliest_version FROM versions GROUP BY 1)
SELECT order_id, earliest_version FROM rated r LEFT JOIN first_ USING (customer_id)
WHERE NOT EXISTS (SELECT 1 FROM versions v WHERE v.customer_id = r.customer_id AND placed_at_utc >= valid_from AND (valid_to IS NULL OR placed_at_utc < valid_to))"""
)
def dq_unresolved_version(spark, sf_dir):
    """Orders whose resolved instant lies before their customer's first version."""
    v = B.versions(spark, sf_dir).withColumn("customer_id", F.col("customer_id").cast("string")).withColumn("customer_key", S.surrogate_key(F.col("customer_id"), F.col("valid_from")))
    keyed = joins.asof_join(_resolved(spark, sf_dir), v, "customer_id", "placed_at_utc", columns=["customer_key"])
    return quality.unresolved_customer_version(keyed, v).select(F.col("order_id").cast("long"), B.ntz("earliest_version"))


@query(
    f"""WITH {B.RESOLVED}, {B.PAYMENTS}, {B.VERSIONS}
SELECT 'legacy_status_spelling' AS pattern, count(*) FILTER (o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0)) AS n FROM orders
UNION ALL SELECT 'soft_deleted_customer', count(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'soft_deleted_customer_with_orders', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0
UNION ALL SELECT 'naive_local_time', count(*) FROM timed WHERE naive
UNION ALL SELECT 'refund_later_than_7_days', count(*) FROM paid WHERE refund_lag_days > 7
UNION ALL SELECT 'refund_later_than_14_days', count(*) FROM paid WHERE refund_lag_days > 14
UNION ALL SELECT 'non_usd_order', count(*) FROM timed WHERE currency_code <> 'USD'
UNION ALL SELECT 'pending_payment_without_time', count(*) FROM payments WHERE payment_status = 'pending'
UNION ALL SELECT 'plan_change', count(*) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'relocation', count(*) FROM (SELECT customer_id FROM versions GROUP BY 1 HAVING count(DISTINCT version_key % 2) > 1)"""
)
def pattern_coverage(spark, sf_dir):
    """Counts of the ten sorts of mess over the bound tables; accounts below zero stand for deleted customers."""
    raw_rows = B.raw_orders(spark, sf_dir)
    people = B.customers(spark, sf_dir)
    moves = B.versions(spark, sf_dir).select(F.col("customer_id").alias("id"), (F.col("version_key") % 2).alias("country_code"))
    return quality.pattern_coverage(raw_rows, moves, staging.orders(raw_rows), people, B.refunds(spark, sf_dir), _paid(spark, sf_dir), B.lifecycle(spark, sf_dir))


@query("SELECT o_orderkey AS order_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')")
def dq_completed_without_payment(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "P", "completed").alias("order_status"))
    paid = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), (F.col("l_returnflag") == "N").alias("is_successful"))
    return quality.completed_without_payment(orders, paid).select("order_id")


@query(f"WITH {B.RESOLVED} SELECT order_id, currency_code FROM rated WHERE currency_code <> 'USD' AND rate_to_usd IS NULL")
def dq_missing_fx_rate(spark, sf_dir):
    return quality.missing_fx_rate(_resolved(spark, sf_dir)).select(F.col("order_id").cast("long"), "currency_code")


@query(
    f"""WITH {B.RESOLVED} SELECT order_id, placed_at_utc FROM rated
WHERE date_diff('minute', (SELECT max(o_orderdate) FROM orders), placed_at_utc) > 5"""
)
def dq_future_dated(spark, sf_dir):
    newest = B.read(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("string")).first()[0]
    return quality.future_dated(_resolved(spark, sf_dir), newest).select(F.col("order_id").cast("long"), B.ntz("placed_at_utc"))


@query(
    f"""SELECT "table", newest, round(date_diff('second', newest, TIMESTAMP '{B.AS_OF}') / 3600.0, 4) AS age_hours,
  CASE WHEN date_diff('second', newest, TIMESTAMP '{B.AS_OF}') / 3600.0 > 6 THEN 'error' WHEN date_diff('second', newest, TIMESTAMP '{B.AS_OF}') / 3600.0 > 2 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT 'orders' AS "table", max(o_orderdate) AS newest FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem UNION ALL SELECT 'events', max(ts) FROM events)"""
)
def freshness_by_table(spark, sf_dir):
    of = lambda t, c: B.read(spark, sf_dir, t).select(F.col(c).alias("_ingested_at"))
    out = quality.freshness({"orders": of("orders", "o_orderdate"), "lineitem": of("lineitem", "l_shipdate"), "events": of("events", "ts")}, B.AS_OF)
    return out.select("table", B.ntz("newest"), F.round("age_hours", 4).alias("age_hours"), "status")


@query(
    """SELECT name, s AS source_rows, m AS model_rows, round(abs(s - m) / CAST(s AS DOUBLE), 6) AS drift, abs(s - m) / CAST(s AS DOUBLE) > 0.02 AS exceeds
FROM (SELECT 'orders' AS name, count(*) AS s, count(*) FILTER (o_orderkey % 100 <> 0) AS m FROM orders UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (l_returnflag <> 'R') FROM lineitem)"""
)
def rowcount_drift(spark, sf_dir):
    orders, items = B.read(spark, sf_dir, "orders"), B.read(spark, sf_dir, "lineitem")
    out = quality.rowcount_drift({"orders": (orders, orders.filter("o_orderkey % 100 <> 0")), "lineitem": (items, items.filter("l_returnflag <> 'R'"))})
    return out.withColumn("drift", F.round("drift", 6))


@query(
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(avg(value), 6) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT day, n, value FROM daily ORDER BY n DESC, day DESC LIMIT 20"""
)
def busiest_days(spark, sf_dir):
    days = B.read(spark, sf_dir, "events").filter("event_type = 'purchase'").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("value"))
    return serving.recent(days, "n", 20, tie="day")


@query("SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_distinct, count(*) FILTER (l_partkey = 42) AS n_found FROM lineitem")
def raw_lookup(spark, sf_dir):
    from lodestream.sources.raw import lookup

    return lookup(B.read(spark, sf_dir, "lineitem"), "l_partkey", 42)


@query(
    """SELECT 'r' AS _op, row_number() OVER (ORDER BY o_orderkey) - 1 AS _kafka_offset, o_orderkey, -1 AS _kafka_partition FROM orders"""
)
def bulk_snapshot(spark, sf_dir):
    from lodestream.sources.raw import bulk_snapshot as tagged

    out = tagged(B.read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", B.AS_OF)
    return out.select("_op", "_kafka_offset", "o_orderkey", F.col("_kafka_partition").cast("int"))


# --- facts end to end ---------------------------------------------------------------------------


@query(
    f"""WITH {B.RESOLVED}, {B.VERSIONS}, plans_ AS (SELECT DISTINCT user_id AS sub, md5(CAST(user_id % 4 + 1 AS VARCHAR)) AS plan_key FROM events)
SELECT order_id, plan_key, version_key, order_status, currency_code, CAST(placed_at_utc AS DATE) AS order_date, md5(CAST(CAST(placed_at_utc AS DATE) AS VARCHAR)) AS date_key,
  CAST(round(CASE WHEN currency_code = 'USD' THEN amount_cents ELSE amount_cents / rate_to_usd END) AS BIGINT) AS amount_usd_cents
FROM rated r LEFT JOIN versions v ON r.customer_id = v.customer_id AND placed_at_utc >= valid_from AND (valid_to IS NULL OR placed_at_utc < valid_to)
LEFT JOIN plans_ ON order_id % 3 = 0 AND sub = r.customer_id % 200"""
)
def order_facts(spark, sf_dir):
    """Orders staged, resolved, rated, and joined to their subscription's plan and the customer version of their instant; the version's key stands as its country."""
    v = B.versions(spark, sf_dir)
    dim = v.select(F.col("customer_id").cast("string"), S.surrogate_key(F.col("customer_id"), F.col("valid_from")).alias("customer_key"), "valid_from", "valid_to", F.col("version_key").alias("country_code"), F.lit(False).alias("is_deleted"))
    out = marts.fct_orders(_resolved(spark, sf_dir), dim, B.plans(spark, sf_dir), B.subscriptions(spark, sf_dir))
    return out.select(F.col("order_id").cast("long"), "plan_key", F.col("customer_country_at_order_time").alias("version_key"), "order_status", "currency_code", "order_date", "date_key", "amount_usd_cents")


@query(
    f"""WITH {B.PAYMENTS}, {B.RESOLVED}, usd AS (
  SELECT p.payment_id, r.currency_code, p.amount_cents, p.refunded_amount_cents, p.net_amount_cents, p.payment_status, CASE WHEN r.currency_code = 'USD' THEN 1.0::DOUBLE ELSE rate_to_usd END AS rate, CAST(placed_at_utc AS DATE) AS order_date
  FROM paid p LEFT JOIN rated r ON p.payment_id = r.order_id)
SELECT payment_id, order_date, payment_status = 'succeeded' AS is_successful, amount_cents AS gross_amount_cents, net_amount_cents,
  CAST(round(amount_cents / rate) AS BIGINT) AS gross_amount_usd_cents, CAST(round(refunded_amount_cents / rate) AS BIGINT) AS refunded_amount_usd_cents, CAST(round(net_amount_cents / rate) AS BIGINT) AS net_amount_usd_cents FROM usd"""
)
def payment_facts(spark, sf_dir):
    orders = _resolved(spark, sf_dir).select(
        "order_id", F.lit(None).cast("string").alias("customer_key"), "customer_id", S.date_key(F.col("placed_at_utc")).alias("date_key"), F.to_date("placed_at_utc").alias("order_date"), "order_channel", "currency_code", "rate_to_usd"
    )
    out = marts.fct_payments(_paid(spark, sf_dir), orders)
    return longs(out.select("payment_id", "order_date", "is_successful", "gross_amount_cents", "net_amount_cents", "gross_amount_usd_cents", "refunded_amount_usd_cents", "net_amount_usd_cents"), "payment_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-log reduction, status normalisation, as-of versions and gap-filled rolling revenue in one plan."""
    facts = QUERIES["order_facts"](spark, sf_dir).filter("order_status = 'completed'")
    paid = facts.select("order_date", F.col("version_key").alias("customer_id"), F.lit(True).alias("is_successful"), F.col("amount_usd_cents").alias("gross_amount_usd_cents"), F.lit(0).cast("long").alias("refunded_amount_usd_cents"), F.col("amount_usd_cents").alias("net_amount_usd_cents"))
    daily = marts.daily_revenue(paid)
    spine = daily.agg(F.min("date_day").alias("a"), F.max("date_day").alias("b")).select(F.explode(F.sequence("a", "b")).alias("date_day"))
    return marts.fct_revenue_rolling(spine, daily)


# The other modules register their queries when they are imported.
from lodestream.plans import check_queries, ingest_queries, staging_queries  # noqa: E402, F401

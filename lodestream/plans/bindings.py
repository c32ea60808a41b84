"""The library's inputs as views of the given tables: change log, lifecycle, payments, refunds and versions.

Each view is stated twice, as a DataFrame and as a DuckDB common table expression, so that queries have a twin in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators.windows import following
from lodestream.plans import staging
from lodestream.plans.marts import dim_plan

#: The four plans.
PLANS = ((1, "legacy_starter", 900), (2, "basic", 1900), (3, "pro", 4900), (4, "enterprise", 19900))
#: A zone for each nation by its key modulo four; the last is unknown.
ZONES = ("America/New_York", "Europe/Paris", "Asia/Tokyo", None)
TRIAL_DAYS = 3
#: The moment that all queries are run as of.
AS_OF = "2001-08-02 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(name: str, alias: str | None = None):
    return F.col(name).cast("timestamp_ntz").alias(alias or name)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        "event_id",
        "event_type",
        "value",
        op.alias("_op"),
        F.when(F.col("event_id") >= 500, F.col("event_id")).alias("_lsn"),
        F.floor(F.col("event_id") / 3).cast("long").alias("_kafka_offset"),
        (F.col("event_id") % 3).cast("int").alias("_kafka_partition"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
        F.col("ts").cast("timestamp").alias("_source_ts"),
    )


CHANGE_LOG = """change_log AS (
  SELECT user_id AS id, event_id, event_type, value,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS _op,
         CASE WHEN event_id >= 500 THEN event_id END AS _lsn,
         event_id // 3 AS _kafka_offset, event_id % 3 AS _kafka_partition, ts AS _ingested_at, ts AS _source_ts
  FROM events)"""


def _meta(key, at) -> list:
    """META columns of one change a row: sequence, offset and partition follow the key."""
    return [
        F.lit("u").alias("_op"),
        key.cast("long").alias("_lsn"),
        key.cast("long").alias("_kafka_offset"),
        F.lit(0).alias("_kafka_partition"),
        at.cast("timestamp").alias("_ingested_at"),
        at.cast("timestamp").alias("_source_ts"),
    ]


def raw_subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lifecycle events: one subscription a user."""
    e = F.col("event_type")
    kind = F.when(e == "signup", " Created").when(e == "purchase", "UPGRADED").when(e == "view", "resumed").when(e == "click", "paused ").otherwise("cancelled")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("subscription_id"),
        kind.alias("event_type"),
        F.when(e.isin("purchase", "error"), F.col("event_id") % 3 + 1).alias("from_plan_id"),
        F.when(e.isin("signup", "purchase"), F.col("event_id") % 4 + 1).alias("to_plan_id"),
        F.col("ts").alias("occurred_at"),
        F.col("ts").alias("created_at"),
        *_meta(F.col("event_id"), F.col("ts")),
    )


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged lifecycle events."""
    return staging.subscription_events(raw_subscription_events(spark, sf_dir))


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription a user, begun with the user's first event."""
    first = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("started_at"), F.max("ts").alias("updated_at"))
    return first.select(
        "id",
        F.col("id").alias("customer_id"),
        (F.col("id") % 4 + 1).alias("plan_id"),
        F.when(F.col("id") % 5 == 0, " Trialing").otherwise("ACTIVE").alias("status"),
        "started_at",
        F.lit(None).cast("timestamp").alias("ended_at"),
        (F.col("started_at") + F.expr(f"interval {TRIAL_DAYS} days")).alias("trial_ends_at"),
        "updated_at",
        *_meta(F.col("id"), F.col("updated_at")),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged subscriptions."""
    return staging.subscriptions(raw_subscriptions(spark, sf_dir))


def raw_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plans that events name, a change a event: the newest has the price that holds."""
    k = F.col("event_id") % 4
    pick = lambda at: F.element_at(F.array(*(F.lit(p[at]) for p in PLANS)), (k + 1).cast("int"))
    return read(spark, sf_dir, "events").select(
        (k + 1).alias("id"),
        F.concat(pick(1), F.lit(" ")).alias("code"),
        pick(2).alias("monthly_cents"),
        F.lit("usd").alias("currency"),
        (k != 0).alias("active"),
        *_meta(F.col("event_id"), F.col("ts")),
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan dimension over staged plans."""
    return dim_plan(staging.plans(raw_plans(spark, sf_dir)))


LIFECYCLE = f"""plans(plan_id, plan_code, monthly_cents) AS (VALUES {', '.join(str(p) for p in PLANS)}),
tiers AS (SELECT *, CASE WHEN plan_code = 'legacy_starter' THEN 'legacy' WHEN monthly_cents < 2500 THEN 'entry' WHEN monthly_cents < 10000 THEN 'mid' ELSE 'top' END AS plan_tier FROM plans),
lifecycle AS (
  SELECT event_id AS subscription_event_id, user_id AS subscription_id,
         CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'upgraded' WHEN 'view' THEN 'resumed' WHEN 'click' THEN 'paused' ELSE 'cancelled' END AS event_type,
         CASE WHEN event_type IN ('purchase', 'error') THEN event_id % 3 + 1 END AS from_plan_id,
         CASE WHEN event_type IN ('signup', 'purchase') THEN event_id % 4 + 1 END AS to_plan_id, ts AS occurred_at
  FROM events),
subs AS (SELECT user_id AS subscription_id, user_id AS customer_id, min(ts) AS started_at, min(ts) + INTERVAL {TRIAL_DAYS} DAY AS trial_ends_at FROM events GROUP BY ALL),
stated AS (
  SELECT l.*, s.customer_id, s.trial_ends_at,
         last_value(to_plan_id IGNORE NULLS) OVER (PARTITION BY l.subscription_id ORDER BY occurred_at, subscription_event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS plan_id,
         lead(occurred_at) OVER (PARTITION BY l.subscription_id ORDER BY occurred_at, subscription_event_id) AS valid_to,
         CASE event_type WHEN 'created' THEN 'trialing' WHEN 'paused' THEN 'paused' WHEN 'cancelled' THEN 'ended' ELSE 'earning' END AS revenue_state
  FROM lifecycle l LEFT JOIN subs s USING (subscription_id)),
periods AS (
  SELECT subscription_id, customer_id, subscription_event_id, event_type, revenue_state, plan_id, occurred_at AS valid_from, valid_to,
         CASE WHEN revenue_state = 'trialing' THEN greatest(occurred_at, trial_ends_at) ELSE occurred_at END AS revenue_from,
         revenue_state IN ('earning', 'trialing') AS can_earn_revenue
  FROM stated WHERE plan_id IS NOT NULL)"""


def last_event_day(spark: SparkSession, sf_dir: str):
    """The day that event queries are run as of: a fixed one after all events."""
    return read(spark, sf_dir, "events").agg(F.max("ts").cast("date")).first()[0]


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments; of every fifth there is an older bulk row, still pending."""
    orders = read(spark, sf_dir, "orders")
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    now = orders.select(
        k.alias("id"),
        k.alias("order_id"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_cents"),
        F.upper("o_orderpriority").alias("method"),
        F.when(pending, " Pending").otherwise("SUCCEEDED").alias("status"),
        F.when(~pending, at).alias("processed_at"),
        at.alias("created_at"),
        at.alias("updated_at"),
        *_meta(k, at),
    )
    bulk = now.filter(F.col("id") % 5 == 0).withColumns({"status": F.lit("pending"), "_op": F.lit("r"), "_lsn": F.lit(None).cast("long"), "_kafka_partition": F.lit(-1)})
    return now.unionByName(bulk)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged payments."""
    return staging.payments(raw_payments(spark, sf_dir))


def raw_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned items as refunds of their order's payment."""
    items = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("id"),
        F.col("l_orderkey").alias("payment_id"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount_cents"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit(" "), "l_linestatus")).otherwise("  ").alias("reason"),
        F.col("l_shipdate").alias("issued_at"),
        F.col("l_shipdate").alias("created_at"),
        *_meta(F.col("l_orderkey"), F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber"))),
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged refunds, ingested when they were issued."""
    return staging.refunds(raw_refunds(spark, sf_dir)).withColumn("_ingested_at", F.col("issued_at"))


PAYMENTS = """payments AS (
  SELECT o_orderkey AS payment_id, o_custkey AS customer_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'succeeded' END AS payment_status FROM orders),
refunds AS (
  SELECT l_orderkey AS payment_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS refund_amount_cents, l_shipdate AS issued_at FROM lineitem WHERE l_returnflag = 'R'),
refund_totals AS (
  SELECT payment_id, CAST(sum(refund_amount_cents) AS BIGINT) AS refunded, count(*) AS n, min(issued_at) AS first_at, max(issued_at) AS last_at FROM refunds GROUP BY payment_id),
paid AS (
  SELECT p.*, coalesce(refunded, 0) AS refunded_amount_cents, coalesce(n, 0) AS refund_count, first_at, last_at, amount_cents - coalesce(refunded, 0) AS net_amount_cents,
         date_diff('day', created_at, last_at) AS refund_lag_days, greatest(created_at, coalesce(last_at, created_at)) AS ingested_at
  FROM payments p LEFT JOIN refund_totals USING (payment_id))"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of the raw table: old status spellings, three currencies, one in seven with local wall-clock text only."""
    k = F.col("o_orderkey")
    naive = k % 7 == 0
    at = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int"), F.lit(0).cast("decimal(18,6)"))
    return read(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(k % 3 == 0, F.col("o_custkey") % 200).alias("subscription_id"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_cents"),
        F.when(k % 10 < 8, " usd").when(k % 10 == 8, "EUR").otherwise("gbp ").alias("currency"),
        F.when(F.col("o_orderstatus") == "O", "paid").when(F.col("o_orderstatus") == "F", " Completed").when(k % 2 == 0, "canceled").otherwise("bogus").alias("status"),
        F.when(~naive, at).cast("timestamp").alias("placed_at"),
        F.when(naive, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).alias("placed_at_local"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.lit("u").alias("_op"),
        k.alias("_lsn"),
        k.alias("_kafka_offset"),
        F.lit(0).alias("_kafka_partition"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        F.lit(None).cast("timestamp").alias("_source_ts"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: a bulk row each, and a change for every second one; some are marked as deleted, some removed at the source."""
    k, n = F.col("c_custkey"), F.col("c_nationkey") % 4
    zone = F.when(n == 0, ZONES[0]).when(n == 1, ZONES[1]).when(n == 2, ZONES[2]).otherwise("  ")
    at = F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval((k % 300).cast("int"))
    bulk = read(spark, sf_dir, "customer").select(
        k.alias("id"),
        F.concat(F.lit(" "), "c_name", F.lit("@Shop.Example")).alias("email"),
        F.concat("c_name", F.lit(" ")).alias("name"),
        F.concat(F.lit("n"), F.col("c_nationkey") % 10).alias("country_code"),
        zone.alias("timezone"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.when(F.col("c_acctbal") < 0, at).alias("deleted_at"),
        F.lit("r").alias("_op"),
        F.lit(None).cast("long").alias("_lsn"),
        k.alias("_kafka_offset"),
        F.lit(-1).alias("_kafka_partition"),
        at.alias("_ingested_at"),
        F.lit(None).cast("timestamp").alias("_source_ts"),
    )
    changed = bulk.filter("id % 2 = 0").withColumns({"name": F.concat(F.lit("new "), "name"), "_op": F.when(F.col("id") % 14 == 0, "d").otherwise("u"), "_lsn": F.col("id"), "_kafka_partition": F.lit(0)})
    return bulk.unionByName(changed)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged customers."""
    return staging.customers(raw_customers(spark, sf_dir))


def fx_rates(spark: SparkSession, sf_dir: str, before: int = 0) -> DataFrame:
    """A rate for each currency and month of the orders, and ``before`` months more, by rule; every eleventh month of one currency is missing."""
    span = read(spark, sf_dir, "orders").agg(F.add_months(F.trunc(F.min("o_orderdate").cast("date"), "month"), -before).alias("a"), F.trunc(F.max("o_orderdate").cast("date"), "month").alias("b"))
    months = span.select(F.explode(F.sequence("a", F.add_months("b", 2), F.expr("interval 1 month"))).alias("rate_date"))
    m = F.month("rate_date")
    eur = months.filter(m != 11).select("rate_date", F.lit("EUR").alias("currency_code"), (F.lit(0.85) + m / 100).alias("rate_to_usd"))
    gbp = months.select("rate_date", F.lit("GBP").alias("currency_code"), (F.lit(0.70) + m / 100).alias("rate_to_usd"))
    return eur.union(gbp)


RESOLVED = f"""zoned AS (
  SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN '{ZONES[0]}' WHEN 1 THEN '{ZONES[1]}' WHEN 2 THEN '{ZONES[2]}' END AS zone FROM customer),
timed AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, o_orderdate,
         CASE WHEN o_orderkey % 10 < 8 THEN 'USD' WHEN o_orderkey % 10 = 8 THEN 'EUR' ELSE 'GBP' END AS currency_code,
         CASE WHEN o_orderstatus IN ('O', 'F') THEN 'completed' WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'unknown' END AS order_status,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS wall, o_orderkey % 7 = 0 AS naive, zone
  FROM orders LEFT JOIN zoned ON o_custkey = c_custkey),
resolved AS (
  SELECT *, CASE WHEN naive AND zone IS NOT NULL THEN (wall AT TIME ZONE zone) AT TIME ZONE 'UTC' ELSE wall END AS placed_at_utc FROM timed),
rated AS (
  SELECT *, CASE WHEN currency_code = 'EUR' AND month(placed_at_utc) <> 11 THEN 0.85::DOUBLE + month(placed_at_utc) / 100 WHEN currency_code = 'GBP' THEN 0.70::DOUBLE + month(placed_at_utc) / 100 END AS rate_to_usd FROM resolved)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of each customer from every order day on, until the next."""
    days = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("timestamp").alias("valid_from")).agg(F.min("o_orderkey").alias("version_key"))
    return days.withColumn("valid_to", following("valid_from", "customer_id", ["valid_from"]))


VERSIONS = """versions AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to
  FROM (SELECT o_custkey AS customer_id, o_orderdate AS valid_from, min(o_orderkey) AS version_key FROM orders GROUP BY ALL))"""

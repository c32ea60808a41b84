"""Dimensions, facts and metrics. Every plan takes the moment it is run as of; none reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import scalars as S
from lodestream.operators.bitmaps import interval_mask, masks, numbers
from lodestream.operators.incremental import lookback
from lodestream.operators.joins import asof_join, gap_fill, interval_days
from lodestream.operators.sweep import bounded, edges, islands, running
from lodestream.operators.windows import moved, rolling

SPINE = ("2024-01-01", "2027-12-31")


def dim_date(spark: SparkSession, run_as_of, holidays: DataFrame | None = None, start: str = SPINE[0], end: str = SPINE[1], end_inclusive: bool = False) -> DataFrame:
    """The complete calendar from ``start`` up to ``end``; holidays are those of all countries (GLOBAL)."""
    d = F.col("date_day")
    last = F.lit(end).cast("date") if end_inclusive else F.date_sub(F.lit(end).cast("date"), 1)
    out = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), last)).alias("date_day")).select(
        "date_day",
        S.date_key(d).alias("date_key"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("iso_week"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        *(F.to_date(F.date_trunc(unit, d)).alias(f"{unit}_start_date") for unit in ("month", "quarter", "year", "week")),
        S.days_in_month(d).alias("days_in_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        S.fiscal_year(d).alias("fiscal_year"),
        S.fiscal_quarter(d).alias("fiscal_quarter"),
        S.fiscal_month(d).alias("fiscal_month"),
    )
    if holidays is None:
        out = out.withColumns({"is_holiday": F.lit(False), "holiday_name": F.lit(None).cast("string"), "holiday_affects_volume": F.lit(False)})
    else:
        named = holidays.filter("country_code = 'GLOBAL'").select(F.col("holiday_date").alias("date_day"), "holiday_name", "affects_volume", F.lit(True).alias("_met"))
        out = out.join(named, "date_day", "left").withColumns({"is_holiday": F.col("_met").isNotNull(), "holiday_affects_volume": F.coalesce("affects_volume", F.lit(False))}).drop("_met", "affects_volume")
    return out.withColumn("is_past", d <= F.lit(run_as_of).cast("date"))


def dim_plan(plans: DataFrame) -> DataFrame:
    """All plans, the retired ones too: live subscriptions may still be on them."""
    return plans.select(
        S.surrogate_key(F.col("plan_id")).alias("plan_key"),
        "plan_id",
        "plan_code",
        "monthly_cents",
        (F.col("monthly_cents").cast("double") / 100).alias("monthly_amount"),
        "currency_code",
        "is_active",
        "price_rank",
        S.plan_tier(F.col("plan_code"), F.col("monthly_cents")).alias("plan_tier"),
    )


def fct_orders(orders_resolved: DataFrame, dim_customer: DataFrame, dim_plan_: DataFrame, subscriptions: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row an order, with the customer version of its instant."""
    fresh = lookback(orders_resolved, target)
    versions = dim_customer.select("customer_id", "customer_key", "valid_from", "valid_to", F.col("country_code").alias("customer_country_at_order_time"), "is_deleted")
    keyed = asof_join(fresh, versions, "customer_id", "placed_at_utc", columns=["customer_key", "customer_country_at_order_time", "is_deleted"])
    plan = subscriptions.select("subscription_id", "plan_id").join(dim_plan_.select("plan_id", "plan_key"), "plan_id", "left").drop("plan_id")
    return keyed.join(plan, "subscription_id", "left").select(
        "order_id",
        "customer_key",
        "customer_id",
        "plan_key",
        "subscription_id",
        S.date_key(F.col("placed_at_utc")).alias("date_key"),
        F.to_date("placed_at_utc").alias("order_date"),
        "order_status",
        "order_status_raw",
        "order_channel",
        "amount_cents",
        "currency_code",
        "amount_usd_cents",
        "rate_to_usd",
        "placed_at_utc",
        "placed_at_local",
        "updated_at",
        "is_legacy_client_order",
        "is_timestamp_inferred",
        "is_timestamp_low_confidence",
        "is_fx_rate_missing",
        F.coalesce("is_deleted", F.lit(False)).alias("customer_is_deleted"),
        "customer_country_at_order_time",
        "_ingested_at",
    )


def fct_payments(payments: DataFrame, orders: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row a payment, net of refunds, in its currency and in USD at the order's rate."""
    usd = lambda c: S.to_usd_cents(F.col(c), F.col("currency_code"), F.col("rate_to_usd"))
    about = orders.select("order_id", "customer_key", "customer_id", "date_key", "order_date", "order_channel", "currency_code", "rate_to_usd")
    return lookback(payments, target).join(about, "order_id", "left").select(
        "payment_id",
        "order_id",
        "customer_key",
        "customer_id",
        "date_key",
        "order_date",
        "order_channel",
        "payment_method",
        "payment_status",
        F.col("amount_cents").alias("gross_amount_cents"),
        "refunded_amount_cents",
        "net_amount_cents",
        "refund_count",
        usd("amount_cents").alias("gross_amount_usd_cents"),
        usd("refunded_amount_cents").alias("refunded_amount_usd_cents"),
        usd("net_amount_cents").alias("net_amount_usd_cents"),
        "is_successful",
        "is_pending",
        "is_refunded",
        "is_fully_refunded",
        "is_partially_refunded",
        "processed_at",
        "created_at",
        "first_refund_issued_at",
        "last_refund_issued_at",
        "refund_lag_days",
        "_ingested_at",
    )


def fct_subscription_events(events: DataFrame, subscriptions: DataFrame, dim_plan_: DataFrame, dim_customer: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row a lifecycle event, with both plans, the change in monthly cents and the customer version."""
    fresh = lookback(events, target).join(subscriptions.select("subscription_id", "customer_id"), "subscription_id", "left")

    def role(name: str) -> DataFrame:
        return dim_plan_.select(F.col("plan_id").alias(f"{name}_plan_id"), F.col("plan_key").alias(f"{name}_plan_key"), F.col("plan_code").alias(f"{name}_plan_code"), F.col("monthly_cents").alias(f"_{name}_cents"))

    both = fresh.join(role("from"), "from_plan_id", "left").join(role("to"), "to_plan_id", "left")
    keyed = asof_join(both, dim_customer, "customer_id", "occurred_at", columns=["customer_key"])
    return keyed.select(
        "subscription_event_id",
        "subscription_id",
        "customer_id",
        "customer_key",
        "event_type",
        "from_plan_id",
        "to_plan_id",
        "from_plan_key",
        "to_plan_key",
        "from_plan_code",
        "to_plan_code",
        (F.coalesce("_to_cents", F.lit(0)) - F.coalesce("_from_cents", F.lit(0))).alias("mrr_delta_cents"),
        "starts_revenue",
        "stops_revenue",
        "changes_revenue",
        "occurred_at",
        F.to_date("occurred_at").alias("event_date"),
        S.date_key(F.col("occurred_at")).alias("date_key"),
        "created_at",
        "_ingested_at",
    )


def fct_mrr_daily(periods: DataFrame, dim_plan_: DataFrame, run_as_of, first: Column | None = None) -> DataFrame:
    """MRR of each day on which something earns: a plan's monthly cents by the days of the month, summed and scaled back.

    Nothing is exploded into days: cents are added where a period begins and taken off where it ends, so an open period of
    years costs two rows, and sums are exact until a day's are divided by its month. Subscriptions and customers are counted
    over the union of their periods. Each tier is also given by itself; the three without legacy do not add up to the whole.
    """
    last = F.lit(run_as_of).cast("date")
    plans = dim_plan_.select("plan_id", "plan_tier", "monthly_cents")
    earning = periods.filter("can_earn_revenue").select("subscription_id", "customer_id", "plan_id", "revenue_from", "valid_to").join(plans, "plan_id")
    spans = bounded(earning, "revenue_from", "valid_to", last, first)
    tiers, one = ("entry", "mid", "top", "legacy"), F.lit(1)
    of_tier = lambda t: F.when(F.col("plan_tier") == t, F.col("monthly_cents")).otherwise(F.lit(0))
    cents = edges(spans, _cents=F.col("monthly_cents"), _rows=one, **{f"_{t}": of_tier(t) for t in tiers})
    daily = running([cents, edges(islands(spans, "subscription_id"), active_subscriptions=one), edges(islands(spans, "customer_id"), paying_customers=one)])
    by_day = daily.filter("_rows > 0").withColumn("days_in_month", S.days_in_month(F.col("date_day")))
    share = lambda c: F.col(c).cast("double") / F.col("days_in_month")
    out = by_day.select(
        "date_day",
        "days_in_month",
        "active_subscriptions",
        "paying_customers",
        share("_cents").alias("daily_mrr_cents"),
        (share("_cents") * F.col("days_in_month")).alias("mrr_cents"),
        *((share(f"_{t}") * F.col("days_in_month")).alias(f"mrr_{t}_cents") for t in tiers),
    )
    return (
        out.withColumn("prev_mrr_cents", moved("mrr_cents"))
        .withColumn("mrr_change_cents", F.col("mrr_cents") - F.col("prev_mrr_cents"))
        .withColumn("prev_active_subscriptions", moved("active_subscriptions"))
        .withColumn("subscription_change", F.col("active_subscriptions") - F.col("prev_active_subscriptions"))
        .withColumn("arpa_cents", F.col("mrr_cents") / F.nullif(F.col("active_subscriptions"), F.lit(0)))
        .withColumn("year_month", F.date_format("date_day", "yyyy-MM"))
        .withColumn("date_key", S.date_key(F.col("date_day")))
    )


def fct_cohort_retention(customers: DataFrame, periods: DataFrame, run_as_of) -> DataFrame:
    """Share of each signup month's customers that earn in each later month; months that a cohort cannot have seen are no rows."""
    last = F.lit(run_as_of).cast("date")
    cohort = customers.select("customer_id", F.to_date(F.date_trunc("month", "created_at")).alias("cohort_month"))
    sizes = cohort.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size")).withColumn("months_observable", S.month_diff(F.col("cohort_month"), last))
    # The months in which a customer earns are bits of a mask, united by customer: no row for each month, no distinct count.
    month = lambda c: F.year(c) * 12 + F.month(c) - 1
    earning = bounded(periods.filter("can_earn_revenue").select("customer_id", "revenue_from", "valid_to"), "revenue_from", "valid_to", last)
    active = masks(interval_mask(earning, month(F.col("_begin")), month(F.col("_stop"))), "customer_id")
    since = F.col("_month") - month(F.col("cohort_month"))
    kept = numbers(active.join(cohort.distinct(), "customer_id"), "_month").withColumn("period_number", since.cast("int")).filter("period_number >= 0")
    retained = kept.groupBy("cohort_month", "period_number").agg(F.count("*").alias("retained_customers"))
    return sizes.join(retained, "cohort_month").filter("period_number <= months_observable").select(
        S.surrogate_key(F.col("cohort_month"), F.col("period_number")).alias("cohort_period_key"),
        "cohort_month",
        "period_number",
        "cohort_size",
        "retained_customers",
        S.percent(F.col("retained_customers"), F.col("cohort_size")).alias("retention_pct"),
        "months_observable",
        (F.col("period_number") <= F.col("months_observable")).alias("is_complete_period"),
    )


_REVENUE = ["order_count", "customer_count", "gross_revenue_usd_cents", "refunded_usd_cents", "net_revenue_usd_cents"]


def daily_revenue(payments: DataFrame) -> DataFrame:
    """Successful payments by order date."""
    return payments.filter("is_successful").groupBy(F.col("order_date").alias("date_day")).agg(
        F.count("*").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("gross_amount_usd_cents").alias("gross_revenue_usd_cents"),
        F.sum("refunded_amount_usd_cents").alias("refunded_usd_cents"),
        F.sum("net_amount_usd_cents").alias("net_revenue_usd_cents"),
    )


def fct_revenue_rolling(spine: DataFrame, actuals: DataFrame) -> DataFrame:
    """Rolling revenue over a calendar without holes: days are filled first, and only then counted back.

    ``spine`` is :func:`dim_date` cut to the days from the first order to the run; windows run over days only.
    """
    net = "net_revenue_usd_cents"
    filled = gap_fill(spine, actuals, "date_day", _REVENUE)
    ago = F.col("net_usd_cents_7d_ago")
    return (
        filled.withColumn("rolling_7d_net_usd_cents", rolling(F.sum, net, 7))
        .withColumn("rolling_7d_avg_net_usd_cents", rolling(F.avg, net, 7))
        .withColumn("rolling_28d_net_usd_cents", rolling(F.sum, net, 28))
        .withColumn("rolling_7d_order_count", rolling(F.sum, "order_count", 7))
        .withColumn("net_usd_cents_7d_ago", moved(net, 7))
        .withColumn("wow_change_pct", F.when(ago != 0, S.percent(F.col(net) - ago, ago)))
    )


def spine_between(calendar: DataFrame, first, last) -> DataFrame:
    return calendar.filter(F.col("date_day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def mrr_from_state(subscriptions: DataFrame, dim_plan_: DataFrame, run_as_of, days: int = 30) -> DataFrame:
    """Daily MRR of the last ``days`` days from the current subscriptions alone: a second path that shares no step with the event log."""
    last = F.lit(run_as_of).cast("date")
    live = subscriptions.filter("subscription_status in ('active', 'cancelled', 'expired')").withColumn("_from", F.coalesce("trial_ends_at", "started_at"))
    spread = interval_days(live.select("subscription_id", "plan_id", "_from", "ended_at"), "_from", "ended_at", last, F.date_sub(last, days - 1))
    return spread.join(dim_plan_.select("plan_id", "monthly_cents"), "plan_id").groupBy("date_day").agg(F.sum(F.col("monthly_cents").cast("double")).alias("mrr_cents"))

"""Parameterised queries over the marts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.operators.windows import rolling

LONGEST_DAYS = 1830
GRANULARITIES = ("day", "week", "month")
TIMELINE = ["occurred_at", "event_category", "event_type", "reference_id", "amount_cents", "currency_code", "detail"]


def date_range(first: date | None, last: date | None, today: date, default_days: int = 90) -> tuple[date, date]:
    """The asked range; without an end it ends today, without a begin it spans ``default_days``."""
    last = last or today
    first = first or last - timedelta(days=default_days)
    if first > last:
        raise ValueError("the range begins after it ends")
    if (last - first).days > LONGEST_DAYS:
        raise ValueError(f"a range spans {LONGEST_DAYS} days at most")
    return first, last


def mrr(daily: DataFrame, first: date, last: date, granularity: str = "day") -> DataFrame:
    """MRR by bucket: a stock, so its average in the bucket, while changes are flows and add up."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity is one of {', '.join(GRANULARITIES)}")
    return (
        daily.filter(F.col("date_day").between(F.lit(first), F.lit(last)))
        .groupBy(F.to_date(F.date_trunc(granularity, "date_day")).alias("period"))
        .agg(
            F.round(F.avg("mrr_cents"), 6).alias("mrr_cents"),
            F.round(F.sum("mrr_change_cents"), 6).alias("mrr_change_cents"),
            F.round(F.avg("active_subscriptions"), 6).alias("active_subscriptions"),
        )
    )


def cohorts(retention: DataFrame, first: date, last: date, max_periods: int = 12) -> tuple[DataFrame, DataFrame]:
    """(cells of the asked cohorts, cohorts too young to have all the asked periods)."""
    if not 1 <= max_periods <= 36:
        raise ValueError("max_periods is from 1 to 36")
    asked = retention.filter(F.col("cohort_month").between(F.lit(first), F.lit(last)))
    young = asked.filter(F.col("months_observable") < max_periods).select("cohort_month", "months_observable").distinct()
    return asked.filter(F.col("period_number") <= max_periods), young


def rolling_revenue(daily: DataFrame, first: date, last: date, window: int = 7, partial: bool = False) -> DataFrame:
    """Rolling net revenue over any window from 1 to 90 days of the gap-filled mart.

    The window is taken before the range is cut, so the first days are whole; ``partial`` cuts first.
    """
    if not 1 <= window <= 90:
        raise ValueError("window is from 1 to 90")
    inside = F.col("date_day").between(F.lit(first), F.lit(last))
    base = daily.filter(inside) if partial else daily
    out = base.select("date_day", "net_revenue_usd_cents", "is_gap_filled_day", rolling(F.sum, "net_revenue_usd_cents", window).alias("rolling_net_usd_cents"))
    return out.filter(inside)


def timeline(orders: DataFrame, payments: DataFrame, refunds: DataFrame, events: DataFrame) -> DataFrame:
    """Four facts in one shape, with ``customer_id``; refunds need it joined in by the caller."""

    def shape(df: DataFrame, category: str, at: str, kind, ref: str, amount, currency, detail) -> DataFrame:
        values = (F.col(at).cast("timestamp"), F.lit(category), kind, F.col(ref).cast("string"), amount, currency, detail)
        return df.select("customer_id", *(v.alias(n) for v, n in zip(values, TIMELINE, strict=True)))

    none, amount = F.lit(None).cast("string"), lambda c: F.col(c).cast("long")
    return (
        shape(orders, "order", "placed_at_utc", F.col("order_status"), "order_id", amount("amount_cents"), F.col("currency_code"), F.col("order_channel"))
        .unionByName(shape(payments, "payment", "processed_at", F.col("payment_status"), "payment_id", amount("gross_amount_cents"), none, F.col("payment_method")))
        .unionByName(shape(refunds, "refund", "issued_at", F.lit("refund"), "refund_id", amount("refund_amount_cents"), none, F.col("refund_reason")))
        .unionByName(shape(events, "subscription", "occurred_at", F.col("event_type"), "subscription_event_id", amount("mrr_delta_cents"), none, F.col("to_plan_code")))
    )


def timeline_page(events: DataFrame, customer_id, limit: int = 50, cursor: tuple | None = None) -> DataFrame:
    """A page of one customer's timeline, newest first, and whether more follows.

    ``cursor`` is (occurred_at, reference_id) of the last row seen; pages join without gaps or repeats, also where moments are equal.
    """
    at = F.struct("occurred_at", "reference_id")
    own = events.filter((F.col("customer_id") == customer_id) & F.col("occurred_at").isNotNull())
    if cursor is not None:
        own = own.filter(at < F.struct(F.lit(cursor[0]).cast("timestamp").alias("occurred_at"), F.lit(cursor[1]).cast("string").alias("reference_id")))
    # One row beyond the page tells whether more follows.
    page = own.orderBy(F.col("occurred_at").desc(), F.col("reference_id").desc()).limit(limit + 1)
    from pyspark.sql import Window

    n = F.row_number().over(Window.orderBy(F.col("occurred_at").desc(), F.col("reference_id").desc()))
    numbered = page.withColumn("_n", n).withColumn("has_more", F.count("*").over(Window.partitionBy()) > limit)
    return numbered.filter(F.col("_n") <= limit).select(*TIMELINE, "has_more")


def customer_exists(customers: DataFrame, customer_id) -> bool:
    return not customers.filter(F.col("customer_id") == customer_id).limit(1).isEmpty()


def data_freshness(payments: DataFrame, run_as_of, stale_hours: float = 26) -> DataFrame:
    """(newest, age_hours, is_stale) of the payments' ingestion."""
    age = (F.unix_timestamp(F.lit(run_as_of).cast("timestamp")) - F.unix_timestamp("newest")) / 3600.0
    return payments.agg(F.max("_ingested_at").alias("newest")).withColumn("age_hours", age).withColumn("is_stale", F.coalesce(F.col("age_hours") > stale_hours, F.lit(True)))


def lag_histogram(df: DataFrame, column: str = "refund_lag_days", lookback_days: int = 21) -> DataFrame:
    """Rows by days of lag, with the headroom that the lookback leaves."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("lag_days")).agg(F.count("*").alias("n")).withColumn("headroom_days", F.lit(lookback_days) - F.col("lag_days"))


def dimension_overview(dim_customer: DataFrame) -> DataFrame:
    """(customers, versions, current, relocated) of the customer dimension."""
    return dim_customer.agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count("*").alias("versions"),
        F.count_if("is_current").alias("current"),
        F.count_distinct(F.when(F.col("has_relocated"), F.col("customer_id"))).alias("relocated"),
    )


def quality_series(observations: DataFrame, run_as_of, days: int = 14) -> DataFrame:
    now = F.lit(run_as_of).cast("timestamp")
    return observations.filter((F.col("observed_at") > now - F.expr(f"interval {days} days")) & (F.col("observed_at") <= now)).groupBy(F.to_date("observed_at").alias("day"), "metric").agg(F.avg("value").alias("value"))


def recent(df: DataFrame, at: str, n: int = 20, tie: str | None = None) -> DataFrame:
    """The n newest rows; ``tie`` orders rows of one moment."""
    return df.orderBy(F.col(at).desc(), *([F.col(tie).desc()] if tie else [])).limit(n)

"""Staging: one row a key from one raw table, typed, trimmed and named; no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import scalars as S
from lodestream.operators.changelog import deletion_flags, latest
from lodestream.sources.raw import raw_column

_META = ["_op", "_lsn", "_ingested_at", "_source_ts"]


def _ts(name: str):
    return F.col(name).cast("timestamp").alias(name)


def customers(raw: DataFrame) -> DataFrame:
    """Deleted customers stay, flagged: their orders still need them."""
    zone = S.blank_to_null(F.col("timezone"))
    now = deletion_flags(latest(raw, "id", include_deletes=True))
    return now.select(
        F.col("id").cast("string").alias("customer_id"),
        S.normalised_text(F.col("email")).alias("email"),
        F.trim("name").alias("customer_name"),
        F.upper(F.trim("country_code")).alias("country_code"),
        F.coalesce(zone, F.lit("UTC")).alias("timezone"),
        F.coalesce(zone != "UTC", F.lit(False)).alias("has_explicit_timezone"),
        *map(_ts, ("created_at", "updated_at", "deleted_at")),
        "is_deleted",
        "is_hard_deleted",
        *_META,
    )


def orders(raw: DataFrame) -> DataFrame:
    channel = S.blank_to_null(raw_column(raw, "channel").cast("string"))
    return latest(raw, "id").select(
        F.col("id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string"),
        F.col("subscription_id").cast("string"),
        F.col("amount_cents").cast("long"),
        F.upper(F.trim("currency")).alias("currency_code"),
        S.normalise_order_status(F.col("status")).alias("order_status"),
        F.trim("status").alias("order_status_raw"),
        S.is_unrecognised_status(F.col("status")).alias("has_unrecognised_status"),
        _ts("placed_at"),
        "placed_at_local",
        (F.col("placed_at").isNull() & F.col("placed_at_local").isNotNull()).alias("is_legacy_client_order"),
        _ts("updated_at"),
        F.coalesce(channel, F.lit("unknown")).alias("order_channel"),
        *_META,
    )


def payments(raw: DataFrame) -> DataFrame:
    status = S.normalised_text(F.col("status"))
    return latest(raw, "id").select(
        F.col("id").cast("string").alias("payment_id"),
        F.col("order_id").cast("string"),
        F.col("amount_cents").cast("long"),
        S.normalised_text(F.col("method")).alias("payment_method"),
        status.alias("payment_status"),
        *map(_ts, ("processed_at", "created_at", "updated_at")),
        (status == "succeeded").alias("is_successful"),
        (status == "pending").alias("is_pending"),
        *_META,
    )


def refunds(raw: DataFrame) -> DataFrame:
    return latest(raw, "id").select(
        F.col("id").cast("string").alias("refund_id"),
        F.col("payment_id").cast("string"),
        F.col("amount_cents").cast("long").alias("refund_amount_cents"),
        S.blank_to_null(F.col("reason")).alias("refund_reason"),
        *map(_ts, ("issued_at", "created_at")),
        F.datediff("_ingested_at", "created_at").alias("ingestion_lag_days"),
        *_META,
    )


def plans(raw: DataFrame) -> DataFrame:
    """A handful of rows: the price rank orders them in one task. Equal prices rank by id."""
    return latest(raw, "id").select(
        F.col("id").cast("int").alias("plan_id"),
        F.trim("code").alias("plan_code"),
        F.col("monthly_cents").cast("long"),
        F.upper(F.trim("currency")).alias("currency_code"),
        F.col("active").cast("boolean").alias("is_active"),
        F.row_number().over(Window.orderBy(F.col("monthly_cents"), F.col("id"))).alias("price_rank"),
        "_ingested_at",
    )


def subscriptions(raw: DataFrame) -> DataFrame:
    status = S.normalised_text(F.col("status"))
    return latest(raw, "id").select(
        F.col("id").cast("string").alias("subscription_id"),
        F.col("customer_id").cast("string"),
        F.col("plan_id").cast("int"),
        status.alias("subscription_status"),
        *map(_ts, ("started_at", "ended_at", "trial_ends_at", "updated_at")),
        status.isin("trialing", "active", "paused").alias("is_live"),
        (status == "trialing").alias("is_trialing"),
        *_META,
    )


def subscription_events(raw: DataFrame, include_deletes: bool = False) -> DataFrame:
    kind = S.normalised_text(F.col("event_type"))
    return latest(raw, "id", include_deletes).select(
        F.col("id").cast("long").alias("subscription_event_id"),
        F.col("subscription_id").cast("string"),
        kind.alias("event_type"),
        F.col("from_plan_id").cast("int"),
        F.col("to_plan_id").cast("int"),
        *map(_ts, ("occurred_at", "created_at")),
        kind.isin("created", "resumed").alias("starts_revenue"),
        kind.isin("cancelled", "paused", "expired").alias("stops_revenue"),
        kind.isin("upgraded", "downgraded").alias("changes_revenue"),
        *_META,
    )

"""Data checks. Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions.scalars import CURRENCIES, minute_diff
from lodestream.operators.incremental import LOOKBACK_DAYS
from lodestream.operators.joins import orphans


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with their number; rows with a null in one of the columns are left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: tuple) -> DataFrame:
    return df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return orphans(child, column, parent, field)


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; unknown is not false."""
    return df.filter(~F.expr(expression))


def not_null_where(df: DataFrame, column: str, condition: str) -> DataFrame:
    return df.filter(F.expr(condition) & F.col(column).isNull())


def between(df: DataFrame, column: str, low, high, where: str = "true") -> DataFrame:
    return df.filter(F.expr(where) & ((F.col(column) < low) | (F.col(column) > high)))


def _with_next(df: DataFrame, key: str, valid_from: str) -> DataFrame:
    return df.withColumn("next_valid_from", F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from)))


def scd2_overlaps(df: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions that end after the next one of their key begins; an open end is the far future."""
    return _with_next(df, key, valid_from).filter(F.col("next_valid_from").isNotNull() & (F.col(valid_to).isNull() | (F.col("next_valid_from") < F.col(valid_to))))


def scd2_overlaps_or_gaps(df: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions whose end is not where the next one begins, named overlap or gap."""
    found = _with_next(df, key, valid_from).filter("next_valid_from is not null")
    kind = F.when(F.col(valid_to).isNull() | (F.col("next_valid_from") < F.col(valid_to)), "overlap").when(F.col("next_valid_from") > F.col(valid_to), "gap")
    return found.withColumn("problem", kind).filter("problem is not null")


def scd2_one_current(df: DataFrame, key: str, flag: str = "is_current") -> DataFrame:
    """Keys with more than one current version, or none."""
    return df.groupBy(key).agg(F.count_if(flag).alias("current_versions")).filter("current_versions <> 1")


def scd2_many_current(df: DataFrame, key: str, flag: str = "is_current") -> DataFrame:
    """Keys with more than one current version; the generic form, which a key without any passes."""
    return df.filter(flag).groupBy(key).agg(F.count("*").alias("current_versions")).filter("current_versions > 1")


def rowcount_matches(df: DataFrame, other: DataFrame | None = None, tolerance: float = 0.0, where: str = "true") -> DataFrame:
    """One row if the counts differ by more than ``tolerance`` of the other's. Without ``other``, the rows of ``df`` for
    which ``where`` holds are counted against all of it, in one pass."""
    if other is None:
        both = df.agg(F.count_if(F.expr(where)).alias("model_rows"), F.count("*").alias("source_rows"))
    else:
        both = df.filter(where).agg(F.count("*").alias("model_rows")).crossJoin(other.agg(F.count("*").alias("source_rows")))
    delta = F.abs(F.col("model_rows") - F.col("source_rows"))
    return both.withColumn("delta", delta).filter(F.col("delta") > F.lit(float(tolerance)) * F.col("source_rows"))


def parents_without(parent: DataFrame, key: str, child: DataFrame, child_key: str) -> DataFrame:
    """Rows of ``parent`` for which the (filtered) child has none."""
    return parent.join(child.select(F.col(child_key).alias("_child")), F.col(key) == F.col("_child"), "left_anti")


def completed_without_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return parents_without(orders.filter("order_status = 'completed'"), "order_id", payments.filter("is_successful"), "order_id")


def missing_fx_rate(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("currency_code") != "USD") & F.col("rate_to_usd").isNull())


def unknown_currency(orders: DataFrame) -> DataFrame:
    return accepted_values(orders, "currency_code", CURRENCIES)


def unresolved_customer_version(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """Orders without a customer version, with the begin of the customer's first one."""
    first = versions.groupBy("customer_id").agg(F.min("valid_from").alias("earliest_version"))
    return orders.filter("customer_key is null").join(first, "customer_id", "left")


def fact_against_staging(fact: DataFrame, staging: DataFrame) -> DataFrame:
    """One row with both counts and the likely cause, if they differ."""
    n, m = fact.agg(F.count("*").alias("fact_rows")), staging.agg(F.count("*").alias("staging_rows"))
    cause = F.when(F.col("fact_rows") > F.col("staging_rows"), "fan-out: a join multiplied rows").otherwise("loss: a join or filter dropped rows")
    return n.crossJoin(m).filter("fact_rows <> staging_rows").withColumn("likely_cause", cause)


def absurd_mrr(daily: DataFrame, most: float = 0.4, floor: int = 100_000) -> DataFrame:
    """Days with negative MRR, or one that moved by more than ``most`` from a day at or above ``floor`` cents."""
    before = daily.withColumn("_before", F.lag("mrr_cents").over(Window.orderBy("date_day")))
    jump = (F.col("_before") >= floor) & (F.abs(F.col("mrr_cents") - F.col("_before")) > F.lit(most) * F.col("_before"))
    reason = F.when(F.col("mrr_cents") < 0, "negative").when(jump, "jump")
    return before.withColumn("reason", reason).filter("reason is not null").withColumnRenamed("_before", "before_cents")


def mrr_against_billed(daily: DataFrame, payments: DataFrame, run_as_of, tolerance: float = 0.025, months: int = 6) -> DataFrame:
    """One row if average MRR and successful payments, both summed over the trailing full months, differ by more than ``tolerance``."""
    end = F.trunc(F.lit(run_as_of).cast("date"), "month")
    start = F.add_months(end, -months)
    inside = lambda c: (F.col(c) >= start) & (F.col(c) < end)
    earned = daily.filter(inside("date_day")).groupBy(F.trunc("date_day", "month").alias("month")).agg(F.avg("mrr_cents").alias("mrr"))
    billed = payments.filter("is_successful").filter(inside("order_date")).groupBy(F.trunc("order_date", "month").alias("month")).agg(F.sum("gross_amount_usd_cents").alias("billed"))
    both = earned.join(billed, "month").agg(F.sum("mrr").alias("mrr_cents"), F.sum("billed").cast("double").alias("billed_cents"))
    return both.withColumn("drift", F.abs(F.col("mrr_cents") - F.col("billed_cents")) / F.nullif(F.col("billed_cents"), F.lit(0.0))).filter(F.col("drift") > tolerance)


def mrr_against_state(daily: DataFrame, state_daily: DataFrame, run_as_of, tolerance: float = 0.005, days: int = 7) -> DataFrame:
    """One row if MRR from the event log and from the current subscriptions differ by more than ``tolerance`` over the trailing days."""
    inside = (F.col("date_day") > F.date_sub(F.lit(run_as_of).cast("date"), days)) & (F.col("date_day") <= F.lit(run_as_of).cast("date"))
    both = daily.filter(inside).select("date_day", F.col("mrr_cents").alias("log")).join(state_daily.filter(inside).select("date_day", F.col("mrr_cents").alias("state")), "date_day")
    total = both.agg(F.sum("log").alias("log_cents"), F.sum("state").alias("state_cents"))
    return total.withColumn("drift", F.abs(F.col("log_cents") - F.col("state_cents")) / F.nullif(F.col("state_cents"), F.lit(0.0))).filter(F.col("drift") > tolerance)


def deleted_events(latest_with_deletes: DataFrame) -> DataFrame:
    """Lifecycle events that somebody deleted; the input must still hold the delete rows."""
    return latest_with_deletes.filter("_op = 'd'")


def future_dated(orders: DataFrame, run_as_of, column: str = "placed_at_utc", grace_minutes: int = 5) -> DataFrame:
    return orders.filter(minute_diff(F.lit(run_as_of).cast("timestamp"), F.col(column)) > grace_minutes)


def late_beyond_lookback(df: DataFrame, column: str = "ingestion_lag_days", days: int = LOOKBACK_DAYS) -> DataFrame:
    return df.filter(F.col(column) > days)


def refund_exceeds_payment(payments: DataFrame) -> DataFrame:
    return payments.filter("refunded_amount_cents > amount_cents")


def freshness(tables: Mapping[str, DataFrame], run_as_of, warn_hours: float = 2, error_hours: float = 6, exempt: tuple[str, ...] = ("plans",), column: str = "_ingested_at") -> DataFrame:
    """(table, newest, age_hours, status) of each table."""
    out = None
    now = F.lit(run_as_of).cast("timestamp")
    for name, df in tables.items():
        age = (F.unix_timestamp(now) - F.unix_timestamp("newest")) / 3600.0
        status = F.lit("exempt") if name in exempt else F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")
        row = df.agg(F.max(F.col(column).cast("timestamp")).alias("newest")).select(F.lit(name).alias("table"), "newest", age.alias("age_hours")).withColumn("status", status)
        out = row if out is None else out.unionByName(row)
    return out


def rowcount_drift(pairs: Mapping[str, tuple[DataFrame, DataFrame]], most: float = 0.02) -> DataFrame:
    """(name, source_rows, model_rows, drift, exceeds) of each pair of source and model."""
    out = None
    for name, (source, model) in pairs.items():
        row = source.agg(F.count("*").alias("source_rows")).crossJoin(model.agg(F.count("*").alias("model_rows")))
        row = row.select(F.lit(name).alias("name"), "source_rows", "model_rows", F.abs(F.col("source_rows") - F.col("model_rows")).cast("double").alias("_d"))
        row = row.withColumn("drift", F.col("_d") / F.nullif(F.col("source_rows").cast("double"), F.lit(0.0))).drop("_d").withColumn("exceeds", F.coalesce(F.col("drift") > most, F.col("model_rows") > 0))
        out = row if out is None else out.unionByName(row)
    return out


def run_suite(checks: Mapping[str, Callable[[], DataFrame]], store: str | None = None) -> dict[str, int]:
    """Failing rows of each check; with ``store``, they are kept as Parquet under that path, one folder a check."""
    out = {}
    for name, check in checks.items():
        failing = check()
        if store is None:
            out[name] = failing.count()
        else:
            failing.write.mode("overwrite").parquet(f"{store}/{name}")
            out[name] = failing.sparkSession.read.parquet(f"{store}/{name}").count()
    return out


def pass_rate(results: DataFrame, failures: str = "failing_rows") -> DataFrame:
    return results.agg(F.count("*").alias("checks"), F.count_if(F.col(failures) == 0).alias("passed")).withColumn("pass_rate", F.round(F.col("passed") / F.col("checks"), 4))


def pattern_coverage(orders_raw: DataFrame, customers_log: DataFrame, orders: DataFrame, customers: DataFrame, refunds: DataFrame, payments: DataFrame, events: DataFrame) -> DataFrame:
    """(pattern, n) of the ten sorts of mess that a source must show, so that no check passes over nothing.

    Each table is read once and gives all its counts; one join finds the orders of deleted customers, one aggregate the relocations.
    """
    deleted = customers.filter("is_deleted").select("customer_id", F.lit(True).alias("_deleted")).distinct()
    relocated = customers_log.groupBy("id").agg((F.min("country_code") < F.max("country_code")).alias("moved"))
    lag = F.col("refund_lag_days")
    counts = [
        (orders_raw, {"legacy_status_spelling": F.lower(F.trim("status")).isin("paid", "complete", "canceled")}),
        (customers, {"soft_deleted_customer": F.col("is_deleted")}),
        (
            orders.join(deleted, "customer_id", "left"),
            {"soft_deleted_customer_with_orders": F.col("_deleted"), "naive_local_time": F.col("is_legacy_client_order"), "non_usd_order": F.col("currency_code") != "USD"},
        ),
        (payments, {"refund_later_than_7_days": lag > 7, "refund_later_than_14_days": lag > 14, "pending_payment_without_time": F.col("is_pending") & F.col("processed_at").isNull()}),
        (events, {"plan_change": F.col("changes_revenue")}),
        (relocated, {"relocation": F.col("moved")}),
    ]
    out = None
    for df, found in counts:
        pairs = F.array(*(F.struct(F.lit(name).alias("pattern"), F.count_if(rule).alias("n")) for name, rule in found.items()))
        rows = df.agg(pairs.alias("_p")).select(F.explode("_p").alias("_p")).select("_p.*")
        out = rows if out is None else out.union(rows)
    return out


def alerts(progress: DataFrame) -> DataFrame:
    """(table, alert) for rows of (table, lag_records, lag_minutes, halted, seconds_since_flush, dead_letters, dead_letters_before)."""
    rules: dict[str, Column] = {
        "lag": (F.col("lag_records") > 100_000) & (F.col("lag_minutes") >= 10),
        "halted": F.col("halted"),
        "no_flush": F.col("seconds_since_flush") > 900,
        "dead_letters_grow": F.col("dead_letters") > F.col("dead_letters_before"),
    }
    raised = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return progress.select("table", F.explode(raised).alias("alert"))


OBSERVATION = "observed_at timestamp, metric string, subject string, value double, payload string"


def observe(spark: SparkSession, table: str, rows: list[tuple] | DataFrame, observed_at) -> None:
    """Append (metric, subject, value, payload) observations of one moment to the quality series, a table or, with a slash in its name, a folder."""
    if isinstance(rows, DataFrame):
        series = rows.select(F.lit(observed_at).cast("timestamp").alias("observed_at"), "metric", "subject", F.col("value").cast("double"), F.col("payload").cast("string"))
    else:
        series = spark.createDataFrame([(observed_at, *r) for r in rows], OBSERVATION)
    writer = series.write.mode("append").format("parquet")
    writer.save(table) if "/" in table else writer.saveAsTable(table)

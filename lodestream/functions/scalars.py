"""Column functions of the business rules. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The accepted vocabularies and the old spellings of order statuses.
ORDER_STATUSES = ("completed", "pending", "cancelled", "refunded")
ORDER_STATUS_SPELLINGS = {"paid": "completed", "complete": "completed", "canceled": "cancelled"}
SUBSCRIPTION_STATUSES = ("trialing", "active", "paused", "cancelled", "expired")
PAYMENT_STATUSES = ("succeeded", "pending", "failed")
EVENT_TYPES = ("created", "upgraded", "downgraded", "paused", "resumed", "cancelled", "expired")
CURRENCIES = ("USD", "EUR", "GBP")
#: The first month of the fiscal year.
FISCAL_START = 2


def normalised_text(c: Column) -> Column:
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def normalise_order_status(c: Column) -> Column:
    """Canonical order status; whatever is not known, a null included, is 'unknown'."""
    low = normalised_text(c)
    out = F.when(low.isin(*ORDER_STATUSES), low)
    for old, new in ORDER_STATUS_SPELLINGS.items():
        out = out.when(low == old, F.lit(new))
    return out.otherwise(F.lit("unknown"))


def is_unrecognised_status(c: Column) -> Column:
    """Whether a status is neither canonical nor an old spelling; null for null."""
    return ~normalised_text(c).isin(*ORDER_STATUSES, *ORDER_STATUS_SPELLINGS)


def to_usd_cents(amount: Column, currency: Column, rate: Column) -> Column:
    """Cents in USD; ``rate`` is units of the currency for one USD. A missing or zero rate gives null, save for USD itself."""
    converted = amount.cast("double") / F.nullif(rate.cast("double"), F.lit(0.0))
    return F.round(F.when(currency == "USD", amount.cast("double")).otherwise(converted)).cast("long")


def resolve_utc(stated: Column, local: Column, zone: Column, later: bool = False) -> Column:
    """The stated instant, or else the local wall-clock text read in ``zone``; an unknown zone counts as UTC.

    A local time that a clock change skips is moved forward. One that occurs twice is read as the earlier instant, or with
    ``later`` as the later one, as SQL's AT TIME ZONE reads it.
    """
    wall, at = F.to_timestamp(local), F.coalesce(zone, F.lit("UTC"))
    first = F.to_utc_timestamp(wall, at)
    if later:
        # The wall clock by the offset of a day later: another instant of the same wall clock, or none.
        day = F.expr("interval 24 hours")
        second = F.to_utc_timestamp(wall + day, at) - day
        first = F.when(F.from_utc_timestamp(second, at) == wall, F.greatest(first, second)).otherwise(first)
    return F.coalesce(stated, first)


def date_key(c: Column) -> Column:
    """The surrogate key of a day: the value is cast to a date first, so a timestamp and its day agree."""
    return F.md5(F.to_date(c).cast("string"))


def surrogate_key(*columns: Column) -> Column:
    """md5 over the columns as text; a null differs from every text in practice."""
    return F.md5(F.concat_ws("-", *(F.coalesce(c.cast("string"), F.lit("_null_")) for c in columns)))


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def month_diff(start: Column, end: Column) -> Column:
    """Month boundaries between two dates."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def minute_diff(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps."""
    floor = lambda c: F.floor(F.unix_timestamp(c) / 60)
    return floor(end) - floor(start)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """part in percent of whole, null for a whole of zero."""
    return F.round(part * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def fiscal_year(c: Column, start: int = FISCAL_START) -> Column:
    return F.year(c) - (F.month(c) < start).cast("int")


def fiscal_month(c: Column, start: int = FISCAL_START) -> Column:
    return F.pmod(F.month(c) - start, F.lit(12)) + 1


def fiscal_quarter(c: Column, start: int = FISCAL_START) -> Column:
    return F.floor((fiscal_month(c, start) - 1) / 3).cast("int") + 1


def plan_tier(code: Column, monthly_cents: Column) -> Column:
    return F.when(code == "legacy_starter", "legacy").when(monthly_cents < 2500, "entry").when(monthly_cents < 10000, "mid").otherwise("top")

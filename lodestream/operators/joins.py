"""Joins over intervals and calendars that plan as equi-joins."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: The grains of as-of joins, finest first: each gives a number that grows with time.
_GRAINS = {
    "day": lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")),
    "month": lambda c: F.year(c) * 12 + F.month(c),
    "year": lambda c: F.year(c),
}


def asof_join(fact: DataFrame, versions: DataFrame, on: str | list[str], at: str, valid_from: str = "valid_from", valid_to: str = "valid_to", columns: list[str] | None = None, grain: str = "month", last: Any = None) -> DataFrame:
    """Each fact row with the version of its key whose half-open interval holds ``at``; an open end is null.

    Rows meet by key and calendar ``grain``: a version is repeated for each month, say, that it touches, so a key with
    very many facts and versions is spread over months, and a fact meets only its own month's versions. Months after the
    last begin or end of any version are one, so open ends stay short. Facts without a version stay, with nulls; versions that end before they
    begin match nothing. ``columns`` are the version's columns to keep; they must not clash with fact's. ``last``, a moment that no version
    begins or ends after, saves the job that looks for it.
    """
    keys = [on] if isinstance(on, str) else on
    keep = [c for c in versions.columns if c not in keys] if columns is None else columns
    number = _GRAINS[grain]
    found = versions.agg(F.max(F.greatest(valid_from, F.coalesce(valid_to, valid_from))).alias("_last")) if last is None else versions.sparkSession.range(1).select(F.lit(last).alias("_last"))
    last = found.select(number(F.col("_last"))).first()[0]
    clamp = lambda c: F.least(number(c), F.lit(last).cast("int"))
    whole = versions.filter(F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))))
    right = whole.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        *(F.col(c) for c in keep),
        F.explode(F.sequence(clamp(F.col(valid_from)), F.coalesce(clamp(F.col(valid_to)), F.lit(last).cast("int")))).alias("_v_grain"),
    )
    inside = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    left = fact.withColumn("_f_grain", clamp(F.col(at)))
    same = [left[k] == right[f"_k_{k}"] for k in keys]
    # Sizes are guessed before versions are repeated: a guess that calls for a broadcast could fill the driver.
    joined = left.join(right.hint("merge"), [*same, left["_f_grain"] == right["_v_grain"], inside], "left")
    return joined.drop(*(f"_k_{k}" for k in keys), "_from", "_to", "_f_grain", "_v_grain")


def asof_carry(fact: DataFrame, versions: DataFrame, on: str | list[str], at: str, valid_from: str = "valid_from", valid_to: str = "valid_to", columns: list[str] | None = None, grain: str = "month") -> DataFrame:
    """:func:`asof_join` where a key's versions do not overlap: both sides are sorted into one sequence, which carries the last version begun to each fact.

    Keys are cut by calendar ``grain``, so one with very many facts or versions is spread over months: a version travels
    once, and once more for each month with facts that it is carried into. No job runs while the query is planned. Of
    versions that begin at one moment the one that ends last counts. Facts without a version stay, with nulls.
    """
    keys = [on] if isinstance(on, str) else on
    keep = [c for c in versions.columns if c not in keys] if columns is None else columns
    number, names = _GRAINS[grain], [f"_k{i}" for i in range(len(keys))]
    whole = versions.filter(F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))))
    for k in keys:
        whole = whole.filter(F.col(k).isNotNull())
    # Open ends rank above all others.
    version = F.struct(F.col(valid_from).alias("from"), F.col(valid_to).isNull().alias("open"), F.col(valid_to).alias("to"), F.struct(*keep).alias("kept"))
    begun = whole.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), number(F.col(valid_from)).alias("_piece"), version.alias("_version"))
    facts = fact.withColumns({n: F.col(k) for k, n in zip(keys, names, strict=True)} | {"_piece": number(F.col(at))})
    last = begun.groupBy(*names, "_piece").agg(F.max_by("_version", F.struct("_version.from", "_version.open", "_version.to")).alias("_last"))
    met = facts.filter(F.col("_piece").isNotNull()).select(*names, "_piece").distinct()
    for n in names:
        met = met.filter(F.col(n).isNotNull())
    # One row for each key and month that has facts or versions.
    pieces = met.withColumn("_asked", F.lit(True)).join(last, [*names, "_piece"], "full")
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*names).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    carried = pieces.withColumn("_carried", before).filter("_asked and _carried is not null").select(*names, "_piece", F.col("_carried").alias("_version"))
    row = F.struct(*(F.col(c) for c in fact.columns))
    sequence = (
        begun.unionByName(carried)
        .select(*names, "_piece", F.col("_version.from").alias("_time"), F.lit(0).alias("_kind"), F.struct("_version.open", "_version.to").alias("_tie"), "_version", F.lit(None).cast(fact.schema).alias("_fact"))
        .unionByName(facts.select(*names, "_piece", F.col(at).cast(versions.schema[valid_from].dataType).alias("_time"), F.lit(1).alias("_kind"), row.alias("_fact")), allowMissingColumns=True)
    )
    now = Window.partitionBy(*names, "_piece").orderBy("_time", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = sequence.withColumn("_met", F.last("_version", ignorenulls=True).over(now)).filter("_kind = 1")
    holds = F.col("_met").isNotNull() & (F.col("_time") >= F.col("_met.from")) & (F.col("_met.open") | (F.col("_time") < F.col("_met.to")))
    return found.select("_fact.*", *(F.when(holds, F.col("_met.kept")[c]).alias(c) for c in keep))


def changed_intervals(old: DataFrame, new: DataFrame, on: str | list[str], valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """(on, valid_from, valid_to) of the versions that only one of the two sets has: outside of them every moment has the version it had."""
    keys = [on] if isinstance(on, str) else on
    same = [c for c in new.columns if c in old.columns]
    differ = old.select(same).exceptAll(new.select(same)).unionByName(new.select(same).exceptAll(old.select(same)))
    return differ.select(*keys, valid_from, valid_to).distinct()


def asof_repair(
    fact: DataFrame, old: DataFrame, new: DataFrame, on: str | list[str], at: str, valid_from: str = "valid_from", valid_to: str = "valid_to", columns: list[str] | None = None, grain: str = "month", last: Any = None
) -> DataFrame:
    """The rows of ``fact``, which :func:`asof_join` gave over ``old`` versions, that ``new`` versions change, joined anew; the others are left out.

    Versions that came late or went are found by comparing the two sets; only facts whose moment lies within one of them are
    joined again. ``columns`` are the version's columns in ``fact``, by default all that are not keys. The three tables are
    read several times, so they should be stored ones. The result is for an upsert, see :func:`lodestream.operators.incremental.merge`.
    """
    keys = [on] if isinstance(on, str) else on
    keep = [c for c in new.columns if c not in keys] if columns is None else columns
    bare = fact.drop(*keep)
    number = _GRAINS[grain]
    # An interval ends for this purpose with the last moment that facts of its key have; so open ones need no far end.
    ends = bare.groupBy(*keys).agg(F.max(at).alias("_last"))
    moved = changed_intervals(old, new, on, valid_from, valid_to).join(ends.hint("merge"), keys).withColumn("_stop", F.least(F.coalesce(valid_to, "_last"), "_last")).filter(F.col(valid_from) <= F.col("_stop"))
    pieces = moved.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), F.explode(F.sequence(number(F.col(valid_from)), number(F.col("_stop")))).alias("_piece")
    )
    inside = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    hit = bare.withColumn("_own", number(F.col(at)))
    hit = hit.join(pieces.hint("merge"), [*(hit[k] == pieces[f"_k_{k}"] for k in keys), hit["_own"] == pieces["_piece"], inside], "left_semi").drop("_own")
    return asof_join(hit, new, on, at, valid_from, valid_to, keep, grain, last).select(*fact.columns)


def current_join(fact: DataFrame, versions: DataFrame, on: str | list[str], columns: list[str], flag: str = "is_current") -> DataFrame:
    """Each fact row with its key's current version, whenever the fact happened; facts without one stay, with nulls."""
    keys = [on] if isinstance(on, str) else on
    return fact.join(versions.filter(flag).select(*keys, *columns), keys, "left")


def interval_days(df: DataFrame, start: str, end: str, last: Column, first: Column | None = None, day: str = "date_day") -> DataFrame:
    """One row for each day of [start, end) up to and with ``last``, and from ``first`` on; an open end is null.

    A range join against a calendar would compare every interval with every day; the days of an interval are its own.
    Intervals without a day in reach vanish.
    """
    begin = F.to_date(start) if first is None else F.greatest(F.to_date(start), first)
    stop = F.least(F.date_sub(F.to_date(end), 1), last)
    return df.withColumn("_begin", begin).withColumn("_stop", stop).filter("_begin <= _stop").withColumn(day, F.explode(F.sequence("_begin", "_stop"))).drop("_begin", "_stop")


def interval_months(df: DataFrame, start: str, end: str, last: Column, month: str = "active_month") -> DataFrame:
    """One row for each month in which [start, end) has a day up to and with ``last``."""
    stop = F.least(F.date_sub(F.to_date(end), 1), last)
    months = F.sequence(F.trunc("_begin", "month"), F.trunc("_stop", "month"), F.expr("interval 1 month"))
    return df.withColumn("_begin", F.to_date(start)).withColumn("_stop", stop).filter("_begin <= _stop").withColumn(month, F.explode(months)).drop("_begin", "_stop")


def gap_fill(spine: DataFrame, actuals: DataFrame, on: str, zero: list[str], flag: str = "is_gap_filled_day") -> DataFrame:
    """Every row of the spine with its actuals, zeros where it has none, and a flag that tells those apart."""
    marked = actuals.select(on, *zero, F.lit(True).alias("_met"))
    joined = spine.join(marked, on, "left")
    return joined.select(*spine.columns, *(F.coalesce(F.col(c), F.lit(0).cast(actuals.schema[c].dataType)).alias(c) for c in zero), F.col("_met").isNull().alias(flag))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``column`` has no ``field`` in ``parent``."""
    known = parent.select(F.col(field).alias("_known"))
    return child.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")

"""Schema evolution of raw tables: what a batch's schema may change, and what halts its table.

A batch's shape comes from its rows, in one aggregate on the executors; only shapes are compared on the driver, and the rows
are conformed on the executors.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from enum import IntEnum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.operators.changelog import META, field
from lodestream.schema import quoted, struct
from lodestream.sources.store import Store


class Change(IntEnum):
    """Classes of change, by severity."""

    NONE = 0
    ADDITIVE = 1
    WIDENING = 2
    DROPPED = 3
    INCOMPATIBLE = 4


#: Type changes that lose nothing; every other one is incompatible.
_UP = {
    T.ByteType(): (T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    T.ShortType(): (T.IntegerType(), T.LongType(), T.DoubleType()),
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
    T.DateType(): (T.TimestampType(),),
}
WIDENINGS = frozenset((a, b) for a, bs in _UP.items() for b in bs)


@dataclass(frozen=True)
class Difference:
    column: str
    change: Change
    from_type: str | None
    to_type: str | None


@dataclass(frozen=True)
class Verdict:
    """The differences of one batch. The worst of them decides."""

    table: str
    differences: tuple[Difference, ...]
    merged: T.StructType

    @property
    def severity(self) -> Change:
        return max((d.change for d in self.differences), default=Change.NONE)

    @property
    def accepted(self) -> bool:
        return self.severity < Change.INCOMPATIBLE


class IncompatibleSchema(Exception):
    """A batch's schema halts its table; the registered schema stays as it was."""

    def __init__(self, verdict: Verdict):
        super().__init__(f"{verdict.table}: " + ", ".join(f"{d.column} {d.from_type} -> {d.to_type}" for d in verdict.differences if d.change == Change.INCOMPATIBLE))
        self.verdict = verdict


def _compare(name: str, old: T.StructField | None, new: T.StructField | None) -> Difference | None:
    a, b = old and old.dataType.simpleString(), new and new.dataType.simpleString()
    if old is None:
        return Difference(name, Change.ADDITIVE, None, b)
    if new is None:
        return Difference(name, Change.DROPPED, a, None)
    if a == b or (new.dataType, old.dataType) in WIDENINGS:
        # A narrower batch fits into the registered type as it is.
        return None
    return Difference(name, Change.WIDENING if (old.dataType, new.dataType) in WIDENINGS else Change.INCOMPATIBLE, a, b)


def reconcile(known: T.StructType, incoming: T.StructType) -> T.StructType:
    """Known columns in their order, widened where the batch is wider, then new ones; all nullable."""
    new = {f.name: f for f in incoming}
    out = []
    for f in known:
        wider = f.name in new and (f.dataType, new[f.name].dataType) in WIDENINGS
        out.append(T.StructField(f.name, new[f.name].dataType if wider else f.dataType))
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in incoming if f.name not in known.names])


def classify(table: str, known: T.StructType | None, incoming: T.StructType) -> Verdict:
    """What ``incoming`` changes. The first schema seen of a table is accepted as it is.

    Names that differ only by case, from each other or from META's, cannot be columns of one table: the later one is incompatible.
    """
    names: dict[str, str] = {}
    for f in (*META, *(known or ()), *incoming):
        names.setdefault(f.name.lower(), f.name)
    clash = [Difference(f.name, Change.INCOMPATIBLE, f"{names[f.name.lower()]} (name)", f.dataType.simpleString()) for f in incoming if names[f.name.lower()] != f.name]
    if clash:
        return Verdict(table, tuple(clash), known or T.StructType([]))
    if known is None:
        return Verdict(table, (), T.StructType([T.StructField(f.name, f.dataType) for f in incoming]))
    old, new = {f.name: f for f in known}, {f.name: f for f in incoming}
    found = [_compare(c, old.get(c), new.get(c)) for c in sorted(old.keys() | new.keys())]
    differences = tuple(d for d in found if d)
    return Verdict(table, differences, known if any(d.change == Change.INCOMPATIBLE for d in differences) else reconcile(known, incoming))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast, and null where it has none."""
    have = set(df.columns)
    return df.select(*((F.col(quoted(f.name)) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


#: Integral types by size, with the largest value of each.
_INTEGRAL = {T.ByteType(): 1 << 7, T.ShortType(): 1 << 15, T.IntegerType(): 1 << 31, T.LongType(): 1 << 63}
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
#: Types whose JSON form is text.
_FROM_TEXT = (T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BinaryType())
_SCALARS = {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType()}


def _number(kind: str) -> T.DataType | None:
    """The type that holds every number of a field of this kind exactly."""
    if kind.startswith("DECIMAL"):
        return T.DecimalType(*map(int, kind[len("DECIMAL(") : -1].split(",")))
    return {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType()}.get(kind)


def _lost(value: Column, exact: T.DataType, own: T.DataType) -> Column:
    """Whether a number is another one, or none, once it is cast to ``own`` and back."""
    there = value.try_cast(own)
    back = there.cast("double") if isinstance(exact, T.DoubleType) else there if isinstance(own, T.DecimalType) else there.try_cast(exact)
    return value.isNotNull() & ~F.coalesce(back == value, F.lit(False))


def _misread(text: Column, own: T.DataType) -> Column:
    """Whether a text is not a value of ``own``, or holds more than ``own`` keeps: a time beside the date, a zone, or parts of a microsecond."""
    more = F.lit(False)
    if isinstance(own, T.DateType):
        more = ~text.rlike(r"^\s*\d{4}-\d{2}-\d{2}\s*$")
    elif isinstance(own, T.TimestampType):
        more = text.rlike(r"\.\d{6}\d*[1-9]")
    elif isinstance(own, T.TimestampNTZType):
        more = text.rlike(r"\.\d{6}\d*[1-9]|:.*([zZ]|[+-]\d{1,2}(:?\d{2})?)\s*$")
    return text.isNotNull() & (text.try_cast(own).isNull() | more)


def _fields(shape: str) -> dict[str, str]:
    """Names and kinds of the top fields of OBJECT<name: KIND, ...>; kinds of nested fields stay as they are."""
    out, depth, start, quoted = {}, 0, 0, False
    inner = shape[len("OBJECT<") : -1] + ","
    for k, c in enumerate(inner):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c == "<") - (c == ">") + (c == "(") - (c == ")")
            if c == "," and not depth and inner[start:k].strip():
                name, kind = inner[start:k].rsplit(": ", 1) if "<" not in inner[start:k] else inner[start:k].split(": ", 1)
                out[name.strip().strip("`").replace("``", "`")] = kind.strip()
                start = k + 1
    return out


def batch_shape(rows: DataFrame, known: T.StructType | None, column: str = "_row") -> T.StructType:
    """The schema that the JSON objects in ``column`` have, as what they would be of ``known``.

    A field has its known type only if every value is the same after a cast to it and back: no digit of a number, no time
    beside a date, no zone is cut. Where one does not fit, the field has the type that holds it: whole numbers bigint, or
    decimal beyond that; others double, or decimal where a double is not exact; texts timestamp where a date is known, else text.
    Objects and arrays are text. Values of several types are a variant, which fits no known type, or text in a field that
    is new. A new number is bigint, double if that is exact, decimal(38,0) if it is whole and larger, or else text. Fields
    that are null in all rows have their known type; unknown ones of that sort are left out, as JSON tells nothing of them.
    One aggregate over the rows, and a second one only where values must be looked at.
    """
    found = rows.agg(F.schema_of_variant_agg(column)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    kinds, types = _fields(found), {f.name: f.dataType for f in known or ()}
    checks: dict[tuple[str, str], Column] = {}

    def count(name: str, what: str, test: Column) -> None:
        checks[name, what] = F.count_if(test).alias(f"c{len(checks)}")

    for name, kind in kinds.items():
        own, exact = types.get(name), _number(kind)
        if exact is not None:
            value = field(column, name, exact.simpleString())
            if kind == "BIGINT" and own in _INTEGRAL and own != T.LongType():
                most = _INTEGRAL[own]
                count(name, "own", (value >= most) | (value < -most))
            elif isinstance(own, _FRACTIONAL):
                count(name, "own", _lost(value, exact, own))
            if kind.startswith("DECIMAL") and not isinstance(own, T.DoubleType):
                count(name, "double", _lost(value, exact, T.DoubleType()))
        elif kind == "STRING" and own in _FROM_TEXT:
            text = field(column, name, "string")
            count(name, "own", _misread(text, own))
            if isinstance(own, T.DateType):
                count(name, "timestamp", _misread(text, T.TimestampType()))
    misfits = dict(zip(checks, rows.agg(*checks.values()).first(), strict=True)) if checks else {}

    def typed(name: str, kind: str) -> T.DataType | None:
        own, exact = types.get(name), _number(kind)
        if kind == "VOID":
            return own
        if misfits.get((name, "own")) == 0:
            return own
        if kind == "STRING" and isinstance(own, T.DateType):
            return T.TimestampType() if not misfits[name, "timestamp"] else T.StringType()
        if kind.startswith("DECIMAL"):
            if isinstance(own, T.DoubleType | T.DecimalType):
                return exact
            if own is None and exact.scale == 0:
                return T.DecimalType(38, 0)
            return T.DoubleType() if not misfits[name, "double"] else T.StringType() if own is None else exact
        if kind == "VARIANT" and own is not None:
            return T.VariantType()
        return _SCALARS.get(kind, T.StringType())

    shape = [(name, typed(name, kind)) for name, kind in kinds.items() if name not in META.names]
    return T.StructType([T.StructField(n, t) for n, t in shape if t is not None])


AUDIT = struct("detected_at timestamp, table string, column_name string, change string, from_type string, to_type string")


class Registry:
    """Last accepted schema of each table and the tables that are halted, as small files in a folder that Spark's file systems reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._store = Store(spark, folder)

    def known(self, table: str) -> T.StructType | None:
        text = self._store.read(f"{table}.json")
        return None if text is None else T.StructType.fromJson(json.loads(text))

    def halted(self, table: str) -> bool:
        return self._store.read(f"{table}.halted") is not None

    def check(self, table: str, incoming: T.StructType) -> Verdict:
        """What ``incoming`` changes of the registered schema; nothing is registered."""
        if self.halted(table):
            raise RuntimeError(f"{table} is halted; resume it first")
        return classify(table, self.known(table), incoming)

    def settle(self, verdict: Verdict) -> None:
        """Register an accepted schema. An incompatible one halts its table and is never registered."""
        if not verdict.accepted:
            self._store.write(f"{verdict.table}.halted", str(IncompatibleSchema(verdict)))
            return
        known = self.known(verdict.table)
        if known is None or verdict.merged.json() != known.json():
            self._store.write(f"{verdict.table}.json", verdict.merged.json())

    def inspect(self, table: str, incoming: T.StructType) -> Verdict:
        """:meth:`check` and :meth:`settle`."""
        verdict = self.check(table, incoming)
        self.settle(verdict)
        return verdict

    def resume(self, table: str) -> None:
        self._store.remove(f"{table}.halted")


def audit_rows(spark: SparkSession, verdict: Verdict, detected_at) -> DataFrame:
    """One row for each difference."""
    return spark.createDataFrame([(detected_at, verdict.table, d.column, d.change.name.lower(), d.from_type, d.to_type) for d in verdict.differences], AUDIT)


def labelled_audit(audit: DataFrame) -> DataFrame:
    """The audit with what came of each change."""
    outcome = (
        F.when(F.col("change") == "additive", "accepted: column added")
        .when(F.col("change") == "widening", "accepted: type widened")
        .when(F.col("change") == "dropped", "accepted: column kept as null")
        .when(F.col("change") == "incompatible", "rejected: table halted")
        .otherwise("unknown")
    )
    return audit.select(*AUDIT.names, outcome.alias("outcome"))

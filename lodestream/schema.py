"""Schemas without a session: Spark's own DDL parser needs a running one, which an import must not."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """Nullable fields from "name type, name type" over the flat types above."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def quoted(name: str) -> str:
    """A column's name as an expression that names it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"

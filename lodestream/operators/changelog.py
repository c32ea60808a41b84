"""Reduction of an append-only change log to current state.

A log holds a bulk snapshot (`_op` r, no `_lsn`, partition -1) and changes (c, u, d) in one table, each row with
META columns. Rows are never removed from it; a delete is one more row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.schema import quoted, struct

META = struct("_op string, _lsn long, _kafka_offset long, _kafka_partition int, _ingested_at timestamp, _source_ts timestamp")
DELETE = "d"


def version_order(newest_first: bool = True) -> list[Column]:
    """Order of one key's versions: log sequence (none: below all others), source time (none: oldest), partition, offset."""
    lsn, ts = F.coalesce(F.col("_lsn"), F.lit(0)), F.col("_source_ts")
    rest = [F.col("_kafka_partition"), F.col("_kafka_offset")]
    if newest_first:
        return [lsn.desc(), ts.desc_nulls_last(), *(c.desc() for c in rest)]
    return [lsn.asc(), ts.asc_nulls_first(), *(c.asc() for c in rest)]


def _rank(df: DataFrame) -> Column:
    """The version order as one comparable value, nulls lowest."""
    return F.struct(F.coalesce("_lsn", F.lit(0)), "_source_ts", "_kafka_partition", "_kafka_offset")


def latest(df: DataFrame, key: str | list[str], include_deletes: bool = False) -> DataFrame:
    """The newest version of each key; keys whose last change is a delete go, unless ``include_deletes``.

    An aggregate keeps the best row of each key per task before the shuffle, so a key with very many versions
    does not gather them in one task. Keys may be null and form a group of their own.
    """
    keys = [key] if isinstance(key, str) else key
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*(F.col(quoted(c)) for c in df.columns)), _rank(df)).alias("_row")).select("_row.*")
    return best if include_deletes else best.filter((F.col("_op") != DELETE) | F.col("_op").isNull())


def dedupe_by_offset(df: DataFrame, delivery: list[str], block: str | None = None) -> DataFrame:
    """One row for each (partition, offset): the last one delivered by the order of the ``delivery`` columns, nulls first.

    An aggregate, so repeated deliveries of one offset are reduced before the shuffle. ``block`` names a column that follows
    from the offset: rows are then shuffled by (partition, block) before the aggregate and lie so afterwards, for a caller
    who needs each block in one task and would shuffle again.
    """
    rows, keys = F.struct(*(F.col(quoted(c)) for c in df.columns)), ["_kafka_partition", "_kafka_offset"]
    if block is not None:
        df, keys = df.repartition("_kafka_partition", block), ["_kafka_partition", block, "_kafka_offset"]
    return df.groupBy(*keys).agg(F.max_by(rows, F.struct(*delivery)).alias("_row")).select(*(F.col(k) for k in keys), *(F.col("_row")[c].alias(c) for c in df.columns if c not in keys)).select(*map(quoted, df.columns))


def union_by_offset(prior: DataFrame, incoming: DataFrame, delivery: list[str] | None = None, block: str | None = None) -> DataFrame:
    """Both sets of rows by (partition, offset), the incoming row where both have one; columns unite by name. For ``block`` see :func:`dedupe_by_offset`."""
    both = prior.withColumn("_incoming", F.lit(0)).unionByName(incoming.withColumn("_incoming", F.lit(1)), allowMissingColumns=True)
    return dedupe_by_offset(both, ["_incoming", *(delivery or [])], block).drop("_incoming")


def field(column: str, name: str, kind: str) -> Column:
    """One field of the JSON object in ``column``, whatever characters its name has; null where it is no ``kind``."""
    if "'" in name and '"' in name:
        # No path can quote such a name.
        return F.try_variant_get(F.col(column).try_cast("map<string,variant>").getItem(name), "$", kind)
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(column, f"$[{quote}{name}{quote}]", kind)


#: What is taken out of an event's text, beside whether the text is a JSON object at all.
PARTS = ("_row", "_op", "_lsn", "_source_ts", "_table", "_whole")


def _parts(topic: str) -> dict[str, Column]:
    """PARTS out of ``_json``. Fields are reached by their whole path: an envelope inside ``payload`` is not built anew as a value of its own."""
    wrapped = F.try_variant_get("_json", "$.payload.op", "string").isNotNull()
    get = lambda path, kind: F.when(wrapped, F.try_variant_get("_json", f"$.payload.{path}", kind)).otherwise(F.try_variant_get("_json", f"$.{path}", kind))
    present = lambda c: F.when(~F.is_variant_null(c), c)
    first, second, op = present(get("after", "variant")), present(get("before", "variant")), get("op", "string")
    return {
        "_row": F.when(op == DELETE, F.coalesce(second, first)).otherwise(F.coalesce(first, second)),
        "_op": op,
        "_lsn": get("source.lsn", "long"),
        "_source_ts": F.timestamp_millis(F.coalesce(get("source.ts_ms", "long"), get("ts_ms", "long"))),
        "_table": F.coalesce(get("source.table", "string"), F.element_at(F.split(topic, r"\."), -1)),
        # What has an operation is an object; only other texts are looked at whole.
        "_whole": op.isNotNull() | F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False)),
    }


def parsed_once(events: DataFrame, value: str = "value", topic: str = "topic") -> DataFrame:
    """``events`` with PARTS, for callers that keep the result: the functions below then parse no text again and take nothing out of it twice."""
    if "_whole" in events.columns:
        return events
    return events.withColumn("_json", F.try_parse_json(value)).withColumns(_parts(topic)).drop("_json")


def _parsed(events: DataFrame, value: str, topic: str) -> DataFrame:
    """``events`` with PARTS; null for a null and for text that is not JSON or repeats a key."""
    if "_whole" in events.columns:
        return events
    # A generated column: filters on it do not slip below, which would parse each text twice.
    return events.withColumn("_json", F.explode(F.array(F.try_parse_json(value)))).withColumns(_parts(topic)).drop("_json")


def parse_events(events: DataFrame, value: str = "value", topic: str = "topic") -> DataFrame:
    """Change events with ``_row`` (the JSON object of the row), META, ``_table`` and the broker's other columns but ``value``.

    Events are wrapped in ``payload`` or bare. A delete carries the row before, all others the row after; where that is
    missing, the other one. The table is the source's, or the last part of the topic. ``_ingested_at`` is the broker's
    ``timestamp``, never the clock. Tombstones (null values), events without an operation and text that is not a JSON object
    are left out; see :func:`unparseable`. Each text is parsed once, or not at all after :func:`parsed_once`.
    """
    kept = [c for c in events.columns if c not in (value, topic, "partition", "offset", "timestamp", *PARTS)]
    return _parsed(events, value, topic).filter("_op is not null").select(
        "_row",
        "_op",
        "_lsn",
        F.col("offset").cast("long").alias("_kafka_offset"),
        F.col("partition").cast("int").alias("_kafka_partition"),
        F.col("timestamp").cast("timestamp").alias("_ingested_at"),
        "_source_ts",
        "_table",
        *kept,
    )


def typed(rows: DataFrame, payload: T.StructType) -> DataFrame:
    """The fields of ``payload``, sorted by name, out of ``_row``, and all other columns; what does not fit its type is null."""
    names = sorted(payload, key=lambda f: f.name)
    cast = lambda f: field("_row", f.name, f.dataType.simpleString()).alias(f.name)
    return rows.select(*map(cast, names), *(c for c in rows.columns if c != "_row"))


def parse_changes(events: DataFrame, payload: T.StructType, value: str = "value", topic: str = "topic") -> DataFrame:
    """Rows of ``payload`` with META and ``_table`` from JSON change events; see :func:`parse_events`.

    Fields that ``payload`` does not name are left out and values of another type are null: ingest compares the batch's own
    shape with the registered schema first, see :func:`lodestream.operators.schema_guard.batch_shape`.
    """
    return typed(parse_events(events, value, topic), payload)


def unparseable(events: DataFrame, value: str = "value", topic: str = "topic") -> DataFrame:
    """The events that are not JSON objects, or repeat a key, with a reason; tombstones are none of them."""
    return _parsed(events, value, topic).filter(F.col(value).isNotNull() & ~F.col("_whole")).drop(*PARTS).withColumn("reason", F.lit("invalid json"))


def deletion_flags(df: DataFrame, soft: str = "deleted_at") -> DataFrame:
    """Tells a row that the application marked as deleted from one that the source removed."""
    return df.withColumn("is_deleted", F.col(soft).isNotNull()).withColumn("is_hard_deleted", F.col("_op") == DELETE)

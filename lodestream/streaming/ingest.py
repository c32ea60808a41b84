"""Ingest of change events by Structured Streaming, one query and one checkpoint for each table.

A batch is written before its checkpoint advances; a batch that is run again leaves the same rows, because the sink keys
them by (partition, offset). An incompatible schema halts its own table only: the batch is kept aside, the audit is
written, and the failure keeps the checkpoint where it was.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lodestream.operators.changelog import META, parse_events, parsed_once, typed, unparseable
from lodestream.operators.schema_guard import IncompatibleSchema, Registry, audit_rows, batch_shape, classify
from lodestream.operators.touched import write_keys
from lodestream.schema import quoted, struct
from lodestream.sources.sinks import append_audit, batch_metrics, batch_name, dead_batch, dead_records, write_batch

#: What a source must give: the columns of a message broker.
RECORD = struct("value string, topic string, partition int, offset long, timestamp timestamp")
FLUSH_RECORDS, FLUSH_SECONDS = 50_000, 60


#: What a source may add: the order of delivery within a batch, any comparable value.
DELIVERY = "_delivery"


def kafka(spark: SparkSession, servers: str, topic: str, per_trigger: int = FLUSH_RECORDS) -> DataFrame:
    """Change events of one topic from its earliest offset; needs the connector on the class path. A broker gives each offset once a batch."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    stream = stream.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_trigger).load()
    return stream.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")


def files(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """Change events from JSON files of RECORD rows; later files, and later rows of a file, are later deliveries."""
    stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", per_trigger).json(path)
    return stream.select(*RECORD.names, F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start").alias(DELIVERY))


def _leaves(value: Column, kind: T.DataType) -> list[Column]:
    return [c for f in kind for c in _leaves(value[f.name], f.dataType)] if isinstance(kind, T.StructType) else [value]


def numbered(batch: DataFrame) -> DataFrame:
    """A micro-batch with its rows' order of delivery: by the source's own, or else the broker's time, then by position within what a task reads in order.

    The order is by columns ``_delivery_0`` and so on, one for each value: a kept column of paths takes next to nothing where a struct has the path in each row.
    """
    own = DELIVERY if DELIVERY in batch.columns else "timestamp"
    order = [*_leaves(F.col(own), batch.schema[own].dataType), F.monotonically_increasing_id()]
    return batch.withColumns({f"{DELIVERY}_{k}": c for k, c in enumerate(order)}).drop(DELIVERY)


def handle(batch: DataFrame, table: str, payload: T.StructType | None, registry: Registry, root: str) -> DataFrame | None:
    """One micro-batch: bad records aside, the rest guarded by the shape of its own rows, conformed and merged. Returns the rows, or None for an empty batch.

    ``payload`` is the schema of a table that is not registered yet; without one, the first batch's own shape is registered.
    All that is written bears the batch's name or the rows' offsets, so a batch that is run again changes nothing.
    """
    spark, batch = batch.sparkSession, parsed_once(batch)
    own, change = F.coalesce(F.col("_table") == table, F.lit(False)), F.col("_op").isNotNull()
    name, bad, mine, others = batch.agg(batch_name(), F.count_if(F.col("value").isNotNull() & ~F.col("_whole")), F.count_if(change & own), F.count_if(change & ~own)).first()
    if bad:
        dead_records(unparseable(batch), f"{root}/_dead/{table}/records", name)
    parsed = parse_events(batch.withColumns({"_value": F.col("value"), "_topic": F.col("topic")}))
    rows = parsed.filter(own).drop("_table", "_value", "_topic")
    if others:
        # Another table's events on this topic are kept, not lost.
        foreign = parsed.filter(~own).select(F.col("_value").alias("value"), F.concat(F.lit("of table "), F.coalesce("_table", F.lit("?"))).alias("reason"), F.col("_topic").alias("topic"), F.col("_kafka_partition").alias("partition"), F.col("_kafka_offset").alias("offset"))
        dead_records(foreign, f"{root}/_dead/{table}/foreign", name)
    if not mine:
        return None
    if payload is not None and registry.known(table) is None:
        registry.settle(classify(table, None, payload))
    verdict = registry.check(table, batch_shape(rows, registry.known(table)))
    # The audit comes before the registry: a crash between the two repeats the audit's rows under the same name.
    if verdict.differences:
        append_audit(audit_rows(spark, verdict, datetime.now(UTC).replace(tzinfo=None)), f"{root}/_audit", f"{table}.{name}")
    if not verdict.accepted:
        dead_batch(rows, str(IncompatibleSchema(verdict)), f"{root}/_dead/{table}/rejected", name)
    registry.settle(verdict)
    if not verdict.accepted:
        raise IncompatibleSchema(verdict)
    whole = typed(rows, verdict.merged)
    # Of one offset's copies in a batch the last delivered wins.
    order = [c for c in whole.columns if c.startswith(f"{DELIVERY}_")]
    landing = whole.select(*map(quoted, [*verdict.merged.names, *META.names, *order]))
    # Counted while the batch flows by: no scan of the table, and no action more.
    seen = Observation()
    of_op = (F.count_if(F.col("_op") == op).alias(op) for op in ("c", "u", "d", "r"))
    write_batch(landing.observe(seen, F.count(F.lit(1)).alias("records"), *of_op, F.max("_ingested_at").alias("newest")), f"{root}/{table}", order, 1)
    batch_metrics(spark, f"{root}/_metrics/{table}", name, seen.get)
    return whole


def ingest(source: DataFrame, table: str, payload: T.StructType | None, registry: Registry, root: str, checkpoint: str, once: bool = False, touched: str | None = None, key: str = "id") -> StreamingQuery:
    """Start the table's query. ``once`` drains what is there and stops; ``touched`` names a folder for each batch's keys."""
    if registry.halted(table):
        raise RuntimeError(f"{table} is halted; resume it first")

    def flush(batch: DataFrame, number: int) -> None:
        # Several actions read the batch; kept, it is read from its source and parsed once.
        batch = parsed_once(numbered(batch)).persist()
        try:
            rows = handle(batch, table, payload, registry, root)
            if rows is not None and touched is not None:
                write_keys(rows.select(key), touched, number)
        finally:
            batch.unpersist()

    writer = source.writeStream.queryName(f"ingest_{table}").option("checkpointLocation", checkpoint).foreachBatch(flush)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")).start()


def dedupe_in_flight(stream: DataFrame, within: str = "1 hour") -> DataFrame:
    """Drops repeated deliveries while they are near in time, with bounded state. The first copy stays, so the sink remains the authority."""
    return stream.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


class Progress(StreamingQueryListener):
    """Rows, lag and time of the last flush of each query, from its progress events, and the failure of a query that ended with one."""

    def __init__(self):
        self.latest: dict[str, dict] = {}
        self._names: dict[str, str] = {}

    def _state(self, name: str) -> dict:
        return self.latest.setdefault(name, {"rows": 0, "lag": None, "at": None, "failed": None})

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name
        self._state(event.name)["failed"] = None

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = self._state(p.name)
        state["rows"] += p.numInputRows
        state["at"] = p.timestamp
        known = [int(x) for x in ((s.metrics or {}).get("maxOffsetsBehindLatest") for s in p.sources) if x is not None]
        state["lag"] = max(known) if known else state["lag"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self._names.get(str(event.id))
        if name is not None and event.exception:
            self._state(name)["failed"] = event.exception


def records_by_op(raw: DataFrame) -> DataFrame:
    """(op, records, last_flush) of a raw table: what was ingested of each operation, and when the newest of it came."""
    return raw.groupBy(F.col("_op").alias("op")).agg(F.count("*").alias("records"), F.max("_ingested_at").alias("last_flush"))

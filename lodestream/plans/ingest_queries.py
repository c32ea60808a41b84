"""Queries over the change log as it is parsed, guarded, ingested and stored.

Streams and sinks need files: these queries write what they derive from the given tables into the shared folder and read it again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lodestream.operators import changelog, quality, touched
from lodestream.operators.incremental import fingerprint
from lodestream.operators.schema_guard import Registry, audit_rows, batch_shape, classify, labelled_audit
from lodestream.plans import bindings as B
from lodestream.plans import serving
from lodestream.plans.registered import longs, query, scratch
from lodestream.schema import struct
from lodestream.sources import raw, sinks
from lodestream.sources.published import STEPS, measured
from lodestream.streaming.ingest import dedupe_in_flight, files, ingest, records_by_op

_PAYLOAD = struct("id long, event_type string, value double")
_BATCHES = 5


def _messages(spark: SparkSession, sf_dir: str, row=None) -> DataFrame:
    """Events as broker records: wrapped and bare envelopes, tombstones, broken text and events without an operation."""
    log, n = B.change_log(spark, sf_dir), F.col("event_id") % 20
    row = F.struct("id", "event_type", "value") if row is None else row
    side = lambda mine: F.when(mine, row)
    body = F.struct(
        F.when(n != 3, F.col("_op")).alias("op"),
        side(F.col("_op") == "d").alias("before"),
        side(F.col("_op") != "d").alias("after"),
        F.struct(F.lit("events").alias("table"), F.col("event_id").alias("lsn"), F.unix_millis("_source_ts").alias("ts_ms")).alias("source"),
    )
    text = F.when(n == 1, F.lit(None)).when(n == 2, F.lit("{broken")).when(n < 10, F.to_json(F.struct(body.alias("payload")))).otherwise(F.to_json(body))
    return log.select(text.alias("value"), F.lit("shop.public.events").alias("topic"), F.col("_kafka_partition").alias("partition"), F.col("_kafka_offset").alias("offset"), F.col("_ingested_at").alias("timestamp"), "event_id")


_GOOD = "event_id % 20 NOT IN (1, 2, 3)"


@query(
    f"""WITH {B.CHANGE_LOG}
SELECT id, event_type, value, _op, event_id AS _lsn, _kafka_offset, _kafka_partition, 'events' AS "table", date_trunc('milliseconds', _source_ts) AS _source_ts
FROM change_log WHERE {_GOOD}"""
)
def parse_change_events(spark, sf_dir):
    out = changelog.parse_changes(_messages(spark, sf_dir), _PAYLOAD)
    return longs(out.select("id", "event_type", "value", "_op", "_lsn", "_kafka_offset", "_kafka_partition", F.col("_table").alias("table"), B.ntz("_source_ts")), "_kafka_partition")


_DEAD = f"WITH {B.CHANGE_LOG} SELECT 'invalid json' AS reason, count(*) AS n, CAST(sum(_kafka_offset) AS BIGINT) AS offsets FROM change_log WHERE event_id % 20 = 2"


@query(_DEAD)
def dead_letter_records(spark, sf_dir):
    bad = changelog.unparseable(_messages(spark, sf_dir))
    return bad.groupBy("reason").agg(F.count("*").alias("n"), F.sum("offset").alias("offsets"))


@query(_DEAD)
def dead_letter_sink(spark, sf_dir):
    """Dead records as the sink keeps them, after a batch that was run twice."""
    path, bad = f"{scratch(spark)}/dead", changelog.unparseable(_messages(spark, sf_dir))
    for _ in range(2):
        sinks.dead_records(bad, path, sinks.batch_id(bad))
    kept = spark.read.schema("value string, reason string, topic string, partition int, offset long").json(path)
    return kept.groupBy("reason").agg(F.count("*").alias("n"), F.sum("offset").alias("offsets"))


@query(
    f"""WITH {B.CHANGE_LOG} SELECT count(*) AS n, min(_kafka_offset) AS first_offset, max(_kafka_offset) AS last_offset, count(*) AS kept, 'halted' AS reason, 5 AS sampled FROM change_log WHERE event_id % {_BATCHES} = 2"""
)
def rejected_batch_sink(spark, sf_dir):
    """A rejected batch as the sink keeps it, after it was run twice: its summary, and how many of its rows are there."""
    path, batch = f"{scratch(spark)}/rejected", B.change_log(spark, sf_dir).filter(f"event_id % {_BATCHES} = 2")
    for _ in range(2):
        sinks.dead_batch(batch, "halted", path, "b")
    kept = spark.read.json(f"{path}/rows").agg(F.count("*").alias("kept"))
    summary = spark.read.schema("n long, first_offset long, last_offset long, reason string, sample array<string>").json(f"{path}/batches")
    return summary.select("n", "first_offset", "last_offset", "reason", F.size("sample").alias("sampled")).crossJoin(kept)


@query(
    f"""SELECT 'all' AS outcome, count(*) AS n FROM events UNION ALL SELECT 'dead', count(*) FILTER (event_id % 20 = 2) FROM events
UNION ALL SELECT 'parsed', count(*) FILTER ({_GOOD}) FROM events UNION ALL SELECT 'tombstone', count(*) FILTER (event_id % 20 = 1) FROM events"""
)
def dlq_split(spark, sf_dir):
    """Event records by what becomes of them: parsed, tombstone or dead; the rest have no operation."""
    m = _messages(spark, sf_dir)
    of = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("outcome"), "n")
    return of(m, "all").union(of(changelog.unparseable(m), "dead")).union(of(changelog.parse_changes(m, _PAYLOAD), "parsed")).union(of(m.filter("value is null"), "tombstone"))


# --- schema guard -------------------------------------------------------------------------------

_KNOWN = struct("id int, event_type string, value double")


def _drifting(spark, sf_dir) -> DataFrame:
    """Events as rows of JSON in five batches: as registered, with one more column, with text for a number, without a column, with numbers too large."""
    b = F.col("event_id") % _BATCHES
    events = B.read(spark, sf_dir, "events").withColumn("batch", b)
    row = F.struct(
        F.when(b == 4, F.col("user_id") + 3_000_000_000).otherwise(F.col("user_id")).alias("id"),
        F.when(b != 3, F.col("event_type")).alias("event_type"),
        F.when(b == 1, F.concat(F.lit("c"), F.col("event_id") % 2)).alias("channel"),
        F.when(b != 2, F.col("value")).alias("value"),
        F.when(b == 2, F.concat(F.lit("about "), F.col("value").cast("string"))).alias("text"),
    )
    # Null fields are left out of the text.
    text = F.regexp_replace(F.to_json(row), '"text":', '"value":')
    return events.select("batch", "event_id", "ts", F.parse_json(text).alias("_row"))


_DRIFT = f"""rows AS (SELECT event_id % {_BATCHES} AS batch, ts, CASE WHEN event_id % 5 = 4 THEN user_id + 3000000000 ELSE user_id END AS id,
  CASE event_id % 5 WHEN 1 THEN to_json({{'id': user_id, 'event_type': event_type, 'channel': 'c', 'value': value}}) WHEN 2 THEN to_json({{'id': user_id, 'event_type': event_type, 'value': 'about ' || value}})
    WHEN 3 THEN to_json({{'id': user_id, 'value': value}}) ELSE to_json({{'id': user_id, 'event_type': event_type, 'value': value}}) END AS row FROM events),
shapes AS (SELECT batch, json_group_structure(row) AS shape, max(id) AS most, count(*) AS records FROM rows GROUP BY batch),
judged AS (SELECT batch, records, json_extract_string(shape, '$.value') = 'VARCHAR' AS bad, json_extract_string(shape, '$.event_type') IS NULL AS dropped, most >= 2147483648 AS wider, json_extract_string(shape, '$.channel') IS NOT NULL AS added FROM shapes)"""


@query(
    f"""WITH {_DRIFT} SELECT batch, CASE WHEN bad THEN 'incompatible' WHEN dropped THEN 'dropped' WHEN wider THEN 'widening' WHEN added THEN 'additive' ELSE 'none' END AS severity,
  bad::BIGINT + dropped::BIGINT + wider::BIGINT + added::BIGINT AS n_differences, NOT bad AS accepted, records FROM judged"""
)
def schema_guard_verdicts(spark, sf_dir):
    """What the rows of each batch change of a registered schema, by class, with the records that the verdict lets in or keeps out."""
    rows = _drifting(spark, sf_dir)
    out = rows.groupBy("batch").agg(F.count("*").alias("records"))
    verdicts = {}
    for b in range(_BATCHES):
        registry = Registry(spark, f"{scratch(spark)}/registry")
        registry.inspect("events", _KNOWN)
        verdicts[b] = registry.inspect("events", batch_shape(rows.filter(F.col("batch") == b), registry.known("events")))
    pick = lambda of: F.create_map(*(F.lit(x) for b, v in verdicts.items() for x in (b, of(v))))[F.col("batch").cast("int")]
    return out.select("batch", "records", pick(lambda v: v.severity.name.lower()).alias("severity"), pick(lambda v: len(v.differences)).cast("long").alias("n_differences"), pick(lambda v: v.accepted).alias("accepted"))


@query(
    f"""WITH {_DRIFT}, changes AS (SELECT batch, 'channel' AS column_name, 'additive' AS change, NULL AS from_type, 'string' AS to_type, 'accepted: column added' AS outcome FROM judged WHERE added
  UNION ALL SELECT batch, 'id', 'widening', 'int', 'bigint', 'accepted: type widened' FROM judged WHERE wider
  UNION ALL SELECT batch, 'event_type', 'dropped', 'string', NULL, 'accepted: column kept as null' FROM judged WHERE dropped
  UNION ALL SELECT batch, 'value', 'incompatible', 'double', 'string', 'rejected: table halted' FROM judged WHERE bad)
SELECT c.*, (SELECT max(ts) FROM rows r WHERE r.batch = c.batch) AS detected_at FROM changes c"""
)
def schema_changes(spark, sf_dir):
    """The audit of those batches' changes as it is written and read again, with what came of each."""
    rows, path = _drifting(spark, sf_dir), f"{scratch(spark)}/audit"
    newest = {r["batch"]: r["at"] for r in rows.groupBy("batch").agg(F.max("ts").alias("at")).collect()}
    for b in range(_BATCHES):
        registry = Registry(spark, f"{scratch(spark)}/registry")
        registry.inspect("events", _KNOWN)
        verdict = registry.inspect("events", batch_shape(rows.filter(F.col("batch") == b), _KNOWN))
        for _ in range(2):
            sinks.append_audit(audit_rows(spark, verdict, newest[b]).withColumn("table", F.lit(str(b))), path, str(b))
    out = labelled_audit(raw.audit(spark, path))
    return out.select(F.col("table").cast("long").alias("batch"), "column_name", "change", "from_type", "to_type", "outcome", B.ntz("detected_at"))


@query(
    """WITH rows AS (SELECT event_id % 4 AS batch, value, CAST(ts AS DATE) AS day FROM events),
judged AS (SELECT batch, count(*) AS records, bool_or(batch = 1 AND round(value, 2) <> round(value, 1)) AS cut, bool_or(batch = 3 AND round(value) >= 100) AS large FROM rows GROUP BY batch)
SELECT batch, records, CASE WHEN cut OR large THEN 'incompatible' WHEN batch = 2 THEN 'widening' ELSE 'none' END AS severity, NOT (cut OR large) AS accepted, CASE WHEN batch = 2 THEN 'timestamp' ELSE 'date' END AS day_type FROM judged"""
)
def exact_value_verdicts(spark, sf_dir):
    """Decimals and dates in four batches: as registered, with more decimals than the type keeps, with times beside the dates, with numbers too large."""
    b, known = F.col("event_id") % 4, T.StructType([T.StructField("amount", T.DecimalType(3, 1)), T.StructField("day", T.DateType())])
    day = F.date_format("ts", "yyyy-MM-dd")
    amount = F.when(b == 1, F.round("value", 2)).when(b == 3, F.round("value")).otherwise(F.round(F.col("value") % 50, 1))
    rows = B.read(spark, sf_dir, "events").select(b.alias("batch"), F.struct(amount.alias("amount"), F.when(b == 2, F.concat(day, F.lit("T10:30:00"))).otherwise(day).alias("day")).alias("row"))
    rows = rows.select("batch", F.parse_json(F.to_json("row")).alias("_row"))
    verdicts = {n: classify("events", known, batch_shape(rows.filter(F.col("batch") == n), known)) for n in range(4)}
    pick = lambda of: F.create_map(*(F.lit(x) for n, v in verdicts.items() for x in (n, of(v))))[F.col("batch").cast("int")]
    out = rows.groupBy("batch").agg(F.count("*").alias("records"))
    return out.select("batch", "records", pick(lambda v: v.severity.name.lower()).alias("severity"), pick(lambda v: v.accepted).alias("accepted"), pick(lambda v: v.merged["day"].dataType.simpleString()).alias("day_type"))


# --- ingest -------------------------------------------------------------------------------------


def _drain(spark, root: str, payload=_PAYLOAD, touched: str | None = None) -> StreamingQuery:
    run = ingest(files(spark, f"{root}/in/*"), "events", payload, Registry(spark, f"{root}/registry"), f"{root}/raw", f"{root}/checkpoint", once=True, touched=touched)
    run.awaitTermination()
    return run


@query(
    f"""WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS _ingested_date, CAST(_kafka_partition AS BIGINT) AS _kafka_partition, _kafka_offset // 100000 AS _offset_block, count(*) AS rows, TRUE AS same
FROM change_log WHERE {_GOOD} GROUP BY ALL"""
)
def stream_ingest_replay(spark, sf_dir):
    """The events ingested as a stream, then delivered again in another order: rows of each directory, with whether its fingerprint stayed."""
    root = scratch(spark)
    messages = _messages(spark, sf_dir).drop("event_id")
    # Spread by offset, not over a fixed number of files: as many tasks write as rows ask for.
    messages.repartition("offset").write.json(f"{root}/in/first")
    _drain(spark, root)
    before = sinks.day_checksums(spark, f"{root}/raw/events").withColumnRenamed("fingerprint", "before").drop("rows")
    before.write.parquet(f"{root}/before")
    messages.filter("offset % 2 = 0").orderBy(F.desc("offset")).write.json(f"{root}/in/second")
    _drain(spark, root)
    after = sinks.day_checksums(spark, f"{root}/raw/events").withColumnRenamed("fingerprint", "after")
    out = after.join(spark.read.parquet(f"{root}/before"), sinks.LAYOUT).withColumn("same", F.col("before") == F.col("after"))
    return longs(out.select(*sinks.LAYOUT, "rows", "same"), "_kafka_partition", "_offset_block")


@query(
    f"""WITH half AS (SELECT max(event_id) // 2 AS h FROM events) SELECT user_id AS id, event_type, value, CASE WHEN event_id > h THEN 'c' || (event_id % 2) END AS channel, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS _op
FROM events, half WHERE {_GOOD} AND event_id % 7 <> 0"""
)
def guarded_ingest(spark, sf_dir):
    """Ingest across a new column, which joins the table, and a change of type, which halts it and stays out."""
    root = scratch(spark)
    half = B.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
    usual = _messages(spark, sf_dir).filter("event_id % 7 <> 0")
    wider = _messages(spark, sf_dir, F.struct("id", "event_type", "value", F.concat(F.lit("c"), F.col("event_id") % 2).alias("channel"))).filter("event_id % 7 <> 0")
    wrong = _messages(spark, sf_dir, F.struct("id", "event_type", F.lit("much").alias("value"))).filter("event_id % 7 = 0")
    usual.filter(F.col("event_id") <= half).drop("event_id").write.json(f"{root}/in/a")
    _drain(spark, root)
    wider.filter(F.col("event_id") > half).drop("event_id").write.json(f"{root}/in/b")
    _drain(spark, root)
    wrong.drop("event_id").write.json(f"{root}/in/c")
    try:
        _drain(spark, root)
        raise AssertionError("a change of type was let in")
    except Exception as e:  # the stream's exception wraps the guard's
        if "value double -> string" not in str(e):
            raise
    return sinks.read_table(spark, f"{root}/raw/events").select("id", "event_type", "value", "channel", "_op")


@query(f"SELECT user_id AS id, event_id AS _lsn, value + 1 AS value FROM events WHERE {_GOOD}")
def last_delivery_wins(spark, sf_dir):
    """Each offset delivered twice within one batch, with another value the second time."""
    root = scratch(spark)
    _messages(spark, sf_dir).drop("event_id").write.json(f"{root}/in/a")
    _messages(spark, sf_dir, F.struct("id", "event_type", (F.col("value") + 1).alias("value"))).drop("event_id").write.json(f"{root}/in/b")
    _drain(spark, root)
    return sinks.read_table(spark, f"{root}/raw/events").select("id", "_lsn", "value")


@query(f"SELECT DISTINCT user_id AS id FROM events WHERE {_GOOD}")
def touched_keys_feed(spark, sf_dir):
    """The keys of each micro-batch, for rebuilds of what they touch."""
    root = scratch(spark)
    _messages(spark, sf_dir).drop("event_id").write.json(f"{root}/in/a")
    _drain(spark, root, touched=f"{root}/touched")
    return spark.read.parquet(f"{root}/touched").select("id").distinct()


def _user_facts(rows: DataFrame) -> DataFrame:
    """One row for each user whose last change is no delete: changes, sum and last value, by the month of the last change."""
    order = F.struct(F.coalesce("_lsn", F.lit(0)), "_source_ts", "_kafka_partition", "_kafka_offset")
    last = rows.groupBy("id").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"), F.max_by(F.struct("_op", "value", "_ingested_at"), order).alias("last")
    )
    return last.filter("last._op <> 'd'").select("id", "n", "cents", F.col("last.value").alias("last_value"), F.date_format("last._ingested_at", "yyyy-MM").alias("month"))


@query(
    f"""WITH good AS (SELECT user_id AS id, event_id, event_type, value, ts FROM events WHERE {_GOOD}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id DESC) AS r, count(*) OVER (PARTITION BY id) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY id) AS BIGINT) AS cents FROM good)
SELECT id, n, cents, value AS last_value, strftime(ts, '%Y-%m') AS month FROM ranked WHERE r = 1 AND event_type <> 'error'"""
)
def streamed_fact(spark, sf_dir):
    """A fact that follows the stream by touched keys over three batches, the second delivered again with the third, and one run that ends before its pointer."""
    root = scratch(spark)
    messages = _messages(spark, sf_dir)
    low, high = B.read(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    first, second = low + (high - low) // 3, low + 2 * (high - low) // 3
    of = {1: F.col("event_id") <= first, 2: (F.col("event_id") > first) & (F.col("event_id") <= second), 3: F.col("event_id") > second}
    raw_rows = lambda: sinks.read_table(spark, f"{root}/raw/events")
    run = lambda hear=None: touched.follow(spark, f"{root}/fact", f"{root}/touched", raw_rows, _user_facts, "id", "month", on_step=hear)
    for k in (1, 2, 3):
        messages.filter(of[k]).drop("event_id").write.json(f"{root}/in/{k}")
        if k == 3:
            messages.filter(of[2]).drop("event_id").orderBy(F.desc("offset")).write.json(f"{root}/in/again")
        _drain(spark, root, touched=f"{root}/touched")
        if k == 2:
            try:
                run(_ends_at("point"))
            except _Ended:
                pass
        run()
    return run().select("id", "n", "cents", "last_value", F.col("month").cast("string").alias("month"))


_BY_OP = f"SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, count(*) AS records, max(ts) AS last_flush FROM events WHERE {_GOOD} GROUP BY 1"


@query(_BY_OP)
def ingested_by_op(spark, sf_dir):
    """What a drained stream ingested of each operation, and the newest of it."""
    root = scratch(spark)
    _messages(spark, sf_dir).drop("event_id").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{root}/in/a")
    _drain(spark, root)
    return records_by_op(sinks.read_table(spark, f"{root}/raw/events")).select("op", "records", B.ntz("last_flush"))


@query(f"SELECT op, records, records AS kept, (SELECT max(ts) FROM events WHERE {_GOOD}) AS newest FROM ({_BY_OP})")
def observed_by_op(spark, sf_dir):
    """What was observed of each operation while two batches flowed by, the first delivered again, beside what the table's writer counted: no scan of the table."""
    root, m = scratch(spark), _messages(spark, sf_dir)
    stamp = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    for name, part, again in (("a", 0, False), ("b", 1, False), ("c", 0, True)):
        some = m.filter(F.col("event_id") % 2 == part).drop("event_id")
        (some.orderBy(F.desc("offset")) if again else some).write.options(**stamp).json(f"{root}/in/{name}")
        _drain(spark, root)
    seen = sinks.read_metrics(spark, f"{root}/raw/_metrics/events")
    newest = seen.agg(F.max("newest").alias("newest"))
    by_op = seen.select(F.explode(F.array(*(F.struct(F.lit(op).alias("op"), F.col(op).alias("n")) for op in "cud"))).alias("x")).groupBy("x.op").agg(F.sum("x.n").alias("records"))
    kept = sinks.kept_by_op(spark, f"{root}/raw/events").withColumnRenamed("records", "kept")
    return by_op.join(kept, "op", "full").crossJoin(newest).select("op", "records", "kept", B.ntz("newest"))


@query(f"WITH {B.CHANGE_LOG} SELECT CAST(_kafka_partition AS BIGINT) AS partition, count(*) AS n, CAST(sum(_kafka_offset) AS BIGINT) AS offsets FROM change_log GROUP BY 1")
def stream_dedupe(spark, sf_dir):
    """Records delivered three times within the watermark, reduced in flight."""
    root = scratch(spark)
    m = _messages(spark, sf_dir).drop("event_id")
    m.union(m).union(m).write.json(f"{root}/in/a")
    stream = dedupe_in_flight(files(spark, f"{root}/in/*"), "60 days").select("partition", "offset")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return longs(spark.read.parquet(f"{root}/out").groupBy("partition").agg(F.count("*").alias("n"), F.sum("offset").alias("offsets")), "partition")


# --- raw tables ---------------------------------------------------------------------------------


def _landed(spark, sf_dir) -> str:
    """The change log in a raw table, written in two batches that overlap, the second in another order."""
    path, log = f"{scratch(spark)}/events", B.change_log(spark, sf_dir).drop("event_id")
    sinks.write_batch(log.filter("_kafka_offset % 10 < 7"), path)
    sinks.write_batch(log.filter("_kafka_offset % 10 >= 4").orderBy(F.desc("_kafka_offset")), path)
    return path


_CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents"


@query(
    f"WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS _ingested_date, CAST(_kafka_partition AS BIGINT) AS _kafka_partition, _kafka_offset // 100000 AS _offset_block, count(*) AS n, {_CENTS} FROM change_log GROUP BY ALL"
)
def raw_sink_layout(spark, sf_dir):
    """Rows of each directory of the raw table's layout."""
    return longs(sinks.read_table(spark, _landed(spark, sf_dir)).groupBy(*sinks.LAYOUT).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")), "_kafka_partition", "_offset_block")


@query(f"WITH {B.CHANGE_LOG} SELECT id, event_type, value, _op, _lsn, _kafka_offset, _ingested_at FROM change_log WHERE CAST(_ingested_at AS DATE) = (SELECT CAST(min(ts) AS DATE) + 2 FROM events)")
def read_one_day(spark, sf_dir):
    path = _landed(spark, sf_dir)
    day = B.read(spark, sf_dir, "events").agg(F.date_add(F.min("ts").cast("date"), 2)).first()[0]
    out = raw.read_day(spark, path, str(day), sinks.stored_schema(spark, path))
    return out.select("id", "event_type", "value", "_op", "_lsn", "_kafka_offset", B.ntz("_ingested_at"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (CAST(ts AS DATE) <> (SELECT CAST(min(ts) AS DATE) + 2 FROM events)) AS after_drop FROM events GROUP BY 1")
def day_dropped_and_replayed(spark, sf_dir):
    """Rows by day after one day was dropped, and after it was ingested again."""
    path = _landed(spark, sf_dir)
    day = str(B.read(spark, sf_dir, "events").agg(F.date_add(F.min("ts").cast("date"), 2)).first()[0])
    sinks.drop_day(spark, path, day)
    left, kept = sinks.read_table(spark, path), f"{path}.left"
    left.groupBy(F.col("_ingested_date").alias("day")).agg(F.count("*").alias("after_drop")).write.parquet(kept)
    sinks.write_batch(B.change_log(spark, sf_dir).drop("event_id").filter(F.to_date("_ingested_at") == F.lit(day).cast("date")), path)
    whole = raw.manifest(sinks.read_table(spark, path)).select(F.col("_ingested_date").alias("day"), F.col("rows").alias("n"))
    return whole.join(spark.read.parquet(kept), "day", "left").select("day", "n", F.coalesce("after_drop", F.lit(0).cast("long")).alias("after_drop"))


class _Ended(Exception):
    """Stands for the end of a process."""


def _ends_at(step: str):
    def hear(now: str) -> None:
        if now == step:
            raise _Ended(step)

    return hear


def _counted(df: DataFrame, step: str, when: str) -> DataFrame:
    # Distinct offsets by bitmaps, as they are dense: a task sends a bitmap for each bucket it has read, and no row.
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_kafka_offset")).alias("bitmap")
    by_bucket = df.groupBy("_kafka_partition", F.bitmap_bucket_number("_kafka_offset").alias("bucket")).agg(F.count("*").alias("n"), F.sum("_kafka_offset").alias("offsets"), bits)
    none = F.lit(0).cast("long")
    whole = by_bucket.agg(F.coalesce(F.sum("n"), none).alias("n"), F.coalesce(F.sum(F.bitmap_count("bitmap")), none).alias("n_distinct"), F.sum("offsets").alias("offsets"))
    return whole.select(F.lit(step).alias("step"), F.lit(when).alias("seen"), "*")


@query(
    f"""WITH {B.CHANGE_LOG}, steps AS (SELECT unnest({list(STEPS)}) AS step, unnest(range(1, {len(STEPS)} + 1)) AS k),
seen AS (SELECT step, 'after the end' AS seen, k - (step <> 'remove')::INT AS slices FROM steps UNION ALL SELECT step, 'after the retry', k FROM steps)
SELECT step, seen, count(*) AS n, count(*) AS n_distinct, CAST(sum(_kafka_offset) AS BIGINT) AS offsets FROM seen, change_log WHERE _kafka_offset % {len(STEPS) + 1} <= slices GROUP BY step, seen"""
)
def sink_ended_at_each_step(spark, sf_dir):
    """Overlapping batches, each of whose runs ends before one step of its write, and is run again: what a reader sees after either."""
    # Months instead of days: fewer directories, as each write is timed by their number.
    log, path = B.change_log(spark, sf_dir).drop("event_id").withColumn("_ingested_at", F.date_trunc("month", "_ingested_at")), f"{scratch(spark)}/events"
    of = F.col("_kafka_offset") % (len(STEPS) + 1)
    sinks.write_batch(log.filter(of == 0), path)
    for k, step in enumerate(STEPS):
        # The retry has the same batch in the same order, so that it is put in order once.
        late = log.filter(of.isin(k, k + 1)).orderBy(F.desc("_kafka_offset")).persist(StorageLevel.DISK_ONLY)
        try:
            sinks.write_batch(late, path, on_step=_ends_at(step))
        except _Ended:
            pass
        _counted(sinks.read_table(spark, path), step, "after the end").write.mode("append").parquet(f"{path}.seen")
        sinks.write_batch(late, path)
        late.unpersist()
        _counted(sinks.read_table(spark, path), step, "after the retry").write.mode("append").parquet(f"{path}.seen")
    return spark.read.parquet(f"{path}.seen")


@query(
    f"""WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS _ingested_date, CAST(_kafka_partition AS BIGINT) AS _kafka_partition, _kafka_offset // 100000 AS _offset_block, 1 AS files, count(*) AS rows, TRUE AS same FROM change_log GROUP BY ALL"""
)
def kept_fingerprints(spark, sf_dir):
    """Rows and fingerprints that the writer kept of each directory over three overlapping batches, with whether a new reading agrees."""
    path, log = _landed(spark, sf_dir), B.change_log(spark, sf_dir).drop("event_id")
    sinks.write_batch(log.filter("_kafka_offset % 10 < 2"), path)
    table = sinks.raw_table(spark, path)
    now = measured(table.read(), sinks.LAYOUT).select(*sinks.LAYOUT, F.col("fingerprint").cast("string").alias("now"))
    out = sinks.kept_checksums(spark, path).join(now, sinks.LAYOUT, "left").withColumn("same", F.coalesce(F.col("now") == F.col("fingerprint"), F.lit(False)))
    return longs(out.select(*sinks.LAYOUT, "files", "rows", "same"), "_kafka_partition", "_offset_block")


@query(
    f"""WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS _ingested_date, CAST(_kafka_partition AS BIGINT) AS _kafka_partition, _kafka_offset // 100000 AS _offset_block, count(*) AS rows,
  CAST(sum(CAST('0x' || substr(md5(_kafka_offset || '|' || event_type || '|' || id), 1, 8) AS BIGINT)) AS VARCHAR) AS fingerprint FROM change_log GROUP BY ALL"""
)
def directory_checksums(spark, sf_dir):
    """The content fingerprint of each directory of a raw table."""
    path = f"{scratch(spark)}/events"
    columns = ["id", "event_type", "_kafka_offset", "_kafka_partition", "_ingested_at"]
    sinks.write_batch(B.change_log(spark, sf_dir).select(columns), path)
    sinks.write_batch(B.change_log(spark, sf_dir).select(columns).filter("_kafka_offset % 3 = 0"), path)
    return longs(fingerprint(sinks.read_table(spark, path).drop("_ingested_at"), sinks.LAYOUT, portable=True), "_kafka_partition", "_offset_block")


@query(f"WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS _ingested_date, CAST(_kafka_partition AS BIGINT) AS _kafka_partition, count(*) AS rows, 0 AS out_of_order FROM change_log GROUP BY ALL")
def raw_file_order(spark, sf_dir):
    """Rows of each directory, and how many lie in their file behind one with a larger offset: the order as the files have it."""
    rows = sinks.read_table(spark, _landed(spark, sf_dir)).select("_ingested_date", "_kafka_partition", "_kafka_offset", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("_kafka_offset").over(Window.partitionBy("file").orderBy("at"))
    counted = rows.withColumn("before", before).groupBy("_ingested_date", "_kafka_partition").agg(F.count("*").alias("rows"), F.count_if(F.col("before") >= F.col("_kafka_offset")).alias("out_of_order"))
    return longs(counted, "_kafka_partition")


@query(f"WITH {B.CHANGE_LOG} SELECT CAST(_ingested_at AS DATE) AS day, count(DISTINCT (_kafka_partition, _kafka_offset // 100000)) AS objects, count(*) AS rows FROM change_log GROUP BY 1")
def partition_manifest(spark, sf_dir):
    """Files and rows of each day: one file a directory."""
    return raw.manifest(sinks.read_table(spark, _landed(spark, sf_dir))).withColumnRenamed("_ingested_date", "day")


@query(f"""SELECT 'orders' AS "table", count(*) AS rows, TIMESTAMP '{B.AS_OF}' AS taken_at FROM orders UNION ALL SELECT 'lineitem', count(*), TIMESTAMP '{B.AS_OF}' FROM lineitem UNION ALL SELECT 'customer', count(*), TIMESTAMP '{B.AS_OF}' FROM customer""")
def snapshot_manifest(spark, sf_dir):
    out = raw.snapshot_manifest({t: B.read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer")}, B.AS_OF)
    return out.select("table", "rows", B.ntz("taken_at"))


@query(
    """WITH span AS (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) + INTERVAL 2 MONTH AS b FROM orders), months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS rate_date FROM span)
SELECT rate_date, 'EUR' AS currency_code, round(0.85 + month(rate_date) / 100, 4)::DOUBLE AS rate_to_usd, 'rule' AS source, FALSE AS is_month_close FROM months WHERE month(rate_date) <> 11
UNION ALL SELECT rate_date, 'GBP', round(0.70 + month(rate_date) / 100, 4)::DOUBLE, 'rule', FALSE FROM months"""
)
def seeded_rates(spark, sf_dir):
    """Rates for the months of the orders, through a typed CSV seed."""
    path = f"{scratch(spark)}/rates"
    B.fx_rates(spark, sf_dir).select("rate_date", "currency_code", F.round("rate_to_usd", 4).alias("rate_to_usd"), F.lit("rule").alias("source"), F.lit(False).alias("is_month_close")).write.csv(path, header=True)
    return raw.seed(spark, path, raw.FX_RATES)


@query(
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type AS metric, avg(value) AS value FROM events GROUP BY ALL), last_ AS (SELECT max(day) AS day FROM daily)
SELECT day, metric, round(value, 6) AS value FROM daily WHERE day > (SELECT day FROM last_) - 14"""
)
def quality_series(spark, sf_dir):
    """Observations of each day appended to the series, and its last two weeks."""
    path, events = f"{scratch(spark)}/series", B.read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    last = events.agg(F.max("day")).first()[0]
    daily = events.groupBy("day", "event_type").agg(F.avg("value").alias("value"))
    rows = daily.select("day", F.col("event_type").alias("metric"), F.lit("events").alias("subject"), "value", F.lit(None).cast("string").alias("payload"))
    quality.observe(spark, path, rows.filter(F.col("day") == last), datetime(last.year, last.month, last.day))
    rest = rows.filter(F.col("day") < last).select(F.col("day").cast("timestamp").alias("observed_at"), "metric", "subject", "value", "payload")
    rest.write.mode("append").parquet(path)
    out = serving.quality_series(spark.read.parquet(path), str(last))
    return out.withColumn("value", F.round("value", 6))

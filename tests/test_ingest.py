"""Ingest of change events: the guard sees what the rows hold, and a batch that is run again changes nothing."""

import json
from datetime import datetime

import pytest
from lodestream.operators.changelog import parse_changes, parse_events, unparseable
from lodestream.operators.schema_guard import Registry, batch_shape
from lodestream.session import configured
from lodestream.sources import raw, sinks
from lodestream.streaming import ingest as I
from pyspark.sql import types as T

AT = datetime(2025, 3, 1, 9)
RECORD = "value string, topic string, partition int, offset long, timestamp timestamp"


def event(row, op="c", **more):
    side = "before" if op == "d" else "after"
    return json.dumps({"op": op, side: row, "source": {"table": "t", "lsn": 1, "ts_ms": 1}, **more})


def records(spark, *values, at=AT, first=0):
    return spark.createDataFrame([(v, "a.t", 0, first + k, at) for k, v in enumerate(values)], RECORD)


@pytest.fixture
def table(spark, tmp_path):
    """(handle of a batch, rows of the table, registry, root)."""
    configured(spark)
    root = str(tmp_path)
    registry = Registry(spark, f"{root}/registry")
    registry.inspect("t", T.StructType.fromDDL("id long, amount int, note string"))
    handle = lambda batch: I.handle(I.numbered(batch), "t", None, registry, root)
    rows = lambda: sinks.read_table(spark, f"{root}/t")
    return handle, rows, registry, root


def test_an_added_column_joins_the_table(spark, table):
    handle, rows, registry, root = table
    handle(records(spark, event({"id": 1, "amount": 5, "note": "a"})))
    handle(records(spark, event({"id": 2, "amount": 6, "note": None, "channel": "web"}), first=1))
    assert sorted(tuple(r) for r in rows().select("id", "amount", "note", "channel").collect()) == [(1, 5, "a", None), (2, 6, None, "web")]
    audit = raw.audit(spark, f"{root}/_audit").collect()
    assert [(r["column_name"], r["change"], r["to_type"]) for r in audit] == [("channel", "additive", "string")]
    # A column that a batch lacks stays, as nulls.
    handle(records(spark, event({"id": 3, "amount": 7}), first=2))
    assert rows().filter("id = 3 and note is null and channel is null").count() == 1


def test_a_widening_across_two_days(spark, table):
    handle, rows, registry, _ = table
    handle(records(spark, event({"id": 1, "amount": 5, "note": "a"})))
    handle(records(spark, event({"id": 2, "amount": 3_000_000_000, "note": "b"}), at=datetime(2025, 3, 2), first=1))
    handle(records(spark, event({"id": 3, "amount": 7, "note": "c"}), first=2))
    assert registry.known("t")["amount"].dataType == T.LongType()
    assert {r["id"]: r["amount"] for r in rows().collect()} == {1: 5, 2: 3_000_000_000, 3: 7}


@pytest.mark.parametrize("bad", [{"id": "abc", "amount": 5, "note": "a"}, {"id": 1, "amount": "12x", "note": "a"}, {"id": 1.5, "amount": 1, "note": "a"}, {"id": 1, "amount": 1, "note": 7}, {"id": 1, "amount": {"x": 1}, "note": "a"}])
def test_values_of_another_type_halt_the_table(spark, table, bad):
    handle, rows, registry, root = table
    handle(records(spark, event({"id": 1, "amount": 5, "note": "a"})))
    batch = records(spark, event({"id": 2, "amount": 6, "note": "b"}), event(bad), first=1)
    for _ in range(2):  # run again after a resume, as a retry does
        with pytest.raises(Exception, match="->"):
            handle(batch)
        with pytest.raises(RuntimeError, match="halted"):
            handle(batch)
        registry.resume("t")
    assert rows().count() == 1 and registry.known("t").simpleString() == "struct<id:bigint,amount:int,note:string>"
    assert spark.read.json(f"{root}/_dead/t/rejected/rows").count() == 2
    assert spark.read.json(f"{root}/_dead/t/rejected/batches").select("n").collect() == [(2,)]
    assert raw.audit(spark, f"{root}/_audit").filter("change = 'incompatible'").count() == 1


def test_retries_repeat_no_dead_letter(spark, table, monkeypatch):
    handle, rows, _, root = table
    batch = records(spark, event({"id": 1, "amount": 5, "note": "a"}), "{broken", "[1]", None)
    write = I.write_batch

    def fails(*args):
        raise OSError("disk")

    monkeypatch.setattr(I, "write_batch", fails)
    with pytest.raises(OSError):
        handle(batch)
    monkeypatch.setattr(I, "write_batch", write)
    handle(batch)
    handle(batch)
    dead = spark.read.json(f"{root}/_dead/t/records")
    assert sorted(r["value"] for r in dead.collect()) == ["[1]", "{broken"] and rows().count() == 1


def test_the_last_delivery_of_an_offset_wins(spark, table, tmp_path):
    handle, rows, _, _ = table
    twice = spark.createDataFrame([(event({"id": 1, "amount": k, "note": "x"}), "a.t", 0, 0, AT) for k in range(6)], RECORD).coalesce(1)
    handle(twice)
    assert [r["amount"] for r in rows().collect()] == [5]


def test_stream_halts_and_resumes(spark, tmp_path):
    configured(spark)
    root = str(tmp_path)
    records(spark, event({"id": 1, "x": 1}), None, "{").write.json(f"{root}/in/a")
    registry, seen = Registry(spark, f"{root}/reg"), I.Progress()
    spark.streams.addListener(seen)
    run = lambda: I.ingest(I.files(spark, f"{root}/in/*"), "t", T.StructType.fromDDL("id long, x int"), registry, f"{root}/raw", f"{root}/cp", once=True, touched=f"{root}/keys")
    run().awaitTermination()
    other = I.files(spark, f"{root}/in/*").writeStream.format("noop").queryName("other").option("checkpointLocation", f"{root}/cp2").trigger(availableNow=True).start()
    other.awaitTermination()
    records(spark, event({"id": 2, "x": "z"}), first=5).write.json(f"{root}/in/b")
    with pytest.raises(Exception, match="x int -> string"):
        run().awaitTermination()
    with pytest.raises(RuntimeError):
        run()
    for _ in range(100):
        if seen.latest.get("ingest_t", {}).get("failed"):
            break
        __import__("time").sleep(0.1)
    spark.streams.removeListener(seen)
    assert seen.latest["ingest_t"]["failed"] and seen.latest["ingest_t"]["rows"] >= 3 and not seen.latest["other"]["failed"]
    assert [(r["id"], r["x"]) for r in sinks.read_table(spark, f"{root}/raw/t").collect()] == [(1, 1)]
    # The checkpoint stayed, so after a resume the same batch comes again.
    registry.resume("t")
    with pytest.raises(Exception, match="x int -> string"):
        run().awaitTermination()
    assert spark.read.json(f"{root}/raw/_dead/t/rejected/rows").count() == 1 and spark.read.parquet(f"{root}/keys").count() == 1


def test_deliveries_in_flight_are_dropped(spark, tmp_path):
    rows = [("{}", "t", 0, k % 3, AT) for k in range(9)]
    spark.createDataFrame(rows, RECORD).write.json(str(tmp_path / "in"))
    stream = I.dedupe_in_flight(I.files(spark, str(tmp_path / "in")))
    stream.writeStream.format("memory").queryName("flight").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("flight").count() == 3


def test_shapes(spark):
    known = T.StructType.fromDDL("a tinyint, b double, c date, d timestamp, e string, f long, g int")
    of = lambda *rows: batch_shape(parse_events(records(spark, *map(event, rows))), known)
    got = {f.name: f.dataType.simpleString() for f in of({"a": 1, "b": 2, "c": "2025-01-01", "d": "2025-01-01 10:00:00", "e": None, "f": 1.5, "g": 1}, {"a": 2, "b": 2.5, "c": None, "g": "x", "o`dd, name": [1], "é": True})}
    assert got == {"a": "tinyint", "b": "double", "c": "date", "d": "timestamp", "e": "string", "f": "double", "g": "variant", "o`dd, name": "string", "é": "boolean"}
    got = {f.name: f.dataType.simpleString() for f in of({"a": 300, "c": "soon", "new": None, "n": {"x": {"y": 1}}})}
    assert got == {"a": "bigint", "c": "string", "n": "string"}
    assert not len(batch_shape(parse_events(records(spark)), known))


def test_envelopes(spark):
    rows = [
        event({"id": 1, "v": "x"}),
        json.dumps({"payload": json.loads(event({"id": 2, "v": "y"}, "d"))}),
        json.dumps({"op": "u", "before": None, "after": None, "ts_ms": 5}),
        json.dumps({"op": "d", "after": {"id": 4}}),
        json.dumps({"after": {"id": 5}}),
        None,
        "{",
        "3",
    ]
    got = parse_changes(records(spark, *rows), T.StructType.fromDDL("v string, id long"))
    assert got.columns[:3] == ["id", "v", "_op"]
    assert [(r["id"], r["v"], r["_op"], r["_table"], r["_kafka_offset"]) for r in got.orderBy("_kafka_offset").collect()] == [(1, "x", "c", "t", 0), (2, "y", "d", "t", 1), (None, None, "u", "t", 2), (4, None, "d", "t", 3)]
    assert [r["value"] for r in unparseable(records(spark, *rows)).collect()] == ["{", "3"]


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    """What a micro-batch keeps is parsed already: no plan over it parses text again."""
    from lodestream.operators import changelog
    from lodestream.streaming import ingest as module

    seen = []

    def flushed(batch, *rest):
        for df in (changelog.parse_events(batch), changelog.unparseable(batch)):
            plan = df._jdf.queryExecution().withCachedData().toString()
            seen.append("InMemoryRelation" in plan and "parse_json" not in plan.split("InMemoryRelation")[0])
        return handled(batch, *rest)

    handled = module.handle
    monkeypatch.setattr(module, "handle", flushed)
    lines = [(event({"id": k, "amount": k, "note": "x"}), "shop.public.t", 0, k, AT) for k in range(5)] + [("{bad", "shop.public.t", 0, 5, AT)]
    spark.createDataFrame(lines, RECORD).write.json(f"{tmp_path}/in/a")
    run = module.ingest(module.files(spark, f"{tmp_path}/in/*"), "t", None, Registry(spark, f"{tmp_path}/registry"), f"{tmp_path}/raw", f"{tmp_path}/checkpoint", once=True)
    run.awaitTermination()
    assert seen == [True, True]
    assert sinks.read_table(spark, f"{tmp_path}/raw/t").count() == 5


def test_nothing_is_taken_out_of_a_kept_batch_twice(spark, tmp_path, monkeypatch):
    """What a micro-batch keeps has its fields taken out already, and each value of the order of delivery as a column of its own."""
    from lodestream.streaming import ingest as module

    seen = []

    def flushed(batch, *rest):
        plan = parse_events(batch)._jdf.queryExecution().withCachedData().toString()
        kinds = {f.name: f.dataType for f in batch.schema}
        seen.append("variant_get" not in plan.split("InMemoryRelation")[0] and not any(isinstance(k, T.StructType) for k in kinds.values()))
        return handled(batch, *rest)

    handled = module.handle
    monkeypatch.setattr(module, "handle", flushed)
    lines = [(json.dumps({"payload": json.loads(event({"id": k}))}) if k % 2 else event({"id": k}, op="ucd"[k % 3]), "shop.public.t", 0, k // 2, AT) for k in range(8)] + [(v, "shop.public.t", 0, 9, AT) for v in ("{bad", '{"a": 1}', "3", None)]
    spark.createDataFrame(lines, RECORD).coalesce(1).write.json(f"{tmp_path}/in/a")
    module.ingest(module.files(spark, f"{tmp_path}/in/*"), "t", None, Registry(spark, f"{tmp_path}/registry"), f"{tmp_path}/raw", f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert seen == [True]
    assert sorted(r["id"] for r in sinks.read_table(spark, f"{tmp_path}/raw/t").collect()) == [1, 3, 5, 7]
    assert sorted(r["value"] for r in spark.read.json(f"{tmp_path}/raw/_dead/t/records").collect()) == ["3", "{bad"]

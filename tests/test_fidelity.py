"""The guard lets nothing in that a type would cut: each value is kept exactly, widens its column, or halts the table."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from lodestream.operators.schema_guard import Change, Registry, batch_shape, classify
from lodestream.session import configured
from lodestream.sources import sinks
from lodestream.streaming import ingest as I
from pyspark.sql import types as T
from test_ingest import event, records

BIG = 2**53


@pytest.mark.parametrize(
    "known, values, becomes",
    [
        ("decimal(5,2)", [1.5, 2, 999.99], "decimal(5,2)"),
        ("decimal(5,2)", [Decimal("123456.78")], None),
        ("decimal(5,2)", [Decimal("1.239")], None),
        ("decimal(5,2)", [1000], None),
        ("decimal(3,0)", [123456], None),
        ("decimal(38,0)", [10**30], "decimal(38,0)"),
        ("float", [0.5, 3], "float"),
        ("float", [0.1], "float"),
        ("float", [1e300], "double"),
        ("float", [Decimal("0.123456789")], "double"),
        ("float", [16777217], None),
        ("double", [BIG, 0.1, 1e300], "double"),
        ("double", [BIG + 1], None),
        ("double", [Decimal("1.23456789012345678901")], None),
        ("date", ["2024-01-01", None], "date"),
        ("date", ["2024-01-01T10:30:00"], "timestamp"),
        ("date", ["2024-01-01", "soon"], None),
        ("timestamp", ["2024-01-01T10:30:00.123456Z"], "timestamp"),
        ("timestamp", ["2024-01-01T10:30:00.123456789Z"], None),
        ("timestamp_ntz", ["2024-01-01 10:30:00"], "timestamp_ntz"),
        ("timestamp_ntz", ["2024-01-01 10:30:00+02:00"], None),
        ("int", [5, 2**31], "bigint"),
        ("int", [1.5], "double"),
        ("bigint", [2**63], None),
        (None, [10**29], "decimal(38,0)"),
        (None, [Decimal("0.5"), 1], "double"),
        (None, [Decimal("1.23456789012345678901")], "string"),
        (None, [1, 2], "bigint"),
    ],
)
def test_values_are_kept_exactly_or_halt(spark, known, values, becomes):
    """``becomes``: the column's type after the batch; None where the table must halt."""

    class Exact(json.JSONEncoder):
        def encode(self, x):
            return "{" + f'"x": {x["x"]}' + "}" if isinstance(x["x"], Decimal) else super().encode(x)

    rows = spark.createDataFrame([(Exact().encode({"x": v}),) for v in values], "text string").selectExpr("parse_json(text) AS _row")
    schema = T.StructType.fromDDL(f"x {known}") if known else T.StructType([])
    verdict = classify("t", schema, batch_shape(rows, schema))
    assert verdict.accepted == (becomes is not None)
    if becomes:
        assert verdict.merged["x"].dataType.simpleString() == becomes


def test_exact_values_land_in_the_table(spark, tmp_path):
    configured(spark)
    root = str(tmp_path)
    registry = Registry(spark, f"{root}/registry")
    registry.inspect("t", T.StructType.fromDDL("d decimal(9,2), day date, f float"))
    handle = lambda *rows, first=0: I.handle(I.numbered(records(spark, *map(event, rows), first=first)), "t", None, registry, root)
    handle({"d": 1234567.89, "day": "2024-01-01", "f": 0.5})
    handle({"d": 1, "day": "2024-01-02T10:30:00", "f": 1e300}, first=1)
    with pytest.raises(Exception, match="decimal"):
        handle({"d": 1.239, "day": "2024-01-03", "f": 1}, first=2)
    got = sorted(tuple(r) for r in sinks.read_table(spark, f"{root}/t").select("d", "day", "f").collect())
    assert got == [(Decimal("1.00"), datetime(2024, 1, 2, 10, 30), 1e300), (Decimal("1234567.89"), datetime(2024, 1, 1), 0.5)]
    assert registry.halted("t")


def test_odd_names_and_names_that_differ_by_case(spark, tmp_path):
    configured(spark)
    root = str(tmp_path)
    registry = Registry(spark, f"{root}/registry")
    handle = lambda *rows, first=0: I.handle(I.numbered(records(spark, *map(event, rows), first=first)), "t", None, registry, root)
    odd = {"id": 1, "a'\"b": 2, "c`d": "x", "e.f": 3, "g h": None, "i'j": True}
    handle(odd)
    handle({**odd, "id": 2, "new \"one' ": 5}, first=1)
    rows = sinks.read_table(spark, f"{root}/t").orderBy("id").collect()
    assert [(r["id"], r["a'\"b"], r["c`d"], r["e.f"], r["i'j"], r["new \"one' "]) for r in rows] == [(1, 2, "x", 3, True, None), (2, 2, "x", 3, True, 5)]
    before = registry.known("t").json()
    with pytest.raises(Exception, match="Id id"):
        handle({"id": 1, "Id": 2}, first=2)
    assert registry.known("t").json() == before
    assert classify("u", None, T.StructType.fromDDL("a int, A int")).severity == Change.INCOMPATIBLE
    assert not classify("u", None, T.StructType.fromDDL("_OP string")).accepted


def test_events_of_another_table_are_kept_aside(spark, tmp_path):
    configured(spark)
    root = str(tmp_path)
    registry = Registry(spark, f"{root}/registry")
    other = json.dumps({"op": "c", "after": {"id": 7}, "source": {"table": "other"}})
    batch = records(spark, event({"id": 1}), other, other)
    for _ in range(2):
        I.handle(I.numbered(batch), "t", None, registry, root)
    kept = spark.read.json(f"{root}/_dead/t/foreign").collect()
    assert [(r["value"], r["reason"]) for r in kept] == [(other, "of table other")] * 2
    assert sinks.read_table(spark, f"{root}/t").count() == 1


def test_a_date_is_read_as_it_was(spark):
    rows = spark.createDataFrame([('{"day": "2024-02-30"}',)], "text string").selectExpr("parse_json(text) AS _row")
    known = T.StructType.fromDDL("day date")
    assert not classify("t", known, batch_shape(rows, known)).accepted

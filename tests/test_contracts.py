"""Coercion, nested schemas, contracts, layouts, canonical JSON and results of a run, on small cases."""

import datetime as dt
import decimal
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import frames, values
from tidemark.operators import ledger, schemas
from tidemark.sources import storage
from tidemark.streaming import commits


@pytest.mark.parametrize("number", [0, 1, -1, 127, -128, 12345, -12345, 2**40, -(2**63)])
def test_unscaled_bytes_of_any_length(spark, number):
    raw = bytearray(number.to_bytes((number + (number < 0)).bit_length() // 8 + 1, "big", signed=True))
    got = spark.createDataFrame([(raw,)], "b binary").select(frames.coerce(F.col("b"), "binary", "decimal(20,2)").alias("d")).first().d
    assert got == decimal.Decimal(number).scaleb(-2)


def test_coercion_of_the_other_types(spark):
    df = spark.createDataFrame([(2**33 + 7, 1_500_000), (-5, -1), (2**31, 0), (None, None)], "n bigint, us bigint")
    got = df.select(frames.coerce(F.col("n"), "bigint", "int").alias("n"), frames.coerce(F.col("us"), "bigint", "timestamp_ntz").alias("t"), frames.coerce(F.col("us"), "bigint", "string").alias("s")).collect()
    epoch = dt.datetime(1970, 1, 1)
    assert [tuple(r) for r in got] == [(7, epoch + dt.timedelta(seconds=1.5), "1500000"), (-5, epoch - dt.timedelta(microseconds=1), "-1"), (-(2**31), epoch, "0"), (None, None, None)]
    wide = spark.createDataFrame([(bytearray(9),), (bytearray(),), (None,)], "b binary").select(frames.coerce(F.col("b"), "binary", "decimal(18,2)").alias("d"))
    assert [r.d for r in wide.collect()] == [None, None, None]


def test_canonical_json_sorts_all_levels(spark):
    schema = "z struct<b int, a array<struct<y string, x decimal(5,2)>>>, m map<string, int>, a string"
    rows = [({"b": None, "a": [{"y": "ä", "x": decimal.Decimal("1.50")}]}, {"q": 2, "c": 1}, None), (None, None, "t")]
    df = spark.createDataFrame(rows, schema)
    doc = df.select(F.struct("z", "m", "a").alias("d"))
    got = [r[0] for r in doc.select(values.canonical_json(F.col("d"), doc.schema["d"].dataType)).collect()]
    assert got == ['{"a":null,"m":{"c":1,"q":2},"z":{"a":[{"x":1.50,"y":"ä"}],"b":null}}', '{"a":"t","m":null,"z":null}']
    assert all(json.loads(x) for x in got)


def test_nested_schemas(spark):
    first = spark.createDataFrame([], "id int, gone struct<x: int>, s struct<a: int, l: array<int>>, m map<string, int>").schema
    second = spark.createDataFrame([], "id int, s struct<a: int, l: array<bigint>, more: struct<b: int>>, m array<int>").schema
    rows = schemas.nested_fields(first, "t", 1, "n.R") + schemas.nested_fields(second, "t", 2, "n.Other")
    got = {(r.path, r.issue) for r in schemas.schema_issues(spark.createDataFrame(rows, schemas.NESTED)).collect()}
    assert got == {("gone", "removed"), ("s.l[]", "type_change"), ("m", "type_change"), ("$", "record_rename")}


def test_additions_need_a_null_default_and_nullability_stays(spark):
    fields = [("s", 1, "a", "int", False, False), ("s", 2, "a", "int", True, True), ("s", 2, "b", "int", True, False), ("s", 2, "c", "int", True, True)]
    got = schemas.schema_issues(spark.createDataFrame(fields, "subject string, version int, path string, type string, nullable boolean, null_default boolean"))
    assert {(r.path, r.issue) for r in got.collect()} == {("a", "type_change"), ("b", "required_addition")}


@pytest.mark.parametrize("reset", [False, True])
def test_contracts(spark, reset):
    columns = "entity string, kind string, value string, detail string, nullable boolean"
    old = [("e", "key", "id", None, None), ("e", "partitions", "3", None, None), ("e", "fingerprint", "f1", None, None), ("e", "column", "a", "int", False), ("e", "column", "b", "int", True), ("e", "column", "d", "int", True)]
    new = [("e", "key", "id", None, None), ("e", "partitions", "6", None, None), ("e", "fingerprint", "f2", None, None), ("e", "column", "a", "int", True), ("e", "column", "b", "int", True), ("e", "column", "n", "int", True), ("e", "column", "r", "int", False), ("new", "key", "x", None, None)]
    new += [("e", "reset", "full_reset", None, None)] if reset else []
    got = {(r.value, r.issue) for r in schemas.contract_issues(spark.createDataFrame(old, columns), spark.createDataFrame(new, columns)).collect()}
    want = {("f1", "fingerprint_removed"), ("a", "column_changed"), ("d", "column_removed"), ("r", "column_added")}
    assert got == want | (set() if reset else {("3", "partitions_removed"), ("6", "partitions_added")})


def test_writers_and_readers(spark):
    reader = spark.createDataFrame([("a", "int", False), ("b", "int", True), ("c", "int", False)], "path string, type string, nullable boolean")
    writers = spark.createDataFrame([(1, "a", "int"), (1, "c", "int"), (2, "a", "int"), (2, "b", "long"), (3, "x", "int")], "schema_id int, path string, type string")
    assert {tuple(r) for r in schemas.writer_acceptable(writers, reader).collect()} == {(1, True, 0), (2, False, 2), (3, False, 2)}


def test_layout_of_a_declared_table(spark):
    spark.sql("drop table if exists laid_out")
    storage.ensure_table(spark, "laid_out", "a int, day string, hour int", "day, hour", {"owner_team": "x"})
    found = schemas.layout_rows(spark, "laid_out")
    declared = spark.createDataFrame([("partition", "day", "0"), ("partition", "region", "1"), ("property", "owner_team", "y"), ("property", "tier", "1")], "kind string, name string, value string")
    assert {tuple(r) for r in schemas.layout_drift(found, declared).collect()} == {("partition", "hour", "extra"), ("partition", "region", "missing"), ("property", "owner_team", "value"), ("property", "tier", "missing")}
    assert schemas.layout_drift(found, found).count() == 0
    spark.sql("drop table laid_out")


def test_extra_columns_are_identifiers(spark):
    assert ledger.extra_columns(spark.createDataFrame([], "id int, z int, b string"), ["id"]) == ["b", "z"]
    with pytest.raises(ValueError, match="identifiers"):
        ledger.extra_columns(spark.createDataFrame([], "id int, `a b` int"), ["id"])


def test_fan_out_refuses_differing_copies(spark, tmp_path):
    tables = commits.CommittedTables(spark, f"file://{tmp_path}/all", "1")
    spread = commits.fan_out(tables, {"a": lambda b: b})
    with pytest.raises(ValueError, match="differ"):
        spread(spark.createDataFrame([("a:0:1", "a", 5), ("a:0:1", "a", 6)], "event_id string, topic string, v int"), 0)
    assert not tables.files("a") and [(r.status, r.error_class) for r in tables.failures().collect()] == [("FAILED", "fatal")]


def test_results_of_a_run(spark):
    rows = spark.createDataFrame([("u", 1, 0, 5, False, "a"), ("u", 1, 0, 25_000, True, "b"), ("u", 2, 1, 7, False, "c"), ("x", 1, 0, 1, False, "d")], "entity string, k int, partition int, offset long, is_deleted boolean, line string")
    expected = spark.createDataFrame([("u", 3), ("lost", 2), ("empty", 0)], "entity string, expected_events long")
    got = {r.entity: r for r in ledger.entity_results(expected, rows, ["k"], F.col("line"), F.col("offset")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert tuple(got["u"])[1:] == ("VALIDATED", 3, 3, 2, 1, sha("\n".join(sha(x) for x in "abc")), None)
    assert (got["lost"].status, got["lost"].materialized_events, got["x"].status, got["x"].expected_events, got["empty"].status) == ("FAILED", 0, "FAILED", 0, "VALIDATED")


def test_wire_types_in_envelopes(spark):
    envelope = json.dumps({"op": "u", "before": None, "after": {"id": 2**32 + 3, "amount": "/4U=", "at": 1_000_001}})
    df = spark.createDataFrame([(envelope, dt.datetime(2024, 1, 1))], "envelope string, log_time timestamp_ntz")
    r = ledger.normalize(df, "id int, amount decimal(18,2), at timestamp_ntz", wire="id bigint, amount binary, at bigint").first()
    assert (r.id, r.amount, r["at"], r.source_ts) == (3, decimal.Decimal("-1.23"), dt.datetime(1970, 1, 1, 0, 0, 1, 1), dt.datetime(2024, 1, 1))
    assert r.before_row_hash is None and r.row_hash == hashlib.sha256(b"3|-1.23|1970-01-01 00:00:01.000001").hexdigest()

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import publication
from tidemark.operators.ledger import progress_rows
from tidemark.sources import storage
from tidemark.streaming import capture, commits

AT = dt.datetime(2024, 1, 1)
EVENTS = "event_id string, topic string, partition int, offset long, source_ts timestamp, v string"


def test_typed_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,price,at\n1,"x, y",2.50,2024-01-02 03:04:05\n2,,3,2024-01-01 00:00:00\n')
    got = storage.read_source_csv(spark, str(tmp_path / "a.csv"), "id int, name string, price decimal(18,2), at timestamp_ntz").orderBy("id").collect()
    assert (got[0].name, float(got[0].price), got[1].name) == ("x, y", 2.5, None)
    with pytest.raises(Exception):
        storage.read_source_csv(spark, str(tmp_path / "a.csv"), "id int, other string, price decimal(18,2), at timestamp_ntz").collect()


def test_jdbc_reference(spark):
    url = "jdbc:derby:memory:ref;create=true"
    spark.range(10).select(F.col("id").alias("ID"), F.col("id").cast("string").alias("ZIP")).write.jdbc(url, "GEO", mode="overwrite", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    got = storage.read_reference_jdbc(spark, url, "GEO", {"ID": "int", "ZIP": "string"}, split=("ID", 0, 10, 3), driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert got.count() == 10 and dict(got.dtypes)["ID"] == "int"


def test_reference_is_loaded_once(spark, tmp_path):
    path = str(tmp_path / "ref")
    assert storage.load_reference_once(spark.range(3).toDF("a"), path) == "loaded"
    assert storage.load_reference_once(spark.range(3).toDF("a"), path) == "unchanged"
    with pytest.raises(ValueError):
        storage.load_reference_once(spark.range(4).toDF("a"), path)


def test_status_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"application": "a", "updated_at": "2024-01-01T00:00:00Z", "queries": [{"name": "q", "state": "RUNNING", "last_batch_id": 3, "partition_offsets": {"t:0": 5}}, {"name": "r", "state": "FAILED"}]}, indent=1))
    got = storage.read_status_json(spark, str(tmp_path / "s.json")).orderBy("name").collect()
    assert [(r.name, r.state, r.last_batch_id) for r in got] == [("q", "RUNNING", 3), ("r", "FAILED", None)]


def test_only_the_runs_partition_is_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "seq long, x long")
    publication.overwrite_run(df, path, "x")
    publication.overwrite_run(spark.createDataFrame([(2, 99)], "seq long, x long"), path)
    assert sorted((r.seq, r.x) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 99)]
    audit = publication.compact(spark, path, 1, 1 << 20, 100).first()
    assert audit.files == 1 and spark.read.parquet(path).count() == 2


def test_checkpoints_are_apart(spark):
    assert capture.checkpoint_for("/c/", "q", "1") == "/c/q/1"
    with pytest.raises(ValueError):
        capture.checkpoint_for("/c", "q/x", "1")


def test_error_classes():
    assert [capture.classify_error(c) for c in ("timeout", "rule_x", "disk")] == ["transient", "record", "fatal"]


def _stream(spark, folder):
    return spark.readStream.schema(EVENTS).parquet(folder)


def test_capture_is_idempotent_over_restarts_and_replays(spark, tmp_path):
    source, ledger, progress = (str(tmp_path / n) for n in ("in", "ledger", "progress"))
    rows = [(f"t:0:{i}", "t", 0, i, AT, "v") for i in range(20)]
    spark.createDataFrame(rows[:10] + rows[:2], EVENTS).coalesce(1).write.parquet(source)
    write = capture.ledger_writer(ledger, progress, lambda b: b)
    capture.start(_stream(spark, source), "one", str(tmp_path / "c1"), write).awaitTermination()
    assert spark.read.parquet(ledger).count() == 10
    spark.createDataFrame(rows[5:], EVENTS).coalesce(1).write.mode("append").parquet(source)
    capture.start(_stream(spark, source), "one", str(tmp_path / "c1"), write).awaitTermination()
    assert spark.read.parquet(ledger).count() == 20
    capture.start(_stream(spark, source), "two", str(tmp_path / "c2"), write).awaitTermination()
    got = spark.read.parquet(ledger)
    assert got.count() == 20 == got.select("event_id").distinct().count()
    assert progress_rows(got).first().last_offset == 19


def test_appends_look_at_their_own_range(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, at long"
    storage.append_new(spark.createDataFrame([("a", 1), ("b", 2), ("n", None)], schema), path, ["k"], within="at")
    storage.append_new(spark.createDataFrame([("b", 2), ("c", 3), ("c", 3), ("n", None)], schema), path, ["k"], within="at")
    storage.append_new(spark.createDataFrame([("n", None)], schema), path, ["k"], within="at")
    storage.append_new(spark.createDataFrame([], schema), path, ["k"], within="at")
    assert sorted((r.k, r.at) for r in spark.read.parquet(path).collect() if r.k != "n") == [("a", 1), ("b", 2), ("c", 3)]
    assert spark.read.parquet(path).where("k = 'n'").count() == 1


def test_serving_gauges(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    markers = spark.createDataFrame([(1, "PUBLISHED", at(1), None), (2, "BLOCKED", at(2), "rejected_transaction")], "seq long, status string, recorded_at timestamp, reason string")
    leases = spark.createDataFrame([("a", at(3)), (None, at(9))], "owner string, expires_at timestamp")
    now = F.lit("2024-01-01 04:00:00").cast("timestamp")
    assert tuple(publication.serving_gauges(markers, now, leases=leases).first()) == (1, 10_800, "BLOCKED", False, True, False)
    assert publication.serving_gauges(markers.drop("reason"), F.lit("2024-01-01 02:30:00").cast("timestamp"), leases=leases).first()[4:] == (False, True)
    assert tuple(publication.serving_gauges(markers.limit(0), now).first()) == (None, None, None, True, False, False)


def test_fan_out_and_listener(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a:0:1", "a", 0, 1, AT, "x"), ("b:0:1", "b", 0, 1, AT, "y"), ("b:0:2", "b", 0, 2, AT, "z")], EVENTS).write.parquet(source)
    listener = capture.ProgressListener()
    spark.streams.addListener(listener)
    mark = lambda name: lambda d: d.withColumn("entity", F.lit(name))
    tables = commits.CommittedTables(spark, target, "1")
    capture.start(_stream(spark, source), "fan", str(tmp_path / "c"), commits.fan_out(tables, {"a": mark("ea"), "b": mark("eb")})).awaitTermination()
    assert [sorted(r.entity for r in tables.read(n, "entity string").collect()) for n in "ab"] == [["ea"], ["eb", "eb"]]
    spark.streams.removeListener(listener)


def test_offsets_of_a_progress_document(spark):
    df = spark.createDataFrame([("q", '{"t": {"0": 5, "1": 7}}')], "name string, p string")
    assert sorted((r.topic, r.partition, r.offset) for r in storage.parse_offsets(df, "p").collect()) == [("t", 0, 5), ("t", 1, 7)]


def test_health_and_barrier(spark):
    now = F.lit("2024-01-01 00:05:00").cast("timestamp")
    status = spark.createDataFrame([("q", "RUNNING", AT, None)], "name string, state string, updated_at timestamp, error_code string")
    lag = spark.createDataFrame([("t", 0, 3)], "topic string, partition int, lag long")
    gap = spark.createDataFrame([], "transaction_id string")
    h = capture.stream_health(status, lag, now).first()
    assert (h.stale, h.failed, h.total_lag, h.ready) == (1, 0, 3, False)
    assert not capture.caught_up(lag, gap).first().caught_up and capture.caught_up(lag.where("lag = 0"), gap).first().caught_up


def test_log_reading_and_replay(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(b"k", b"v", t, 0, i, AT + dt.timedelta(hours=i), 0, [("h", b"x")]) for i, t in enumerate(["a", "b", "a"])]
    spark.createDataFrame(rows, storage.LOG).write.parquet(path)
    raw = storage.read_log(spark, ["a"], path=path, streaming=False)
    assert raw.count() == 2
    assert storage.replay(raw, "a", AT + dt.timedelta(hours=1)).count() == 1
    assert storage.read_ledger_stream(spark, path, storage.LOG, ["a"]).isStreaming


def test_declared_tables(spark):
    storage.ensure_table(spark, "declared_once", "a int, seq long", "seq")
    storage.ensure_table(spark, "declared_once", "a int, seq long", "seq")
    assert spark.table("declared_once").columns == ["a", "seq"]
    spark.sql("drop table declared_once")

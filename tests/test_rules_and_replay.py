"""Conflicts, unknown topics, checkpoints, replay, retention, and point-in-time joins against plain loops."""

import random
import types

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger, publication, transactions, versions
from tidemark.sources import storage
from tidemark.streaming import capture, commits


def test_a_cluster_needs_a_shared_folder(spark):
    far = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: None), sparkContext=types.SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        storage.shared_dir(far)
    named = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: "hdfs://store/x/"), sparkContext=far.sparkContext)
    assert storage.shared_dir(named) == "hdfs://store/x"
    saved = storage.save(spark.range(3), "kept")
    assert saved.count() == 3
    path = saved.inputFiles()[0].rsplit("/", 1)[0]
    storage.drop_saved(saved)
    assert not storage.exists(spark, path)


def log_rows(spark, rows):
    return spark.createDataFrame(rows, "event_id string, topic string, partition int, offset long, source_ts timestamp, v int")


def test_differing_copies_and_unknown_topics_fail_a_batch(spark, tmp_path):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    write = capture.ledger_writer(f"file://{tmp_path}/ledger", f"file://{tmp_path}/progress", lambda b: b)
    write(log_rows(spark, [("a:0:1", "a", 0, 1, t, 5), ("a:0:1", "a", 0, 1, t, 5)]), 0)
    with pytest.raises(ValueError, match="differ"):
        write(log_rows(spark, [("a:0:2", "a", 0, 2, t, 5), ("a:0:2", "a", 0, 2, t, 6)]), 1)
    assert spark.read.parquet(f"file://{tmp_path}/ledger").count() == 1
    with pytest.raises(ValueError, match="differ"):  # from what an earlier batch has brought
        write(log_rows(spark, [("a:0:1", "a", 0, 1, t, 6), ("a:0:3", "a", 0, 3, t, 6)]), 1)
    write(log_rows(spark, [("a:0:1", "a", 0, 1, t, 5), ("a:0:3", "a", 0, 3, t, 6)]), 1)
    assert sorted(r.offset for r in spark.read.parquet(f"file://{tmp_path}/ledger").collect()) == [1, 3]
    tables = commits.CommittedTables(spark, f"file://{tmp_path}/all", "1")
    spread = commits.fan_out(tables, {"a": lambda b: b, "tx": lambda b: b})
    spread(log_rows(spark, [("a:0:1", "a", 0, 1, t, 5), ("tx:0:1", "tx", 0, 1, t, 5)]), 0)
    assert [tables.read(n, "event_id string").count() for n in ("a", "tx", "none")] == [1, 1, 0]
    with pytest.raises(ValueError, match="stranger"):
        spread(log_rows(spark, [("s:0:1", "stranger", 0, 1, t, 5)]), 1)


def test_checkpoints_belong_to_one_contract(spark, tmp_path):
    path = f"file://{tmp_path}/q/1"
    capture.claim_checkpoint(spark, path, "abc")
    capture.claim_checkpoint(spark, path, "abc")
    with pytest.raises(ValueError, match="belongs to contract abc"):
        capture.claim_checkpoint(spark, path, "other")


def test_replay_counts_first_and_hands_over_when_told(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 0, 4), ("a", 1, 2)], "topic string, partition int, offset long")
    given = []
    assert {tuple(r) for r in storage.run_replay(rows, lambda b, i: given.append(b)).collect()} == {("a", 0, 2, 1, 4), ("a", 1, 1, 2, 2)} and not given
    storage.run_replay(rows, lambda b, i: given.append((b.count(), i)), execute=True, batch_id=9)
    assert given == [(3, 9)]


def test_retention_drops_only_when_told(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    spark.range(6).select("id", (F.col("id") % 3).alias("seq")).write.partitionBy("seq").parquet(path)
    plan = spark.createDataFrame([(0, "drop"), (1, "keep"), (2, "keep")], "seq long, action string")
    assert [r.dropped for r in publication.apply_retention(spark, path, plan).collect()] == [False]
    assert spark.read.parquet(path).count() == 6
    publication.apply_retention(spark, path, plan, dry_run=False)
    assert {r.seq for r in spark.read.parquet(path).collect()} == {1, 2}


def test_caught_up_twice(spark):
    one = lambda n: spark.createDataFrame([(n,)], "lag long")
    none = spark.createDataFrame([], "transaction_id string")
    first = capture.caught_up(one(0), none)
    assert capture.caught_up(one(0), none, first).first().confirmed
    assert not capture.caught_up(one(3), none, first).first().confirmed


def test_changes_outside_transactions_pass_the_boundary(spark):
    changes = spark.createDataFrame([(1, "t1"), (2, None), (3, "t2"), (4, "t3")], "offset long, transaction_id string")
    states = spark.createDataFrame([("t1", "COMPLETE", 1, False), ("t2", "OPEN", 3, False), ("t3", "COMPLETE", 9, False)], "transaction_id string, status string, offset long, missing_id boolean")
    boundary = spark.createDataFrame([(5,)], "target_offset long")
    assert sorted(r.offset for r in transactions.within_transactions(changes, states, boundary).collect()) == [1, 2]


@pytest.mark.parametrize("keys", [1, 4])
def test_point_in_time_joins_are_those_of_plain_loops(spark, keys):
    rnd = random.Random(keys)
    left = [(i, rnd.randrange(keys) if i % 17 else None, rnd.randrange(-5, 300), i % 3) for i in range(200)]
    right = [(rnd.randrange(keys), rnd.randrange(300), j % 3, f"v{j}") for j in range(60)]
    a = spark.createDataFrame(left, "i long, k long, t long, o long")
    b = spark.createDataFrame(right, "k long, t long, o long, v string").dropDuplicates(["k", "t", "o"])
    kept = [tuple(r) for r in b.collect()]
    b = spark.createDataFrame(kept, "k long, t long, o long, v string")
    got = {r.i: r.v for r in versions.asof_latest(a, b, ["k"], ["t", "o"], ["v"]).collect()}
    for i, k, t, o in left:
        before = [x for x in kept if x[0] == k and (x[1], x[2]) <= (t, o)]
        assert got[i] == (max(before, key=lambda x: x[1:3])[3] if before else None)
    held = [(e, rnd.randrange(keys), t, 0) for e in range(8) for t in sorted(rnd.sample(range(300), 6))]
    c = spark.createDataFrame(held, "e long, k long, t long, o long")
    found = {(r.e, r.v) for r in versions.asof_reverse(c, b, "e", "k", ["t", "o"]).collect()}
    want = set()
    for e, k, t, o in held:
        after = [x[2:] for x in held if x[0] == e and x[2:] > (t, o)]
        want |= {(e, x[3]) for x in kept if x[0] == k and (t, o) < (x[1], x[2]) and (not after or (x[1], x[2]) < min(after))}
    assert found == want


def test_entities_are_staged_by_their_contract(spark):
    spec = ledger.EntitySpec("things", "cdc.things", ("id",), "id bigint, n int", (ledger.Rule("rule_positive", "n > 0"),))
    body = lambda op, n: f'{{"op":"{op}","after":{{"id":1,"n":{n}}},"source":{{"ts_ms":1000,"snapshot":"false"}}}}'
    rows = [(1, body("c", 4), '{"id":1}'), (2, body("u", 7), '{"id":1}'), (3, body("u", -1), '{"id":1}'), (4, '{"op":"u"}', '{"id":2}')]
    records = spark.createDataFrame(rows, "offset long, envelope string, key_json string").withColumn("log_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    changes = ledger.stage_changes(records, spec)
    assert [(r.id, r.error_code) for r in changes.orderBy("offset").collect()] == [(1, None), (1, None), (1, "rule_positive"), (2, "missing_image")]
    assert [(r.id, r.n, r.offset) for r in ledger.stage(changes, spec, F.struct("offset")).collect()] == [(1, 7, 2)]

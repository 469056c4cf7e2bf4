"""Digest trees, bucketed tables, incremental intervals, promotion of types and holding times of alerts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, hashtree, ledger, schemas, versions
from tidemark.sources import buckets

AT = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("bits", [4, 8, 11])
def test_differences_by_trees_are_those_of_the_join(spark, bits):
    rnd = random.Random(bits)
    left = {i: f"h{i}" for i in range(400)}
    for changed in (0, 1, 25, 400):
        right = dict(left)
        for k in rnd.sample(range(400), changed):
            if rnd.random() < 0.3:
                del right[k]
            else:
                right[k if rnd.random() < 0.7 else 1000 + k] = "other"
        a, b = (spark.createDataFrame(list(x.items()) or [(0, None)], "k long, row_hash string") for x in (left, right))
        found = {tuple(r) for r in hashtree.tree_parity(a, b, ["k"], bits=bits).collect()}
        assert found == {tuple(r) for r in ledger.parity(a, b, ["k"]).collect()} and bool(found) == (left != right)


def test_only_differing_leaves_are_joined(spark):
    a = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("row_hash"))
    b = a.withColumn("row_hash", F.when(F.col("k") == 77, "x").otherwise(F.col("row_hash")))
    da, db = (hashtree.leaf_digests(x, ["k"], bits=10) for x in (a, b))
    leaves = [r["leaf"] for r in hashtree.differing_leaves(da, db, 10).collect()]
    assert len(leaves) == 1 and a.where(hashtree.leaf(["k"], 10).isin(leaves)).count() < 25
    parts = hashtree.combine(hashtree.leaf_digests(a.where("k < 100"), ["k"], bits=10).unionByName(hashtree.leaf_digests(a.where("k >= 100"), ["k"], bits=10)))
    assert hashtree.differing_leaves(da, parts, 10).count() == 0
    empty = a.where("false")
    assert hashtree.tree_parity(empty, empty, ["k"]).count() == 0 and hashtree.tree_parity(a.limit(9), empty, ["k"]).count() == 9
    twice = a.where("k < 3").unionByName(a.where("k = 2"))
    assert hashtree.differing_leaves(hashtree.leaf_digests(a.where("k < 3"), ["k"]), hashtree.leaf_digests(twice, ["k"])).count() == 1


def test_a_batch_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    schema = "k long, at long, v string, is_deleted boolean"
    table = buckets.BucketedTable(spark, str(tmp_path / "t"), ["k"], schema, 8)
    rnd, all_rows = random.Random(2), []
    made = [(rnd.randrange(60), i, f"v{i}", i % 5 == 0) for i in range(400)]
    rnd.shuffle(made)
    for low in range(0, 400, 80):
        batch = made[low : low + 80]
        all_rows += batch
        for _ in range(1 + (low == 160)):  # one batch comes twice
            buckets.apply_current(table, spark.createDataFrame(batch, schema), F.col("at"))
        want = {}
        for r in all_rows:
            want[r[0]] = max(want.get(r[0], r), r, key=lambda x: x[1])
        assert {tuple(r) for r in table.read().collect()} == set(want.values())
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before, one = files(), spark.createDataFrame([(7, 10_000, "new", False)], schema)
    buckets.apply_current(table, one, F.col("at"))
    touched = table.touched(one)
    assert len(touched) == 1 and {f for f in before if f"_bucket={touched[0]}/" not in f} == {f for f, t in files().items() if before.get(f) == t}
    plan = table.read(touched)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    buckets.apply_current(table, one.where("false"), F.col("at"))
    table.replace(one.where("false"), touched)
    assert all(r.k != 7 for r in table.read().collect()) and not [f for f in files() if f"_bucket={touched[0]}/" in f]


def test_intervals_do_not_depend_on_the_order_of_batches(spark, tmp_path):
    names = ("source_ts", "partition", "offset")
    schema = "k long, v string, source_ts timestamp_ntz, partition int, offset long, is_snapshot boolean, is_deleted boolean"
    build = lambda rows: versions.scd2(rows, "k", names, F.md5("v"))
    kept = ["k", "v", "valid_from", "valid_to", "is_current"]
    for seed in range(3):
        rnd = random.Random(seed)
        rows = [(rnd.randrange(12), rnd.choice("ab"), AT + dt.timedelta(hours=rnd.randrange(30)), 0, i, rnd.random() < 0.05, rnd.random() < 0.15) for i in range(120)]
        whole = spark.createDataFrame(rows, schema)
        out = build(whole).select(*kept)
        events, intervals = buckets.BucketedTable(spark, str(tmp_path / f"e{seed}"), ["k"], schema, 4), buckets.BucketedTable(spark, str(tmp_path / f"i{seed}"), ["k"], out.schema, 4)
        rnd.shuffle(rows)
        for low in (0, 50, 50, 51, 119):  # a batch again, a single row, the last one
            high = {0: 50, 50: 110, 51: 52, 119: 120}[low]
            buckets.apply_intervals(events, intervals, spark.createDataFrame(rows[low:high], schema), build)
        buckets.apply_intervals(events, intervals, spark.createDataFrame(rows[110:119], schema), build)
        buckets.apply_intervals(events, intervals, whole.where("false"), build)
        assert sorted(map(str, intervals.read().collect())) == sorted(map(str, out.collect())) and events.read().count() == 120


def test_numbers_may_widen_and_nothing_else(spark):
    kinds = ["int", "long", "float", "double", "string", None]
    pairs = spark.createDataFrame([(w, r) for w in kinds for r in kinds], "w string, r string")
    found = {(x.w, x.r) for x in pairs.where(schemas.readable(F.col("w"), F.col("r"))).collect()}
    assert found == {(k, k) for k in kinds} | {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double")}


FIELDS = "subject string, version int, record string, path string, parent string, type string, nullable boolean, has_default boolean"


def test_relaxed_rules(spark):
    one = [("a", "", "int", False, False), ("b", "", "long", True, True), ("r", "", "record", False, False), ("r.x", "r", "int", False, False), ("gone", "", "string", False, False), ("gone.y", "gone", "int", False, False), ("f", "", "double", False, False)]
    two = [("a", "", "double", False, False), ("b", "", "double", True, True), ("r", "", "record", False, False), ("r.x", "r", "string", False, False), ("n", "", "string", False, False), ("d", "", "record", True, True), ("d.z", "d", "int", False, False), ("f", "", "float", False, False)]
    rows = [("s", v, r, *f) for v, r, fields in ((1, "R", one), (2, "R", two), (3, "Q", two)) for f in fields]
    found = {(r.old, r.new, r.path, r.issue) for r in schemas.relaxed_schema_issues(spark.createDataFrame(rows, FIELDS)).collect()}
    # a number in a union with null is another type; below an addition or a removal nothing is told
    issues = {("b", "type_change"), ("r.x", "type_change"), ("gone", "removed"), ("n", "no_default"), ("f", "type_change")}
    assert found == {(1, n, *i) for n in (2, 3) for i in issues} | {(1, 3, "$", "record_rename"), (2, 3, "$", "record_rename")}


def test_writers_are_resolved_field_by_field(spark):
    schema = "path string, parent string, type string, nullable boolean, has_default boolean"
    reader = spark.createDataFrame([("id", "", "long", False, False), ("v", "", "double", True, True), ("r", "", "record", True, True), ("r.x", "r", "int", False, False), ("must", "", "string", False, False)], schema)
    writers = spark.createDataFrame(
        [("w1", "id", "", "int", False, False), ("w1", "must", "", "string", False, False), ("w1", "extra", "", "string", True, True), ("w1", "r", "", "record", True, True), ("w1", "r.x", "r", "string", False, False),
         ("w2", "id", "", "string", False, False), ("w2", "v", "", "float", False, False), ("w2", "hard", "", "record", False, False), ("w2", "hard.y", "hard", "int", False, False)], f"schema_id string, {schema}",
    )
    found = {(r.schema_id, r.path): r.outcome for r in schemas.resolve_writers(writers, reader).collect()}
    assert found == {("w1", "id"): "promoted", ("w1", "must"): "read", ("w1", "extra"): "added", ("w1", "v"): "defaulted", ("w1", "r"): "read", ("w1", "r.x"): "type_change", ("w2", "id"): "type_change", ("w2", "v"): "promoted", ("w2", "hard"): "added_required", ("w2", "r"): "defaulted", ("w2", "must"): "dropped"}


def plain_episodes(samples, holds, seconds):
    out, since, fired = [], None, None
    for at in sorted({s[0] for s in samples}):
        if all(holds(s) for s in samples if s[0] == at):
            since = since or at
            fired = fired or (at if (at - since).total_seconds() >= seconds else None)
        elif since:
            out.append((since, fired, at))
            since = fired = None
    return out + ([(since, fired, None)] if since else [])


@pytest.mark.parametrize("seed", range(3))
def test_alerts_hold_for_their_time_over_batches(spark, seed):
    rnd = random.Random(seed)
    samples = [(AT + dt.timedelta(seconds=15 * i + rnd.randrange(14)), rnd.choice([20_000, 20_000, 20_000, 1, None]), rnd.choice([0, 1, 1, 1])) for i in range(120)]
    samples += [(samples[5][0], 1, 0)]
    frame = lambda some: spark.createDataFrame([("s", *r) for r in some], "series string, at timestamp_ntz, lag long, rejected int")
    rules = (alerts.AlertRule("lag_high", "lag > 10000", 60), alerts.AlertRule("rejected_boundary", "rejected = 1", 30))
    want = {("lag_high", *e) for e in plain_episodes(samples, lambda s: (s[1] or 0) > 10_000, 60)} | {("rejected_boundary", *e) for e in plain_episodes(samples, lambda s: s[2] == 1, 30)}
    found = {(r.rule, r.since, r.fired_at, r.until) for r in alerts.episodes(frame(samples), rules).collect()}
    assert found == want and any(r[2] for r in want)
    open_, closed = None, set()
    cuts = [0, 30, 31, 75, 121]
    samples.sort(key=lambda s: s[0])
    for a, b in zip(cuts, cuts[1:]):
        while b < len(samples) and samples[b][0] == samples[b - 1][0]:
            b += 1
        part = [s for s in samples[a:b]]
        made = alerts.episodes(frame(part), rules, open_=open_).collect()
        closed |= {(r.rule, r.since, r.fired_at, r.until) for r in made if r.until}
        open_ = spark.createDataFrame(made, "rule string, series string, since timestamp_ntz, fired_at timestamp_ntz, until timestamp_ntz")
    closed |= {(r.rule, r.since, r.fired_at, r.until) for r in open_.where("until is null").collect()}
    assert closed == want and alerts.firing(open_).count() == sum(r[2] is not None and r[3] is None for r in want)

"""What keeps work and memory near the size of the input: one parse an envelope, groups of state, bounded filters."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import ledger, transactions
from tidemark.plans import entities, registry
from tidemark.plans.views import Views
from tidemark.sources import ledger_files
from tidemark.sources.ledger_files import LedgerFiles
from tidemark.streaming import stateful

AT = dt.datetime(2024, 1, 1)
SPEC = ledger.EntitySpec("things", "cdc.things", ("a", "b"), "a bigint, b bigint, amount bigint", (ledger.Rule("rule_amount", "amount <> -1"), ledger.Rule("rule_small", "amount < 5")))


def envelopes(spark):
    body = F.concat(F.lit('{"op":"u","after":{"a":1,"b":2,"amount":'), (F.col("id") - 1).cast("string"), F.lit("}}"))
    return spark.range(8).select(F.when(F.col("id") < 7, body).otherwise("no json").alias("envelope"), F.lit('{"a":1,"b":2}').alias("key_json"), F.lit(AT).cast("timestamp_ntz").alias("log_time"), F.col("id").alias("offset"))


def test_an_envelope_is_parsed_once_a_row(spark):
    staged = ledger.stage_changes(envelopes(spark), SPEC)
    for df in (ledger.applied(staged), ledger.stage(staged, SPEC, F.struct("offset"), ["offset", "amount"]), transactions.transaction_counts(staged)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(StructField(op") == 1
    found = {r.offset: (r.apply_status, r.error_code, r.failed_rules, r.a) for r in staged.collect()}
    assert found[0] == ("REJECTED", "rule_amount", 1, 1) and found[6] == ("REJECTED", "rule_small", 1, 1) and found[3] == ("APPLIED", None, 0, 1)
    assert found[7][:2] == ("REJECTED", "invalid_op") and found[7][3] == 1
    current = ledger.stage(staged, SPEC, F.struct("offset"), ["offset", "amount"])
    assert current.columns == ["a", "b", "offset", "amount", "is_deleted"] and current.first().offset == 5


def test_only_what_is_named_is_read_of_an_envelope(spark):
    whole = '{"op":"%s","before":%s,"after":%s,"source":{"ts_ms":5,"snapshot":"first"},"transaction":{"id":"tx-1"}}'
    image, other = '{"a":1,"b":2,"amount":4}', '{"a":"x","b":[1],"amount":9}'
    texts = [whole % x for x in (("d", image, "null"), ("u", image, other), ("d", "null", image), ("x", image, image), ("c", "3", "{}"))]
    texts += [None, "", "[]", texts[0][:-2], '{"op":"u","after":{"b":2}}', '{"op":"r","after":{"amount":99999999999999999999},"source":7,"transaction":{"id":3}}', '{"op":7}']
    rows = [(i, t, '{"a":1,"b":2}', AT) for i, t in enumerate(texts)]
    sent = spark.createDataFrame(rows, "offset long, envelope string, key_json string, log_time timestamp_ntz")
    every = ledger.stage_changes(sent, SPEC)
    for columns in (["offset", "is_deleted", "apply_status", "error_code"], ["offset", "transaction_id"], ["offset", "is_snapshot", "source_ts", "a", "op"], ["offset", "b", "amount", "row_hash", "error_ordinal"]):
        some = ledger.stage_changes(sent, SPEC, columns)
        assert some.columns == columns and sorted(map(repr, some.collect())) == sorted(map(repr, every.select(*columns).collect()))
    read = ledger.stage_changes(sent, SPEC, ["offset", "transaction_id", "error_code"])._jdf.queryExecution().optimizedPlan().toString()
    assert read.count("from_json") == 1 and "StructField(amount" in read and not any(f"StructField({c}," in read for c in ("a", "b", "ts_ms", "snapshot"))


def test_envelopes_of_one_row_group_are_made_by_many_tasks(spark, tmp_path):
    spark.range(-70, 2000).selectExpr("id as o_orderkey", "id * 1.5D as o_totalprice").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    log = entities.change_log(Views(spark, str(tmp_path)), "orders").select("offset", F.get_json_object("envelope", "$.op").alias("op"))
    sizes = [r["count"] for r in log.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 0.5 * sum(sizes)
    assert {(r.offset, r.op) for r in log.collect()} == {(n * 3 + i, op) for n in range(-70, 2000) for i, (op, every) in enumerate((("r", 1), ("u", 3), ("d", 11))) if n % every == 0}


def test_transactions_share_calls_by_hash(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(f"t{i}", s, o, None, None, f"t{i}:{s}", AT) for i in range(300) for s, o in (("OPEN", i), ("COMPLETE", 1000 + i))]
    for portion in (rows[::3], rows[1::3], rows[2::3]):
        spark.createDataFrame(portion, stateful.OBSERVATION).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(stateful.OBSERVATION).option("maxFilesPerTrigger", 1).parquet(source)
    query = stateful.assemble_stream(stream, "1 day", buckets=5).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    states = spark.read.parquet(out)
    found = transactions.effective_transactions(states.drop("begin_offset", "stale")).collect()
    assert {(r.transaction_id, r.status, r.offset) for r in found} == {(f"t{i}", "COMPLETE", 1000 + i) for i in range(300)} and len(found) == 300
    assert {r.transaction_id: r.b for r in states.groupBy("transaction_id").agg(F.min("begin_offset").alias("b")).collect()} == {f"t{i}": i for i in range(300)}


def test_no_task_holds_the_values_of_a_profile(spark):
    df = registry.queries()["merged_profiles"](spark, "/root/testdata/sf0.001")
    assert "percentile(" not in df._jdf.queryExecution().optimizedPlan().toString()
    found = {r.column_name: (r.distinct_close, r.median_close) for r in df.collect()}
    assert found == {"o_orderkey": (True, True), "o_custkey": (True, True), "o_orderpriority": (True, None)}


def _ids(spark, ids):
    return spark.createDataFrame([(f"id{i:05d}", i) for i in ids], "event_id string, n long").coalesce(1)


def test_a_large_batch_opens_files_by_range_and_none_of_it_is_sent(spark, tmp_path, monkeypatch):
    table = LedgerFiles(spark, str(tmp_path / "t"), ["event_id"])
    for low in (0, 100, 200):
        table.append(_ids(spark, range(low, low + 50)))
    assert [(r.n, r.low, r.high) for r in table.index().orderBy("low").collect()][1] == (50, "id00100", "id00149")
    monkeypatch.setattr(ledger_files, "KEYS", 10)
    monkeypatch.setattr(type(_ids(spark, [1])), "toArrow", lambda self: 1 / 0)
    table.append(_ids(spark, range(120, 180)))
    assert len(table.opened) == 1 and spark.read.parquet(str(tmp_path / "t")).count() == 180
    table.append(_ids(spark, range(0, 260)))
    assert len(table.opened) == 4 and spark.read.parquet(str(tmp_path / "t")).distinct().count() == 260 == spark.read.parquet(str(tmp_path / "t")).count()


def test_filters_hold_the_positions_of_few_hashes_at_once(monkeypatch):
    sizes, place = [], ledger_files._positions
    monkeypatch.setattr(ledger_files, "_positions", lambda h, n: sizes.append(len(h)) or place(h, n))
    hashes = np.random.default_rng(1).integers(-(2**62), 2**62, 200_001)
    assert ledger_files.may_hold(ledger_files.bloom(hashes), hashes).all() and max(sizes) <= 1 << 16

"""Membership-indexed ledgers, batch commits, state across batches, and as-of joins over bursts and quiet years."""

import datetime as dt
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import transactions, versions
from tidemark.sources import storage
from tidemark.sources.ledger_files import LedgerFiles, bloom, may_hold
from tidemark.streaming import capture, commits, stateful

AT = dt.datetime(2024, 1, 1)


def test_a_filter_admits_its_ids_and_few_others():
    rng = np.random.default_rng(1)
    held, other = rng.integers(-(2**62), 2**62, (2, 50_000))
    bits = bloom(held)
    assert may_hold(bits, held).all() and may_hold(bits, other).sum() <= 5
    assert not may_hold(bloom(held[:0]), other[:1000]).any()


def rows_of(spark, ids, v=0):
    return spark.createDataFrame([(f"id{i:05d}", i, v, f"run{v}") for i in ids], "event_id string, n long, v int, query_id string").coalesce(1)


def test_an_append_opens_only_files_that_may_hold_its_ids(spark, tmp_path):
    table = LedgerFiles(spark, str(tmp_path / "t"), ["event_id"])
    ids = list(range(600))
    random.Random(1).shuffle(ids)  # any order: ranges of all files overlap
    for k in range(6):
        table.append(rows_of(spark, ids[100 * k : 100 * k + 100]))
    assert len(table.files()) == 6 and table.index().count() == 6
    table.append(rows_of(spark, ids[250:260]))
    assert len(table.opened) == 1 and spark.read.parquet(str(tmp_path / "t")).count() == 600
    table.append(rows_of(spark, range(700, 720)))
    assert table.opened == [] and spark.read.parquet(str(tmp_path / "t")).count() == 620
    with pytest.raises(ValueError, match="differ"):
        table.append(rows_of(spark, [ids[5], 900], v=1))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 620
    table.append(rows_of(spark, [ids[5]]).withColumn("query_id", F.lit("another run")))  # lineage may differ
    verdicts = {r.n: r.verdict for r in table.judge(rows_of(spark, [ids[7], 901]).unionByName(rows_of(spark, [902, 903])).unionByName(rows_of(spark, [903], 2))).collect()}
    assert verdicts == {ids[7]: "known", 901: "new", 902: "new", 903: "differs_in_batch"}
    table.release()


def test_files_without_an_index_count_and_are_indexed_later(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of(spark, range(50)).write.parquet(path)
    table = LedgerFiles(spark, path, ["event_id"])
    assert table.new_rows(rows_of(spark, [3, 60])).count() == 1 and table.index().count() == 0
    table.release()
    table.append(rows_of(spark, [3, 60]).unionByName(spark.createDataFrame([(None, 1, 0, "r")], "event_id string, n long, v int, query_id string")))
    assert table.index().count() == len(table.files()) and spark.read.parquet(path).count() == 52
    table.append(rows_of(spark, []))
    assert spark.read.parquet(path).count() == 52


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path):
    tables = commits.CommittedTables(spark, str(tmp_path / "all"), "v7")
    good, broken = rows_of(spark, range(5)), rows_of(spark, range(3)).withColumn("v", F.raise_error(F.lit("planted")).cast("int"))
    with pytest.raises(Exception, match="planted"):
        tables.write(0, {"a": good, "b": broken})
    assert not tables.files("a") and not tables.files("b") and tables.failures().count() == 1
    log = spark.createDataFrame([("t", 0, 9, "t:0:9", 8)], "topic string, partition int, last_offset long, last_event_id string, events long")
    assert tables.write(0, {"a": good, "b": rows_of(spark, range(3))}, log) and not tables.write(0, {"a": rows_of(spark, range(50, 60))})
    tables.write(1, {"a": rows_of(spark, range(4, 7)), "b": rows_of(spark, [])}, log)
    schema = "event_id string, n long, v int, query_id string"
    assert [tables.read(t, schema).count() for t in ("a", "b")] == [7, 3]
    progress = {(r.batch_id, r.target): (r.contract_version, r.status, r.n_rows, r.last_offset, r.error_class) for r in tables.progress().collect()}
    assert progress == {(0, "a"): ("v7", "COMMITTED", 5, 9, None), (0, "b"): ("v7", "COMMITTED", 3, 9, None), (1, "a"): ("v7", "COMMITTED", 2, 9, None), (1, "b"): ("v7", "COMMITTED", 0, 9, None)}
    with pytest.raises(ValueError, match="differ"):
        tables.write(2, {"a": rows_of(spark, [1], v=3)})
    assert tables.commits().count() == 2 and {r.error_class for r in tables.failures().collect()} == {"fatal"}


def test_a_query_refuses_another_contracts_checkpoint(spark, tmp_path):
    source = str(tmp_path / "in")
    rows_of(spark, range(3)).write.parquet(source)
    stream = lambda: spark.readStream.schema("event_id string, n long").parquet(source)
    capture.start(stream(), "own", f"file://{tmp_path}/c", lambda b, i: None, contract="one").awaitTermination()
    with pytest.raises(ValueError, match="belongs to contract one"):
        capture.start(stream(), "own", f"file://{tmp_path}/c", lambda b, i: None, contract="two")


def _observations(spark, rows):
    full = [(t, s, o, 2 if s == "COMPLETE" else None, o if s == "COMPLETE" else None, f"{t}:{o}:{s}", AT) for t, s, o in rows]
    return spark.createDataFrame(full, stateful.OBSERVATION).coalesce(1)


def _assemble(spark, source, out, quiet="1 day"):
    stream = spark.readStream.schema(stateful.OBSERVATION).option("maxFilesPerTrigger", 1).parquet(source)
    made = stateful.assemble_stream(stream, quiet, "0 seconds").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c")
    made.trigger(availableNow=True).start().awaitTermination()


def test_transactions_span_batches_and_restarts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [("a", "OPEN", 1), ("b", "OPEN", 2), ("c", "COMPLETE", 9), ("d", "REJECTED", 4), (None, "OPEN", 5), ("big", "OPEN", 2**60 + 1)]
    later = [("a", "COMPLETE", 7), ("c", "OPEN", 3), ("d", "COMPLETE", 4), ("a", "OPEN", 1), (None, "OPEN", 6)]
    _observations(spark, first).write.parquet(source)
    _assemble(spark, source, out)
    _observations(spark, later).write.mode("append").parquet(source)
    _assemble(spark, source, out)
    _observations(spark, later).write.mode("append").parquet(source)  # all of it again
    _assemble(spark, source, out)
    states = spark.read.parquet(out)
    got = sorted((str(r.transaction_id), r.status, r.offset, r.event_count) for r in transactions.effective_transactions(states.drop("begin_offset", "stale")).dropDuplicates(["transaction_id", "event_id"]).collect())
    want = sorted((str(r.transaction_id), r.status, r.offset, r.event_count) for r in transactions.effective_transactions(_observations(spark, first + later)).collect())
    assert got == want
    begins = {r.transaction_id: r.b for r in states.groupBy("transaction_id").agg(F.min("begin_offset").alias("b")).collect()}
    assert (begins["a"], begins["c"], begins["d"], begins["big"]) == (1, 3, None, 2**60 + 1)
    assert states.where("transaction_id = 'a' and status = 'COMPLETE'").count() == 1  # copies change nothing


def test_a_timer_reports_what_stays_open(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate([[("a", "OPEN", 1), ("b", "COMPLETE", 2)], [("x", "COMPLETE", 3)], [("y", "COMPLETE", 4)], [("a", "COMPLETE", 9)]]):
        _observations(spark, rows).write.mode("append").parquet(source)
        time.sleep(1.2)
        _assemble(spark, source, out, "1 second")
    states = spark.read.parquet(out)
    assert [(r.transaction_id, r.status) for r in states.where("stale").collect()] == [("a", "OPEN")]
    assert states.where("transaction_id = 'a' and status = 'COMPLETE'").count() == 1


def test_state_of_recent_duplicates_is_bounded_and_nothing_is_lost(spark, tmp_path):
    source, ledger, progress = (str(tmp_path / n) for n in ("in", "ledger", "progress"))
    schema = "event_id string, n long, v int, query_id string, topic string, partition int, offset long, source_ts timestamp"
    made = lambda ids, v=0: rows_of(spark, ids, v).withColumns({"topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("n"), "source_ts": F.lit(AT)})
    listener = capture.ProgressListener()
    spark.streams.addListener(listener)
    write = capture.ledger_writer(ledger, progress, lambda b: b)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        capture.start(stateful.dedupe_recent(stream, ["event_id"], ["n", "v"], "2 seconds"), "recent", str(tmp_path / "c"), write).awaitTermination()

    for ids in (range(40), range(20, 60)):
        made(ids).write.mode("append").parquet(source)
        run()
    time.sleep(3)
    for ids in (range(100, 110), range(0, 5), range(110, 112)):  # the middle one comes again after the window
        made(ids).write.mode("append").parquet(source)
        run()
        time.sleep(2.5)
    assert spark.read.parquet(ledger).count() == 72 == spark.read.parquet(ledger).select("event_id").distinct().count()
    made([0], v=1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="differ"):
        run()
    spark.streams.removeListener(listener)
    kept = [r[7] for r in listener.rows if r[7]]
    assert max(kept) <= 60 and kept[-1] < 40  # far fewer than the 72 of the ledger
    assert listener.take(spark).columns[-2:] == ["state_rows", "state_bytes"]



@pytest.mark.parametrize("held", [versions.HELD, 3])
def test_versions_in_force_over_bursts_and_quiet_years(spark, monkeypatch, held):
    monkeypatch.setattr(versions, "HELD", held)
    monkeypatch.setattr(versions, "PAIRS", 50)
    rnd = random.Random(held)
    start = dt.datetime(1980, 1, 1)
    products, names = [], []
    for e in range(20):  # two versions five seconds apart, then twenty years of quiet
        t = start + dt.timedelta(seconds=rnd.randrange(10))
        products += [(e, rnd.choice("xyz"), t, 0, 2 * e), (e, rnd.choice("xyz"), t + dt.timedelta(seconds=5), 0, 2 * e + 1)]
    products += [(None, "x", start, 0, 90), (30, None, start, 0, 91), (31, "x", start, 0, 92), (31, "y", start, 0, 92)]
    names += [(c, f"{c}{i}", start + dt.timedelta(seconds=rnd.randrange(25)), 1, i) for i in range(40) for c in rnd.choice("xyz")]
    names += [("x", "late", start + dt.timedelta(days=7305), 1, 99), (None, "none", start, 1, 100)]
    a = spark.createDataFrame(products, "product long, category string, source_ts timestamp_ntz, partition int, offset long")
    b = spark.createDataFrame(names, "category string, english string, source_ts timestamp_ntz, partition int, offset long")
    found = sorted((str(r["product"]), r.category, r.english) for r in versions.asof_reverse(a, b, "product", "category", ["source_ts", "partition", "offset"]).collect())
    want = []
    for p in products:
        after = [q[2:] for q in products if q[0] == p[0] and q[2:] > p[2:]]
        twin = [q for q in products if q[0] == p[0] and q[2:] == p[2:]]
        if len(twin) > 1 and p is not twin[-1]:
            continue
        want += [(str(p[0]), p[1], n[1]) for n in names if n[0] is not None and n[0] == p[1] and n[2:] > p[2:] and (not after or n[2:] < min(after))]
    drop = lambda rows: sorted(r for r in rows if r[0] != "31")  # noqa: E731, equal orders of one entity: either may be last
    assert drop(found) == drop(want) and any(r[2] == "late" for r in found)


def test_ranges_hold_equally_many_rows(spark):
    rows = spark.range(4000).select((F.pow(F.lit(1.01), F.col("id") / 4)).alias("_t"))
    cuts = versions._cuts([rows], 16)
    sizes = [r["count"] for r in rows.groupBy(versions._range(F.col("_t"), cuts).alias("k")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 250
    assert versions._cuts([rows.limit(0)], 16) == [] and versions._cuts([rows], 1) == []

import datetime as dt
import hashlib
import types

import pytest
from pyspark.sql import functions as F

from tidemark.functions import frames, values
from tidemark.operators import checks, ledger, publication, schemas, transactions
from tidemark.plans import cdc

OBS = "transaction_id string, status string, offset long, event_count long, end_offset long, event_id string, recorded_at timestamp"
AT = dt.datetime(2024, 1, 1)


def obs(spark, *rows):
    full = [(t, s, o, n, o if s == "COMPLETE" else None, f"tx:{i}", AT) for i, (t, s, o, n) in enumerate(rows)]
    return transactions.effective_transactions(spark.createDataFrame(full, OBS))


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("a", "OPEN", 5, None), ("a", "COMPLETE", 9, 2)], ("MATERIALIZING", "complete_prefix", 9, 1, 2)), ([("a", "OPEN", 5, None)], ("WAITING", "open_transaction", None, 0, 0)),
        ([("a", "REJECTED", 5, None)], ("BLOCKED", "rejected_transaction", None, 0, 0)), ([("a", "REJECTED", 5, None), ("a", "COMPLETE", 6, 1)], ("MATERIALIZING", "complete_prefix", 6, 1, 1)),
        ([], ("NOOP", "nothing_new", None, 0, 0)), ([("a", "COMPLETE", 5, 0)], ("NOOP", "nothing_new", None, 0, 0)), ([("a", "COMPLETE", 1, 3)], ("NOOP", "nothing_new", None, 0, 0)),
        ([("a", "ODD", 5, 1)], ("BLOCKED", "unknown_state", None, 0, 0)), ([("a", "COMPLETE", None, 1)], ("BLOCKED", "missing_offset", None, 0, 0)), ([(None, "COMPLETE", 5, 1)], ("BLOCKED", "missing_transaction_id", None, 0, 0)),
        ([("a", "COMPLETE", 5, 1), ("b", "OPEN", 7, None), ("c", "COMPLETE", 9, 4)], ("MATERIALIZING", "complete_prefix", 5, 1, 1)), ([("a", "COMPLETE", 5, 1), ("b", "REJECTED", 7, None)], ("BLOCKED", "rejected_transaction", None, 0, 0)),
        ([("a", "COMPLETE", 5, 3), ("b", "COMPLETE", 9, 0)], ("MATERIALIZING", "complete_prefix", 5, 1, 3)), ([("a", "COMPLETE", 5, 3), (None, "COMPLETE", 9, 1)], ("BLOCKED", "missing_transaction_id", None, 0, 0)),
        ([("a", "COMPLETE", 5, 3), (" ", "COMPLETE", 9, 1)], ("BLOCKED", "missing_transaction_id", None, 0, 0)), ([("a", "COMPLETE", 5, 3), ("b", "OPEN", 6, None), ("c", "REJECTED", 7, None), ("d", "ODD", 8, 1)], ("MATERIALIZING", "complete_prefix", 5, 1, 3)),
        ([("a", "COMPLETE", 5, 0), ("b", "OPEN", 6, None)], ("WAITING", "open_transaction", None, 0, 0)), ([("a", None, 5, 1)], ("BLOCKED", "unknown_state", None, 0, 0)),
    ],
)
def test_boundary_outcomes(spark, rows, want):
    r = transactions.select_boundary(obs(spark, *rows), 2).first()
    assert (r.status, r.reason, r.target_offset, r.transactions, r.expected_events) == want


def test_one_effective_observation_each(spark):
    got = obs(spark, ("a", "OPEN", 1, None), ("a", "COMPLETE", 4, 2), ("a", "COMPLETE", 4, 2), ("b", "OPEN", 5, None), ("c", "REJECTED", 6, None), ("c", "COMPLETE", 6, 1), (None, "OPEN", 3, None)).collect()
    assert sorted((r.transaction_id or "-", r.status, r.missing_id) for r in got) == [("-", "OPEN", True), ("a", "COMPLETE", False), ("b", "OPEN", False), ("c", "COMPLETE", False)]


def test_initial_snapshot_needs_all_entities(spark):
    changes = spark.createDataFrame([("a", 1, True), ("a", 4, True), ("b", 2, True)], "entity string, offset long, is_snapshot boolean")
    need = spark.createDataFrame([("a",), ("b",)], "entity string")
    assert transactions.initial_boundary(changes, need).first().asDict() == {"status": "MATERIALIZING", "missing_entities": 0, "target_offset": 4, "expected_events": 3}
    assert transactions.initial_boundary(changes.where("entity = 'a'"), need).first().status == "WAITING"


@pytest.mark.parametrize("raw, error, schema_id", [(None, "value_null", None), ("0000", "value_too_short", None), ("010000002A61", "value_bad_magic", None), ("0000000000", "value_bad_schema_id", None), ("00FFFFFFFF", "value_bad_schema_id", None), ("000000002A6869", None, 42)])
def test_frames(spark, raw, error, schema_id):
    f = spark.createDataFrame([(bytes.fromhex(raw) if raw else None,)], "b binary").select(frames.inspect_frame(F.col("b"), "value").alias("f")).first().f
    assert (f.error, f.schema_id, f.valid) == (error, schema_id, error is None)
    assert f.payload == (b"hi" if error is None else None)


@pytest.mark.parametrize("number", [0, 1, -1, 123456, -99999])
def test_unscaled_decimals(spark, number):
    raw = number.to_bytes(4, "big", signed=True)
    got = spark.createDataFrame([(raw,)], "b binary").select(frames.unscaled_decimal(F.col("b"), 4, 2).alias("d")).first().d
    assert float(got) == number / 100


def test_rules_report_the_first_failure(spark):
    rules = (ledger.Rule("rule_score", "score between 1 and 5"), ledger.Rule("rule_name", "name rlike '^[A-Z]{2}$'"))
    df = spark.createDataFrame([(1, 9, "xx"), (2, 3, "xx"), (3, None, "SP")], "id int, score int, name string")
    assert [(r.id, r.apply_status, r.error_code, r.failed_rules) for r in ledger.apply_rules(df, rules).orderBy("id").collect()] == [(1, "REJECTED", "rule_score", 2), (2, "REJECTED", "rule_name", 1), (3, "APPLIED", None, 0)]


def test_snapshot_crud_and_evolution_counts(spark):
    from tidemark.operators.versions import current_counts, current_state

    order = F.struct("partition", "offset")
    cols = "k int, op string, partition int, offset long, is_deleted boolean"
    snapshot = [(i, "r", 0, i, False) for i in range(79)]
    crud = [(79 + i, "c", 0, 100 + i, False) for i in range(7)] + [(0, "u", 0, 110, False), (1, "u", 0, 111, False), (2, "d", 0, 112, True)]
    first = spark.createDataFrame(snapshot, cols)
    after = first.unionByName(spark.createDataFrame(crud, cols))
    assert current_counts(first, ["k"], order).first().visible == 79
    assert current_counts(after, ["k"], order).first().asDict() == {"changes": 89, "physical": 86, "visible": 85, "deleted": 1}
    evolved = ledger.align_schema(after, spark.createDataFrame([(3, "u", 0, 120, False, "new")], cols + ", extra string"))
    assert evolved.count() == 90 and current_state(evolved, ["k"], order).where("extra = 'new'").count() == 1
    again = ledger.new_rows(evolved, evolved, ["offset"])
    assert again.count() == 0


def test_conflicting_copies_are_held_back(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "id string, x int")
    good, bad = ledger.dedupe_exact(df, "id", ["x"])
    assert [r.id for r in good.collect()] == ["a"] and [r.id for r in bad.collect()] == ["b"]


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_checksums_are_of_leaves_and_not_of_order(spark, digits):
    lines = [(i % 3 if i % 3 else None, f"line {i * 7919 % 1000} é" if i % 10 else None) for i in range(1000)] + [(7, None), (8, "one"), (8, "one")]
    frame = spark.createDataFrame(lines, "g int, l string")
    got = {r.g: (r.checksum, r.lines) for r in ledger.event_checksum(frame.repartition(5), ["g"], F.col("l"), digits).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for g in {g for g, _ in lines}:
        own = [x for k, x in lines if k == g]
        leaves = {}
        for x in own:
            if x is not None:
                leaves.setdefault(sha(x)[:digits], []).append(x)
        want[g] = (sha("\n".join(sha("\n".join(sorted(leaves[k]))) for k in sorted(leaves))), len(own))
    assert got == want
    other = {r.g: r.checksum for r in ledger.event_checksum(frame.withColumn("l", F.when(F.col("l") == "one", "two").otherwise(F.col("l"))), ["g"], F.col("l"), digits).collect()}
    assert {g for g in want if other[g] != want[g][0]} == {8}


def test_status_documents_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cdc.storage, "status_rows", lambda d: seen.append(d) or d.select("application", "updated_at", F.explode("queries").alias("q")).select("application", "updated_at", "q.*"))
    changes = spark.range(60_000).selectExpr("id as user_id", "id % 3 as partition", "'u' as op", "id as offset")
    assert cdc.status_rows(types.SimpleNamespace(changes=changes)).count() == 60_000
    assert seen[0].agg(F.max(F.size("queries"))).first()[0] <= 10_000


def test_unpublished_runs_stay_hidden(spark):
    rows = spark.createDataFrame([("k", 1, "one"), ("k", 2, "two")], "k string, seq long, v string")
    markers = spark.createDataFrame([(1, "PUBLISHED", AT), (2, "MATERIALIZING", AT)], "seq long, status string, recorded_at timestamp")
    assert [r.v for r in publication.published_view(rows, markers).collect()] == ["one"]
    assert {r.v for r in publication.visible_runs(rows, markers, 2).collect()} == {"one", "two"}


def test_illegal_transitions_show(spark):
    events = spark.createDataFrame([("a", "STARTED", AT), ("a", "PUBLISHED", AT + dt.timedelta(hours=1))], "run_id string, status string, recorded_at timestamp")
    r = publication.run_ledger(events).first()
    assert (r.status, r.legal) == ("PUBLISHED", 0)


def test_schema_changes(spark):
    fields = [("s", 1, "a", "int", False), ("s", 1, "b", "int", True), ("s", 1, "c", "int", True), ("s", 2, "a", "long", False), ("s", 2, "c", "int", True), ("s", 2, "d", "int", True), ("s", 2, "e", "int", False)]
    got = schemas.schema_issues(spark.createDataFrame(fields, "subject string, version int, path string, type string, nullable boolean"))
    assert {(r.path, r.issue) for r in got.collect()} == {("a", "type_change"), ("b", "removed"), ("e", "required_addition")}


def test_drift_of_a_declared_table(spark):
    a = schemas.field_table(spark.createDataFrame([], "x int, y string, z int"), "t", 1)
    b = schemas.field_table(spark.createDataFrame([], "x long, y string, w int"), "t", 1)
    assert {(r.path, r.drift) for r in schemas.table_drift(a, b).collect()} == {("x", "type"), ("z", "extra"), ("w", "missing")}


def test_profile_types(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-01", "x", None), ("-2", "3", "2024-01-01 10:00:00", "1", None)], "a string, b string, c string, d string, e string")
    assert {r.column_name: r.inferred_type for r in schemas.profile(df, ["a", "b", "c", "d", "e"]).collect()} == {"a": "integer", "b": "decimal", "c": "timestamp", "d": "string", "e": "empty"}


def test_redaction_and_source_order(spark):
    got = spark.createDataFrame([("password=abc, x Bearer abc.def", "bin.000012")], "t string, f string").select(values.redact("t").alias("t"), values.file_index("f").alias("f")).first()
    assert got.t == "password=***, x bearer ***" and got.f == 12


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    assert [r.fk for r in checks.orphans(child, "fk", spark.createDataFrame([(1,)], "pk int"), "pk").collect()] == [2]

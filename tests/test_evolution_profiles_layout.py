"""Columns that writers add, profiles that merge, and compaction in an order of two keys."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evolution, ledger, sketches
from tidemark.sources import clustering

CONTRACT = "id bigint, n int"
WRITERS = {1: CONTRACT, 2: "id bigint, n int, colour string", 3: "id bigint, n bigint, colour string, weight double", 4: CONTRACT}


def envelopes(spark, rows):
    made = [(f"e{i}", i, s, json.dumps({"op": "c", "after": image}), json.dumps({"id": image["id"]})) for i, (s, image) in enumerate(rows)]
    return spark.createDataFrame(made, "event_id string, offset long, schema_id int, envelope string, key_json string").withColumn("log_time", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_each_writer_is_read_by_its_own_columns(spark):
    image = {"id": 1, "n": 5, "colour": "red", "weight": 0.5}
    sent = envelopes(spark, [(1, image), (2, image), (3, {**image, "n": 2**40}), (4, image), (9, image), (None, image)])
    rows = evolution.normalize_by_writer(sent, WRITERS, CONTRACT, "id bigint").orderBy("offset").collect()
    assert [(r.n, r.colour, r.weight, r.apply_status, r.error_code) for r in rows] == [
        (5, None, None, "APPLIED", None), (5, "red", None, "APPLIED", None), (2**40, "red", 0.5, "APPLIED", None), (5, None, None, "APPLIED", None), (5, None, None, "REJECTED", "unknown_writer"), (5, None, None, "REJECTED", "unknown_writer"),
    ]
    assert rows[0].row_hash == rows[3].row_hash == ledger.normalize(sent, CONTRACT).orderBy("offset").first().row_hash != rows[1].row_hash
    found = {r.column_name: (r.schema_id, r.event_id, r.rows) for r in evolution.column_origins(sent, WRITERS, CONTRACT, F.col("offset")).collect()}
    assert found == {"colour": (2, "e1", 2), "weight": (3, "e2", 1)}
    assert evolution.column_origins(sent, {1: CONTRACT}, CONTRACT, F.col("offset")).count() == 0


def test_a_ledger_takes_new_columns_and_wider_numbers(spark):
    old = spark.createDataFrame([("a", 1)], "event_id string, n int")
    new = spark.createDataFrame([("b", 2**40, "red")], "event_id string, n bigint, colour string")
    both = evolution.add_to_ledger(old, new)
    assert dict(both.dtypes) == {"event_id": "string", "n": "bigint", "colour": "string"}
    assert {tuple(r) for r in both.collect()} == {("a", 1, None), ("b", 2**40, "red")}
    assert dict(evolution.add_to_ledger(new, old).dtypes)["n"] == "bigint"
    with pytest.raises(ValueError, match="no common type"):
        evolution.add_to_ledger(old, spark.createDataFrame([("c", "x")], "event_id string, n string"))
    with pytest.raises(ValueError, match="identifiers"):
        evolution.add_to_ledger(old, spark.createDataFrame([("c", 1)], "event_id string, `a b` int"))
    assert evolution.wider("float", "int") == "float" == evolution.wider("int", "float") and evolution.wider("double", "bigint") == "double"


def test_merged_profiles_are_near_the_whole(spark):
    rnd = random.Random(5)
    rows = [(i % 4, rnd.randrange(3000) if i % 10 else None, f"w{rnd.randrange(40)}", None) for i in range(8000)]
    df = spark.createDataFrame(rows, "day int, n int, word string, none double")
    days = sketches.profile_sketches(df, ["n", "word", "none"], ["day"])
    assert days.count() == 12 and dict(days.dtypes)["distinct"] == dict(days.dtypes)["quantiles"] == "binary"
    merged = {r.column_name: r for r in sketches.read_profiles(sketches.merge_profiles(days)).collect()}
    whole = {r.column_name: r for r in sketches.read_profiles(sketches.profile_sketches(df, ["n", "word", "none"])).collect()}
    values = sorted(r[1] for r in rows if r[1] is not None)
    for found in (merged, whole):
        assert (found["n"].n, found["n"].nulls, found["word"].least, found["none"].nulls, found["none"].greatest) == (8000, 800, "w0", 8000, None)
        assert abs(found["n"].distinct_values - len(set(values))) <= 0.08 * len(set(values)) and abs(found["word"].distinct_values - 40) <= 1 and found["none"].distinct_values == 0
        for q, x in zip((0.25, 0.5, 0.75), found["n"].quantiles):
            rank = sum(v <= x for v in values) / len(values)
            assert abs(rank - q) < 0.04
        assert found["word"].quantiles is None and found["none"].quantiles is None
    assert sketches.merge_profiles(days.where("false")).count() == 0


def test_files_are_packed_by_size():
    sizes = {"a": 60, "b": 50, "c": 40, "d": 30, "e": 20, "big": 150}
    groups = clustering.pack_files(sizes, 100)
    assert sorted(f for g in groups for f in g) == sorted(sizes) and ["big"] in groups
    assert all(sum(sizes[f] for f in g) <= 100 for g in groups if g != ["big"]) and len(groups) == 3
    assert clustering.pack_files({}, 100) == []


def test_a_filter_on_either_key_opens_few_files(spark, tmp_path):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), F.pow(F.lit(1.0005), F.col("id")).alias("b"), F.lit("x").alias("c"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, "n")], "a long, b double, c string"))
    rows.repartition(40).write.parquet(str(tmp_path / "loose"))
    size = sum(clustering.file_sizes(spark, str(tmp_path / "loose")).values())
    audit = clustering.compact_clustered(spark, str(tmp_path / "loose"), str(tmp_path / "tight"), ["a", "b"], size // 36 + 1).first()
    table = spark.read.parquet(str(tmp_path / "tight"))
    assert audit.files_before == 40 and audit.files_after == 36 and table.count() == 20_001
    assert table.exceptAll(rows).count() == 0
    for where in (F.col("a") < 400, F.col("b") < F.pow(F.lit(1.0005), F.lit(400)), F.col("a").between(9000, 9300)):
        assert clustering.opened_share(table, where) <= 0.34  # about the root of the files, a sixth, and its neighbours
    assert clustering.opened_share(spark.read.parquet(str(tmp_path / "loose")), F.col("a") < 400) > 0.9


def test_small_files_are_packed_and_rows_stay(spark, tmp_path):
    for i in range(12):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "many"))
    one = max(clustering.file_sizes(spark, str(tmp_path / "many")).values())
    audit = clustering.pack_small(spark, str(tmp_path / "many"), str(tmp_path / "few"), 4 * one)
    files = clustering.file_sizes(spark, str(tmp_path / "few"))
    assert audit.first().files_after <= 4 and len(files) <= 4 and spark.read.parquet(str(tmp_path / "few")).distinct().count() == 120


def test_interleaved_bits(spark):
    found = {(r.a, r.b): r.z for r in spark.range(16).select((F.col("id") % 4).alias("a"), F.floor(F.col("id") / 4).alias("b")).select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    assert found == {(a, b): (a & 1) | (b & 1) << 1 | (a >> 1) << 2 | (b >> 1) << 3 for a in range(4) for b in range(4)}

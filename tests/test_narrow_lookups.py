"""The fact is spread by order once: only orders, keys and times are sent to the versions and back."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold, versions
from tidemark.plans import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def joins_by_exchange(spark):
    """No table is broadcast for its size, as with larger ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    """What each exchange of the plan sends: its keys as text and its columns."""
    found, todo = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append((node.outputPartitioning().toString(), {node.output().apply(i).name() for i in range(node.output().size())}))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_whole_facts_are_sent_once(spark, joins_by_exchange):
    sent = exchanges(registry.queries()["fact_order_items"](spark, SMALL))
    items = [keys for keys, columns in sent if columns & {"price_cents", "l_extendedprice", "allocated_cents"}]
    assert len(items) == 1 and items[0].startswith("hashpartitioning(order_id")
    assert not [columns for _, columns in sent if any(c.endswith(("version_key", "seller_key", "status_key")) for c in columns)]
    orders = [keys for keys, columns in sent if "status" in columns and "customer_id" in columns]
    assert sorted(keys.split("#")[0] for keys in orders) == ["hashpartitioning(customer_id", "hashpartitioning(order_id"]


def test_equal_exchanges_are_made_once_and_keys_without_partners_are_not_sent(spark, joins_by_exchange):
    df = registry.queries()["fact_order_items"](spark, SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("ReusedExchange") >= 4  # orders by customer and by order, listings, versions
    rows = spark.createDataFrame([(i,) for i in range(40)], "k long")
    keys = spark.createDataFrame([(3,), (5,), (5,), (None,)], "k long")
    assert [r.k for r in versions.with_keys(rows, keys, "k").collect()] == [3, 5]


def test_keys_and_sellers_may_be_many(spark, joins_by_exchange, monkeypatch):
    few = registry.queries()["fact_order_items"](spark, SMALL)
    want = sorted(map(repr, few.collect()))
    monkeypatch.setattr(versions, "KEYS", 3)
    monkeypatch.setattr(gold, "SELLERS", 3)
    many = registry.queries()["fact_order_items"](spark, SMALL)
    assert sorted(map(repr, many.collect())) == want
    rows = spark.createDataFrame([(i,) for i in range(40)], "k long")
    assert versions.with_keys(rows, rows.where("k > 10"), "k").count() == 40


def test_fact_of_odd_tables_equals_its_sql(spark, joins_by_exchange, tmp_path):
    t = {name: spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("orders", "lineitem", "customer", "supplier", "events")}
    key, line = F.col("o_orderkey"), F.col("l_orderkey")
    begins = t["events"].select((F.col("event_id") * 2).alias("o_orderkey"), "ts")  # many orders at the moment when a version begins or ends
    other = F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(secs=(key * 7919) % 2592000)
    at = F.when(key % 97 == 0, None).when(key % 13 == 1, F.to_timestamp(F.lit("1890-05-05"))).otherwise(F.coalesce("ts", other)).cast(t["orders"].schema["o_orderdate"].dataType)
    orders = t["orders"].join(begins, "o_orderkey", "left").withColumn("o_orderdate", at).withColumn("o_custkey", F.when(key % 89 != 0, F.col("o_custkey") % 15)).drop("ts").select(t["orders"].columns)
    twice = orders.where(key % 50 == 4)  # the same order again, and with another customer and time
    moved = orders.where(key % 60 == 8).withColumn("o_custkey", F.col("o_custkey") + 3).withColumn("o_orderdate", (F.col("o_orderdate") + F.expr("interval 9 days")).cast(orders.schema["o_orderdate"].dataType))
    lines = t["lineitem"].withColumn("l_suppkey", F.when(line % 37 != 0, F.col("l_suppkey"))).withColumn("l_orderkey", F.when(line % 41 != 0, line))
    made = {
        "orders": orders.unionByName(twice).unionByName(moved), "lineitem": lines.unionByName(lines.where(line % 20 == 4)), "events": t["events"],
        "customer": t["customer"].unionByName(t["customer"].where("c_custkey % 4 = 0")), "supplier": t["supplier"].unionByName(t["supplier"].where("s_suppkey % 3 = 1")),
    }
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        part = next(f for f in os.listdir(f"{tmp_path}/{name}.parquet") if f.endswith(".parquet"))
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/{part}'")
    df = registry.queries()["fact_order_items"](spark, str(tmp_path))
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    found = con.execute(registry.oracle_sql()["fact_order_items"])
    names = [d[0] for d in found.description]
    want = sorted(repr([dict(zip(names, row))[c] for c in columns]) for row in found.fetchall())
    assert got == want and len({r.product_version_key for r in df.collect()}) > 50


@pytest.mark.parametrize("parts", ["1", "4", "32"])
def test_facts_at_home_find_what_others_find(spark, joins_by_exchange, parts):
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    spans = [(k, day(10 * i), None if i == 19 else day(10 * i + (5 if i % 3 else 10)), f"{k}{i}") for k in "abc" for i in range(20)]
    dim = spark.createDataFrame(spans, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    facts = [(i // 5 if i % 17 else None, None if i % 11 == 0 else "abcd"[i % 4], None if i % 13 == 0 else day(i * 7 % 215 - 5), f"p{i}") for i in range(600)]
    facts += facts[:90] + [(7, "abcd"[i % 4], day(i // 4), f"q{i}") for i in range(400)]  # repeated rows, a home with many keys and times
    fact = spark.createDataFrame(facts, "home long, k string, at timestamp_ntz, payload string")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        cuts = versions.time_cuts(fact.select("at"), dim.select("valid_from"))
        want = sorted(map(repr, versions.scd2_lookup(fact.drop("home"), dim, "k", "at", "v").collect()))
        at = fact.select("home", "k", "at", versions.time_range(fact, "at", cuts).alias("place"))
        for more in ({}, {"cuts": cuts}, {"cuts": cuts, "moments": at, "place": "place"}):
            df = versions.scd2_lookup(fact.where("home is not null").repartition("home"), dim, "k", "at", "v", home="home", **more)
            lost = versions.scd2_lookup(fact.where("home is null").drop("home"), dim, "k", "at", "v")
            assert df.columns == ["home", "k", "at", "payload", "v"]
            assert sorted(map(repr, df.drop("home").unionByName(lost).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")

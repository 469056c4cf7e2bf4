"""Point-in-time work whose plans do not grow with the ranges, and lookups that sort moments instead of facts."""

import bisect
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.plans import registry

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_range_is_found_by_halving_and_its_expression_does_not_grow(spark):
    values = spark.range(700).select(F.when(F.col("id") != 699, F.col("id") * 1.5 - 20).alias("t"))
    for n in (0, 1, 2, 3, 7, 8, 199, 511):
        cuts = [float(i * i % 1009 + i) for i in range(n)]
        cuts = sorted(set(cuts))
        df = values.select("t", versions._range(F.col("t"), cuts).alias("at"))
        assert all(r["at"] == (0 if r.t is None else bisect.bisect_right(cuts, r.t)) for r in df.collect())
        assert plan(df).count("CASE WHEN") <= 1 + plan(values).count("CASE WHEN")


def test_scd2_two_stream_has_small_expressions_whatever_the_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert plan(registry.queries()["scd2_two_stream"](spark, SMALL)).count("CASE WHEN") < 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_facts_are_not_sorted_among_versions(spark):
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    spans = [(k, 10 * i, 10 * i + (5 if i % 3 else 10), f"{k}{i}") for k in "abc" for i in range(20)]
    dim = spark.createDataFrame([(k, day(a), None if a == 190 else day(b), v) for k, a, b, v in spans], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    facts = [(None if i % 11 == 0 else "abcd"[i % 4], None if i % 13 == 0 else i * 7 % 210, f"p{i}", {"x": str(i)}) for i in range(400)]
    facts += facts[:50]  # repeated rows stay
    fact = spark.createDataFrame([(k, day(t), p, m) for k, t, p, m in facts], "k string, at timestamp_ntz, payload string, tags map<string,string>")

    def plain(k, t):
        return next((v for g, a, b, v in spans if g == k and t is not None and a <= t and (a == 190 or t < b)), None)

    df = versions.scd2_lookup(fact, dim, "k", "at", "v")
    assert df.columns == ["k", "at", "payload", "tags", "v"]
    assert sorted((r.payload, str(r.v)) for r in df.collect()) == sorted((p, str(plain(k, t))) for k, t, p, _ in facts)
    assert not [line for line in plan(df).splitlines() if "_side" in line and "payload" in line]


def test_items_are_numbered_and_allocated_in_one_exchange(spark):
    text = plan(registry.queries()["payment_allocation"](spark, SMALL))
    assert text.count("Window [") == 2 and text.count("Exchange hashpartitioning(") == 2  # items, payments

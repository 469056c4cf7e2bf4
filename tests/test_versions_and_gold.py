import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import checks, gold, versions

ORDER = ("source_ts", "partition", "offset")
EVENT = "k string, v string, source_ts timestamp_ntz, partition int, offset long, is_snapshot boolean, is_deleted boolean"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "order_id long, item_no long, price_cents long, freight_cents long")


def payments(spark, *rows):
    return spark.createDataFrame(list(rows), "order_id long, paid_cents long")


def test_payments_are_allocated_by_share_and_not_at_zero_gross(spark):
    got = gold.allocate(items(spark, (1, 1, 5000, 1000), (1, 2, 3500, 500), (2, 1, 0, 0), (3, 1, 10, 0)), payments(spark, (1, 5000), (1, 5000), (2, 1000)))
    assert {(r.order_id, r.item_no): r.allocated_cents for r in got.collect()} == {(1, 1): 6000, (1, 2): 4000, (2, 1): None, (3, 1): None}
    assert checks.allocation_balance(got).count() == 0


def test_identical_updates_collapse_and_a_delete_closes(spark):
    rows = [("a", "x", day(0), 0, 1, True, False), ("a", "x", day(1), 0, 2, False, False), ("a", "x", day(2), 0, 3, False, True)]
    got = versions.scd2(spark.createDataFrame(rows, EVENT), "k", ORDER, F.md5("v")).collect()
    assert [(r.v, r.valid_from, r.valid_to, r.is_current) for r in got] == [("x", dt.datetime(1900, 1, 1), day(2), False)]


def test_an_old_category_does_not_return(spark):
    products = spark.createDataFrame([("p", "cat-a", day(0), 0, 1), ("p", "cat-b", day(1), 0, 2)], "product string, category string, source_ts timestamp_ntz, partition int, offset long")
    names = spark.createDataFrame([("cat-a", "A", day(-1), 0, 0), ("cat-a", "A2", day(2), 0, 3), ("cat-b", "B", day(-1), 0, 5)], "category string, english string, source_ts timestamp_ntz, partition int, offset long")
    own = versions.asof_latest(products, names, ["category"], ORDER, ["english"])
    assert sorted((r.category, r.english) for r in own.collect()) == [("cat-a", "A"), ("cat-b", "B")]
    assert versions.asof_reverse(products, names, "product", "category", ORDER).count() == 0


def test_asof_takes_equal_orders_and_keeps_null_keys(spark):
    left = spark.createDataFrame([("a", 1, "l1"), ("a", 5, "l2"), (None, 1, "l3")], "k string, t int, name string")
    right = spark.createDataFrame([("a", 1, 10), ("a", 4, 20), ("a", 6, 30)], "k string, t int, x int")
    assert {r.name: r.x for r in versions.asof_latest(left, right, ["k"], ["t"], ["x"]).collect()} == {"l1": 10, "l2": 20, "l3": None}


def test_asof_with_given_cuts_and_moments_finds_the_same(spark):
    schema = "k string, t int, name string, tags map<string,string>"
    rows = [(None if i % 11 == 0 else "abc"[i % 3], None if i % 13 == 0 else i * 7 % 200, f"l{i}", {"x": str(i)}) for i in range(300)]
    left = spark.createDataFrame(rows + rows[:5], schema)  # also repeated rows, and a column that cannot be hashed
    known = [("abc"[i % 3], i * 31 % 200, i) for i in range(40)]
    right = spark.createDataFrame(known, "k string, t int, x int")

    def plain(k, t):
        older = [(u, x) for g, u, x in known if g == k and t is not None and u <= t]
        return max(older)[1] if older else None

    want = sorted((n, str(plain(k, t))) for k, t, n, _ in rows + rows[:5])
    moments = left.select("k", "t").union(spark.createDataFrame([("z", 5), ("a", 999)], "k string, t int"))
    for cuts in (None, [], [50.0], versions.time_cuts(left.select("t"), right.select("t"))):
        for extra in (None, moments):
            got = versions.asof_latest(left, right, ["k"], ["t"], ["x"], cuts, extra).collect()
            assert sorted((r.name, str(r.x)) for r in got) == want
    assert versions.asof_latest(left.limit(0), right, ["k"], ["t"], ["x"]).count() == 0


def test_deletes_leave_only_after_ranking(spark):
    rows = [("a", "old", day(0), 0, 1, False, False), ("a", "gone", day(1), 0, 2, False, True), ("b", "one", day(0), 0, 3, False, False), ("b", "two", day(0), 0, 4, False, False)]
    df = spark.createDataFrame(rows, EVENT)
    order = F.struct("partition", "offset")
    assert [(r.k, r.v) for r in versions.current_state(df, ["k"], order).collect()] == [("b", "two")]
    assert versions.current_counts(df, ["k"], order).first().asDict() == {"changes": 4, "physical": 2, "visible": 1, "deleted": 1}
    late = df.where("offset in (1, 3)")
    assert {r.v for r in versions.apply_current(df.where("offset in (2, 4)"), late, ["k"], order).collect()} == {"gone", "two"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(0, 6), st.booleans(), st.booleans()), max_size=12))
def test_intervals_are_disjoint_and_order_of_arrival_is_no_matter(spark, events):
    rows = [(k, v, day(d), 0, i, s, x) for i, (k, v, d, s, x) in enumerate(events)]
    make = lambda r: versions.scd2(spark.createDataFrame(r, EVENT), "k", ORDER, F.md5("v"))
    dim = make(rows)
    assert versions.interval_overlaps(dim, "k").count() == 0
    seen = lambda d: sorted((r.k, r.v, str(r.valid_from), str(r.valid_to)) for r in d.collect())
    assert seen(dim) == seen(make(rows[::-1]))


def test_point_in_time_lookup(spark):
    rows = [("a", "x", day(0), 0, 1, False, False), ("a", "y", day(5), 0, 2, False, False)]
    dim = versions.scd2(spark.createDataFrame(rows, EVENT), "k", ORDER, F.md5("v"))
    fact = spark.createDataFrame([("a", day(1)), ("a", day(5)), ("c", day(1))], "k string, at timestamp_ntz")
    got = versions.scd2_lookup(fact, dim, "k", "at", "v").collect()
    assert sorted((r.k, r.v or "") for r in got) == [("a", "x"), ("a", "y"), ("c", "")]


def test_overlaps_are_found(spark):
    rows = [("a", day(0), day(5)), ("a", day(3), day(6)), ("a", day(6), None)]
    bad = versions.interval_overlaps(spark.createDataFrame(rows, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz"), "k").collect()
    assert [r.valid_from for r in bad] == [day(3)]

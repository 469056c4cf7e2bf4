"""Dimensions, fact, marts and their checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks, gold, versions
from tidemark.plans.catalog import query
from tidemark.plans.views import Views

ORDER = ("source_ts", "partition", "offset")


def allocation(v: Views) -> DataFrame:
    return gold.allocate(v.items, v.payments)


def sales(v: Views, customers: bool = False) -> DataFrame:
    """Allocated items with what the marts need of their orders and, if asked, customers."""
    rows = gold.allocate(v.items, v.payments, "price_cents", "freight_cents").join(v.orders, "order_id")
    rows = rows.join(v.customers, "customer_id", "left") if customers else rows
    return rows.select("order_id", "item_no", "customer_id", *["unique_id"] * customers, F.to_date("purchase").alias("purchase_day"), "status", "price_cents", "freight_cents", "allocated_cents")


def user_versions(v: Views, users: DataFrame | None = None) -> DataFrame:
    """Versions of all users, or at least of those in a table of user_id."""
    attributes = F.md5(F.concat(F.col("event_type"), F.lit("|"), F.expr("cast(value_cents div 20000 as string)")))
    changes = v.changes if users is None else versions.with_keys(v.changes, users, "user_id")
    return versions.scd2(changes, "user_id", ORDER, attributes)


@query("select purchase_day, items, orders, customers, delivered_orders, failed_orders, price_cents, freight_cents, paid_cents, gross_cents, average_order_cents from v_daily")
def mart_daily_revenue(v: Views) -> DataFrame:
    return gold.mart_daily(sales(v))


@query("select month, active_customers, orders, paid_cents, repeat_customers, arpu_cents, aov_cents, orders_per_customer, repeat_rate from v_monthly")
def mart_monthly_arpu(v: Views) -> DataFrame:
    return gold.mart_monthly(sales(v, customers=True))


@query("select * from v_allocation")
def payment_allocation(v: Views) -> DataFrame:
    return allocation(v)


@query("""select md5(i.order_id || '|' || i.item_no) as item_key, i.order_id, i.item_no, o.customer_id, c.unique_id, d.version_key as customer_version_key, md5(cast(s.seller_id as varchar)) as seller_key,
    md5(cast(i.product_id as varchar)) as product_key, p.version_key as product_version_key, md5(o.status) as status_key,
    cast(strftime(purchase, '%Y%m%d') as int) as purchase_date_key, cast(strftime(approved, '%Y%m%d') as int) as approved_date_key, cast(strftime(delivered, '%Y%m%d') as int) as delivered_date_key, cast(strftime(estimated, '%Y%m%d') as int) as estimated_date_key,
    i.price_cents, i.freight_cents, a.allocated_cents, cast(date_diff('day', cast(purchase as date), cast(delivered as date)) as int) as delivery_days, cast(date_diff('day', cast(estimated as date), cast(delivered as date)) as int) as delay_days,
    cast(cast(delivered as date) > cast(estimated as date) as int) as is_late
    from v_items i join v_orders o using (order_id) left join v_customers c using (customer_id) left join v_allocation a on a.order_id = i.order_id and a.item_no = i.item_no left join v_sellers s on s.seller_id = i.seller_id
    left join (select user_id, valid_from, valid_to, md5(user_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) as version_key from v_scd2) d on d.user_id = c.unique_id and o.purchase >= d.valid_from and o.purchase < coalesce(d.valid_to, timestamp '2299-12-31')
    left join (select product_id, valid_from, valid_to, md5(product_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) as version_key from v_product) p on p.product_id = i.product_id % 200 and o.purchase >= p.valid_from and o.purchase < coalesce(p.valid_to, timestamp '2299-12-31')""")
def fact_order_items(v: Views) -> DataFrame:
    dim = user_versions(v, v.customers.select(F.col("unique_id").alias("user_id"))).select(F.col("user_id").alias("unique_id"), "valid_from", "valid_to")
    listing = (F.col("product_id") % 200).alias("listing_id")
    items = gold.allocate(v.items, v.payments, "product_id", "seller_id", "price_cents", "freight_cents").select("*", listing)
    products = versions.scd2(product_events(v), "product_id", ORDER, F.col("category")).select(F.col("product_id").alias("listing_id"), "valid_from", "valid_to")
    listed = versions.with_keys(v.items.select("order_id", listing), product_events(v).select(F.col("product_id").alias("listing_id")), "listing_id")
    return gold.fact_items(items, v.orders, v.customers, gold.dim_seller(v.sellers, "seller_id"), dim, products, v.changes.select("source_ts"), listed)


@query("""select cast(strftime(d, '%Y%m%d') as int) as date_key, d as date, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month, rpad(monthname(d), 9, ' ') as month_name, cast(weekofyear(d) as int) as week,
    cast(day(d) as int) as day, cast(dayofweek(d) as int) as day_of_week, strftime(d, '%Y-%m') as year_month, dayofweek(d) in (0, 6) as is_weekend from (
    select cast(purchase as date) as d from v_orders union select cast(approved as date) from v_orders union select cast(delivered as date) from v_orders union select cast(estimated as date) from v_orders) where d is not null""")
def dim_date(v: Views) -> DataFrame:
    return gold.dim_date(v.orders, "purchase", "approved", "delivered", "estimated")


@query("select distinct md5(status) as status_key, status, cast(status = 'delivered' as int) as is_success, cast(status in ('canceled', 'unavailable') as int) as is_failure from v_orders")
def dim_order_status(v: Views) -> DataFrame:
    return gold.dim_status(v.orders)


@query("select md5(cast(seller_id as varchar)) as seller_key, seller_id, seller_name, nation_id from v_sellers")
def dim_seller(v: Views) -> DataFrame:
    return gold.dim_seller(v.sellers, "seller_id", "seller_name", "nation_id")


@query("select user_id, event_id, event_type, value_cents, valid_from, valid_to, valid_to is null as is_current from v_scd2")
def scd2_customer(v: Views) -> DataFrame:
    return user_versions(v).select("user_id", "event_id", "event_type", "value_cents", "valid_from", "valid_to", "is_current")


def product_events(v: Views) -> DataFrame:
    """Changes of even users as product versions, with a category each."""
    return v.changes.where("user_id % 2 = 0").select(F.expr("user_id % 200").alias("product_id"), F.concat(F.lit("cat"), F.expr("cast((value_cents div 100) % 7 as string)")).alias("category"), *ORDER, "is_snapshot", "is_deleted")


def category_events(v: Views) -> DataFrame:
    """Changes of odd users as new names of categories."""
    return v.changes.where("user_id % 2 = 1").select(F.concat(F.lit("cat"), F.expr('cast("offset" % 7 as string)'.replace('"', "`"))).alias("category"), F.concat(F.col("event_type"), F.expr("cast(`offset` % 5 as string)")).alias("english"), *ORDER)


_STREAMS = """select user_id % 200 as product_id, 'cat' || ((value_cents // 100) % 7) as category, source_ts, partition, "offset", is_snapshot, is_deleted from v_changes where user_id % 2 = 0"""
_NAMES = """select 'cat' || ("offset" % 7) as category, event_type || ("offset" % 5) as english, source_ts, partition, "offset" from v_changes where user_id % 2 = 1"""
_ASOF = f"""select p.*, n.english from ({_STREAMS}) p left join ({_NAMES}) n on n.category = p.category and (n.source_ts, n.partition, n."offset") <= (p.source_ts, p.partition, p."offset")
    qualify row_number() over (partition by p."offset" order by n.source_ts desc, n.partition desc, n."offset" desc) = 1"""


def named_products(v: Views) -> DataFrame:
    return versions.asof_latest(product_events(v), category_events(v), ["category"], ORDER, ["english"])


@query(_ASOF)
def asof_latest(v: Views) -> DataFrame:
    return named_products(v).select("product_id", "category", "source_ts", "partition", "offset", "is_snapshot", "is_deleted", "english")


@query(f"""with p as ({_STREAMS}), n as ({_NAMES}), h as (select *, lead({{'t': source_ts, 'p': partition, 'o': "offset"}}) over (partition by product_id order by source_ts, partition, "offset") as nxt from p),
    all_rows as (
    select product_id, category, english, source_ts, partition, "offset", is_snapshot, is_deleted from ({_ASOF})
    union all select h.product_id, h.category, n.english, n.source_ts, n.partition, n."offset", false, false from h join n using (category)
    where not h.is_deleted and (n.source_ts, n.partition, n."offset") > (h.source_ts, h.partition, h."offset") and (h.nxt is null or (n.source_ts, n.partition, n."offset") < (h.nxt.t, h.nxt.p, h.nxt.o))),
    o as (select *, case when is_snapshot or source_ts = min(source_ts) over (partition by product_id) then timestamp '1900-01-01' else source_ts end as valid_from, category || '|' || coalesce(english, '<NULL>') || '|' || is_deleted as vh from all_rows),
    d as (select * from o qualify row_number() over (partition by product_id, valid_from order by source_ts desc, partition desc, "offset" desc) = 1),
    c as (select * from (select *, lag(vh) over (partition by product_id order by valid_from) as b from d) where b is null or b <> vh),
    e as (select *, lead(valid_from) over (partition by product_id order by valid_from) as valid_to from c)
    select product_id, category, english, valid_from, valid_to from e where not is_deleted""".replace("with p as", "select * from (with p as") + ")")
def scd2_two_stream(v: Views) -> DataFrame:
    """Product versions that also change when their category's name does."""
    products = product_events(v)
    own = named_products(v).select("product_id", "category", "english", *ORDER, "is_snapshot", "is_deleted")
    renamed = versions.asof_reverse(products, category_events(v), "product_id", "category", ORDER).where("not is_deleted")
    renamed = renamed.select("product_id", "category", "english", *(F.col(f"at_{c}").alias(c) for c in ORDER), F.lit(False).alias("is_snapshot"), F.lit(False).alias("is_deleted"))
    attributes = F.concat_ws("|", "category", F.coalesce("english", F.lit("<NULL>")))
    return versions.scd2(own.unionByName(renamed), "product_id", ORDER, attributes).select("product_id", "category", "english", "valid_from", "valid_to")


_PLANTED = """(select * replace (case user_id % 10 when 0 then null when 1 then valid_from else valid_to end as valid_to) from v_scd2)"""


@query(f"""select user_id, a.valid_from, a.valid_to from {_PLANTED} a where exists (select 1 from {_PLANTED} b where b.user_id = a.user_id and b."offset" <> a."offset" and b.valid_from <= a.valid_from
    and a.valid_from < coalesce(b.valid_to, timestamp '2299-12-31')) or a.valid_to <= a.valid_from""")
def scd2_overlap_check(v: Views) -> DataFrame:
    user = F.col("user_id") % 10  # planted: versions that never end, and some that end as they begin
    dim = user_versions(v).withColumn("valid_to", F.when(user == 1, F.col("valid_from")).when(user != 0, F.col("valid_to")))
    return versions.interval_overlaps(dim, "user_id").unionByName(dim.where("valid_to <= valid_from")).select("user_id", "valid_from", "valid_to")


@query("select * from (select order_id, cast(sum(allocated_cents) as bigint) as allocated_cents, max(paid_cents) as paid_cents, count(*) as items from (select * replace (allocated_cents + case when order_id % 100 = 7 then 50 else 0 end as allocated_cents) from v_allocation) where order_gross_cents <> 0 and paid_cents is not null group by 1) where abs(allocated_cents - paid_cents) > items")
def allocation_balance(v: Views) -> DataFrame:
    planted = F.col("allocated_cents") + F.when(F.col("order_id") % 100 == 7, 50).otherwise(0)
    return checks.allocation_balance(allocation(v).withColumn("allocated_cents", planted))


@query("select month, arpu_cents, repeat_rate from (select * replace (arpu_cents + cast(month(month) = 3 as bigint) as arpu_cents) from v_monthly) where arpu_cents <> floor(cast(paid_cents as double) / active_customers + 0.5::double) or repeat_rate not between 0 and 1")
def arpu_formula(v: Views) -> DataFrame:
    planted = F.col("arpu_cents") + (F.month("month") == 3).cast("bigint")
    return checks.arpu_formulas(gold.mart_monthly(sales(v, customers=True)).withColumn("arpu_cents", planted)).select("month", "arpu_cents", "repeat_rate")


@query("select purchase_day, gross_cents from (select * replace (gross_cents + cast(day(purchase_day) = 13 as bigint) as gross_cents) from v_daily) where gross_cents <> price_cents + freight_cents")
def components_check(v: Views) -> DataFrame:
    planted = F.col("gross_cents") + (F.dayofmonth("purchase_day") == 13).cast("bigint")
    return checks.components_add_up(gold.mart_daily(sales(v)).withColumn("gross_cents", planted)).select("purchase_day", "gross_cents")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(v: Views) -> DataFrame:
    return checks.duplicate_keys(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("select order_id, item_no, count(*) as n from (select order_id, item_no from v_items union all select order_id, item_no from v_items where order_id % 50 = 0) group by 1, 2 having count(*) > 1")
def unique_combination(v: Views) -> DataFrame:
    rows = v.items.select("order_id", "item_no")
    return checks.duplicate_keys(rows.unionByName(rows.where("order_id % 50 = 0")), ["order_id", "item_no"])


@query("select o_orderkey, o_custkey from (select o_orderkey, case when o_orderkey % 500 = 3 then -o_custkey else o_custkey end as o_custkey from orders) where o_custkey not in (select c_custkey from customer)")
def orphans(v: Views) -> DataFrame:
    planted = v.table("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 500 == 3, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("o_custkey"))
    return checks.orphans(planted, "o_custkey", v.table("customer"), "c_custkey").select("o_orderkey", "o_custkey")


@query("select count(*) as n_orphans from (select case when l_partkey % 911 = 5 then null when l_partkey % 701 = 3 then -l_partkey else l_partkey end as p from lineitem) where p is not null and not exists (select 1 from part where p_partkey = p)")
def relationships(v: Views) -> DataFrame:
    p = F.col("l_partkey")
    planted = v.table("lineitem").select(F.when(p % 911 == 5, None).when(p % 701 == 3, -p).otherwise(p).alias("part"))
    return checks.orphans(planted, "part", v.table("part"), "p_partkey").agg(F.count("*").alias("n_orphans"))


@query("select 'delivered' as column_name, count(*) filter (where delivered is null) as failures from v_orders union all select 'purchase', count(*) filter (where purchase is null) from v_orders union all select 'status', count(*) filter (where status is null) from v_orders")
def not_null(v: Views) -> DataFrame:
    return checks.not_null(v.orders, ["delivered", "purchase", "status"])


@query("select 'c_acctbal' as column_name, count(*) filter (where c_acctbal < 0) as failures from customer union all select 'c_nationkey', count(*) filter (where c_nationkey < 0) from customer")
def non_negative(v: Views) -> DataFrame:
    return checks.non_negative(v.table("customer"), ["c_acctbal", "c_nationkey"])


@query("select c_name as name, 'left_only' as side from customer where c_custkey % 7 <> 0 and c_name not in (select c_name from customer where c_custkey % 5 <> 0) union all select c_name, 'right_only' from customer where c_custkey % 5 <> 0 and c_name not in (select c_name from customer where c_custkey % 7 <> 0)")
def name_diff(v: Views) -> DataFrame:
    c = v.table("customer").select(F.col("c_name").alias("name"), "c_custkey")
    return checks.name_diff(c.where("c_custkey % 7 <> 0"), c.where("c_custkey % 5 <> 0"), "name")


@query("select o_orderkey, exists (select 1 from lineitem where l_orderkey = o_orderkey) as has_items from orders")
def with_exists(v: Views) -> DataFrame:
    from tidemark.operators.ledger import with_exists as flagged

    return flagged(v.table("orders").select("o_orderkey"), v.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "has_items")

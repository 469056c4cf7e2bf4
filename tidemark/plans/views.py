"""The domain's relations, derived from the driver's tables; each in Spark and as a SQL common table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.values import cents

#: The number of customers behind the customer ids, and of log partitions.
USERS, PARTITIONS = 100, 3


class Views:
    """Lazily made views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled")
        o = self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("purchase"))
        return o.select(
            "*", F.expr("purchase + interval 1 hour").alias("approved"), F.expr("case when status = 'delivered' then purchase + make_dt_interval(cast((order_id * 7) % 40 as int)) end").alias("delivered"), F.expr("purchase + interval 21 day").alias("estimated"),
        )

    @cached_property
    def items(self) -> DataFrame:
        order = ("l_linenumber", "product_id", "seller_id", "l_shipdate", "l_extendedprice", "l_quantity", "l_tax")
        rows = self.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"), "l_linenumber", *order[3:])
        # numbered by the name that later windows and joins use, so that they need no exchange of their own
        return rows.select(
            "order_id", F.row_number().over(Window.partitionBy("order_id").orderBy(*order)).cast("bigint").alias("item_no"), "product_id", "seller_id",
            cents("l_extendedprice").alias("price_cents"), cents(F.col("l_extendedprice") * F.col("l_tax")).alias("freight_cents"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        total = cents("o_totalprice")
        split = (F.col("o_orderkey") % 4 == 0) & (total > 1000)
        parts = F.when(split, F.array(F.lit(1000).cast("bigint"), total - 1000)).otherwise(F.array(total))
        return self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.posexplode(parts).alias("pos", "paid_cents")).select("order_id", (F.col("pos") + 1).cast("bigint").alias("payment_no"), "paid_cents")

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("customer_id"), (F.col("c_custkey") % USERS).alias("unique_id"), F.col("c_mktsegment").alias("segment"))

    @cached_property
    def sellers(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), F.col("s_nationkey").cast("bigint").alias("nation_id"))

    @cached_property
    def changes(self) -> DataFrame:
        op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
        return self.table("events").select(
            F.lit("users").alias("entity"), F.lit("cdc.users").alias("topic"), (F.col("user_id") % PARTITIONS).alias("partition"), F.col("event_id").alias("offset"), F.concat_ws(":", F.lit("cdc.users"), (F.col("user_id") % PARTITIONS).cast("string"), F.col("event_id").cast("string")).alias("event_id"),
            F.col("user_id"), F.col("ts").cast("timestamp_ntz").alias("source_ts"), op.alias("op"), (op == "d").alias("is_deleted"), "event_type", cents(F.coalesce("value", F.lit(0.0))).alias("value_cents"), F.coalesce("props", F.lit("")).alias("props"),
            (F.col("event_id") % 20 == 0).alias("is_snapshot"), F.expr("event_id div 5").alias("transaction_no"), F.expr("concat('tx-', cast(event_id div 5 as string))").alias("transaction_id"),
        )

    @cached_property
    def observations(self) -> DataFrame:
        """OPEN and COMPLETE observations of each transaction; some stay open, some were rejected first."""
        per = self.changes.groupBy("transaction_no").agg(F.min("offset").alias("begin"), F.max("offset").alias("end"), F.count("*").alias("n"), F.max("source_ts").alias("at"))
        n = F.col("transaction_no")
        kinds = F.when(n % 97 == 96, F.array(F.lit("OPEN"))).when(n % 50 == 7, F.array(F.lit("OPEN"), F.lit("REJECTED"), F.lit("COMPLETE"))).otherwise(F.array(F.lit("OPEN"), F.lit("COMPLETE")))
        rows = per.select("*", F.explode(kinds).alias("status"))
        whole = F.col("status") == "COMPLETE"
        return rows.select(
            F.concat(F.lit("tx-"), n.cast("string")).alias("transaction_id"), "status", F.when(F.col("status") == "OPEN", F.col("begin")).otherwise(F.col("end")).alias("offset"), F.when(whole, F.col("n")).alias("event_count"),
            F.when(whole, F.col("end")).alias("end_offset"), F.concat(F.lit("tx:0:"), n.cast("string"), F.lit(":"), F.col("status")).alias("event_id"), F.col("at").alias("recorded_at"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Orders by purchase year as runs, with two versions of one order where its number allows."""
        return self.orders.select("order_id", "status", (F.year("purchase") - 1990).cast("bigint").alias("seq"), F.col("order_id").alias("offset"))

    @cached_property
    def markers(self) -> DataFrame:
        """A started and, for even runs and the first, a published marker of each run."""
        per = self.runs.select("seq").distinct()
        made = F.when((F.col("seq") % 2 == 0), F.array(F.lit("STARTED"), F.lit("MATERIALIZING"), F.lit("PUBLISHED"))).otherwise(F.array(F.lit("STARTED"), F.lit("MATERIALIZING"), F.lit("FAILED")))
        rows = per.select("seq", F.posexplode(made).alias("step", "status"))
        return rows.select("seq", "status", F.expr("timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(cast(seq as int), step)").alias("recorded_at"))


#: The same relations in DuckDB SQL, in the order in which they build on each other.
SQL = {
    "v_orders": """select order_id, customer_id, status, purchase, purchase + interval 1 hour as approved,
        case when status = 'delivered' then purchase + to_days(cast((order_id * 7) % 40 as integer)) end as delivered, purchase + interval 21 day as estimated
        from (select o_orderkey as order_id, o_custkey as customer_id, case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as status, cast(o_orderdate as timestamp) as purchase from orders)""",
    "v_items": """select l_orderkey as order_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_tax) as item_no,
        l_partkey as product_id, l_suppkey as seller_id, cast(floor(l_extendedprice * 100 + 0.5::double) as bigint) as price_cents, cast(floor(l_extendedprice * l_tax * 100 + 0.5::double) as bigint) as freight_cents from lineitem""",
    "v_payments": """select order_id, payment_no, paid_cents from (
        select o_orderkey as order_id, 1::bigint as payment_no, case when o_orderkey % 4 = 0 and c > 1000 then 1000 else c end as paid_cents from (select *, cast(floor(o_totalprice * 100 + 0.5::double) as bigint) as c from orders)
        union all select o_orderkey, 2::bigint, c - 1000 from (select *, cast(floor(o_totalprice * 100 + 0.5::double) as bigint) as c from orders) where o_orderkey % 4 = 0 and c > 1000)""",
    "v_customers": "select c_custkey as customer_id, c_custkey % 100 as unique_id, c_mktsegment as segment from customer",
    "v_sellers": "select s_suppkey as seller_id, s_name as seller_name, cast(s_nationkey as bigint) as nation_id from supplier",
    "v_changes": """select 'users' as entity, 'cdc.users' as topic, user_id % 3 as partition, event_id as "offset", 'cdc.users:' || (user_id % 3) || ':' || event_id as event_id, user_id, cast(ts as timestamp) as source_ts,
        case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op, event_type = 'error' as is_deleted, event_type, cast(floor(coalesce(value, 0) * 100 + 0.5::double) as bigint) as value_cents, coalesce(props, '') as props,
        event_id % 20 = 0 as is_snapshot, event_id // 5 as transaction_no, 'tx-' || (event_id // 5) as transaction_id from events""",
    "v_observations": """select 'tx-' || transaction_no as transaction_id, status, case status when 'OPEN' then b else e end as "offset", case when status = 'COMPLETE' then n end as event_count, case when status = 'COMPLETE' then e end as end_offset,
        'tx:0:' || transaction_no || ':' || status as event_id, seen as recorded_at from (
        select *, unnest(case when transaction_no % 97 = 96 then ['OPEN'] when transaction_no % 50 = 7 then ['OPEN', 'REJECTED', 'COMPLETE'] else ['OPEN', 'COMPLETE'] end) as status from (
        select transaction_no, min("offset") as b, max("offset") as e, count(*) as n, max(source_ts) as seen from v_changes group by 1))""",
    "v_effective": """select * exclude (n) from (select *, row_number() over (partition by transaction_id order by "offset" desc, recorded_at desc, (end_offset is not null) desc,
        case status when 'COMPLETE' then 3 when 'REJECTED' then 2 when 'OPEN' then 1 else 0 end desc, event_id desc) as n from v_observations) where n = 1""",
    "v_runs": """select order_id, status, cast(year(purchase) - 1990 as bigint) as seq, order_id as "offset" from v_orders""",
    "v_markers": """select seq, status, timestamp '2020-01-01 00:00:00' + to_days(cast(seq as integer)) + to_hours(cast(step as integer)) as recorded_at from (
        select seq, unnest([0, 1, 2]) as step, unnest(case when seq % 2 = 0 then ['STARTED', 'MATERIALIZING', 'PUBLISHED'] else ['STARTED', 'MATERIALIZING', 'FAILED'] end) as status from (select distinct seq from v_runs))""",
    "v_allocation": """select order_id, item_no, g as gross_cents, og as order_gross_cents, paid_cents,
        case when og <> 0 then cast(floor(cast(paid_cents as double) * cast(g as double) / cast(og as double) + 0.5::double) as bigint) end as allocated_cents from (
        select order_id, item_no, price_cents + freight_cents as g, cast(sum(price_cents + freight_cents) over (partition by order_id) as bigint) as og from v_items)
        left join (select order_id, cast(sum(paid_cents) as bigint) as paid_cents from v_payments group by 1) using (order_id)""",
    "v_sales": """select i.order_id, i.item_no, o.customer_id, c.unique_id, cast(o.purchase as date) as purchase_day, o.status, i.price_cents, i.freight_cents, a.allocated_cents
        from v_items i join v_orders o using (order_id) left join v_customers c using (customer_id) left join v_allocation a on a.order_id = i.order_id and a.item_no = i.item_no""",
    "v_scd2": """select * from (select *, lead(valid_from) over (partition by user_id order by valid_from) as valid_to from (
        select * from (select *, lag(version_hash) over (partition by user_id order by valid_from) as before from (
        select * from (select *, row_number() over (partition by user_id, valid_from order by source_ts desc, partition desc, "offset" desc) as n from (
        select *, case when is_snapshot or source_ts = min(source_ts) over (partition by user_id) then timestamp '1900-01-01 00:00:00' else source_ts end as valid_from,
        md5(event_type || '|' || (value_cents // 20000)) || '|' || is_deleted as version_hash from v_changes)) where n = 1)) where before is null or before <> version_hash)) where not is_deleted""",
    "v_product": """select * from (select *, lead(valid_from) over (partition by product_id order by valid_from) as valid_to from (select * from (select *, lag(vh) over (partition by product_id order by valid_from) as b from (
        select *, category || '|' || is_deleted as vh from (select *, case when is_snapshot or source_ts = min(source_ts) over (partition by product_id) then timestamp '1900-01-01 00:00:00' else source_ts end as valid_from from (
        select user_id % 200 as product_id, 'cat' || ((value_cents // 100) % 7) as category, source_ts, partition, "offset", is_snapshot, is_deleted from v_changes where user_id % 2 = 0))
        qualify row_number() over (partition by product_id, valid_from order by source_ts desc, partition desc, "offset" desc) = 1)) where b is null or b <> vh)) where not is_deleted""",
    "v_daily": """select *, price_cents + freight_cents as gross_cents, cast(floor(cast(paid_cents as double) / cast(orders as double) + 0.5::double) as bigint) as average_order_cents from (
        select purchase_day, cast(sum(items) as bigint) as items, count(*) as orders, count(distinct customer_id) as customers, count(*) filter (where status = 'delivered') as delivered_orders, count(*) filter (where status in ('canceled', 'unavailable')) as failed_orders,
        cast(sum(price_cents) as bigint) as price_cents, cast(sum(freight_cents) as bigint) as freight_cents, cast(sum(paid_cents) as bigint) as paid_cents from (
        select purchase_day, order_id, customer_id, status, count(*) as items, sum(price_cents) as price_cents, sum(freight_cents) as freight_cents, sum(coalesce(allocated_cents, price_cents + freight_cents)) as paid_cents from v_sales group by 1, 2, 3, 4) group by 1)""",
    "v_monthly": """select *, cast(floor(cast(paid_cents as double) / active_customers + 0.5::double) as bigint) as arpu_cents, cast(floor(cast(paid_cents as double) / orders + 0.5::double) as bigint) as aov_cents, cast(orders as double) / active_customers as orders_per_customer, cast(repeat_customers as double) / active_customers as repeat_rate from (
        select month, count(*) as active_customers, cast(sum(orders) as bigint) as orders, cast(sum(paid_cents) as bigint) as paid_cents, count(*) filter (where orders > 1) as repeat_customers from (
        select month, unique_id, count(distinct order_id) as orders, sum(paid) as paid_cents from (select cast(date_trunc('month', purchase_day) as date) as month, unique_id, order_id, coalesce(allocated_cents, price_cents + freight_cents) as paid from v_sales) group by 1, 2) group by 1)""",
}
_NEEDS = {name: [other for other in SQL if other != name and other in text] for name, text in SQL.items()}


def sql(body: str) -> str:
    """``body`` behind the common tables that it names, directly or not."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in SQL:
        if name in body:
            add(name)
    if not wanted:
        return body
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in wanted) + "\n" + body

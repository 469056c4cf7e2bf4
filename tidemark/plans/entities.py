"""The eight captured entities: contracts, rules, and their change logs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import cents
from tidemark.operators import ledger, transactions
from tidemark.plans.catalog import query
from tidemark.plans.views import Views

_RULES = (ledger.Rule("rule_amount", "amount <> -1"),)


def _spec(name: str, keys: str, amount: str = "bigint") -> ledger.EntitySpec:
    """An entity by its key columns' DDL; every image has a number ``n`` and an ``amount``."""
    names = tuple(k.strip().split(" ")[0] for k in keys.split(","))
    return ledger.EntitySpec(name, f"cdc.{name}", names, f"{keys}, n bigint, amount {amount}", _RULES)


#: The entities in the order of their names.
ENTITIES = {
    s.name: s
    for s in (
        _spec("category_translation", "category string"), _spec("customers", "customer_id bigint"), _spec("order_items", "order_id bigint, item_no bigint"), _spec("order_payments", "order_id bigint, payment_no bigint"),
        _spec("order_reviews", "review_id string, order_id bigint"), _spec("orders", "order_id bigint"), _spec("products", "product_id bigint"), _spec("sellers", "seller_id bigint"),
    )
}


def rows_of(v: Views, name: str) -> DataFrame:
    """An entity's keys, a number that tells rows apart, and an amount."""
    n = lambda c: F.expr(c).cast("bigint").alias("n")
    if name == "customers":
        return v.table("customer").select(F.col("c_custkey").alias("customer_id"), n("c_custkey"), cents("c_acctbal").alias("amount"))
    if name == "orders":
        return v.table("orders").select(F.col("o_orderkey").alias("order_id"), n("o_orderkey"), cents("o_totalprice").alias("amount"))
    if name == "order_items":
        return v.items.select("order_id", "item_no", n("order_id * 10 + item_no"), F.col("price_cents").alias("amount"))
    if name == "order_payments":
        return v.payments.select("order_id", "payment_no", n("order_id * 2 + payment_no"), F.col("paid_cents").alias("amount"))
    if name == "order_reviews":
        return v.table("orders").where("o_orderkey % 2 = 0").select(F.expr("concat('r', cast(o_orderkey as string))").alias("review_id"), F.col("o_orderkey").alias("order_id"), n("o_orderkey"), F.expr("o_orderkey % 5 + 1").alias("amount"))
    if name == "products":
        return v.table("part").select(F.col("p_partkey").alias("product_id"), n("p_partkey"), F.col("p_size").cast("bigint").alias("amount"))
    if name == "sellers":
        return v.table("supplier").select(F.col("s_suppkey").alias("seller_id"), n("s_suppkey"), cents("s_acctbal").alias("amount"))
    brands = v.table("part").select(F.col("p_brand").alias("category")).distinct()
    return brands.select("category", n("cast(regexp_extract(category, '[0-9]+', 0) as bigint)"), F.length("category").cast("bigint").alias("amount"))


#: Tasks a core for entities whose rows come straight out of a scan, which has no more tasks than its files have row groups.
_TASKS_A_CORE = {"customers": 1, "order_payments": 4, "order_reviews": 4, "orders": 4, "products": 1, "sellers": 1}


def spread(rows: DataFrame, tasks_a_core: int, by: Column) -> DataFrame:
    """Narrow rows dealt evenly, before each becomes an envelope or more, so that all cores share them; equal ``by`` stay together."""
    return rows.repartition(tasks_a_core * rows.sparkSession.sparkContext.defaultParallelism, by)


def change_log(v: Views, name: str) -> DataFrame:
    """An entity's envelopes: a snapshot row each, an update of every third (every seventh of them bad), a delete of every eleventh."""
    spec, n = ENTITIES[name], F.col("n")
    # whole literals: a filter over an array of cases takes as long as writing the envelope
    kinds = lambda *ops: F.array(*(F.lit(o) for o in ops))
    ops = F.when(n % 33 == 0, kinds("r", "u", "d")).when(n % 3 == 0, kinds("r", "u")).when(n % 11 == 0, kinds("r", "d")).otherwise(kinds("r"))
    rows = rows_of(v, name)
    if name in _TASKS_A_CORE:
        rows = spread(rows, _TASKS_A_CORE[name], F.expr("n div 256"))
    rows = rows.select("*", F.explode(ops).alias("op"))
    amount = F.when(F.col("op") == "u", F.when(n % 7 == 0, F.lit(-1)).otherwise(F.col("amount") + 1)).otherwise(F.col("amount"))
    image = F.struct(*spec.keys, "n", amount.alias("amount"))
    body = F.struct("op", F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), F.struct((n * 1000).alias("ts_ms"), F.when(F.col("op") == "r", "true").otherwise("false").alias("snapshot")).alias("source"), F.struct(F.expr("concat('tx-', cast(n div 4 as string))").alias("id")).alias("transaction"))
    offset = (n * 3 + F.when(F.col("op") == "u", 1).when(F.col("op") == "d", 2).otherwise(0)).alias("offset")
    return rows.select(F.lit(spec.topic).alias("topic"), F.lit(0).cast("bigint").alias("partition"), offset, F.lit("2024-01-01").cast("timestamp_ntz").alias("log_time"), F.to_json(body).alias("envelope"), F.to_json(F.struct(*spec.keys)).alias("key_json"))


def staged(v: Views, *columns: str) -> DataFrame:
    """All entities' ledger rows: of the columns that all ledgers have the named ones."""
    out = None
    for name, spec in ENTITIES.items():
        rows = ledger.stage_changes(change_log(v, name), spec, columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def _key(spec: ledger.EntitySpec) -> Column:
    return F.concat_ws("/", *(F.col(k).cast("string") for k in spec.keys))


_SOURCES = {
    "category_translation": "select p_brand as key, cast(regexp_extract(p_brand, '[0-9]+') as bigint) as n, length(p_brand) as amount from part group by 1",
    "customers": "select cast(c_custkey as varchar) as key, c_custkey as n, cast(floor(c_acctbal * 100 + 0.5::double) as bigint) as amount from customer",
    "order_items": "select order_id || '/' || item_no as key, order_id * 10 + item_no as n, price_cents as amount from v_items",
    "order_payments": "select order_id || '/' || payment_no as key, order_id * 2 + payment_no as n, paid_cents as amount from v_payments",
    "order_reviews": "select 'r' || o_orderkey || '/' || o_orderkey as key, o_orderkey as n, o_orderkey % 5 + 1 as amount from orders where o_orderkey % 2 = 0",
    "orders": "select cast(o_orderkey as varchar) as key, o_orderkey as n, cast(floor(o_totalprice * 100 + 0.5::double) as bigint) as amount from orders",
    "products": "select cast(p_partkey as varchar) as key, p_partkey as n, p_size as amount from part",
    "sellers": "select cast(s_suppkey as varchar) as key, s_suppkey as n, cast(floor(s_acctbal * 100 + 0.5::double) as bigint) as amount from supplier",
}
_ALL = "(" + " union all ".join(f"select '{name}' as entity, key, cast(n as bigint) as n, cast(amount as bigint) as amount from ({text})" for name, text in _SOURCES.items()) + ")"
_LOG = f"(select entity, key, n, op, n * 3 + case op when 'u' then 1 when 'd' then 2 else 0 end as \"offset\", case when op = 'u' and n % 7 = 0 then -1 when op = 'u' then amount + 1 else amount end as amount from (select *, unnest(case when n % 33 = 0 then ['r', 'u', 'd'] when n % 3 = 0 then ['r', 'u'] when n % 11 = 0 then ['r', 'd'] else ['r'] end) as op from {_ALL}))"


@query(f"""select entity, key, "offset", op, amount from {_LOG} where amount <> -1 qualify row_number() over (partition by entity, key order by "offset" desc) = 1 and op <> 'd'""")
def stage_entities(v: Views) -> DataFrame:
    """The current relations of all eight entities, out of their envelopes by contract and rules."""
    out = None
    for name, spec in ENTITIES.items():
        columns = ["offset", "op", "amount", "partition"]
        changes = ledger.stage_changes(change_log(v, name), spec, ["entity", *spec.keys, *columns, "is_deleted", "apply_status"])
        rows = ledger.stage(changes, spec, F.struct("partition", "offset"), columns).select(F.lit(name).alias("entity"), _key(spec).alias("key"), "offset", "op", "amount")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"""select entity, count(*) as events, max("offset") as last_offset, count(*) filter (where amount = -1) as rejected, count(*) filter (where op = 'd') as deletes, count(distinct n // 4) as transactions from {_LOG} group by 1""")
def entity_ledgers(v: Views) -> DataFrame:
    """What the eight ledgers hold, over their union."""
    rows = staged(v, "entity", "offset", "is_deleted", "transaction_id", "apply_status")
    return rows.groupBy("entity").agg(F.count("*").alias("events"), F.max("offset").alias("last_offset"), F.count_if(F.col("apply_status") == "REJECTED").alias("rejected"), F.count_if("is_deleted").alias("deletes"), F.count_distinct("transaction_id").alias("transactions"))


@query(f"""select 'tx-' || (n // 4) as transaction_id, count(*) as events, count(distinct entity) as entities, nullif(count(*) filter (where entity = 'orders'), 0) as orders_events from {_LOG} group by 1""")
def entity_transactions(v: Views) -> DataFrame:
    """Events of every transaction, per entity of all eight."""
    per = transactions.transaction_counts(staged(v, "entity", "transaction_id"))
    return per.select("transaction_id", "events", F.size("counts").cast("bigint").alias("entities"), F.try_element_at("counts", F.lit("orders")).alias("orders_events"))

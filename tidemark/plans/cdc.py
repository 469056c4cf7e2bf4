"""Capture, ledger, transactions, publication and contract checks over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import frames, values
from tidemark.operators import alerts, checks, evolution, hashtree, ledger, publication, schemas, sketches, transactions, versions
from tidemark.plans.catalog import query
from tidemark.plans.views import Views
from tidemark.sources import buckets, clustering, storage
from tidemark.sources.ledger_files import LedgerFiles
from tidemark.streaming import capture, commits, stateful

def place():
    return F.struct("partition", "offset")


# --- current state and counts ---------------------------------------------------------------------
@query("""select user_id, event_id, "offset", op, value_cents from (select *, row_number() over (partition by user_id order by partition desc, "offset" desc) as n from v_changes) where n = 1 and not is_deleted""")
def current_state(v: Views) -> DataFrame:
    return versions.current_state(v.changes, ["user_id"], place()).select("user_id", "event_id", "offset", "op", "value_cents")


@query("""select cast(sum(n) as bigint) as changes, count(*) as physical, count(*) filter (where not gone) as visible, count(*) filter (where gone) as deleted from (select user_id, count(*) as n, arg_max(is_deleted, "offset") as gone from v_changes group by 1)""")
def current_counts(v: Views) -> DataFrame:
    return versions.current_counts(v.changes, ["user_id"], place())


def order_changes(v: Views) -> DataFrame:
    """The orders as a second ledger: a snapshot row each, and an update of those that are done."""
    both = F.explode(F.when(F.col("status") == "shipped", F.array(F.lit("r"))).otherwise(F.array(F.lit("r"), F.lit("u")))).alias("op")
    rows = v.orders.select("order_id", "customer_id", "status", "purchase", both)
    status = F.when(F.col("op") == "r", "created").otherwise(F.col("status"))
    return rows.select("order_id", "customer_id", status.alias("status"), "op", (F.col("order_id") * 2 + (F.col("op") == "u").cast("int")).alias("offset"), F.lit("cdc.orders").alias("topic"), F.lit(0).cast("bigint").alias("partition"), F.col("purchase").alias("source_ts"), F.lit(False).alias("is_deleted")).withColumn("transaction_id", F.expr("concat('tx-', cast(`offset` div 5 as string))"))


_ORDER_CHANGES = """(select order_id, customer_id, case op when 'r' then 'created' else status end as status, op, order_id * 2 + cast(op = 'u' as int) as "offset", 'tx-' || ((order_id * 2 + cast(op = 'u' as int)) // 5) as transaction_id from (select *, unnest(case when status = 'shipped' then ['r'] else ['r', 'u'] end) as op from v_orders))"""


@query(f"select 'users' as entity, op, count(*) as n from v_changes group by 2 union all select 'orders', op, count(*) from {_ORDER_CHANGES} group by 2")
def op_counts(v: Views) -> DataFrame:
    return ledger.union_ledgers(users=v.changes.drop("entity"), orders=order_changes(v)).groupBy("entity", "op").agg(F.count("*").alias("n"))


@query(f"""select order_id, customer_id, status, op from (select *, row_number() over (partition by order_id order by "offset" desc) as n from {_ORDER_CHANGES} where status <> 'canceled') where n = 1""")
def stage_orders(v: Views) -> DataFrame:
    """Orders out of their envelopes: key record, contract, rules, then the newest applied version."""
    c = order_changes(v)
    image = F.struct("order_id", "customer_id", "status")
    body = F.struct("op", F.lit(None).alias("before"), image.alias("after"), F.struct((F.col("offset") * 1000).alias("ts_ms"), F.lit("false").alias("snapshot")).alias("source"))
    records = c.select("offset", "partition", F.col("source_ts").alias("log_time"), F.to_json(body).alias("envelope"), F.to_json(F.struct("order_id")).alias("key_json"))
    return ledger.stage(ledger.stage_changes(records, ORDERS), ORDERS, place(), ["customer_id", "status", "op", "partition", "offset"]).select("order_id", "customer_id", "status", "op")


@query("""select transaction_id, status, "offset", case when status = 'OPEN' and n is not null then n else event_count end as event_count from v_effective left join (select transaction_id, count(*) as n from v_changes group by 1) using (transaction_id)""")
def filled_event_counts(v: Views) -> DataFrame:
    """Counts that an effective transaction lacks, from the ledger."""
    return transactions.fill_event_counts(effective(v), transactions.transaction_counts(v.changes)).select("transaction_id", "status", "offset", "event_count")


@query("""select user_id, event_id from (select *, row_number() over (partition by user_id order by case when is_snapshot then 0 else 1 end desc, "offset" // 1000 desc, ("offset" * 37) % 1000 desc, -1 desc, "offset" % 5 desc, source_ts desc, partition desc, "offset" desc) as n from v_changes) where n = 1""")
def source_order_latest(v: Views) -> DataFrame:
    file = F.concat(F.lit("binlog."), F.lpad(F.expr("cast(`offset` div 1000 as string)"), 6, "0"))
    order = values.source_order(F.col("is_snapshot"), file, F.expr("(`offset` * 37) % 1000"), F.lit(None).cast("int"), F.col("offset") % 5, F.col("source_ts"), F.col("partition"), F.col("offset"))
    return versions.latest_by(v.changes, ["user_id"], order).select("user_id", "event_id")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey desc limit 1")
def latest_row(v: Views) -> DataFrame:
    """The feature is the one latest row."""
    return v.table("orders").orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).limit(1).select("o_orderkey", "o_totalprice")


@query("select seq from v_markers where status = 'PUBLISHED' order by seq desc limit 3")
def top_runs(v: Views) -> DataFrame:
    """The feature is the newest three published runs."""
    return publication.published_runs(v.markers).orderBy(F.desc("seq")).limit(3)


# --- raw log --------------------------------------------------------------------------------------
def log(v: Views) -> DataFrame:
    """Events as framed log records, with a share of each kind of broken frame."""
    n = F.col("event_id")
    key = F.when(n % 41 == 0, None).otherwise(F.concat(F.unhex(F.lpad(F.hex(n % 3 + 1), 10, "0")), F.col("user_id").cast("string").cast("binary")))
    good = F.concat(F.unhex(F.lpad(F.hex(n % 7 + 1), 10, "0")), F.col("props").cast("binary"))
    value = F.when(n % 29 == 0, None).when(n % 31 == 0, F.unhex(F.lit("0000"))).when(n % 37 == 0, F.concat(F.unhex(F.lit("0100000001")), F.col("props").cast("binary"))).when(n % 43 == 0, F.unhex(F.lit("0000000000"))).otherwise(good)
    topic = F.when(n % 11 == 0, "cdc.transaction").when(n % 13 == 0, "heartbeat.cdc").when(n % 17 == 0, "cdc").otherwise("cdc.users")
    return v.table("events").select(key.alias("key"), value.alias("value"), topic.alias("topic"), (F.col("user_id") % 3).alias("partition"), n.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
        F.array(F.struct(F.lit("source").alias("key"), F.col("event_type").cast("binary").alias("value"))).alias("headers"), "user_id", "props")


_LOG = """(select event_id as n, user_id, props, event_type, event_id % 41 <> 0 as has_key, event_id % 29 <> 0 as has_value, case when event_id % 11 = 0 then 'cdc.transaction' when event_id % 13 = 0 then 'heartbeat.cdc' when event_id % 17 = 0 then 'cdc' else 'cdc.users' end as topic,
    case when event_id % 41 = 0 then 'key_null' end as key_error, case when event_id % 29 = 0 then 'value_null' when event_id % 31 = 0 then 'value_too_short' when event_id % 37 = 0 then 'value_bad_magic' when event_id % 43 = 0 then 'value_bad_schema_id' end as value_error,
    case when event_id % 11 = 0 then 'transaction' when event_id % 13 = 0 then 'heartbeat' when event_id % 17 = 0 then 'schema_change' when event_id % 41 <> 0 and event_id % 29 = 0 then 'tombstone' else 'data' end as kind from events)"""


def raw(v: Views) -> DataFrame:
    return ledger.project_raw(log(v), "cdc.transaction", "heartbeat", "cdc", 7, "raw", F.col("timestamp"))


@query(f"""select topic || ':' || (user_id % 3) || ':' || n as event_id, kind as record_kind, has_key and not has_value as is_tombstone, case when has_key then sha256(('\\x00\\x00\\x00\\x00' || case n % 3 when 0 then '\\x01' when 1 then '\\x02' else '\\x03' end)::blob || encode(cast(user_id as varchar))) end as key_sha256,
    case when has_key then cast(n % 3 + 1 as int) end as key_schema_id, case when value_error is null then cast(n % 7 + 1 as int) end as value_schema_id, has_key as key_framing_valid, value_error is null as value_framing_valid, coalesce(key_error, value_error) as framing_error,
    0 as timestamp_type, event_type as source_header, 7::bigint as ingest_batch_id, 'raw' as query_id,
    case when has_value then sha256(case value_error when 'value_too_short' then '\\x00\\x00'::blob when 'value_bad_magic' then '\\x01\\x00\\x00\\x00\\x01'::blob || encode(props) when 'value_bad_schema_id' then '\\x00\\x00\\x00\\x00\\x00'::blob else ('\\x00\\x00\\x00\\x00\\x0' || (n % 7 + 1))::blob || encode(props) end) end as value_sha256 from {_LOG}""")
def project_raw(v: Views) -> DataFrame:
    return raw(v).select("event_id", "record_kind", "is_tombstone", "key_sha256", "key_schema_id", "value_schema_id", "key_framing_valid", "value_framing_valid", "framing_error", "timestamp_type", F.get("headers", F.lit(0))["value"].cast("string").alias("source_header"), "ingest_batch_id", "query_id", "value_sha256")


@query(f"select kind as record_kind, count(*) as n from {_LOG} group by 1")
def record_kind(v: Views) -> DataFrame:
    rows = log(v).select(frames.record_kind(F.col("topic"), F.col("key"), F.col("value"), "cdc.transaction", "heartbeat", "cdc").alias("record_kind"))
    return rows.groupBy("record_kind").agg(F.count("*").alias("n"))


@query(f"select n as event, value_error as error, case when value_error is null then cast(n % 7 + 1 as int) end as schema_id, case when value_error is null then props end as payload from {_LOG}")
def frame_inspection(v: Views) -> DataFrame:
    f = frames.inspect_frame(F.col("value"), "value")
    return log(v).select(F.col("offset").alias("event"), f["error"].alias("error"), f["schema_id"].alias("schema_id"), F.decode(f["payload"], "UTF-8").alias("payload"))


@query(f"""select case when not has_key or value_error is not null then coalesce(key_error, value_error) when n % 3 + 1 not in (1, 2) then 'unknown_writer' else 'valid' end as outcome, count(*) as n from {_LOG} where not (has_key and not has_value) group by 1""")
def gate_valid(v: Views) -> DataFrame:
    good, bad = ledger.split_valid(raw(v), [1, 2])
    return good.withColumn("outcome", F.lit("valid")).select("outcome").unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"select distinct schema_id, md5(cast(schema_id as varchar)) as fingerprint from (select cast(n % 3 + 1 as int) as schema_id from {_LOG} where has_key union select cast(n % 7 + 1 as int) from {_LOG} where value_error is null) where schema_id not in (2, 5)")
def capture_schemas(v: Views) -> DataFrame:
    seen = raw(v)
    ids = seen.select(F.explode(F.array("key_schema_id", "value_schema_id")).alias("schema_id")).where("schema_id is not null").distinct()
    return schemas.capture_schemas(seen, ids.where("schema_id in (2, 5)"), ids.select("schema_id", F.md5(F.col("schema_id").cast("string")).alias("fingerprint")))


# --- envelopes, rules, quarantine -----------------------------------------------------------------
def envelopes(v: Views) -> DataFrame:
    """Change envelopes as JSON, some with a bad op or without an image."""
    c = v.changes
    n = F.col("offset")
    image = F.struct(F.col("user_id"), F.col("value_cents"), F.col("event_type"))
    none = F.lit(None)
    op = F.when(n % 89 == 0, "x").otherwise(F.col("op"))
    body = F.struct(
        op.alias("op"), F.when(F.col("is_deleted") & (n % 53 != 0), image).otherwise(none).alias("before"), F.when(~F.col("is_deleted") & (n % 53 != 0), image).otherwise(none).alias("after"),
        F.struct(F.when(n % 71 != 0, n * 1000).alias("ts_ms"), F.when(F.col("is_snapshot"), "true").otherwise("false").alias("snapshot")).alias("source"), F.struct(F.col("transaction_id").alias("id")).alias("transaction"),
    )
    return c.select("event_id", n, F.col("source_ts").alias("log_time"), F.to_json(body).alias("envelope"), F.to_json(F.struct("user_id")).alias("key_json"))


def normalized(v: Views) -> DataFrame:
    return ledger.normalize(envelopes(v), USERS.columns, USERS.key_columns())


#: The captured entities.
USERS = ledger.EntitySpec("users", "cdc.users", ("user_id",), "user_id bigint, value_cents bigint, event_type string", (
    ledger.Rule("rule_value_range", "value_cents < 20000"), ledger.Rule("rule_known_type", "event_type in ('signup', 'purchase', 'view', 'click')"), ledger.Rule("rule_even_user", "user_id % 2 = 0 or value_cents < 10000"),
))
ORDERS = ledger.EntitySpec("orders", "cdc.orders", ("order_id",), "order_id bigint, customer_id bigint, status string", (ledger.Rule("rule_not_canceled", "status <> 'canceled'"),))


_NORMAL = """(select event_id, "offset", case when "offset" % 89 = 0 then 'x' else op end as op, case when "offset" % 89 = 0 then false else is_deleted end as is_deleted, is_snapshot, case when "offset" % 71 = 0 then source_ts else timestamp '1970-01-01' + to_seconds("offset") end as source_ts, transaction_id,
    case when "offset" % 89 = 0 or "offset" % 53 = 0 then 'REJECTED' when is_deleted and "offset" % 89 = 0 then 'REJECTED' else 'APPLIED' end as apply_status, case when "offset" % 89 = 0 then 'invalid_op' when "offset" % 53 = 0 then 'missing_image' end as error_code,
    user_id, case when is_deleted and "offset" % 53 <> 0 then h end as before_row_hash, case when not is_deleted and "offset" % 53 <> 0 then h end as after_row_hash, case when "offset" % 53 = 0 or (op = 'd' and "offset" % 89 = 0) then null else h end as row_hash, case when "offset" % 53 = 0 or (op = 'd' and "offset" % 89 = 0) then null else value_cents end as value_cents from (select *, sha256(user_id || '|' || value_cents || '|' || event_type) as h from v_changes))"""


@query(f"select * from {_NORMAL}")
def normalize_envelope(v: Views) -> DataFrame:
    return normalized(v).select("event_id", "offset", "op", "is_deleted", "is_snapshot", "source_ts", "transaction_id", "apply_status", "error_code", "user_id", "before_row_hash", "after_row_hash", "row_hash", "value_cents")


@query("""select order_id, purchased, amount_text, to_json({'amount': amount_text, 'lines': [status], 'order_id': order_id, 'status': nullif(status, 'P')})::varchar as canonical from (select cast(o_orderkey as int) as order_id, o_orderstatus as status, timestamp '1970-01-01' + to_microseconds(datediff('day', date '1970-01-01', cast(o_orderdate as date)) * 86400000000 + o_orderkey % 1000) as purchased,
    cast(cast(cast(floor(o_totalprice * 100 + 0.5) as bigint) * case when o_orderkey % 5 = 0 then -1 else 1 end as decimal(18,0)) * 0.01::decimal(3,2) as decimal(18,2))::varchar as amount_text from orders)""")
def normalize_wire(v: Views) -> DataFrame:
    """Orders as they are sent: unscaled bytes of 4 or 8, microseconds, numbers wider than the contract's."""
    o = v.table("orders")
    n, cents = F.col("o_orderkey"), values.cents("o_totalprice") * F.when(F.col("o_orderkey") % 5 == 0, -1).otherwise(1)
    digits = F.lpad(F.hex(cents), 16, "0")
    raw = F.unhex(F.when((n % 2 == 0) & (F.abs(cents) < 2**31), F.substring(digits, 9, 8)).otherwise(digits))
    micros = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86_400_000_000 + n % 1000
    image = F.struct((n + 2**33).alias("order_id"), raw.alias("amount"), micros.alias("purchased"), F.col("o_orderstatus").alias("status"))
    body = F.struct(F.lit("c").alias("op"), F.lit(None).alias("before"), image.alias("after"))
    sent = o.select(F.to_json(body).alias("envelope"), F.col("o_orderdate").cast("timestamp_ntz").alias("log_time"))
    rows = ledger.normalize(sent, "order_id int, amount decimal(18,2), purchased timestamp_ntz, status string", wire="order_id bigint, amount binary, purchased bigint, status string")
    rows = rows.select("order_id", "purchased", "status", values.decimal_text("amount").alias("amount_text"))
    doc = rows.withColumn("doc", F.struct(F.when(F.col("status") != "P", F.col("status")).alias("status"), "order_id", F.array("status").alias("lines"), F.col("amount_text").alias("amount")))
    return doc.select("order_id", "purchased", "amount_text", values.canonical_json(F.col("doc"), doc.schema["doc"].dataType).alias("canonical"))


#: Writers of the users' topic: what they were, one that adds a column, one that adds another and widens a number, and one that came back.
_WRITERS = {1: "user_id bigint, value_cents int, event_type string", 2: "user_id bigint, value_cents int, event_type string, channel string", 3: "user_id bigint, value_cents bigint, event_type string, channel string, score double", 4: "user_id bigint, value_cents int, event_type string"}
_CONTRACT_COLUMNS = "user_id bigint, value_cents int, event_type string"
_WRITER_SQL = """(select *, case when "offset" % 97 = 0 then 9 when "offset" < 3000 then 1 when "offset" < 6000 then 2 when "offset" % 10 = 0 then 4 else 3 end as schema_id from v_changes)"""


def by_writer(v: Views) -> DataFrame:
    """The changes as envelopes of several writers; every image holds all columns, of which a writer's rows have its own."""
    c, n = v.changes, F.col("offset")
    writer = F.when(n % 97 == 0, 9).when(n < 3000, 1).when(n < 6000, 2).when(n % 10 == 0, 4).otherwise(3)
    image = F.struct("user_id", "value_cents", "event_type", F.concat(F.lit("ch"), (n % 4).cast("string")).alias("channel"), (n / 8).alias("score"))
    body = F.struct(F.when(F.col("is_deleted"), "u").otherwise(F.col("op")).alias("op"), F.lit(None).alias("before"), image.alias("after"))
    return c.select("event_id", n, "partition", F.col("source_ts").alias("log_time"), writer.alias("schema_id"), F.to_json(body).alias("envelope"))


@query(f"""select user_id, event_id, cast(value_cents as bigint) as value_cents, case when schema_id in (2, 3) then 'ch' || ("offset" % 4) end as channel, case when schema_id = 3 then "offset" / 8 end as score from {_WRITER_SQL}
    where schema_id <> 9 qualify row_number() over (partition by user_id order by partition desc, "offset" desc) = 1""")
def additive_columns(v: Views) -> DataFrame:
    """Columns that first appear in the middle of the log reach the current state; unknown writers are rejected."""
    rows = evolution.normalize_by_writer(by_writer(v), _WRITERS, _CONTRACT_COLUMNS)
    early = rows.where("schema_id = 1").select("event_id", "offset", "partition", "user_id", F.col("value_cents").cast("int").alias("value_cents"), "event_type", "apply_status")
    both = evolution.add_to_ledger(early, rows.where("schema_id <> 1").select(*early.columns, "channel", "score"))
    return versions.latest_by(ledger.applied(both), ["user_id"], place()).select("user_id", "event_id", "value_cents", "channel", "score")


@query(f"""select column_name, arg_min(schema_id, "offset") as schema_id, arg_min(event_id, "offset") as event_id, count(*) as rows from (select *, unnest(case schema_id when 2 then ['channel'] when 3 then ['channel', 'score'] else [] end) as column_name from {_WRITER_SQL}) group by 1""")
def column_origins(v: Views) -> DataFrame:
    """Where each further column comes from: its first writer and event."""
    return evolution.column_origins(by_writer(v), _WRITERS, _CONTRACT_COLUMNS, F.col("offset"))


_RULED = """(select event_id, source_ts, case when value_cents >= 20000 then 'rule_value_range' when event_type not in ('signup', 'purchase', 'view', 'click') then 'rule_known_type' when user_id % 2 <> 0 and value_cents >= 10000 then 'rule_even_user' end as error_code,
    cast(value_cents >= 20000 as int) + cast(event_type not in ('signup', 'purchase', 'view', 'click') as int) + cast(user_id % 2 <> 0 and value_cents >= 10000 as int) as failed_rules from v_changes)"""


def ruled(v: Views) -> DataFrame:
    return ledger.apply_rules(v.changes, USERS.rules)


@query(f"""select event_id, case when error_code is null then 'APPLIED' else 'REJECTED' end as apply_status, error_code, cast(case error_code when 'rule_value_range' then 1 when 'rule_known_type' then 2 when 'rule_even_user' then 3 end as int) as error_ordinal,
    case error_code when 'rule_value_range' then 'rule_value_range: value_cents < 20000' when 'rule_known_type' then 'rule_known_type: event_type in (''signup'', ''purchase'', ''view'', ''click'')' when 'rule_even_user' then 'rule_even_user: user_id % 2 = 0 or value_cents < 10000' end as error_message, failed_rules from {_RULED}""")
def rule_rejections(v: Views) -> DataFrame:
    return ruled(v).select("event_id", "apply_status", "error_code", "error_ordinal", "error_message", "failed_rules")


@query(f"""select event_id, error_code, min(source_ts) as first_seen, max(source_ts) as last_seen, count(*) as occurrences, sha256(event_id || '|' || error_code) as error_id from (select event_id, error_code, source_ts from {_RULED} union all select event_id, error_code, source_ts + interval 1 day from {_RULED} where cast(split_part(event_id, ':', 3) as bigint) % 3 = 0) where error_code is not null group by 1, 2""")
def quarantine(v: Views) -> DataFrame:
    rows = ruled(v).select("event_id", "error_code", "apply_status", "source_ts", "offset")
    again = rows.where("`offset` % 3 = 0").withColumn("source_ts", F.expr("source_ts + interval 1 day"))
    return ledger.quarantine(rows.unionByName(again))


@query(f"select coalesce(error_code, 'none') as error_code, count(*) as n from {_RULED} group by 1")
def error_counts(v: Views) -> DataFrame:
    return ruled(v).groupBy(F.coalesce("error_code", F.lit("none")).alias("error_code")).agg(F.count("*").alias("n"))


# --- idempotent writes ----------------------------------------------------------------------------
def redelivered(v: Views) -> DataFrame:
    """The changes twice over for some, a few of the copies altered."""
    c = v.changes.select("event_id", "offset", "user_id", "value_cents")
    copies = c.where("`offset` % 4 = 0").withColumn("value_cents", F.when(F.col("offset") % 100 == 0, F.col("value_cents") + 1).otherwise(F.col("value_cents")))
    return c.unionByName(copies)


@query("""select event_id, "offset", user_id, value_cents from v_changes where "offset" % 100 <> 0""")
def dedupe_exact(v: Views) -> DataFrame:
    return ledger.dedupe_exact(redelivered(v), "event_id", ["offset", "user_id", "value_cents"])[0]


@query("""select event_id from v_changes where "offset" % 100 = 0""")
def identity_collisions(v: Views) -> DataFrame:
    c = v.changes.select("event_id", "user_id", "value_cents")
    return ledger.identity_collisions(redelivered(v), c, "event_id", ["user_id", "value_cents"])


@query("""select event_id, "offset" from v_changes where "offset" % 3 <> 0""")
def append_new(v: Views) -> DataFrame:
    c = v.changes.select("event_id", "offset")
    return ledger.new_rows(c, c.where("`offset` % 3 = 0"), ["event_id"])


@query("""select event_id, case when "offset" % 3 = 0 then 'new' when "offset" % 100 = 0 then 'differs' else 'known' end as verdict from v_changes""")
def append_verdicts(v: Views) -> DataFrame:
    """A batch of all changes, a few of them altered, against a table that has two thirds in files of any order."""
    path = f"{storage.shared_dir(v.spark)}/judged-{uuid.uuid4().hex}"
    c = v.changes.select("event_id", "offset", "user_id", "value_cents")
    c.where("`offset` % 3 <> 0").write.parquet(path)
    table = LedgerFiles(v.spark, path, ["event_id"])
    table.add_to_index()
    return table.judge(c.withColumn("value_cents", F.when(F.col("offset") % 100 == 0, F.col("value_cents") + 1).otherwise(F.col("value_cents")))).select("event_id", "verdict")


@query("select p_partkey, case when p_partkey % 3 = 0 then p_size + 1 else p_size end as p_size from part")
def upsert(v: Views) -> DataFrame:
    p = v.table("part").select("p_partkey", "p_size")
    return ledger.upsert(p, p.where("p_partkey % 3 = 0").withColumn("p_size", F.col("p_size") + 1), ["p_partkey"])


@query("select p_partkey, p_size from part")
def insert_if_absent(v: Views) -> DataFrame:
    p = v.table("part").select("p_partkey", "p_size")
    return ledger.insert_if_absent(p.where("p_partkey % 2 = 0"), p, ["p_partkey"])


@query("select l_orderkey, l_quantity, row_number() over (partition by l_orderkey order by l_quantity, l_extendedprice, l_partkey, l_suppkey, l_linenumber) as row_number, l_extendedprice from lineitem where l_orderkey % 2 = 1")
def append_numbered(v: Views) -> DataFrame:
    rows = ledger.number_rows(v.table("lineitem"), "l_orderkey", ["l_quantity", "l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber"])
    rows = rows.select("l_orderkey", "l_quantity", F.col("row_number").cast("bigint").alias("row_number"), "l_extendedprice")
    return ledger.new_rows(rows, rows.where("l_orderkey % 2 = 0"), ["l_orderkey", "row_number"]).select(*rows.columns)


@query("select p_brand as brand, case when p_brand < 'Brand#3' then upper(p_brand) else p_brand end as english from (select distinct p_brand from part)")
def backfill_parent(v: Views) -> DataFrame:
    child = v.table("part").select(F.col("p_brand").alias("brand"))
    parent = child.where("brand < 'Brand#3'").distinct().withColumn("english", F.upper("brand"))
    return ledger.backfill_parent(child, parent, "brand", english=F.col("brand"))


@query("select s_suppkey, s_name, null::double as s_acctbal from supplier where s_suppkey % 2 = 0 union all select s_suppkey, s_name, s_acctbal from supplier where s_suppkey % 2 = 1")
def align_schema(v: Views) -> DataFrame:
    s = v.table("supplier")
    return ledger.align_schema(s.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name"), s.where("s_suppkey % 2 = 1").select("s_suppkey", "s_name", "s_acctbal"))


@query("select s_suppkey, s_name from supplier")
def load_once(v: Views) -> DataFrame:
    """A reference table written once; the second load leaves it."""
    path = f"{storage.shared_dir(v.spark)}/reference-{uuid.uuid4().hex}"
    rows = v.table("supplier").select("s_suppkey", "s_name")
    storage.load_reference_once(rows, path)
    storage.load_reference_once(rows, path)
    return v.spark.read.parquet(path)


def _portions(v: Views, rows: DataFrame, parts: int) -> list[DataFrame]:
    """The rows in batches whose order has nothing to do with time."""
    return [rows.where(F.pmod(F.xxhash64("offset"), F.lit(parts)) == i) for i in range(parts)]


@query("""select user_id, event_id, "offset", op, value_cents from (select *, row_number() over (partition by user_id order by partition desc, "offset" desc) as n from v_changes) where n = 1 and not is_deleted""")
def current_by_buckets(v: Views) -> DataFrame:
    """The current state kept batch by batch, each of which rewrites the buckets of its keys; late rows lose."""
    c = v.changes.select("user_id", "partition", "event_id", "offset", "op", "value_cents", "is_deleted")
    table = buckets.BucketedTable(v.spark, f"{storage.shared_dir(v.spark)}/current-{uuid.uuid4().hex}", ["user_id"], c.schema, 16)
    for batch in _portions(v, c, 3):
        buckets.apply_current(table, batch, place())
    return table.read().where("not is_deleted").select("user_id", "event_id", "offset", "op", "value_cents")


@query("select user_id, event_id, event_type, value_cents, valid_from, valid_to, valid_to is null as is_current from v_scd2")
def scd2_by_batches(v: Views) -> DataFrame:
    """Type-2 versions kept batch by batch, whose events come in any order and split or merge intervals."""
    names = ["user_id", "source_ts", "partition", "offset", "event_id", "event_type", "value_cents", "is_snapshot", "is_deleted"]
    attributes = F.md5(F.concat(F.col("event_type"), F.lit("|"), F.expr("cast(value_cents div 20000 as string)")))
    build = lambda rows: versions.scd2(rows, "user_id", ("source_ts", "partition", "offset"), attributes)
    c = v.changes.select(*names)
    root = f"{storage.shared_dir(v.spark)}/scd2-{uuid.uuid4().hex}"
    kept = ["user_id", "event_id", "event_type", "value_cents", "valid_from", "valid_to", "is_current"]
    events = buckets.BucketedTable(v.spark, f"{root}/events", ["user_id"], c.schema, 16)
    intervals = buckets.BucketedTable(v.spark, f"{root}/intervals", ["user_id"], build(c).select(*kept).schema, 16)
    for batch in _portions(v, c, 3):
        buckets.apply_intervals(events, intervals, batch, build)
    return intervals.read()


# --- transactions and boundary --------------------------------------------------------------------
def effective(v: Views) -> DataFrame:
    return transactions.effective_transactions(v.observations)


@query("""select transaction_id, case when max(case when status = 'COMPLETE' then 1 else 0 end) = 1 then 'COMPLETE' else 'OPEN' end as status, min(case when status = 'OPEN' then "offset" end) as begin_offset, max(end_offset) as end_offset, max(event_count) as event_count, count(*) as markers, 'cdc.users:' || max(event_count) as collections from v_observations where status <> 'REJECTED' group by 1""")
def assemble_transactions(v: Views) -> DataFrame:
    marks = v.observations.where("status <> 'REJECTED'").withColumn("status", F.when(F.col("status") == "OPEN", "BEGIN").otherwise("END"))
    return transactions.assemble_transactions(marks.withColumn("collections", F.when(F.col("status") == "END", F.concat(F.lit("cdc.users:"), F.col("event_count").cast("string")))))


@query("""select transaction_id, status, "offset", event_count from v_effective""")
def effective_transactions(v: Views) -> DataFrame:
    return effective(v).select("transaction_id", "status", "offset", "event_count")


_STOP = """(select min("offset") from v_effective where status <> 'COMPLETE' and "offset" > 100)"""
_PREFIX = f"""v_effective where status = 'COMPLETE' and "offset" > 100 and "offset" < coalesce({_STOP}, 9223372036854775807)"""


@query(f"""select 'MATERIALIZING' as status, 'complete_prefix' as reason, max("offset") as target_offset, arg_max(transaction_id, "offset") as target_transaction, count(*) as transactions, cast(sum(event_count) as bigint) as expected_events from {_PREFIX}""")
def boundary_select(v: Views) -> DataFrame:
    return transactions.select_boundary(storage.save(effective(v), "effective"), 100)


#: Planted changes of the effective transactions, as (status, transaction_id, event_count) where it holds; behind the first OPEN one nothing counts.
_SCENARIOS = {
    "plain": ("false", "status", "transaction_id", "event_count"),
    "empty_last": ("`offset` > 300", "status", "transaction_id", "0L"),
    "all_empty": ("true", "status", "transaction_id", "0L"),
    "rejected_behind_prefix": ("`offset` between 201 and 209 and status = 'COMPLETE'", "'REJECTED'", "transaction_id", "event_count"),
    "rejected_behind_open": ("`offset` > 2000 and status = 'COMPLETE'", "'REJECTED'", "transaction_id", "event_count"),
    "nameless": ("`offset` between 301 and 309 and status = 'COMPLETE'", "status", "' '", "event_count"),
    "unknown": ("`offset` between 401 and 409", "'HALF'", "transaction_id", "event_count"),
    "first_open": ("`offset` between 101 and 109", "'OPEN'", "transaction_id", "event_count"),
}


def _scenario_sql(name: str) -> str:
    """The rule, written out: what blocks before the first OPEN transaction, then what the prefix holds."""
    when, status, tx, count = (x.replace("`", '"').replace("0L", "0") for x in _SCENARIOS[name])
    return f"""select '{name}' as scenario, case when blocked is not null then 'BLOCKED' when transactions > 0 then 'MATERIALIZING' when open_at is not null then 'WAITING' else 'NOOP' end as status,
        coalesce(blocked, case when transactions > 0 then 'complete_prefix' when open_at is not null then 'open_transaction' else 'nothing_new' end) as reason, target_offset, target_transaction, transactions, expected_events from (
        with e as (select "offset", case when {when} then {status} else status end as status, case when {when} then {tx} else transaction_id end as transaction_id, case when {when} then {count} else event_count end as event_count from v_effective where "offset" > 100),
        o as (select min("offset") as open_at from e where status = 'OPEN'),
        b as (select arg_min(case when status = 'REJECTED' then 'rejected_transaction' when status <> 'COMPLETE' then 'unknown_state' else 'missing_transaction_id' end, "offset") as blocked from e, o
            where "offset" < coalesce(open_at, 9223372036854775807) and (status in ('REJECTED', 'HALF') or (status = 'COMPLETE' and trim(transaction_id) = '')))
        select open_at, blocked, max("offset") as target_offset, arg_max(transaction_id, "offset") as target_transaction, count("offset") as transactions, cast(coalesce(sum(event_count), 0) as bigint) as expected_events
        from o cross join b left join e on blocked is null and status = 'COMPLETE' and event_count > 0 and "offset" < coalesce(open_at, 9223372036854775807) group by open_at, blocked)"""


@query(" union all ".join(f"select * from ({_scenario_sql(n)})" for n in _SCENARIOS))
def boundary_scenarios(v: Views) -> DataFrame:
    """The boundary with planted empty, rejected, nameless, unknown and open transactions."""
    states = storage.save(effective(v), "effective")
    out = None
    for name, (when, *new) in _SCENARIOS.items():
        changed = states.withColumns({c: F.expr(f"case when {when} then {x} else {c} end") for c, x in zip(("status", "transaction_id", "event_count"), new)})
        row = transactions.select_boundary(changed, 100).select(F.lit(name).alias("scenario"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def bounded(v: Views) -> DataFrame:
    """Changes inside the newest complete prefix; the boundary stays a one-row table.

    The effective transactions and the boundary are written once, as several parts read them.
    """
    states = storage.save(effective(v), "effective")
    target = F.broadcast(storage.save(transactions.select_boundary(states, 100).select("target_offset"), "boundary"))
    changes = v.changes.withColumn("transaction_id", F.when(F.col("offset") % 19 != 0, F.col("transaction_id")))  # some are outside transactions
    ends = changes.crossJoin(target).groupBy("topic", "partition").agg(F.max(F.when(F.col("offset") <= F.col("target_offset"), F.col("offset"))).alias("end_offset"))
    return transactions.within_transactions(transactions.within_offsets(changes, ends), states, target)


_BOUNDED = f"""(select * from v_changes where "offset" <= (select max("offset") from {_PREFIX}) and ("offset" % 19 = 0 or transaction_id in (select transaction_id from v_effective where status = 'COMPLETE' and "offset" <= (select max("offset") from {_PREFIX}))))"""


@query(f"""select event_id, "offset" from {_BOUNDED}""")
def within_boundary(v: Views) -> DataFrame:
    return bounded(v).select("event_id", "offset")


@query(f"""select user_id, event_id, is_deleted from {_BOUNDED} qualify row_number() over (partition by user_id order by partition desc, "offset" desc) = 1""")
def candidate_current(v: Views) -> DataFrame:
    return versions.latest_by(bounded(v), ["user_id"], place()).select("user_id", "event_id", "is_deleted")


@query(f"""select transaction_id, count(*) as events, nullif(count(*) filter (where entity = 'users'), 0) as users_events, nullif(count(*) filter (where entity = 'orders'), 0) as orders_events from (select transaction_id, 'users' as entity from v_changes union all select transaction_id, 'orders' from {_ORDER_CHANGES}) group by 1""")
def transaction_counts(v: Views) -> DataFrame:
    both = ledger.union_ledgers(users=v.changes.select("transaction_id"), orders=order_changes(v).select("transaction_id"))
    per = transactions.transaction_counts(both)
    return per.select("transaction_id", "events", *(F.try_element_at("counts", F.lit(e)).alias(f"{e}_events") for e in ("users", "orders")))


@query("select distinct transaction_id from v_changes where transaction_id not in (select transaction_id from v_effective where status = 'COMPLETE')")
def audit_gap(v: Views) -> DataFrame:
    return transactions.audit_gap(v.changes, effective(v))


@query("""select 'MATERIALIZING' as status, 0::bigint as missing_entities, max("offset") as target_offset, count(*) as expected_events from v_changes where is_snapshot""")
def initial_snapshot_boundary(v: Views) -> DataFrame:
    kind = F.concat(F.lit("users_"), F.col("partition").cast("string"))
    c = v.changes.withColumn("entity", kind)
    return transactions.initial_boundary(c, c.select("entity").distinct())


@query(f"""select entity, cast(count(*) as bigint) as events, cast(max(case when partition = 0 then "offset" end) as bigint) as last_0, cast(max(case when partition = 1 then "offset" end) as bigint) as last_1 from (select entity, partition, "offset" from v_changes union all select 'orders', 0, "offset" from {_ORDER_CHANGES}) group by 1""")
def entity_metrics(v: Views) -> DataFrame:
    m = ledger.entity_metrics(ledger.union_ledgers(users=v.changes.drop("entity"), orders=order_changes(v)))
    last = lambda p: F.try_element_at("offsets", F.concat(F.lit("cdc."), "entity", F.lit(f":{p}")))
    return m.select("entity", "events", last(0).alias("last_0"), last(1).alias("last_1"))


@query(f"""select * from (with m as (select 'users' as entity, user_id as k, partition, "offset", is_deleted, event_id from {{_BOUNDED}} union all select 'orders', order_id, 0, "offset", false, 'cdc.orders:0:' || "offset" from {_ORDER_CHANGES}),
    e as (select 'users' as entity, count(*) as n from {{_BOUNDED}} union all select 'orders', count(*) from v_orders), k as (select entity, k, count(*) as n, arg_max(is_deleted, "offset") as gone from m group by 1, 2),
    h as (select entity, cast(sum(n) as bigint) as n, count(*) as keys, count(*) filter (where not gone) as visible from k group by 1),
    s as (select entity, sha256(string_agg(c, chr(10) order by partition, span)) as checksum from (select entity, partition, "offset" // 10000 as span, sha256(string_agg(event_id, chr(10) order by event_id)) as c from m group by 1, 2, 3) group by 1)
    select entity, case when e.n = h.n then 'VALIDATED' else 'FAILED' end as status, e.n as expected_events, h.n as materialized_events, h.keys as affected_keys, h.visible as current_rows, s.checksum, case when e.n <> h.n then 'count_mismatch' end as error_code from e join h using (entity) join s using (entity))""".replace("{_BOUNDED}", _BOUNDED))
def entity_results(v: Views) -> DataFrame:
    """A run's result per entity; of the orders only the snapshot is expected, so they fail (planted)."""
    inside = storage.save(bounded(v).select("user_id", "partition", "offset", "is_deleted", "event_id"), "inside")
    orders = order_changes(v).select(F.col("order_id").alias("k"), "partition", "offset", "is_deleted", F.concat(F.lit("cdc.orders:0:"), F.col("offset").cast("string")).alias("event_id"))
    rows = ledger.union_ledgers(users=inside.withColumnRenamed("user_id", "k"), orders=orders)
    count = lambda df, e: df.agg(F.count("*").alias("expected_events")).withColumn("entity", F.lit(e))
    expected = count(inside, "users").unionByName(count(v.orders, "orders"))
    return ledger.entity_results(expected, rows, ["k"], F.col("event_id"), place())


# --- progress and health --------------------------------------------------------------------------
@query("""select topic, partition, max("offset") as last_offset, arg_max(event_id, "offset") as last_event_id, arg_max(source_ts, "offset") as last_source_ts, count(*) as events from v_changes group by 1, 2""")
def progress_rows(v: Views) -> DataFrame:
    return ledger.progress_rows(v.changes)


@query("""select 'users_' || p as entity, "last" as last_offset, "last" is not null as found from (select distinct user_id % 4 as p from events) left join (select partition as p, max("offset") as "last" from v_changes group by 1) using (p)""")
def latest_progress(v: Views) -> DataFrame:
    name = lambda c: F.concat(F.lit("users_"), c.cast("string")).alias("entity")
    rows = v.changes.select(name(F.col("partition")), F.col("source_ts").alias("recorded_at"), F.col("offset").alias("last_offset"))
    need = v.table("events").select(name(F.col("user_id") % 4)).distinct()
    return ledger.latest_progress(rows, need).select("entity", "last_offset", "found")


def lag(v: Views) -> DataFrame:
    """Progress as of the changes whose offset does not divide by 7, against the whole log."""
    c = v.changes
    ends = c.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ledger.stream_lag(ends, ledger.progress_rows(c.where("`offset` % 10 < 7 and partition <> 2")))


_LAG = """(select topic, partition, end_offset, greatest(end_offset - coalesce("last" + 1, 0), 0) as lag from (select topic, partition, max("offset") + 1 as end_offset, max(case when "offset" % 10 < 7 and partition <> 2 then "offset" end) as "last" from v_changes group by 1, 2))"""


@query(f"select * from {_LAG}")
def stream_lag(v: Views) -> DataFrame:
    return lag(v)


def status(v: Views) -> DataFrame:
    """Each user's newest change as the status of a query."""
    return v.changes.groupBy("user_id").agg(F.max("source_ts").alias("updated_at"), F.max_by("op", "offset").alias("op")).withColumn("ready", F.col("op") != "d")


def now(v: Views) -> DataFrame:
    return v.changes.agg(F.max("source_ts").alias("now"))


@query(f"""select cast(t as bigint) as total_lag, cast(r as int) as min_ready, s as max_staleness, n as stale_queries, t > 10000 as lag_alert, s > 120 as stale_alert from (select sum(lag) as t from {_LAG}), (select min(cast(op <> 'd' as int)) as r, max(age) as s, count(*) filter (where age > 120) as n from (
    select arg_max(op, "offset") as op, cast(floor(epoch((select max(source_ts) from v_changes))) - floor(epoch(max(source_ts))) as bigint) as age from v_changes group by user_id))""")
def slo_rollup(v: Views) -> DataFrame:
    rows = status(v).crossJoin(F.broadcast(now(v)))
    moved = rows.withColumn("updated_at", F.timestamp_seconds(F.unix_timestamp("updated_at") - F.unix_timestamp("now")))
    return ledger.slo_rollup(lag(v), moved, F.timestamp_seconds(F.lit(0)))


_SAMPLES = """(select 'series' || (user_id % 50) as series, source_ts as seen, value_cents as lag, value_cents // 10 as publication_age, cast(value_cents % 3 <> 0 as int) as rejected, cast(value_cents % 2 = 0 as int) as active_lease from v_changes)"""
_ALERTS = (("lag_high", "lag > 10000", 120), ("publication_stalled", "publication_age > 600", 120), ("rejected_boundary", "rejected = 1", 30), ("lease_stalled", "active_lease = 1 and publication_age > 600", 120))


@query(f"""select * from (with j as (select series, seen, rule, secs, bool_and(on_) as on_ from ({' union all '.join(f"select series, seen, '{n}' as rule, {k} as secs, {c} as on_ from {_SAMPLES}" for n, c, k in _ALERTS)}) group by 1, 2, 3, 4),
    i as (select *, sum(cast(not on_ as int)) over (partition by series, rule order by seen) as island, lead(seen) over (partition by series, rule order by seen) as nxt, lead(on_) over (partition by series, rule order by seen) as goes_on from j),
    s as (select *, min(seen) over (partition by series, rule, island) as since from i where on_)
    select rule, series, min(since) as since, min(case when seen >= since + to_seconds(secs) then seen end) as fired_at, max(case when not goes_on then nxt end) as until from s group by rule, series, island)""")
def alert_episodes(v: Views) -> DataFrame:
    """How long conditions held, over status samples in two batches; what is open at the first one's end goes on."""
    c = v.changes
    cents = F.col("value_cents")
    samples = c.select(F.expr("concat('series', cast(user_id % 50 as string))").alias("series"), F.col("source_ts").alias("at"), cents.alias("lag"), F.expr("value_cents div 10").alias("publication_age"), (cents % 3 != 0).cast("int").alias("rejected"), (cents % 2 == 0).cast("int").alias("active_lease"))
    middle = samples.agg(F.expr("timestamp_seconds(div(unix_timestamp(cast(min(at) as timestamp)) + unix_timestamp(cast(max(at) as timestamp)), 2))").cast("timestamp_ntz").alias("middle"))
    both = samples.crossJoin(F.broadcast(middle))
    first = storage.save(alerts.episodes(both.where("at < middle").drop("middle")), "episodes")
    return first.where("until is not null").unionByName(alerts.episodes(both.where("at >= middle").drop("middle"), open_=first))


@query("""select max(case when status = 'PUBLISHED' then seq end) as last_published, cast(epoch(timestamp '2021-01-01') - epoch(max(case when status = 'PUBLISHED' then recorded_at end)) as bigint) as publication_age, arg_max(status, recorded_at) as latest_status, true as age_alert,
    arg_max(status, recorded_at) = 'FAILED' as rejected, (select count(*) from v_runs where seq = 3) > 0 as active_lease from v_markers""")
def serving_gauges(v: Views) -> DataFrame:
    """Failed runs count as rejected, and each order of one run holds a lease."""
    at = F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")
    markers = v.markers.withColumn("reason", F.when(F.col("status") == "FAILED", "rejected_transaction"))
    leases = v.runs.select(F.col("order_id").cast("string").alias("owner"), F.when(F.col("seq") == 3, at + F.expr("interval 1 hour")).otherwise(at).alias("expires_at"))
    return publication.serving_gauges(markers, at, leases=leases)


@query("""select entity, topic, cast(partition as int) as partition, max("offset") as "offset" from v_changes group by 1, 2, 3""")
def parse_offsets(v: Views) -> DataFrame:
    per = v.changes.groupBy("entity", "topic", "partition").agg(F.max("offset").alias("last"))
    inner = per.groupBy("entity", "topic").agg(F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "last"))).alias("m"))
    progress = inner.groupBy("entity").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "m")))).alias("progress"))
    return storage.parse_offsets(progress, "progress").drop("progress")


#: Consecutive user ids in one status document, so that its size does not grow with the table.
STATUS_USERS = 10_000


@query("""select 'app' || partition as application, 'user' || user_id as name, arg_max(op, "offset") as state, max("offset") as last_batch_id from v_changes group by partition, user_id""")
def status_rows(v: Views) -> DataFrame:
    per = v.changes.groupBy("partition", "user_id").agg(F.max_by("op", "offset").alias("state"), F.max("offset").alias("last_batch_id"))
    one = F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"), "state", "last_batch_id")
    doc = per.groupBy("partition", F.floor(F.col("user_id") / STATUS_USERS)).agg(F.to_json(F.collect_list(one)).alias("json"))
    parsed = doc.select(F.concat(F.lit("app"), F.col("partition").cast("string")).alias("application"), F.lit(None).alias("updated_at"), F.from_json("json", "array<struct<name: string, state: string, last_batch_id: bigint>>").alias("queries"))
    return storage.status_rows(parsed).drop("updated_at")


# --- streaming ------------------------------------------------------------------------------------
def _captured(v: Views, times: int) -> DataFrame:
    """The events captured as a file stream, ``times`` over, each time with a checkpoint of its own."""
    root = f"{storage.shared_dir(v.spark)}/capture-{uuid.uuid4().hex}"
    source = v.table("events")
    for i in range(times):
        stream = v.spark.readStream.schema(source.schema).parquet(f"{v.sf_dir}/event[s].parquet")  # a pattern serves a file and a folder
        rows = stream.select(F.lit("cdc.users").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.concat_ws(":", F.lit("cdc.users"), (F.col("user_id") % 3).cast("string"), F.col("event_id").cast("string")).alias("event_id"), F.col("ts").alias("source_ts"), "event_type")
        write = capture.ledger_writer(f"{root}/ledger", f"{root}/progress", lambda b: b)
        capture.start(rows, f"capture_{uuid.uuid4().hex}", capture.checkpoint_for(f"{root}/checkpoints", f"raw{i}", "1"), write, contract=f"{i}:1").awaitTermination()
    return v.spark.read.parquet(f"{root}/ledger")


@query("""select topic, cast(partition as int) as partition, "offset", event_id, event_type from v_changes""")
def stream_raw_to_ledger(v: Views) -> DataFrame:
    return _captured(v, 1).select("topic", "partition", "offset", "event_id", "event_type")


@query("select event_type, count(*) as n, count(distinct event_id) as ids from v_changes group by 1")
def stream_replay_idempotent(v: Views) -> DataFrame:
    return _captured(v, 2).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


def _arriving(v: Views, rows: DataFrame, parts: int):
    """Rows as files of a folder that arrive in ``parts`` portions; ``bring(i)`` brings portion i, ``read()`` is the stream."""
    folder = f"{storage.shared_dir(v.spark)}/arriving-{uuid.uuid4().hex}"
    rows = storage.save(rows, "portions")

    def bring(i: int) -> None:
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == i).coalesce(1).write.mode("append").parquet(folder)

    return bring, lambda: v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder), folder


@query("""select transaction_id, status, "offset", event_count, min(case when o.status_ = 'OPEN' then o.at end) as begin_offset from v_effective join (select transaction_id, status as status_, "offset" as at from v_observations) o using (transaction_id) group by 1, 2, 3, 4""")
def stream_transactions(v: Views) -> DataFrame:
    """Transactions whose BEGIN and END come in different batches, in any order, with a restart between."""
    bring, read, folder = _arriving(v, v.observations, 3)
    for portions in ((0, 1), (2,)):
        for i in portions:
            bring(i)
        made = stateful.assemble_stream(read(), "30 days").writeStream.format("parquet").option("path", f"{folder}-states").option("checkpointLocation", f"{folder}-checkpoint")
        made.trigger(availableNow=True).start().awaitTermination()
    states = v.spark.read.parquet(f"{folder}-states").where("not stale")
    begins = states.groupBy("transaction_id").agg(F.min("begin_offset").alias("begin_offset"))
    return transactions.effective_transactions(states.drop("begin_offset", "stale")).join(begins, "transaction_id").select("transaction_id", "status", "offset", "event_count", "begin_offset")


@query("""select event_type, count(*) as n, count(distinct event_id) as ids, 1 as dropped_before_ledger from v_changes group by 1""")
def stream_recent_duplicates(v: Views) -> DataFrame:
    """Events that come twice: the copies go at the state, or, where they come after a restart without it, at the index."""
    rows = v.changes.select("topic", "partition", "offset", "event_id", "source_ts", "event_type")
    bring, read, folder = _arriving(v, rows, 2)
    for i in (0, 1, 0):
        bring(i)
    write = capture.ledger_writer(f"{folder}-ledger", f"{folder}-progress", lambda b: b)
    listener = capture.ProgressListener()
    v.spark.streams.addListener(listener)
    once = stateful.dedupe_recent(read(), ["event_id"], ["topic", "partition", "offset", "source_ts", "event_type"], "1 day")
    for name in ("a", "b"):  # the second query has no state of the first
        capture.start(once, f"recent_{uuid.uuid4().hex}", capture.checkpoint_for(f"{folder}-checkpoints", name, "1"), write).awaitTermination()
    v.spark.streams.removeListener(listener)
    batches = v.spark.read.parquet(f"{folder}-progress").groupBy("batch_id").agg(F.sum("events").alias("n")).where("batch_id = 2").count()
    return v.spark.read.parquet(f"{folder}-ledger").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.lit(1 - batches).alias("dropped_before_ledger"))


@query("""select 'users' as target, event_id as id, op as what from v_changes union all select 'transactions', event_id, status from v_observations union all select 'schemas', cast(s as varchar), 'seen' from (select distinct user_id % 3 + 1 as s from v_changes)""")
def stream_entity_tables(v: Views) -> DataFrame:
    """A log of changes and transaction marks fanned out to three tables; the first try crashes between two of them."""
    c = v.changes.select("topic", "partition", "offset", "event_id", "source_ts", F.col("op").alias("what"), (F.col("user_id") % 3 + 1).alias("schema_id"))
    o = v.observations.select(F.lit("tx").alias("topic"), F.lit(0).cast("bigint").alias("partition"), "offset", "event_id", F.col("recorded_at").alias("source_ts"), F.col("status").alias("what"), F.lit(None).cast("bigint").alias("schema_id"))
    bring, read, folder = _arriving(v, c.unionByName(o), 2)
    for i in (0, 1):
        bring(i)
    tables = commits.CommittedTables(v.spark, f"{folder}-tables", "1")
    kept = ("event_id", "what")
    tries = []

    def transactions_of(batch: DataFrame) -> DataFrame:
        tries.append(1)
        crash = F.raise_error(F.lit("planted")).cast("string").alias("what")  # when it is written, after the other tables
        return batch.select("event_id", crash if len(tries) == 1 else "what")

    def users(batch: DataFrame) -> dict[str, DataFrame]:
        seen = batch.select(F.col("schema_id").cast("string").alias("event_id"), F.lit("seen").alias("what")).distinct()
        return {"users": batch.select(*kept), "schemas": seen}

    write = commits.fan_out(tables, {"cdc.users": users, "tx": transactions_of})
    start = lambda: capture.start(read(), f"fan_{uuid.uuid4().hex}", capture.checkpoint_for(f"{folder}-checkpoints", "fan", "1"), write, contract="1")
    try:
        start().awaitTermination()
    except Exception:
        if tables.files("users") or len(tries) != 1 or tables.failures().count() != 1:
            raise
    start().awaitTermination()
    out = None
    for name in ("users", "transactions", "schemas"):
        rows = tables.read("tx" if name == "transactions" else name, "event_id string, what string").select(F.lit(name).alias("target"), F.col("event_id").alias("id"), "what")
        out = rows if out is None else out.unionByName(rows)
    return out


# --- publication ----------------------------------------------------------------------------------
_PUBLISHED = "(select seq from (select seq, arg_max(status, recorded_at) as status from v_markers group by 1) where status = 'PUBLISHED')"


@query(f"""select order_id, status, "offset" from v_runs where seq = (select coalesce(max(seq), 0) from {_PUBLISHED})""")
def published_latest(v: Views) -> DataFrame:
    return publication.published_view(v.runs, v.markers)


@query(f"select order_id, seq from v_runs where seq in (select seq from {_PUBLISHED}) or seq = 5")
def unpublished_isolation(v: Views) -> DataFrame:
    return publication.visible_runs(v.runs, v.markers, candidate=5).select("order_id", "seq")


@query(f"select distinct seq, case when seq in (select seq from {_PUBLISHED} order by seq desc limit 2) then 'keep' else 'drop' end as action from v_runs")
def retention_plan(v: Views) -> DataFrame:
    return publication.retention_plan(v.runs, v.markers, 2)


@query("""select customer_id, order_id, seq from (select customer_id, order_id, cast(year(purchase) - 1990 as bigint) as seq, row_number() over (partition by customer_id order by purchase desc, order_id desc) as n from v_orders where year(purchase) - 1990 <= 5) where n = 1""")
def read_as_of(v: Views) -> DataFrame:
    rows = v.orders.select("customer_id", "order_id", "purchase", (F.year("purchase") - 1990).cast("bigint").alias("seq"))
    return publication.read_as_of(rows, ["customer_id"], 5, F.struct("purchase", "order_id")).select("customer_id", "order_id", "seq")


@query("select seq as run_id, arg_max(status, recorded_at) as status, count(*) as steps, 1 as legal from v_markers group by 1")
def run_ledger(v: Views) -> DataFrame:
    return publication.run_ledger(v.markers.withColumnRenamed("seq", "run_id"))


# --- parity, digests ------------------------------------------------------------------------------
@query(f"""select partition, a as expected, b as actual, a = b as matches from (select partition, count(*) as a from v_changes group by 1) left join (select partition, count(*) as b from {_BOUNDED} group by 1) using (partition)""")
def count_parity(v: Views) -> DataFrame:
    want = v.changes.groupBy("partition").agg(F.count("*").alias("expected"))
    have = bounded(v).groupBy("partition").agg(F.count("*").alias("actual"))
    return want.join(have, "partition", "left").withColumn("matches", F.col("expected") == F.col("actual"))


@query("""select event_id, case when "offset" % 11 = 0 then 'missing_right' when "offset" % 13 = 0 then 'missing_left' else 'hash_diff' end as difference from v_changes where "offset" % 11 = 0 or "offset" % 13 = 0 or "offset" % 17 = 0""")
def row_parity(v: Views) -> DataFrame:
    c = v.changes.select("event_id", "offset", values.row_digest("user_id", "value_cents").alias("row_hash"))
    left = c.where("`offset` % 13 <> 0 or `offset` % 11 = 0")
    right = c.where("`offset` % 11 <> 0").withColumn("row_hash", F.when(F.col("offset") % 17 == 0, F.lit("altered")).otherwise(F.col("row_hash")))
    return ledger.parity(left, right, ["event_id"])


@query("""select event_id, case when "offset" % 1100 = 0 then 'missing_right' when "offset" % 1300 = 0 then 'missing_left' else 'hash_diff' end as difference from v_changes where "offset" % 1100 = 0 or "offset" % 1300 = 0 or "offset" % 1700 = 0""")
def tree_parity(v: Views) -> DataFrame:
    """A few differences, found by digests: only the leaves that hold them are joined."""
    c = v.changes.select("event_id", "offset", values.row_digest("user_id", "value_cents").alias("row_hash"))
    left = c.where("`offset` % 1300 <> 0 or `offset` % 1100 = 0")
    right = c.where("`offset` % 1100 <> 0").withColumn("row_hash", F.when(F.col("offset") % 1700 == 0, F.lit("altered")).otherwise(F.col("row_hash")))
    return hashtree.tree_parity(left, right, ["event_id"])


@query("""select user_id, sha256(string_agg(d, chr(10) order by leaf)) as checksum, cast(sum(n) as bigint) as lines from (select user_id, sha256(l)[:2] as leaf, sha256(string_agg(l, chr(10) order by l)) as d, count(*) as n from (
    select user_id, event_id || '|' || value_cents || '|' || transaction_id as l from v_changes) group by 1, 2) group by 1""")
def event_checksum(v: Views) -> DataFrame:
    return ledger.event_checksum(v.changes, ["user_id"], F.concat_ws("|", "event_id", F.col("value_cents").cast("string"), "transaction_id"))


@query("""select partition, sha256(string_agg(d, chr(10) order by leaf)) as checksum, cast(sum(n) as bigint) as lines from (select partition, sha256(h)[:2] as leaf, sha256(string_agg(h, chr(10) order by h)) as d, count(*) as n from (
    select partition, sha256(event_id || '|' || user_id || '|' || props) as h from v_changes) group by 1, 2) group by 1""")
def manifest(v: Views) -> DataFrame:
    return ledger.event_checksum(v.changes, ["partition"], values.row_digest("event_id", "user_id", "props"))


@query(f"""with a as (select user_id, event_id from {_BOUNDED} qualify row_number() over (partition by user_id order by partition desc, "offset" desc) = 1), b as (select user_id, event_id from {_BOUNDED} where user_id % 10 <> 3 or "offset" % 4 <> 0 qualify row_number() over (partition by user_id order by partition desc, "offset" desc) = 1)
    select user_id, case when b.event_id is null then 'missing_right' else 'hash_diff' end as difference from a left join b using (user_id) where b.event_id is null or a.event_id <> b.event_id""".replace("with a as", "select * from (with a as", 1) + ")")
def rebuild_parity(v: Views) -> DataFrame:
    """A rebuild from the ledger against a state kept batch by batch, which has lost some changes (planted)."""
    inside = storage.save(bounded(v), "inside")
    a = versions.latest_by(inside, ["user_id"], place()).withColumn("row_hash", values.row_digest("event_id", "value_cents"))
    kept = inside.where("user_id % 10 <> 3 or `offset` % 4 <> 0")
    half = kept.where("`offset` % 2 = 0")
    b = versions.apply_current(versions.latest_by(half, ["user_id"], place()), kept.where("`offset` % 2 = 1"), ["user_id"], place()).withColumn("row_hash", values.row_digest("event_id", "value_cents"))
    return ledger.parity(a, b, ["user_id"])


@query(f"""select 'changes' as measure, count(*) as n from v_changes union all select 'duplicates', count(*) from (select event_id from v_changes group by 1 having count(*) > 1) union all select 'rejected', count(*) from {_RULED} where error_code is not null
    union all select 'op_' || op, count(*) from v_changes group by op union all select 'visible', count(*) from (select arg_max(is_deleted, "offset") as g from v_changes group by user_id) where not g
    union all select 'deleted', count(*) from (select arg_max(is_deleted, "offset") as g from v_changes group by user_id) where g union all select 'physical', count(distinct user_id) from v_changes""")
def acceptance_counts(v: Views) -> DataFrame:
    c = v.changes
    row = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n")
    ops = c.groupBy("op").agg(F.count("*").alias("n")).select(F.concat(F.lit("op_"), "op").alias("measure"), "n")
    parts = [row(checks.duplicate_keys(c, ["event_id"]), "duplicates"), row(ruled(v).where("error_code is not null"), "rejected"), ops]
    counts = versions.current_counts(c, ["user_id"], place()).select(F.explode(F.map_from_arrays(F.array(*(F.lit(m) for m in ("physical", "visible", "deleted"))), F.array("physical", "visible", "deleted"))).alias("measure", "n"))
    parts.append(counts)
    out = row(c, "changes")
    for p in parts:
        out = out.unionByName(p)
    return out


@query(f"""select 'open' as check_name, count(*) as failures, count(*) = 0 as passed from v_effective where status = 'OPEN' union all select 'rejected', count(*), count(*) = 0 from v_effective where status = 'REJECTED' union all select 'gap', count(distinct transaction_id), count(distinct transaction_id) = 0 from v_changes where transaction_id not in (select transaction_id from v_effective where status = 'COMPLETE')
    union all select 'unpublished', count(*), count(*) = 0 from (select seq, arg_max(status, recorded_at) as s from v_markers group by 1) where s <> 'PUBLISHED' union all select 'parity', count(*), count(*) = 0 from v_changes where "offset" % 11 = 0 or "offset" % 13 = 0 or "offset" % 17 = 0""")
def final_gate(v: Views) -> DataFrame:
    e = effective(v)
    return checks.gate(open=e.where("status = 'OPEN'"), rejected=e.where("status = 'REJECTED'"), gap=transactions.audit_gap(v.changes, e), unpublished=v.markers.select("seq").distinct().join(publication.published_runs(v.markers), "seq", "left_anti"), parity=row_parity(v))


@query("""select distinct 'cdc.users' as topic, partition, 'missing' as problem from v_changes where partition not in (select partition from v_changes where "offset" % 10 < 7 and partition <> 2) union all select distinct 'old.users', partition, 'topic_prefix' from v_changes where partition <> 2 and partition = 1 and "offset" % 10 < 7""")
def offsets_valid(v: Views) -> DataFrame:
    """Run offsets: each topic and partition that is needed is there, and topics have the capture's prefix (one is planted without)."""
    rows = ledger.progress_rows(v.changes.where("`offset` % 10 < 7 and partition <> 2"))
    have = rows.select("topic", "partition").unionByName(rows.where("partition = 1").select(F.lit("old.users").alias("topic"), "partition"))
    return ledger.offset_problems(have, v.changes.select("topic", "partition").distinct(), "cdc.")


@query("""select user_id, a as events_before, b as events_after, coalesce(a, 0) <> b as moved from (select user_id, count(*) filter (where "offset" < 5000) as a0, count(*) as b from v_changes group by 1) left join (select user_id as u, count(*) as a from v_changes where "offset" < 5000 group by 1) on u = user_id""")
def snapshot_transition(v: Views) -> DataFrame:
    before = v.changes.where("`offset` < 5000").groupBy("user_id").agg(F.count("*").alias("events_before"))
    after = v.changes.groupBy("user_id").agg(F.count("*").alias("events_after"))
    both = before.join(after, "user_id", "full_outer")
    return both.select("user_id", "events_before", "events_after", (F.coalesce("events_before", F.lit(0)) != F.col("events_after")).alias("moved"))


@query(f"""select c.event_id, cast(l.n % 7 + 1 as int) as value_schema_id, md5(cast(l.n % 7 + 1 as varchar)) as fingerprint, cast(json_extract_string(c.props, '$.k') as bigint) as k from v_changes c join {_LOG} l on l.n = c."offset" where l.value_error is null and l.topic = 'cdc.users'""")
def trace_column(v: Views) -> DataFrame:
    """A column's way from the raw record over its schema to the ledger row."""
    r = raw(v).where("topic = 'cdc.users' and value_framing_valid").select("event_id", "value_schema_id")
    archive = r.select("value_schema_id").distinct().withColumn("fingerprint", F.md5(F.col("value_schema_id").cast("string")))
    rows = r.join(v.changes.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")), "event_id")
    return rows.join(archive, "value_schema_id").select("event_id", "value_schema_id", "fingerprint", "k")


# --- schemas and contracts ------------------------------------------------------------------------
def field_rows(v: Views) -> DataFrame:
    """Fields observed in the changes: per user and stretch of the log up to five versions, whose paths have a type that some change."""
    c = v.changes
    version = F.expr("cast(`offset` div 4000 % 5 as int)")
    path = F.concat(F.lit("f"), F.expr("cast(value_cents % 5 as string)"))
    return c.groupBy(F.expr("concat('user', cast(user_id as string), '-', cast(`offset` div 20000 as string))").alias("subject"), version.alias("version"), path.alias("path")).agg(F.when(F.max("value_cents") > 30000, "long").otherwise("int").alias("type"), (F.count("*") < 8).alias("nullable"))


_FIELDS = """(select 'user' || user_id || '-' || ("offset" // 20000) as subject, cast("offset" // 4000 % 5 as int) as version, 'f' || (value_cents % 5) as path, case when max(value_cents) > 30000 then 'long' else 'int' end as type, count(*) < 8 as nullable from v_changes group by 1, 2, 3)"""


@query(f"""with f as {_FIELDS}, vs as (select distinct subject, version from f), p as (select a.subject, a.version as o, b.version as n from vs a join vs b on a.subject = b.subject and a.version < b.version),
    a as (select p.*, f.path, f.type as ot, f.nullable as om from p join f on f.subject = p.subject and f.version = p.o), b as (select p.*, f.path, f.type as nt, f.nullable as nn from p join f on f.subject = p.subject and f.version = p.n)
    select * from (select subject, o as old, n as new, path, case when nt is null then 'removed' when ot is null and not nn then 'required_addition' when ot <> nt or om <> nn then 'type_change' end as issue from a full join b using (subject, o, n, path)) where issue is not null""".replace("with f as", "select * from (with f as", 1) + ")")
def schema_issues(v: Views) -> DataFrame:
    return schemas.schema_issues(field_rows(v))


_NESTED = """(select subject, version, path, case path when 'a.x' then 'a' when 'a.y' then 'a' when 'b[]' then 'b' else '' end as parent, type, nullable, null_default, case when version = 2 then 'R2' else 'R' end as record from (
    select 'user' || user_id || '-' || ("offset" // 5000) as subject, cast("offset" // 1000 % 5 as int) as version, case "offset" * 7 % 6 when 0 then 'a' when 1 then 'a.x' when 2 then 'a.y' when 3 then 'b' when 4 then 'b[]' else 'c' end as path, case when max(value_cents) > 40000 then 'long' else 'int' end as type, count(*) < 3 as nullable, count(*) % 2 = 1 as null_default from v_changes group by 1, 2, 3))"""


@query(f"""select * from (with f as {_NESTED}, vs as (select distinct subject, version, record from f), p as (select a.subject, a.version as o, b.version as n, a.record <> b.record as renamed from vs a join vs b on a.subject = b.subject and a.version < b.version),
    a as (select p.subject, p.o, p.n, f.path, f.parent as ap, f.type as ot, f.nullable as om from p join f on f.subject = p.subject and f.version = p.o), b as (select p.subject, p.o, p.n, f.path, f.parent as bp, f.type as nt, f.nullable as nn, f.null_default as nd from p join f on f.subject = p.subject and f.version = p.n),
    x as (select *, coalesce(ap, bp) as parent from a full join b using (subject, o, n, path)), y as (select x.*, case when nt is null then 'removed' when ot is null and not (nn and nd) then 'required_addition' when ot <> nt or om <> nn then 'type_change' end as issue from x)
    select subject, o as old, n as new, path, issue from y where issue is not null and not exists (select 1 from x z where z.subject = y.subject and z.o = y.o and z.n = y.n and z.path = y.parent and (z.ot is null or z.nt is null or z.ot <> z.nt))
    union all select subject, o, n, '$', 'record_rename' from p where renamed)""")
def nested_schema_issues(v: Views) -> DataFrame:
    """Records with fields below fields: identities, defaults, and nothing reported below what is itself reported."""
    path = F.expr("case `offset` * 7 % 6 when 0 then 'a' when 1 then 'a.x' when 2 then 'a.y' when 3 then 'b' when 4 then 'b[]' else 'c' end")
    keys = (F.expr("concat('user', cast(user_id as string), '-', cast(`offset` div 5000 as string))").alias("subject"), F.expr("cast(`offset` div 1000 % 5 as int)").alias("version"), path.alias("path"))
    rows = v.changes.groupBy(*keys).agg(F.when(F.max("value_cents") > 40000, "long").otherwise("int").alias("type"), (F.count("*") < 3).alias("nullable"), (F.count("*") % 2 == 1).alias("null_default"))
    parent = F.when(F.col("path").startswith("a."), "a").when(F.col("path") == "b[]", "b").otherwise("")
    return schemas.schema_issues(rows.withColumn("parent", parent).withColumn("record", F.when(F.col("version") == 2, "R2").otherwise("R")))


_TYPED = """(select subject, version, path, case path when 'a.x' then 'a' when 'a.y' then 'a' when 'b[]' then 'b' else '' end as parent, type, nullable, has_default from (
    select 'user' || user_id || '-' || ("offset" // 5000) as subject, cast("offset" // 1000 % 5 as int) as version, case "offset" * 7 % 6 when 0 then 'a' when 1 then 'a.x' when 2 then 'a.y' when 3 then 'b' when 4 then 'b[]' else 'c' end as path,
    case max(value_cents) // 10000 when 0 then 'int' when 1 then 'int' when 2 then 'long' when 3 then 'float' when 4 then 'double' else 'string' end as type, count(*) > 2 as nullable, count(*) % 2 = 1 as has_default from v_changes group by 1, 2, 3))"""
_WIDER = "((w = 'int' and r in ('long', 'float', 'double')) or (w = 'long' and r in ('float', 'double')) or (w = 'float' and r = 'double'))"


def typed_fields(v: Views) -> DataFrame:
    """Fields below fields, with types of numbers and defaults, read off the changes."""
    path = F.expr("case `offset` * 7 % 6 when 0 then 'a' when 1 then 'a.x' when 2 then 'a.y' when 3 then 'b' when 4 then 'b[]' else 'c' end")
    keys = (F.expr("concat('user', cast(user_id as string), '-', cast(`offset` div 5000 as string))").alias("subject"), F.expr("cast(`offset` div 1000 % 5 as int)").alias("version"), path.alias("path"))
    kind = F.expr("case max(value_cents) div 10000 when 0 then 'int' when 1 then 'int' when 2 then 'long' when 3 then 'float' when 4 then 'double' else 'string' end")
    rows = v.changes.groupBy(*keys).agg(kind.alias("type"), (F.count("*") > 2).alias("nullable"), (F.count("*") % 2 == 1).alias("has_default"))
    return rows.withColumn("parent", F.when(F.col("path").startswith("a."), "a").when(F.col("path") == "b[]", "b").otherwise(""))


@query(f"""select * from (with f as {_TYPED}, vs as (select distinct subject, version from f), p as (select a.subject, a.version as o, b.version as n from vs a join vs b on a.subject = b.subject and a.version < b.version),
    a as (select p.*, f.path, f.parent as ap, f.type as w, f.nullable as wn from p join f on f.subject = p.subject and f.version = p.o), b as (select p.*, f.path, f.parent as bp, f.type as r, f.nullable as rn, f.has_default as rd from p join f on f.subject = p.subject and f.version = p.n),
    x as (select *, coalesce(ap, bp) as parent, case when r is null then 'removed' when w is null then case when not rd then 'no_default' end when not ((w = r and wn = rn) or ({_WIDER} and not wn and not rn)) then 'type_change' end as issue from a full join b using (subject, o, n, path))
    select subject, o as old, n as new, path, issue from x y where issue is not null and not exists (select 1 from x z where z.subject = y.subject and z.o = y.o and z.n = y.n and z.path = y.parent and (z.issue is not null or z.w is null or z.r is null)))""")
def relaxed_schema_issues(v: Views) -> DataFrame:
    return schemas.relaxed_schema_issues(typed_fields(v))


@query(f"""select * from (with f as {_TYPED}, r as (select path, min(parent) as parent, max(type) as r, bool_or(nullable) as rn, bool_and(has_default) as rd from f where version = 0 group by 1), w as (select subject || '/' || version as schema_id, path, parent, type as w, nullable as wn, has_default as wd from f where version <> 0),
    x as (select schema_id, path, coalesce(w.parent, r.parent) as parent, case when w.w is null then case when rd then 'defaulted' else 'dropped' end when r.r is null then case when wn and wd then 'added' else 'added_required' end
    when w.w = r.r and (wn = rn or rn) then 'read' when {_WIDER.replace("(w =", "(w.w =").replace(" r in", " r.r in").replace("and r =", "and r.r =")} and (not wn or rn) then 'promoted' else 'type_change' end as outcome from (select distinct schema_id from w) cross join r full join w using (schema_id, path))
    select schema_id, path, outcome from x y where not exists (select 1 from x z where z.schema_id = y.schema_id and z.path = y.parent and z.outcome not in ('read', 'promoted')))""")
def writer_resolution(v: Views) -> DataFrame:
    """One reader against the schemas of all writers: read, promoted, defaulted, added, or why not."""
    f = typed_fields(v)
    reader = f.where("version = 0").groupBy("path").agg(F.min("parent").alias("parent"), F.max("type").alias("type"), F.bool_or("nullable").alias("nullable"), F.bool_and("has_default").alias("has_default"))
    writers = f.where("version <> 0").select(F.expr("concat(subject, '/', cast(version as string))").alias("schema_id"), "path", "parent", "type", "nullable", "has_default")
    return schemas.resolve_writers(writers, reader)


_CONTRACT = """(select entity, kind, value, era, case when kind = 'column' then min(event_type) end as detail, case when kind = 'column' then bool_or("offset" % 3 = 0) end as nullable from (select *, case kind when 'reset' then case when user_id % 3 = 0 then 'full_reset' else 'none' end else 'v' || (value_cents % 40) end as value from (
    select 'user' || (user_id % 20) || '-' || ("offset" // 1000) as entity, case "offset" % 5 when 0 then 'key' when 1 then 'topic' when 2 then 'fingerprint' when 3 then 'column' else case when value_cents % 4 = 0 then 'reset' else 'partitions' end end as kind, "offset" // 500 % 2 as era, * from v_changes)) group by 1, 2, 3, 4)"""


@query(f"""select * from (with c as {_CONTRACT}, o as (select * from c where era = 0 and kind <> 'reset'), n as (select * from c where era = 1 and kind <> 'reset')
    select entity, kind, value, issue from (select entity, kind, value, kind || '_removed' as issue from o where not exists (select 1 from n where n.entity = o.entity and n.kind = o.kind and n.value = o.value)
    union all select entity, kind, value, kind || '_added' from n where kind <> 'fingerprint' and not (kind = 'column' and nullable) and entity in (select entity from o) and not exists (select 1 from o where n.entity = o.entity and n.kind = o.kind and n.value = o.value)
    union all select o.entity, o.kind, o.value, 'column_changed' from o join n on n.entity = o.entity and n.kind = o.kind and n.value = o.value where o.kind = 'column' and (o.detail <> n.detail or o.nullable <> n.nullable))
    where kind <> 'partitions' or entity not in (select entity from c where era = 1 and kind = 'reset' and value = 'full_reset'))""")
def contract_issues(v: Views) -> DataFrame:
    """Contracts read off the changes, two eras of each entity: keys, topics, fingerprints, columns, partitions and resets."""
    kind = F.expr("case `offset` % 5 when 0 then 'key' when 1 then 'topic' when 2 then 'fingerprint' when 3 then 'column' else case when value_cents % 4 = 0 then 'reset' else 'partitions' end end")
    value = F.when(F.col("kind") != "reset", F.expr("concat('v', cast(value_cents % 40 as string))")).when(F.col("user_id") % 3 == 0, "full_reset").otherwise("none")
    c = v.changes.withColumn("kind", kind).withColumn("value", value).withColumn("era", F.expr("`offset` div 500 % 2"))
    column = lambda x: F.when(F.col("kind") == "column", x)
    rows = c.groupBy(F.expr("concat('user', cast(user_id % 20 as string), '-', cast(`offset` div 1000 as string))").alias("entity"), "kind", "value", "era").agg(F.min("event_type").alias("detail"), F.bool_or(F.col("offset") % 3 == 0).alias("nullable"))
    rows = rows.withColumn("detail", column(F.col("detail"))).withColumn("nullable", column(F.col("nullable")))
    return schemas.contract_issues(rows.where("era = 0").drop("era"), rows.where("era = 1").drop("era"))


@query(f"""with r as (select path, max(type) as want, bool_or(nullable) as optional from {_FIELDS} where version = 0 group by 1), w as (select subject || '/' || version as schema_id, path, type from {_FIELDS} where version <> 0)
    select schema_id, max(bad) = 0 as acceptable, cast(sum(bad) as bigint) as problems from (select i.schema_id, case when w.type is null and not optional then 1 when w.type <> want then 1 else 0 end as bad from (select distinct schema_id from w) i cross join r left join w on w.schema_id = i.schema_id and w.path = r.path) group by 1""".replace("with r as", "select * from (with r as", 1) + ")")
def writer_acceptable(v: Views) -> DataFrame:
    f = field_rows(v)
    reader = f.where("version = 0").groupBy("path").agg(F.max("type").alias("type"), F.bool_or("nullable").alias("nullable"))
    writers = f.where("version <> 0").select(F.expr("concat(subject, '/', cast(version as string))").alias("schema_id"), "path", "type")
    return schemas.writer_acceptable(writers, reader)


@query("select user_id as schema_id from v_changes group by 1 having min(value_cents // 30000) <> max(value_cents // 30000)")
def schema_id_conflicts(v: Views) -> DataFrame:
    return schemas.schema_id_conflicts(v.changes.select(F.col("user_id").alias("schema_id"), F.expr("value_cents div 30000").alias("fingerprint")))


@query("""select 'user' || user_id as name, case when b is null then 'missing' when a <> b then 'row_count' end as issue from (select user_id, count(*) as a from v_changes group by 1) left join (select user_id, count(*) as b from v_changes where "offset" % 50 <> 0 and user_id % 9 <> 0 group by 1) using (user_id) where b is null or a <> b""")
def source_contract_issues(v: Views) -> DataFrame:
    count = lambda df: df.groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name")).agg(F.lit("id,value").alias("header"), F.count("*").alias("n_rows"))
    return schemas.source_contract_issues(count(v.changes.where("`offset` % 50 <> 0 and user_id % 9 <> 0")), count(v.changes))


@query("""select c as column_name, n, nulls, least, greatest, true as distinct_close, case when numeric then true end as median_close from (
    select 'o_orderkey' as c, count(*) as n, count(*) filter (where o_orderkey is null) as nulls, min(cast(o_orderkey as varchar)) as least, max(cast(o_orderkey as varchar)) as greatest, true as numeric from orders
    union all select 'o_custkey', count(*), count(*) filter (where o_custkey is null), min(cast(o_custkey as varchar)), max(cast(o_custkey as varchar)), true from orders
    union all select 'o_orderpriority', count(*), count(*) filter (where o_orderpriority is null), min(o_orderpriority), max(o_orderpriority), false from orders)""")
def merged_profiles(v: Views) -> DataFrame:
    """Profiles of each year's orders, merged, and their estimates held against exact values."""
    o, names = v.table("orders"), ["o_orderkey", "o_custkey", "o_orderpriority"]
    years = storage.save(sketches.profile_sketches(o.withColumn("year", F.year("o_orderdate")), names, ["year"]), "profiles")
    merged = sketches.read_profiles(sketches.merge_profiles(years), [0.5])
    middle = F.get("quantiles", F.lit(0))
    numbers = [c for c in names if c != "o_orderpriority"]
    middles = merged.agg(*(F.max(F.when(F.col("column_name") == c, middle)).alias(f"_{c}") for c in numbers))
    below = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("m"), F.count_if(F.col(c) < F.col(f"_{c}")).alias("less"), F.count_if(F.col(c) <= F.col(f"_{c}")).alias("upto")) for c in numbers]
    ranks = o.crossJoin(F.broadcast(middles)).agg(F.array(*below).alias("x")).select(F.explode("x").alias("x")).select("x.*")  # counts of a scan, so that no task holds the values
    exact = o.agg(F.array(*(F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("d")) for c in names)).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    both = merged.join(exact, "column_name").join(ranks, "column_name", "left")
    close = F.when(middle.isNotNull(), (F.col("upto") >= F.col("m") * 0.46) & (F.col("less") <= F.col("m") * 0.54))
    return both.select("column_name", "n", "nulls", "least", "greatest", (F.abs(F.col("distinct_values") - F.col("d")) <= F.greatest(F.lit(1), F.col("d") * 0.08)).alias("distinct_close"), close.alias("median_close"))


@query("""select f as filter, n, true as few_files from (select 'customer' as f, count(*) as n from orders where o_custkey <= (select max(o_custkey) // 50 from orders) union all select 'day', count(*) from orders where o_orderkey <= (select max(o_orderkey) // 50 from orders))""")
def clustered_scan(v: Views) -> DataFrame:
    """Orders compacted in an order of two keys: a filter on either one opens few of the files."""
    root = f"{storage.shared_dir(v.spark)}/clustered-{uuid.uuid4().hex}"
    o = v.table("orders").select("o_orderkey", "o_custkey")
    o.write.parquet(f"{root}/loose")
    size = sum(clustering.file_sizes(v.spark, f"{root}/loose").values())
    clustering.compact_clustered(v.spark, f"{root}/loose", f"{root}/tight", ["o_custkey", "o_orderkey"], max(1, size // 64))
    table, out = v.spark.read.parquet(f"{root}/tight"), None
    ends = o.agg(F.expr("max(o_custkey) div 50").alias("c"), F.expr("max(o_orderkey) div 50").alias("k")).first()
    for name, where in (("customer", F.col("o_custkey") <= ends["c"]), ("day", F.col("o_orderkey") <= ends["k"])):
        share = clustering.opened_share(table, where)
        row = table.where(where).agg(F.count("*").alias("n")).select(F.lit(name).alias("filter"), "n", F.lit(share <= 0.25).alias("few_files"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as nulls, count(o_orderkey) as n_values, min(cast(o_orderkey as varchar)) as least, max(cast(o_orderkey as varchar)) as greatest, 'integer' as inferred_type, (select string_agg(x, '|' order by x) from (select distinct cast(o_orderkey as varchar) as x from orders order by 1 limit 3)) as samples from orders
    union all select 'o_orderpriority', count(*) filter (where o_orderpriority is null), count(o_orderpriority), min(o_orderpriority), max(o_orderpriority), 'string', (select string_agg(x, '|' order by x) from (select distinct o_orderpriority as x from orders where o_orderpriority is not null order by 1 limit 3)) from orders
    union all select 'o_orderdate', count(*) filter (where o_orderdate is null), count(o_orderdate), min(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')), max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')), 'timestamp', (select string_agg(x, '|' order by x) from (select distinct strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as x from orders where o_orderdate is not null order by 1 limit 3)) from orders""")
def profile_columns(v: Views) -> DataFrame:
    return schemas.profile(v.table("orders"), ["o_orderkey", "o_orderpriority", "o_orderdate"])


# --- text -----------------------------------------------------------------------------------------
@query(r"""select doc_id, md5(regexp_replace(regexp_replace(text, '(password|passwd|secret|token|api_?key)(\s*[:=]\s*)[^\s,;]+', '\1\2***', 'gi'), 'bearer\s+[A-Za-z0-9._-]+', 'bearer ***', 'gi')) as redacted_md5 from documents""")
def redact_text(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.md5(values.redact("text")).alias("redacted_md5"))


@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as ts_text, regexp_full_match(event_type, '[A-Za-z0-9_]+') as valid_name, lower(event_type) || '|' || coalesce(nullif(event_type, 'view'), '<NULL>') as name_text from events""")
def canonical_text(v: Views) -> DataFrame:
    name = F.when(F.col("event_type") != "view", F.col("event_type"))
    return v.table("events").select("event_id", values.canonical_time("ts").alias("ts_text"), values.valid_identifier("event_type").alias("valid_name"), F.concat_ws("|", F.lower("event_type"), values.text(name)).alias("name_text"))

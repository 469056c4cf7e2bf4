"""Raw capture, normalization of change envelopes, idempotent writes and reconciliation."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import coerce, inspect_frame, is_tombstone, record_kind
from tidemark.functions.values import redact, row_digest
from tidemark.operators.versions import current_state, latest_by

OPERATIONS = ("c", "u", "r", "d")
#: Snapshot markers of the change source.
SNAPSHOT = ("true", "first", "first_in_data_collection", "last_in_data_collection", "last")


@dataclass(frozen=True)
class Rule:
    """A business rule: rows where ``holds`` is false are rejected with ``code``; null counts as held."""

    code: str
    holds: str


@dataclass(frozen=True)
class EntitySpec:
    """A captured entity: its topic, typed columns, key columns and rules, in the order they are tried."""

    name: str
    topic: str
    keys: tuple[str, ...]
    columns: str = ""
    rules: tuple[Rule, ...] = ()

    def key_columns(self) -> str:
        """The DDL of the key columns."""
        types = dict(c.strip().split(" ", 1) for c in self.columns.split(","))
        return ", ".join(f"{k} {types[k]}" for k in self.keys)


def stage_changes(envelopes: DataFrame, spec: EntitySpec, columns: Sequence[str] | None = None) -> DataFrame:
    """An entity's ledger rows: normalized by its contract, then judged by its rules; a corrupt row keeps its own code.

    With ``columns``, the rows have these only, and no field of the envelope is read that neither they nor the rules name.
    """
    named = {word for r in spec.rules for word in re.findall(r"\w+", r.holds.lower())}
    needs = None if columns is None else lambda name: name in columns or not named.isdisjoint(re.findall(r"\w+", name.lower()))
    rows = normalize(envelopes, spec.columns, spec.key_columns(), needs=needs).withColumnsRenamed({"apply_status": "_status", "error_code": "_code"})
    rows = apply_rules(rows, spec.rules) if spec.rules else rows.withColumns({"error_code": F.lit(None).cast("string"), "apply_status": F.lit("APPLIED")})
    code = F.coalesce("_code", "error_code")
    out = rows.withColumn("error_code", code).withColumn("apply_status", F.when(code.isNull(), "APPLIED").otherwise("REJECTED"))
    out = out.withColumn("entity", F.lit(spec.name)).drop("_status", "_code")
    return out if columns is None else out.select(*columns)


def stage(ledger: DataFrame, spec: EntitySpec, order: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """An entity's current relation: the newest applied version of each key, without deleted ones.

    With ``columns``, which name all that keys, order and result need, no other column is made and sent.
    """
    rows = applied(ledger.where(F.col("entity") == spec.name))
    rows = rows if columns is None else rows.select(*dict.fromkeys((*spec.keys, *columns, "is_deleted")))
    return current_state(rows, list(spec.keys), order)


def union_ledgers(**ledgers: DataFrame) -> DataFrame:
    """Several entities' ledgers as one, with the entity's name on each row."""
    out = None
    for name, rows in ledgers.items():
        rows = rows.withColumn("entity", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def event_id() -> Column:
    return F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))


def project_raw(log: DataFrame, transactions: str, heartbeats: str, schema_changes: str, batch_id: int = 0, query_id: str = "", ingested_at: Column | None = None) -> DataFrame:
    """Log records with identity, kind, hashes, framing evidence and the lineage of their capture."""
    topic, key, value = F.col("topic"), F.col("key"), F.col("value")
    k, v = inspect_frame(key, "key"), inspect_frame(value, "value")
    return log.select(
        event_id().alias("event_id"), record_kind(topic, key, value, transactions, heartbeats, schema_changes).alias("record_kind"), "topic", "partition", "offset", "timestamp", F.col("timestampType").alias("timestamp_type"), "headers",
        is_tombstone(key, value).alias("is_tombstone"), F.sha2(key, 256).alias("key_sha256"), F.sha2(value, 256).alias("value_sha256"),
        k["schema_id"].alias("key_schema_id"), v["schema_id"].alias("value_schema_id"), k["valid"].alias("key_framing_valid"), v["valid"].alias("value_framing_valid"),
        F.coalesce(k["error"], v["error"]).alias("framing_error"), k["payload"].alias("key_payload"), v["payload"].alias("value_payload"), key.alias("key_bytes"), value.alias("value_bytes"),
        F.lit(batch_id).cast("bigint").alias("ingest_batch_id"), F.lit(query_id).alias("query_id"), (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def split_valid(raw: DataFrame, allowed_ids: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Rows fit for normalization, and the rest with a reason; tombstones belong to neither."""
    rows = raw.where(~F.coalesce(F.col("is_tombstone"), F.lit(False)))
    reason = F.when(~(F.col("key_framing_valid") & F.col("value_framing_valid")), F.col("framing_error")).when(~F.col("key_schema_id").isin(*allowed_ids), F.lit("unknown_writer"))
    rows = rows.withColumn("reason", reason)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def normalize(envelopes: DataFrame, image: str, keys: str | None = None, wire: str | None = None, needs: Callable[[str], bool] | None = None) -> DataFrame:
    """Ledger rows out of envelope JSON: op, flags, source and transaction fields, and the chosen image.

    The image is ``before`` for deletes and ``after`` otherwise; a missing one is corrupt. With ``keys``
    (their DDL), key columns come from the key record in ``key_json``, so a corrupt image has them too.
    before_row_hash, after_row_hash and row_hash (of the chosen image) are SHA-256 of the business
    columns, null where there is no image. ``wire`` is the DDL of the columns as they are sent, where it
    differs from the contract's (unscaled bytes, microseconds, wider numbers); values are then coerced.

    ``needs`` says of a hash, a flag, a field or an image column by its name whether it is wanted; what is
    not is neither made nor read, which saves a good part of the time. op, is_deleted, apply_status and
    error_code are always there, and same as with everything read. A hash needs the whole image.

    The envelope is read once a row: it comes out of a generator, below which no filter is pushed that
    would read it again for each field it names.
    """
    wanted = needs or (lambda name: True)
    types = lambda ddl: {f.name: f.dataType.simpleString() for f in envelopes.select(F.from_json(F.lit("{}"), ddl).alias("i")).schema["i"].dataType}
    want, sent = types(image), types(wire or image)
    hashed = [h for h in ("before_row_hash", "after_row_hash", "row_hash") if wanted(h)]
    own = [k for k in types(keys) if wanted(k)] if keys else []
    fields = [c for c in want if hashed or (wanted(c) and c not in own)] or list(want)[:1]  # an image of no column could not be told from a missing one
    part = wire or image if fields == list(want) else ", ".join(f"`{c}` {sent[c]}" for c in fields)
    source = [ddl for ddl, name in (("ts_ms bigint", "source_ts"), ("snapshot string", "is_snapshot")) if wanted(name)]
    schema = ["op string", f"before struct<{part}>", f"after struct<{part}>", *([f"source struct<{', '.join(source)}>"] if source else []), *(["transaction struct<id string>"] if wanted("transaction_id") else [])]
    rows = envelopes.select("*", F.inline(F.array(F.from_json("envelope", ", ".join(schema)))).alias(*(f"_{ddl.split(' ')[0]}" for ddl in schema)))
    if wire:
        for side in ("_before", "_after"):
            x = F.col(side)
            rows = rows.withColumn(side, F.when(x.isNotNull(), F.struct(*(coerce(x[c], sent[c], want[c]).alias(c) for c in fields))))
    deleted = F.col("_op") == "d"
    payload = F.when(deleted, F.col("_before")).otherwise(F.col("_after"))
    strange = ~F.coalesce(F.col("_op").isin(*OPERATIONS), F.lit(False))
    status = F.when(strange | payload.isNull(), "REJECTED").otherwise("APPLIED")
    code = F.when(strange, "invalid_op").when(payload.isNull(), "missing_image")
    digest = lambda x: F.when(x.isNotNull(), row_digest(*(x[f] for f in fields)))
    image_of = {"before_row_hash": F.col("_before"), "after_row_hash": F.col("_after"), "row_hash": payload}
    made = [digest(image_of[h]).alias(h) for h in hashed] + [F.col("_op").alias("op"), F.coalesce(deleted, F.lit(False)).alias("is_deleted")]
    if wanted("is_snapshot"):
        made.append(F.coalesce(F.col("_source.snapshot").isin(*SNAPSHOT), F.lit(False)).alias("is_snapshot"))
    if wanted("source_ts"):
        made.append(F.coalesce(F.timestamp_millis("_source.ts_ms").cast("timestamp_ntz"), F.col("log_time")).alias("source_ts"))
    if wanted("transaction_id"):
        made.append(F.col("_transaction.id").alias("transaction_id"))
    columns = [c for c in fields if wanted(c) and c not in own]
    if own:
        rows, k = rows.withColumn("_k", F.from_json("key_json", keys)), F.col("_k")
    image_row = F.struct(*(k[f].alias(f) for f in own), *(payload[f].alias(f) for f in columns)) if own else payload
    names = [*own, *columns]
    out = rows.select(*[c for c in envelopes.columns if c not in ("envelope", "key_json")], *made, status.alias("apply_status"), code.alias("error_code"), image_row.alias("_p"))
    return out.select("*", *(F.col(f"_p.`{c}`").alias(c) for c in names)).drop("_p")


def apply_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """apply_status, error_code, error_ordinal and error_message; of the rules that fail, the first counts."""
    found = [F.when(~F.expr(r.holds), F.struct(F.lit(i).alias("ordinal"), F.lit(r.code).alias("code"), redact(F.lit(f"{r.code}: {r.holds}")).alias("message"))) for i, r in enumerate(rules, 1)]
    first, failed = F.coalesce(*found), sum((F.when(x.isNotNull(), 1).otherwise(0) for x in found), F.lit(0))
    out = rows.withColumn("error_code", first["code"]).withColumn("error_ordinal", first["ordinal"]).withColumn("error_message", first["message"])
    return out.withColumn("apply_status", F.when(first.isNull(), "APPLIED").otherwise("REJECTED")).withColumn("failed_rules", failed)


def quarantine(rows: DataFrame) -> DataFrame:
    """Rejected rows by event and code, with an id of both, first and last time and number of sightings."""
    seen = rows.where("lower(apply_status) = 'rejected'").groupBy("event_id", "error_code").agg(F.min("source_ts").alias("first_seen"), F.max("source_ts").alias("last_seen"), F.count("*").alias("occurrences"))
    return seen.withColumn("error_id", F.sha2(F.concat_ws("|", "event_id", "error_code"), 256))


def applied(rows: DataFrame) -> DataFrame:
    return rows.where("lower(apply_status) = 'applied'")


def dedupe_exact(rows: DataFrame, key: str, payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One row per id; and the ids whose copies differ, which must not pass."""
    digest = F.sha2(F.to_json(F.struct(*payload)), 256)
    marked = rows.withColumn("_d", digest)
    seen = marked.groupBy(key).agg((F.min("_d") != F.max("_d")).alias("conflict"), F.min_by(F.struct(*rows.columns), "_d").alias("_row"))
    return seen.where("not conflict").select("_row.*"), seen.where("conflict").select(key)


def identity_collisions(incoming: DataFrame, existing: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Incoming ids that the target has with another value in any attribute; nulls equal nulls."""
    differ = F.lit(False)
    for a in attributes:
        differ = differ | ~F.col(f"i.{a}").eqNullSafe(F.col(f"e.{a}"))
    return incoming.alias("i").join(existing.alias("e"), F.col(f"i.{key}") == F.col(f"e.{key}")).where(differ).select(F.col(f"i.{key}").alias(key)).distinct()


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose keys the target lacks. Rows with a null key count as new."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the source's rows in place of those with their keys."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(new_rows(source, target, keys))


def number_rows(df: DataFrame, identity: str, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """A stable row number for keyless rows of one source, from their values; equal rows count on."""
    from pyspark.sql import Window

    return df.withColumn(name, F.row_number().over(Window.partitionBy(identity).orderBy(*order)))


def backfill_parent(child: DataFrame, parent: DataFrame, key: str, **identity: Column) -> DataFrame:
    """The parent table with a row for each key that only the child has."""
    missing = child.select(key).where(F.col(key).isNotNull()).distinct().join(parent.select(key), key, "left_anti")
    return parent.unionByName(missing.select(key, *(c.alias(n) for n, c in identity.items())), allowMissingColumns=True)


def extra_columns(incoming: DataFrame, known: Sequence[str]) -> list[str]:
    """Columns beyond a contract's, in order of their names; one that is no plain identifier is an error."""
    extra = sorted(set(incoming.columns) - set(known))
    bad = [c for c in extra if not re.fullmatch("[A-Za-z0-9_]+", c)]
    if bad:
        raise ValueError(f"not identifiers: {bad}")
    return extra


def align_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both tables with the columns of either; what a row never had is null."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def progress_rows(batch: DataFrame) -> DataFrame:
    """Per topic and partition the last offset, its event and source time, and the number of events."""
    last = F.max_by(F.struct("event_id", "source_ts"), F.col("offset"))
    return batch.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"), last.alias("_l"), F.count("*").alias("events")).select("topic", "partition", "last_offset", F.col("_l.event_id").alias("last_event_id"), F.col("_l.source_ts").alias("last_source_ts"), "events")


def latest_progress(progress: DataFrame, required: DataFrame, entity: str = "entity") -> DataFrame:
    """The newest progress of every required entity; ``found`` is false where there is none."""
    newest = latest_by(progress, [entity], F.struct("recorded_at", "last_offset"))
    return required.join(newest, entity, "left").withColumn("found", F.col("recorded_at").isNotNull())


def entity_metrics(changes: DataFrame) -> DataFrame:
    """Per entity the greatest offset of each topic and partition, as a map, and the number of events."""
    per = changes.groupBy("entity", "topic", "partition").agg(F.max("offset").alias("last"), F.count("*").alias("n"))
    place = F.concat_ws(":", "topic", F.col("partition").cast("string"))
    return per.groupBy("entity").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(place, "last")))).alias("offsets"), F.sum("n").alias("events"))


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str], hash_col: str = "row_hash") -> DataFrame:
    """Keys that only one side has, or whose hashes differ, with the kind of difference."""
    a = left.select(*keys, F.col(hash_col).alias("_a"), F.lit(True).alias("_in_a"))
    b = right.select(*keys, F.col(hash_col).alias("_b"), F.lit(True).alias("_in_b"))
    kind = F.when(F.col("_in_a").isNull(), "missing_left").when(F.col("_in_b").isNull(), "missing_right").when(~F.col("_a").eqNullSafe(F.col("_b")), "hash_diff")
    return a.join(b, list(keys), "full_outer").withColumn("difference", kind).where("difference is not null").select(*keys, "difference")


def _sorted_digest(line: str) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256)


def event_checksum(df: DataFrame, group: Sequence[str], line: Column, digits: int = 2) -> DataFrame:
    """Order-insensitive SHA-256 of a group's lines, by leaves, so that many tasks share a large group.

    A leaf is the lines whose own SHA-256 begins with the same ``digits`` hexadecimal digits; its digest
    is that of its sorted lines, joined by line feeds, and the group's that of its leaves' digests in
    order. With more digits leaves get smaller: 16 ** digits of them a group. Null lines count but are not
    digested.
    """
    rows = df.select(*group, line.alias("_line")).withColumn("_leaf", F.substring(F.sha2("_line", 256), 1, digits))
    leaves = rows.groupBy(*group, "_leaf").agg(_sorted_digest("_line").alias("_d"), F.count("*").alias("_n"))
    found = F.array_sort(F.collect_list(F.when(F.col("_leaf").isNotNull(), F.struct("_leaf", "_d"))))
    return leaves.groupBy(*group).agg(F.sha2(F.array_join(F.transform(found, lambda x: x["_d"]), "\n"), 256).alias("checksum"), F.sum("_n").alias("lines"))


def entity_results(expected: DataFrame, rows: DataFrame, keys: Sequence[str], line: Column, order: Column, span: int = 10_000) -> DataFrame:
    """Per entity of a run: events expected and materialized, affected keys, visible keys, checksum and status.

    ``expected`` is (entity, expected_events); ``rows`` are the materialized changes with entity,
    partition, offset and is_deleted. Lines are digested in spans of offsets, in sorted order, and the
    entity's checksum is of those digests by partition and span, so no task holds an entity's lines.
    Counts that differ, and entities that only one side has, are FAILED.
    """
    per = rows.groupBy("entity", *keys).agg(F.count("*").alias("_n"), F.max_by("is_deleted", order).alias("_gone"))
    have = per.groupBy("entity").agg(F.sum("_n").alias("materialized_events"), F.count("*").alias("affected_keys"), F.count_if(~F.col("_gone")).alias("current_rows"))
    lines = rows.select("entity", "partition", F.floor(F.col("offset") / span).alias("_span"), line.alias("_line"))
    parts = lines.groupBy("entity", "partition", "_span").agg(_sorted_digest("_line").alias("checksum"))  # a span has as many lines as offsets
    sums = parts.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("partition", "_span", "checksum"))).alias("_s"))
    sums = sums.select("entity", F.sha2(F.array_join(F.transform("_s", lambda x: x["checksum"]), "\n"), 256).alias("checksum"))
    both = expected.select("entity", F.col("expected_events").alias("_e")).join(have, "entity", "full_outer").join(sums, "entity", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    same = count("_e") == count("materialized_events")
    return both.select(
        "entity", F.when(same, "VALIDATED").otherwise("FAILED").alias("status"), count("_e").alias("expected_events"), count("materialized_events").alias("materialized_events"), count("affected_keys").alias("affected_keys"),
        count("current_rows").alias("current_rows"), "checksum", F.when(~same, "count_mismatch").alias("error_code"),
    )


def with_exists(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """A boolean column: whether the other table has the row's key."""
    return df.join(other.select(key).distinct().withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def stream_lag(ends: DataFrame, progress: DataFrame) -> DataFrame:
    """How far each topic and partition's progress is behind its end; never below 0."""
    position = F.coalesce(F.col("last_offset") + 1, F.lit(0))
    return ends.join(progress.select("topic", "partition", "last_offset"), ["topic", "partition"], "left").select("topic", "partition", "end_offset", F.greatest(F.col("end_offset") - position, F.lit(0)).alias("lag"))


def slo_rollup(lag: DataFrame, status: DataFrame, now: Column, stale_seconds: int = 120, lag_limit: int = 10_000) -> DataFrame:
    """Total lag, least readiness, greatest staleness and the alerts they raise, in one row."""
    a = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("updated_at"))
    b = status.agg(F.min(F.col("ready").cast("int")).alias("min_ready"), F.max(age).alias("max_staleness"), F.count_if(age > stale_seconds).alias("stale_queries"))
    return a.crossJoin(b).withColumn("lag_alert", F.col("total_lag") > lag_limit).withColumn("stale_alert", F.col("max_staleness") > stale_seconds)


def offset_problems(offsets: DataFrame, required: DataFrame, prefix: str) -> DataFrame:
    """(topic, partition, problem): needed partitions without an offset, and offsets of topics without the capture's prefix."""
    missing = required.select("topic", "partition").distinct().join(offsets.select("topic", "partition"), ["topic", "partition"], "left_anti").withColumn("problem", F.lit("missing"))
    strange = offsets.where(~F.col("topic").startswith(prefix)).select("topic", "partition").distinct().withColumn("problem", F.lit("topic_prefix"))
    return missing.unionByName(strange)

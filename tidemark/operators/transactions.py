"""Transaction observations, effective states, and the boundary that splits no transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The order of states, used to break ties between observations.
RANK = {"OPEN": 1, "REJECTED": 2, "COMPLETE": 3}


def _rank():
    out = F.lit(0)
    for state, n in RANK.items():
        out = F.when(F.col("status") == state, n).otherwise(out)
    return out


def assemble_transactions(markers: DataFrame) -> DataFrame:
    """One observation per transaction out of BEGIN and END markers; END alone completes it.

    ``markers`` has transaction_id, status (BEGIN or END), offset, event_count and collections.
    """
    begin, end = F.col("status") == "BEGIN", F.col("status") == "END"
    collections = [F.max_by("collections", F.when(end, F.col("offset"))).alias("collections")] if "collections" in markers.columns else []
    return markers.groupBy("transaction_id").agg(
        F.when(F.max(end), "COMPLETE").otherwise("OPEN").alias("status"), F.min(F.when(begin, F.col("offset"))).alias("begin_offset"), F.max(F.when(end, F.col("offset"))).alias("end_offset"),
        F.max_by("event_count", F.when(end, F.col("offset"))).alias("event_count"), F.count("*").alias("markers"), *collections,
    )


def effective_transactions(observations: DataFrame) -> DataFrame:
    """One observation per transaction: the greatest (offset, recorded_at, has end, rank, event id).

    Observations without an id are kept one by one and flagged, for a boundary must not pass them.
    """
    order = F.struct(F.coalesce("offset", F.lit(-1)), "recorded_at", F.col("end_offset").isNotNull(), _rank(), F.col("event_id"))
    rest = [c for c in observations.columns if c != "transaction_id"]
    named = observations.where("transaction_id is not null").groupBy("transaction_id").agg(F.max_by(F.struct(*rest), order).alias("_r")).select("transaction_id", "_r.*")
    lost = observations.where("transaction_id is null").select("transaction_id", *rest)
    return named.withColumn("missing_id", F.lit(False)).unionByName(lost.withColumn("missing_id", F.lit(True)))


def select_boundary(effective: DataFrame, previous: int) -> DataFrame:
    """One row: status, reason, the newest complete prefix's end and what it holds.

    Transactions up to the previous boundary are passed over. The first OPEN one ends the prefix. Before
    it, a REJECTED or unknown one, or a COMPLETE one without id or offset, blocks, whatever stands before
    that one. A COMPLETE one without events (a heartbeat) is passed over: it moves no boundary. The first
    blocker is a minimum and the prefix a filter, so nothing is sorted globally.
    """
    rows = effective.where(F.col("offset").isNull() | (F.col("offset") > previous))
    nameless = F.col("missing_id") | (F.trim(F.coalesce("transaction_id", F.lit(""))) == "")
    done, open_ = (F.coalesce(F.col("status") == s, F.lit(False)) for s in ("COMPLETE", "OPEN"))
    reason = F.when(F.col("status") == "REJECTED", "rejected_transaction").when(~done & ~open_, "unknown_state").when(done & nameless, "missing_transaction_id").when(done & F.col("offset").isNull(), "missing_offset")
    at = F.struct(F.coalesce("offset", F.lit(-1)).alias("at"), F.coalesce("event_id", F.lit("")).alias("event_id"), reason.alias("reason"))
    stop = rows.agg(F.min(F.when(open_, at)).alias("open"), F.min(F.when(reason.isNotNull(), at)).alias("broken"))
    blocks = F.col("broken").isNotNull() & (F.col("open").isNull() | (F.col("broken") < F.col("open")))
    stop = stop.select("open", F.when(blocks, F.col("broken.reason")).alias("blocked"))
    inside = F.col("open").isNull() | (at < F.col("open"))
    prefix = rows.where(done & ~nameless & F.col("offset").isNotNull() & (F.coalesce("event_count", F.lit(0)) > 0)).crossJoin(F.broadcast(stop)).where(inside & F.col("blocked").isNull())
    taken = prefix.agg(F.max("offset").alias("target_offset"), F.max_by("transaction_id", F.col("offset")).alias("target_transaction"), F.count("*").alias("transactions"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("expected_events"))
    some = F.col("transactions") > 0
    status = F.when(F.col("blocked").isNotNull(), "BLOCKED").when(some, "MATERIALIZING").when(F.col("open").isNotNull(), "WAITING").otherwise("NOOP")
    reason = F.coalesce(F.col("blocked"), F.when(some, "complete_prefix"), F.when(F.col("open").isNotNull(), "open_transaction"), F.lit("nothing_new"))
    return taken.crossJoin(F.broadcast(stop)).select(status.alias("status"), reason.alias("reason"), "target_offset", "target_transaction", "transactions", "expected_events")


def initial_boundary(changes: DataFrame, required: DataFrame) -> DataFrame:
    """The boundary of a first snapshot, which has no transactions: all entities must have offsets."""
    held = changes.where("is_snapshot").groupBy("entity").agg(F.max("offset").alias("offset"), F.count("*").alias("n"))
    both = required.join(held, "entity", "left")
    return both.agg(F.count_if(F.col("offset").isNull()).alias("missing_entities"), F.max("offset").alias("target_offset"), F.coalesce(F.sum("n"), F.lit(0)).alias("expected_events")).select(
        F.when(F.col("missing_entities") == 0, "MATERIALIZING").otherwise("WAITING").alias("status"), "missing_entities", F.when(F.col("missing_entities") == 0, F.col("target_offset")).alias("target_offset"), "expected_events",
    )


def within_offsets(changes: DataFrame, ends: DataFrame) -> DataFrame:
    """Changes at or below the frozen end of their topic and partition (one row per partition)."""
    return changes.join(ends.select("topic", "partition", F.col("end_offset").alias("_end")), ["topic", "partition"]).where("offset <= _end").drop("_end")


def within_transactions(changes: DataFrame, effective: DataFrame, boundary: DataFrame) -> DataFrame:
    """Changes without a transaction, and those of transactions complete at or below the boundary (one row with target_offset)."""
    done = effective.where("status = 'COMPLETE' and not missing_id").crossJoin(F.broadcast(boundary.select("target_offset"))).where(F.col("offset") <= F.col("target_offset")).select("transaction_id")
    loose = changes.where("transaction_id is null")
    return changes.join(done, "transaction_id", "left_semi").select(*changes.columns).unionByName(loose)


def transaction_counts(changes: DataFrame) -> DataFrame:
    """Events of each transaction per entity as a map, and in all."""
    per = changes.where("transaction_id is not null").groupBy("transaction_id", "entity").agg(F.count("*").alias("n"))
    return per.groupBy("transaction_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("entity", "n")))).alias("counts"), F.sum("n").alias("events"))


def fill_event_counts(effective: DataFrame, counts: DataFrame) -> DataFrame:
    """Missing event counts of transactions, from what the ledger holds of them."""
    held = counts.select("transaction_id", F.col("events").alias("_held"))
    return effective.join(held, "transaction_id", "left").withColumn("event_count", F.coalesce("event_count", "_held")).drop("_held").select(*effective.columns)


def audit_gap(changes: DataFrame, effective: DataFrame) -> DataFrame:
    """Transactions of the ledger that are not complete; an anti join, so null ids cannot hide any."""
    done = effective.where("status = 'COMPLETE'").select("transaction_id")
    return changes.where("transaction_id is not null").select("transaction_id").distinct().join(done, "transaction_id", "left_anti")

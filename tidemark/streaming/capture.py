"""Micro-batch capture: raw log to ledger, idempotent by event id, state kept in tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.ledger import progress_rows
from tidemark.sources.ledger_files import LedgerFiles
from tidemark.sources.storage import append_new, drop_saved, parse_offsets

#: Error classes of a batch.
TRANSIENT, RECORD, FATAL = "transient", "record", "fatal"


def checkpoint_for(root: str, query: str, contract_version: str) -> str:
    """A checkpoint folder that no other query or contract version uses."""
    if not query or "/" in query or not contract_version or "/" in contract_version:
        raise ValueError("a query and a contract version are names without slashes")
    return f"{root.rstrip('/')}/{query}/{contract_version}"


def start(stream: DataFrame, name: str, checkpoint: str, write: Callable[[DataFrame, int], None], seconds: int | None = None, contract: str | None = None) -> StreamingQuery:
    """A named query that hands batches to ``write``: every ``seconds``, or all there is and then an end.

    With ``contract``, its fingerprint, a checkpoint that another contract has marked is refused.
    """
    if contract is not None:
        claim_checkpoint(stream.sparkSession, checkpoint, contract)
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def claim_checkpoint(spark: SparkSession, path: str, contract: str) -> None:
    """Mark a checkpoint with its contract's fingerprint, or refuse one that another contract has marked."""
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.contract")
    store = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(file):
        found = spark.read.text(str(file)).first()
        if not found or found[0] != contract:
            raise ValueError(f"{path} belongs to contract {found[0] if found else None}, not {contract}")
        return
    out = store.create(file, False)
    out.writeBytes(contract)
    out.close()


def ledger_writer(target: str, progress: str, project: Callable[[DataFrame], DataFrame], keys: Sequence[str] = ("event_id",), payload: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Appends a batch's new events to the ledger, and its progress with the batch's number.

    A batch that is tried again finds its events in place and appends nothing. One in which copies of an
    event differ, from each other or from the ledger's, fails, and nothing of it is written. Of the ledger
    only files are read that may hold the batch's ids; the batch is computed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = project(batch)
        table = LedgerFiles(rows.sparkSession, target, keys, payload)
        ends = table.append(rows, progress_rows)
        append_new(ends.withColumn("batch_id", F.lit(batch_id).cast("bigint")), progress, ("topic", "partition", "batch_id"), within="batch_id")
        drop_saved(ends)

    return write


def classify_error(code: str) -> str:
    """Whether a failure may pass by itself, concerns a record, or must stop the query."""
    if code in ("timeout", "connection", "commit_conflict"):
        return TRANSIENT
    return RECORD if code.startswith(("key_", "value_", "invalid_", "missing_", "rule_")) else FATAL


class ProgressListener(StreamingQueryListener):
    """Collects one small row per batch or end: name, id, state, batch, rows, end offsets JSON, error, and the rows and bytes that the query keeps as state.

    ``take`` hands the rows over and forgets them, so a caller that appends them to a table now and then
    keeps the driver's list short.
    """

    SCHEMA = "name string, query_id string, state string, batch_id bigint, n_rows bigint, end_offsets string, error string, state_rows bigint, state_bytes bigint"

    def __init__(self):
        self.rows: list[tuple] = []
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.names[str(p.id)] = p.name or ""
        self.rows.append((p.name or "", str(p.id), "RUNNING", p.batchId, p.numInputRows, p.sources[0].endOffset if p.sources else "{}", None, sum(s.numRowsTotal for s in p.stateOperators), sum(s.memoryUsedBytes for s in p.stateOperators)))

    def onQueryTerminated(self, event) -> None:
        name = self.names.pop(str(event.id), "")
        self.rows.append((name, str(event.id), "FAILED" if event.exception else "TERMINATED", None, None, "{}", event.exception, None, None))

    def take(self, spark) -> DataFrame:
        rows, self.rows = self.rows, []
        return spark.createDataFrame(rows, self.SCHEMA)

    def offsets(self, spark) -> DataFrame:
        rows = spark.createDataFrame(self.rows, self.SCHEMA).where("state = 'RUNNING'").select("name", "batch_id", "n_rows", "end_offsets")
        return parse_offsets(rows, "end_offsets")


def stream_health(status: DataFrame, lag: DataFrame, now, stale_seconds: int = 120) -> DataFrame:
    """Readiness, staleness and lag of all queries in one row."""
    age = F.unix_timestamp(now) - F.unix_timestamp("updated_at")
    a = status.agg(F.count_if(F.col("state") != "RUNNING").alias("not_running"), F.count_if(age > stale_seconds).alias("stale"), F.count_if(F.col("error_code").isNotNull()).alias("failed"))
    b = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))
    return a.crossJoin(b).withColumn("ready", (F.col("not_running") == 0) & (F.col("stale") == 0) & (F.col("failed") == 0))


def caught_up(lag: DataFrame, gap: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One boolean row: nothing is behind and no transaction is missing.

    ``before`` is the row of an earlier look; with it, ``confirmed`` tells whether both were caught up.
    """
    a = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))
    b = gap.agg(F.count("*").alias("missing_transactions"))
    out = a.crossJoin(b).withColumn("caught_up", (F.col("total_lag") == 0) & (F.col("missing_transactions") == 0))
    return out if before is None else out.crossJoin(before.select(F.col("caught_up").alias("_before"))).withColumn("confirmed", F.col("caught_up") & F.col("_before")).drop("_before")

"""Batches that become visible as one: a table for each target, and one commit row for all of them.

A batch writes the rows of every target into a folder of its own. Only when all are there, one small
file is put in place that names the batch, the contract's version, each target's files, rows and
fingerprint, and how far the log was read. Readers take the files that commit files name and no others,
so a crash between two targets leaves nothing to be seen, and the batch, tried again, writes new folders.
A batch that has its commit is not written twice. Failures leave a row too, with the error's class.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.ledger_files import FILE_ROWS, LedgerFiles
from tidemark.sources.storage import exists, list_files, write_once
from tidemark.streaming.capture import classify_error

COMMIT = (
    "batch_id bigint, contract_version string, status string, error_class string, error string, committed_at timestamp, "
    "targets array<struct<name: string, n: bigint, fingerprint: string, files: array<string>>>, offsets array<struct<topic: string, partition: bigint, last_offset: bigint, last_event_id: string, events: bigint>>"
)


class CommittedTables:
    """Target tables under ``root``, each keyed by ``keys``, visible by their commits."""

    def __init__(self, spark: SparkSession, root: str, contract_version: str, keys: Sequence[str] = ("event_id",)):
        self.spark, self.root, self.version, self.keys = spark, root.rstrip("/"), contract_version, list(keys)

    def _rows(self, kind: str) -> DataFrame:
        where = f"{self.root}/{kind}"
        return self.spark.read.schema(COMMIT).json(where) if exists(self.spark, where) else self.spark.createDataFrame([], COMMIT)

    def commits(self) -> DataFrame:
        """One row per committed batch."""
        return self._rows("commits")

    def failures(self) -> DataFrame:
        """One row per failed try of a batch."""
        return self._rows("failures")

    def progress(self) -> DataFrame:
        """Per batch and target the table's version, and per topic and partition how far the batch has come."""
        rows = self.commits().select("batch_id", "contract_version", "status", "error_class", "committed_at", F.explode_outer("targets").alias("t"), "offsets")
        return rows.select("batch_id", "contract_version", "status", "error_class", "committed_at", F.col("t.name").alias("target"), F.col("t.n").alias("n_rows"), F.col("t.fingerprint").alias("table_version"), F.explode_outer("offsets").alias("o")).select("*", "o.*").drop("o")

    def files(self, target: str) -> list[str]:
        named = self.commits().select(F.explode("targets").alias("t")).where(F.col("t.name") == target).select(F.explode("t.files").alias("file"))
        return sorted(r["file"] for r in named.collect())

    def table(self, target: str) -> LedgerFiles:
        return LedgerFiles(self.spark, f"{self.root}/{target}", self.keys, files=lambda: self.files(target))

    def read(self, target: str, schema: T.StructType | str) -> DataFrame:
        """The target's committed rows."""
        files = self.files(target)
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def write(self, batch_id: int, targets: Mapping[str, DataFrame], offsets: DataFrame | None = None) -> bool:
        """Write all targets' new rows, then the commit; false if the batch has been committed before."""
        name = f"{self.root}/commits/{batch_id:012d}.json"
        if exists(self.spark, name):
            return False
        done = []
        try:
            for target, rows in targets.items():
                table = self.table(target)
                table.add_to_index()
                folder = f"{self.root}/{target}/{batch_id:012d}-{uuid.uuid4().hex}"
                table.new_rows(rows).write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
                table.release()
                done.append({"name": target, **self._fingerprint(folder, rows.schema), "files": list_files(self.spark, folder)})
            ends = [] if offsets is None else [r.asDict() for r in offsets.select("topic", F.col("partition").cast("bigint").alias("partition"), "last_offset", "last_event_id", "events").collect()]
        except Exception as error:
            self._put(f"{self.root}/failures/{batch_id:012d}-{uuid.uuid4().hex}.json", batch_id, "FAILED", error_class=classify_error(_code(error)), error=str(error)[:500], targets=[], offsets=[])
            raise
        return self._put(name, batch_id, "COMMITTED", error_class=None, error=None, targets=done, offsets=ends)

    def _fingerprint(self, folder: str, schema: T.StructType) -> dict:
        """Rows of a folder and a digest of them that does not depend on their order."""
        found = self.spark.read.schema(schema).parquet(folder).select(F.xxhash64(F.to_json(F.struct("*"))).alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
        return {"n": found["n"], "fingerprint": f"{found['n']}:{found['s'] or 0}"}

    def _put(self, path: str, batch_id: int, status: str, **rest) -> bool:
        at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        return write_once(self.spark, path, json.dumps({"batch_id": batch_id, "contract_version": self.version, "status": status, "committed_at": at, **rest}))


def _code(error: Exception) -> str:
    """The class of failure that an exception stands for."""
    if isinstance(error, (TimeoutError, ConnectionError)):
        return "timeout"
    return "fatal" if not isinstance(error, ValueError) else "invalid_record" if "differ" not in str(error) else "identity_collision"


def fan_out(tables: CommittedTables, normalizers: Mapping[str, Callable[[DataFrame], DataFrame | dict[str, DataFrame]]]) -> Callable[[DataFrame, int], None]:
    """One scan of a batch for all topics; every topic's rows go through its normalizer to tables of their own.

    A normalizer gives a table's rows, named like its topic, or several tables by name: changes, schema
    rows and transaction observations are targets alike. A topic that nobody handles fails the batch, and
    so do differing copies of one id, within the batch or against a table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            lost = batch.where(~F.coalesce(F.col("topic").isin(*normalizers), F.lit(False))).groupBy("topic").count().orderBy("topic").limit(5).collect()
            if lost:
                raise ValueError(f"nothing handles the records of {[(r['topic'], r['count']) for r in lost]}")
            targets: dict[str, DataFrame] = {}
            for topic, normalize in normalizers.items():
                made = normalize(batch.where(F.col("topic") == topic))
                targets |= made if isinstance(made, dict) else {topic: made}
            if not {"partition", "offset"} <= set(batch.columns):
                tables.write(batch_id, targets)
                return
            event, at = (F.col(c) if c in batch.columns else F.lit(None) for c in ("event_id", "source_ts"))
            last = batch.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"), F.max_by(event.cast("string"), F.col("offset")).alias("last_event_id"), F.max(at.cast("timestamp")).alias("last_source_ts"), F.count("*").alias("events"))
            tables.write(batch_id, targets, last)
        finally:
            batch.unpersist()

    return write

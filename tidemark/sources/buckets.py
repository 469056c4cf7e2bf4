"""Tables kept by hash buckets of their keys, of which a batch reads and rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import latest_by
from tidemark.sources.storage import drop_saved, exists, save


class BucketedTable:
    """A folder per bucket of ``keys``; a bucket is replaced as a whole.

    A batch's cost follows the buckets of its keys and not the table. There should be as many buckets as
    the table will have parts that one task can rewrite, for a bucket is rewritten by one. Spark writes the new buckets beside
    the old ones and moves them into place; what a crash leaves between old and new buckets, the same
    batch mends when it is tried again, since applying it twice changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType | str, buckets: int = 256):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = spark.createDataFrame([], schema).schema

    def place(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        return sorted(r["b"] for r in rows.select(self.place().alias("b")).distinct().collect())

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or the rows of some buckets; others' files are not opened."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])).parquet(self.path)
        return (rows if buckets is None else rows.where(F.col("_bucket").isin(*buckets))).select(*self.schema.names)

    def replace(self, rows: DataFrame, buckets: Sequence[int]) -> None:
        """Put ``rows``, all of these buckets, in place of what they hold; a bucket without rows is emptied."""
        staged = save(rows.select(*self.schema.names).withColumn("_bucket", self.place()), "buckets")
        staged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)
        held = {r["_bucket"] for r in staged.select("_bucket").distinct().collect()}
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for b in set(buckets) - held:
            store.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_bucket={b}"), True)
        drop_saved(staged)


def apply_current(table: BucketedTable, batch: DataFrame, order: Column) -> None:
    """The newest version of every key, deleted ones too, so that rows that come late lose."""
    buckets = table.touched(batch)
    if buckets:
        table.replace(latest_by(table.read(buckets).unionByName(batch.select(*table.schema.names)), table.keys, order), buckets)


def apply_intervals(events: BucketedTable, intervals: BucketedTable, batch: DataFrame, build: Callable[[DataFrame], DataFrame]) -> None:
    """Validity intervals after a batch whose events may come in any order.

    ``events`` keeps every event once, also those that collapse today, for a late one may part them.
    ``build`` makes the intervals of some keys' events. A late event splits, extends or merges the
    intervals of its key; keys that the batch does not have keep theirs, and their events are not sorted
    again. Buckets without such keys are not read.
    """
    buckets = events.touched(batch)
    if not buckets:
        return
    names = events.schema.names
    keys = batch.select(*events.keys).distinct()
    held = events.read(buckets)
    whole = save(held.unionByName(batch.select(*names)).dropDuplicates(names), "events")
    fresh = build(whole.join(keys, events.keys, "left_semi")).select(*intervals.schema.names)
    rest = intervals.read(buckets).join(keys, intervals.keys, "left_anti")
    made = save(rest.unionByName(fresh), "intervals")
    events.replace(whole, buckets)
    intervals.replace(made, buckets)
    drop_saved(whole)
    drop_saved(made)

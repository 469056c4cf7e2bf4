"""Reading sources and writing targets; targets are Parquet folders with one writer each."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ledger import new_rows

#: The columns of a log record.
LOG = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()), T.StructField("timestampType", T.IntegerType()),
     T.StructField("headers", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])))]
)
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that is unset, one of this process on a local master; on a cluster, whose machines could not
    see each other's files there, an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _local.setdefault("dir", "") or f"file://{tempfile.mkdtemp(prefix='spark-')}"
        _local["dir"] = found
    return found.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it again.

    For results that several parts of a plan read; a lost executor then costs no recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Delete the files behind a table that ``save`` made and that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder, without those of its subfolders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found, out = store.listStatusIterator(folder), []
    while found.hasNext():
        status = found.next()
        if status.isFile() and not status.getPath().getName().startswith(("_", ".")):
            out.append(status.getPath().toString())
    return sorted(out)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole or not at all; false if it is there already."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(target):
        return False
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    out = store.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    return bool(store.rename(beside, target))


def read_log(spark: SparkSession, topics: Sequence[str], servers: str | None = None, path: str | None = None, streaming: bool = True) -> DataFrame:
    """Log records of some topics: from brokers where a connector is at hand, else from files of the same columns."""
    reader = spark.readStream if streaming else spark.read
    if servers:
        options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest", "failOnDataLoss": "true", "includeHeaders": "true"}
        return reader.format("kafka").options(**options).load()
    return reader.schema(LOG).parquet(path).where(F.col("topic").isin(*topics))


def read_ledger_stream(spark: SparkSession, path: str, schema: T.StructType, topics: Sequence[str]) -> DataFrame:
    """A table of records as a stream, cut to some topics."""
    return spark.readStream.schema(schema).parquet(path).where(F.col("topic").isin(*topics))


def replay(raw: DataFrame, topic: str, start=None, end=None) -> DataFrame:
    """A bounded slice of the raw table, by topic and optional times, for the ordinary batch writer."""
    rows = raw.where(F.col("topic") == topic)
    if start is not None:
        rows = rows.where(F.col("timestamp") >= start)
    return rows if end is None else rows.where(F.col("timestamp") < end)


def run_replay(rows: DataFrame, write: Callable[[DataFrame, int], None], execute: bool = False, batch_id: int = -1) -> DataFrame:
    """What a replay would hand over (topic, partition, rows and offsets); with ``execute`` it goes to the batch writer."""
    if execute:
        write(rows, batch_id)
    return rows.groupBy("topic", "partition").agg(F.count("*").alias("n_rows"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def read_reference_jdbc(spark: SparkSession, url: str, table: str, casts: Mapping[str, str], split: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A table over JDBC with explicit casts; ``split`` is (column, low, high, partitions) for parallel reads."""
    if split:
        options |= {"partitionColumn": split[0], "lowerBound": str(split[1]), "upperBound": str(split[2]), "numPartitions": str(split[3])}
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in casts.items()), F.lit(table).alias("source_table"), F.current_timestamp().alias("loaded_at"))


def read_source_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with exactly this header and these types; empty fields are null, bad rows end the job."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, nullValue="", mode="FAILFAST", escape='"', multiLine=True)


def load_reference_once(df: DataFrame, path: str) -> str:
    """Write a reference table; an equal one is left, one of another size is an error."""
    spark = df.sparkSession
    if exists(spark, path):
        have, want = spark.read.parquet(path).count(), df.count()
        if have != want:
            raise ValueError(f"{path} holds {have} rows, the source {want}")
        return "unchanged"
    df.write.mode("errorifexists").parquet(path)
    return "loaded"


def append_new(df: DataFrame, path: str, keys: Sequence[str], within: str | None = None) -> None:
    """Append the rows whose keys the target lacks.

    They are written beside the target first, because the target is read to find them. ``within`` is a
    column that rows of equal keys have in common, such as an offset: only the part of the target in the
    new rows' range of it, or without it, is read.
    """
    spark = df.sparkSession
    rows = df.dropDuplicates(list(keys))
    if exists(spark, path):
        held = spark.read.schema(df.schema).parquet(path)
        if within:
            low, high = df.agg(F.min(within), F.max(within)).first()
            inside = F.lit(False) if low is None else F.col(within).between(low, high)
            held = held.where(inside | F.col(within).isNull())
        rows = save(new_rows(rows, held, keys).select(*df.columns), "staged")
        rows.write.mode("append").parquet(path)
        drop_saved(rows)
    else:
        rows.write.mode("append").parquet(path)


def status_rows(documents: DataFrame) -> DataFrame:
    """One row per query inside each status document (application, updated_at, queries)."""
    return documents.select("application", "updated_at", F.explode("queries").alias("q")).select("application", "updated_at", "q.*")


def read_status_json(spark: SparkSession, path: str) -> DataFrame:
    schema = "application string, updated_at timestamp, queries array<struct<name: string, state: string, last_batch_id: bigint, partition_offsets: map<string, bigint>, error_code: string>>"
    return status_rows(spark.read.json(path, schema=schema, multiLine=True))


def parse_offsets(df: DataFrame, column: str) -> DataFrame:
    """(…, topic, partition, offset) rows out of a progress JSON of topic to partition to offset."""
    outer = df.withColumn("_m", F.from_json(column, "map<string, map<string, bigint>>"))
    inner = outer.select(*df.columns, F.explode("_m").alias("topic", "_p"))
    return inner.select(*df.columns, "topic", F.explode("_p").alias("_k", "offset")).select(*df.columns, "topic", F.col("_k").cast("int").alias("partition"), "offset")


def ensure_table(spark: SparkSession, name: str, ddl: str, partition_by: str | None = None, properties: Mapping[str, str] | None = None) -> None:
    """Create a declared table where there is none; schemas.table_drift and layout_drift tell how one that is there differs."""
    more = f" partitioned by ({partition_by})" if partition_by else ""
    if properties:
        more += " tblproperties (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(f"create table if not exists {name} ({ddl}) using parquet{more}")

"""Runs, publication markers, retention and compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.versions import latest_by

#: Legal status transitions of a run.
TRANSITIONS = (("", "STARTED"), ("STARTED", "MATERIALIZING"), ("STARTED", "NOOP"), ("STARTED", "WAITING"), ("STARTED", "BLOCKED"), ("MATERIALIZING", "PUBLISHED"), ("MATERIALIZING", "FAILED"))

#: The reasons of a run that mean a rejected boundary.
REJECTIONS = ("rejected_transaction", "snapshot_rejected")


def published_runs(markers: DataFrame) -> DataFrame:
    """Runs whose newest marker says they are published."""
    return latest_by(markers, ["seq"], F.col("recorded_at")).where("status = 'PUBLISHED'").select("seq")


def visible_runs(df: DataFrame, markers: DataFrame, candidate: int | None = None) -> DataFrame:
    """Rows of published runs, and of the candidate run that is being built."""
    runs = published_runs(markers)
    if candidate is not None:
        runs = runs.unionByName(runs.sparkSession.range(candidate, candidate + 1).select(F.col("id").cast(dict(runs.dtypes)["seq"]).alias("seq"))).distinct()
    return df.join(runs, "seq", "left_semi")


def published_view(df: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows of the newest published run, without the run column."""
    newest = published_runs(markers).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("_newest"))
    return df.join(F.broadcast(newest), F.col("seq") == F.col("_newest")).drop("seq", "_newest")


def read_as_of(df: DataFrame, keys: Sequence[str], seq: int, order: Column) -> DataFrame:
    """The state of each key as of a run."""
    return latest_by(df.where(F.col("seq") <= seq), keys, order)


def retention_plan(partitions: DataFrame, markers: DataFrame, keep: int) -> DataFrame:
    """What happens to each run's partition: the newest ``keep`` (two at least) published runs stay."""
    held = published_runs(markers).orderBy(F.desc("seq")).limit(max(2, keep)).withColumn("_kept", F.lit(True))
    runs = partitions.select("seq").distinct().join(F.broadcast(held), "seq", "left")
    return runs.select("seq", F.when(F.col("_kept"), "keep").otherwise("drop").alias("action"))


def apply_retention(spark, path: str, plan: DataFrame, dry_run: bool = True) -> DataFrame:
    """The plan's dropped partitions, one row each with their folder; they go only without ``dry_run``.

    Runs are few: one row a publication.
    """
    drop = plan.where("action = 'drop'").select("seq", F.concat(F.lit(f"{path}/seq="), F.col("seq").cast("string")).alias("folder")).orderBy("seq")
    if not dry_run:
        for r in drop.toLocalIterator():
            folder = spark._jvm.org.apache.hadoop.fs.Path(r["folder"])
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return drop.withColumn("dropped", F.lit(not dry_run))


def run_ledger(events: DataFrame) -> DataFrame:
    """Each run's newest status and whether all its transitions were legal."""
    w = Window.partitionBy("run_id").orderBy("recorded_at")
    step = F.concat_ws(">", F.coalesce(F.lag("status").over(w), F.lit("")), F.col("status"))
    legal = step.isin(*(f"{a}>{b}" for a, b in TRANSITIONS))
    marked = events.withColumn("_legal", legal)
    return marked.groupBy("run_id").agg(F.max_by("status", "recorded_at").alias("status"), F.count("*").alias("steps"), F.min(F.col("_legal").cast("int")).alias("legal"))


def serving_gauges(markers: DataFrame, now: Column, limit_seconds: int = 86_400, leases: DataFrame | None = None) -> DataFrame:
    """Newest published run and its age, the newest status of any run, whether that was rejected, and whether a lease is held, in one row.

    ``markers`` may have a reason, which tells rejections; ``leases`` (owner, expires_at) holds those given out.
    """
    done = F.when(F.col("status") == "PUBLISHED", F.col("recorded_at"))
    newest = F.struct("recorded_at", "seq")
    reason = F.max_by("reason", newest) if "reason" in markers.columns else F.lit(None).cast("string")
    out = markers.agg(F.max(F.when(F.col("status") == "PUBLISHED", F.col("seq"))).alias("last_published"), F.max(done).alias("_at"), F.max_by("status", newest).alias("latest_status"), reason.alias("_reason"))
    held = F.lit(False)
    if leases is not None:
        out = out.crossJoin(leases.agg(F.count_if(F.col("owner").isNotNull() & (F.col("expires_at") > now)).alias("_held")))
        held = F.col("_held") > 0
    age = F.unix_timestamp(now) - F.unix_timestamp("_at")
    rejected = F.coalesce(F.col("_reason").isin(*REJECTIONS), F.lit(False))
    return out.select("last_published", age.alias("publication_age"), "latest_status", F.coalesce(age > limit_seconds, F.lit(True)).alias("age_alert"), rejected.alias("rejected"), held.alias("active_lease"))


def overwrite_run(df: DataFrame, path: str, *sort: str) -> None:
    """Replace only the run partitions that ``df`` holds."""
    out = df.sortWithinPartitions("seq", *sort) if sort else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seq").parquet(path)


def compact(spark, path: str, seq: int, target_bytes: int, size_bytes: int) -> DataFrame:
    """Rewrite one run's partition into files of about ``target_bytes``; the audit row is returned.

    Files of the old partition are replaced only once the new ones are written, to a folder beside it.
    """
    rows = spark.read.parquet(path).where(F.col("seq") == seq)
    files = max(1, -(-size_bytes // target_bytes))
    staged = f"{path}-compact-{seq}"
    rows.repartition(files).write.mode("overwrite").parquet(staged)
    overwrite_run(spark.read.parquet(staged), path)
    return spark.createDataFrame([(path, seq, "compact", files)], "target string, seq long, action string, files long")

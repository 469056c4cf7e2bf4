"""Clustered compaction: small files packed into few, and rows in an order that serves filters on either of two keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import _cuts, _range, _ticks
from tidemark.sources.storage import list_files

#: Bits of each key's place in the interleaved order.
BITS = 6


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f: store.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)).getLen() for f in list_files(spark, path)}


def pack_files(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Groups of files of up to ``target`` bytes together, the largest first into the fullest group it fits; larger files stand alone."""
    groups: list[list[str]] = []
    room: list[int] = []
    for file in sorted(sizes, key=lambda f: (-sizes[f], f)):
        fits = [i for i, left in enumerate(room) if left >= sizes[file]]
        if fits:
            best = min(fits, key=lambda i: room[i])
            groups[best].append(file)
            room[best] -= sizes[file]
        else:
            groups.append([file])
            room.append(max(0, target - sizes[file]))
    return groups


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """One number of the bits of several, taken in turn, so that near numbers are near in each of them."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, place in enumerate(places):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(place.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(places) + k))
    return out


def cluster(rows: DataFrame, keys: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``rows`` dealt over ``files`` partitions, each of a small range of every key.

    Keys are numbers or times; their places are equally full ranges, so skewed values spread. Nulls come
    first. Equal places of one crowded value may still fill several files, since ties are dealt by a hash.
    """
    places = []
    for key in keys:
        ticks = _ticks(rows, key)
        cuts = _cuts([rows.select(ticks.alias("_t"))], 1 << bits)
        places.append(F.coalesce(_range(ticks, cuts), F.lit(0)))
    dealt = rows.withColumn("_z", interleaved(places, bits)).withColumn("_tie", F.xxhash64(*rows.columns))
    return dealt.repartitionByRange(files, "_z", "_tie").sortWithinPartitions("_z").drop("_z", "_tie")


def compact_clustered(spark: SparkSession, path: str, target: str, keys: Sequence[str], bytes_per_file: int) -> DataFrame:
    """Rewrite the files of ``path`` to ``target`` in clustered order, as many as their bytes fill; one audit row.

    The size is taken from the files. The old folder stays as it is, for readers that have it open; the
    caller moves its view to the new one.
    """
    sizes = file_sizes(spark, path)
    files = max(1, -(-sum(sizes.values()) // bytes_per_file))
    rows = spark.read.parquet(path)
    cluster(rows, keys, files).write.mode("errorifexists").parquet(target)
    return spark.createDataFrame([(path, target, len(sizes), files, sum(sizes.values()))], "source string, target string, files_before long, files_after long, bytes long")


def pack_small(spark: SparkSession, path: str, target: str, bytes_per_file: int) -> DataFrame:
    """Copy the files of ``path`` to ``target`` with small ones packed together, and those of the size or more as they are; one audit row.

    Every group of files becomes one, by one task, so rows are read and written once and nothing is shuffled but small files.
    """
    sizes = file_sizes(spark, path)
    groups = pack_files(sizes, bytes_per_file)
    of = spark.createDataFrame([(f.rsplit("/", 1)[-1], i) for i, g in enumerate(groups) for f in g], "_file string, _group int")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.parquet(path)
    placed = rows.select("*", name.alias("_file")).join(F.broadcast(of), "_file")  # a name and a number for each file
    placed.repartitionByRange(len(groups) or 1, "_group").drop("_file", "_group").write.mode("errorifexists").parquet(target)
    return spark.createDataFrame([(path, target, len(sizes), len(groups), sum(sizes.values()))], "source string, target string, files_before long, files_after long, bytes long")


def opened_share(table: DataFrame, where: Column) -> float:
    """The share of a table's files whose least and greatest values admit rows of a filter (by the rows they hold)."""
    every = table.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return table.where(where).select(F.col("_metadata.file_path").alias("f")).distinct().count() / max(1, every)

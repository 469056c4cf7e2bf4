"""Helpers that every operator of this subpackage uses: shared storage and grouped Arrow streams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import save, shared_dir

__all__ = ["documents", "drop_saved", "save", "shared_dir", "sorted_groups", "spread", "text_key", "whole_groups"]


def drop_saved(df: DataFrame) -> None:
    """Delete the files behind a table that ``save`` made and that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(doc_id="doc_id", text="text"):
    """A column that tells rows apart by id and text, so repeated ids do not mix."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal ``key`` out of a stream that is sorted by it."""
    kept: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        start = 0
        for i, k in enumerate(keys):
            if k != current:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                if kept:
                    yield pa.Table.from_batches(kept)
                kept, start, current = [], i, k
        if len(keys) > start:
            kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` rows, or one group if that is larger, out of a stream that is sorted by ``key``; no group is split."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            keys = batch.column(key).to_numpy()
            if kept and size >= most:  # what still belongs to the last group, then a table
                other = keys != kept[-1].column(key)[-1].as_py()
                same = int(other.argmax()) if other.any() else len(other)
                if same:
                    kept.append(batch.slice(0, same))
                batch = batch.slice(same)
                if batch.num_rows:
                    yield pa.Table.from_batches(kept)
                    kept, size = [], 0
                continue
            kept.append(batch.slice(0, most - size))
            batch = batch.slice(most - size)
            size += kept[-1].num_rows
    if kept:
        yield pa.Table.from_batches(kept)

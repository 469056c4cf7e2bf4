"""Append-only tables with a membership index: which files may hold an id.

Beside each file of a table stands one row of a sidecar: the least and the greatest id in it, and a Bloom
filter of its ids. An append reads only the files whose range and filter admit one of the batch's ids,
whatever order the ids come in; what it finds there settles whether a row is new, a copy, or a copy that
differs, which must not pass. Filters are small enough (BITS an id) that a batch of a hundred thousand
ids opens about one foreign file in ten. A batch of more than KEYS ids would open most files by chance
alone; it opens all those whose range meets its own, and neither driver nor workers hold its ids.

A file without a sidecar row, as a crash between the two writes leaves it, counts as one that may hold
anything, and the next append indexes it. Each table has one writer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import drop_saved, exists, list_files, save

#: Bits of a filter for each id, and positions an id sets.
BITS, PLACES = 30, 12
#: Rows of a file at most, so that a filter is made by one task; ids of a batch that are sent to the filters.
FILE_ROWS, KEYS = 1_000_000, 250_000
#: Hashes whose positions are held at once.
_CHUNK = 1 << 16

#: Columns that tell how a row was captured; copies may differ in them.
LINEAGE = ("ingest_batch_id", "query_id", "ingested_at")
#: ``file`` is the file's own name, which no other file of the table has.
INDEX = "file string, n long, low string, high string, bits binary"


def _positions(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits that each hash sets in a filter of ``size`` bits: (hashes, PLACES)."""
    first = hashes.view(np.uint64)
    second = (first * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | np.uint64(1)
    return ((first[:, None] + second[:, None] * np.arange(PLACES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(1, -(-len(hashes) * BITS // 8)) * 8, bool)
    for i in range(0, len(hashes), _CHUNK):
        bits[_positions(hashes[i : i + _CHUNK], len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes | pa.Buffer, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter admits."""
    packed, out = np.frombuffer(bits, np.uint8), np.empty(len(hashes), bool)
    for i in range(0, len(hashes), _CHUNK):
        at = _positions(hashes[i : i + _CHUNK], 8 * len(packed))
        out[i : i + _CHUNK] = ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
    return out


def _name(file: str) -> str:
    return file.rsplit("/", 1)[-1]


class LedgerFiles:
    """The files of one table, by default those of its folder, and their index in a folder beside it.

    ``payload`` are the columns in which copies of a row must agree, by default all but the keys and LINEAGE.
    ``opened`` lists the files that the last look into the table has read.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], payload: Sequence[str] | None = None, files: Callable[[], list[str]] | None = None):
        self.spark, self.path, self.keys, self.payload = spark, path.rstrip("/"), list(keys), payload
        self.files = files or (lambda: list_files(spark, self.path))
        self.opened: list[str] = []

    def _id(self) -> Column:
        return F.concat_ws("\x1f", *(F.col(k).cast("string") for k in self.keys))

    def index(self) -> DataFrame:
        where = f"{self.path}.index"
        return self.spark.read.schema(INDEX).parquet(where) if exists(self.spark, where) else self.spark.createDataFrame([], INDEX)

    def add_to_index(self) -> None:
        """Sidecar rows for the files that have none."""
        known = {r["file"] for r in self.index().select("file").collect()}
        fresh = [f for f in self.files() if _name(f) not in known]
        if not fresh:
            return

        def build(table: pa.Table) -> pa.Table:
            return pa.table({"k": table.column("k").slice(0, 1), "bits": pa.array([bloom(table.column("h").to_numpy())], pa.binary())})

        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        rows = self.spark.read.parquet(*fresh).select(name.alias("file"), self._id().alias("id")).withColumn("k", F.xxhash64("file"))
        bits = rows.select("k", F.xxhash64("id").alias("h")).groupBy("k").applyInArrow(build, "k long, bits binary")  # two numbers a row, whatever the ids are
        ends = rows.groupBy("k", "file").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        made = save(ends.join(bits, "k").select("file", "n", "low", "high", "bits"), "index")
        seen = {r["file"] for r in made.select("file").collect()}
        empty = [(_name(f), 0, None, None, b"") for f in fresh if _name(f) not in seen]
        made.unionByName(self.spark.createDataFrame(empty, INDEX)).coalesce(max(1, len(fresh) // 1000)).write.mode("append").parquet(f"{self.path}.index")
        drop_saved(made)

    def candidates(self, rows: DataFrame) -> list[str]:
        """Files that may hold an id of ``rows``, which are read twice."""
        files = self.files()
        if not files:
            return []
        index, ids = self.index(), rows.select(self._id().alias("id"))
        n, least, most = ids.agg(F.count("*"), F.min("id"), F.max("id")).first()
        if not n:
            return []
        near = index.where(F.col("n") > 0).where((F.col("low") <= most) & (F.col("high") >= least))
        some = {_name(f) for f in files} - {r["file"] for r in index.select("file").collect()}
        if n > KEYS:
            some |= {r["file"] for r in near.select("file").collect()}
            return [f for f in files if _name(f) in some]
        part = ids.withColumn("h", F.xxhash64("id")).toArrow()
        order = pc.sort_indices(part.column("id"))
        text, hashes = part.column("id").take(order).to_pylist(), part.column("h").take(order).to_numpy()
        sent = self.spark.sparkContext.broadcast((np.array(text, object), hashes))

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            text, hashes = sent.value
            for batch in batches:
                hit = []
                for file, low, high, bits in zip(*(batch.column(c) for c in ("file", "low", "high", "bits"))):
                    a, b = np.searchsorted(text, low.as_py(), "left"), np.searchsorted(text, high.as_py(), "right")
                    if b > a and may_hold(bits.as_buffer(), hashes[a:b]).any():
                        hit.append(file.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], ["file"])

        some |= {r["file"] for r in near.mapInArrow(test, "file string").collect()}
        sent.destroy()
        return [f for f in files if _name(f) in some]

    def judge(self, rows: DataFrame) -> DataFrame:
        """One row of each id with its ``verdict``: new, known, or differs (from the table's) or differs_in_batch.

        The batch and the result are written once, for everything that follows to read; ``release`` deletes them.
        Rows without an id are all new.
        """
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        payload = [c for c in rows.columns if c not in self.keys and c not in LINEAGE] if self.payload is None else list(self.payload)
        mark = F.sha2(F.to_json(F.struct(*payload)), 256)
        batch = save(rows, "batch")
        own = batch.where(whole).withColumn("_mark", mark).groupBy(*self.keys).agg((F.min("_mark") != F.max("_mark")).alias("_conflict"), F.min_by(F.struct(*rows.columns), "_mark").alias("_row"), F.min("_mark").alias("_mark"))
        self.opened = self.candidates(batch.where(whole))
        if self.opened:
            held = self.spark.read.schema(batch.schema).parquet(*self.opened).where(whole).select(*self.keys, mark.alias("_held"))
            own = own.join(held, self.keys, "left")
        else:
            own = own.withColumn("_held", F.lit(None).cast("string"))
        verdict = F.when(F.col("_conflict"), "differs_in_batch").when(F.col("_held").isNull(), "new").when(F.col("_held") == F.col("_mark"), "known").otherwise("differs")
        judged = save(own.select("_row.*", verdict.alias("verdict")).unionByName(batch.where(~whole).withColumn("verdict", F.lit("new"))), "judged")
        self._scratch = [batch, judged]
        return judged

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """The rows whose ids the table lacks, one of each id; copies that differ, in the batch or from the table, are an error."""
        judged = self.judge(rows)
        bad = judged.where("verdict like 'differs%'").select(*self.keys, "verdict").limit(3).collect()
        if bad:
            self.release()
            raise ValueError(f"copies of one {', '.join(self.keys)} differ: {[tuple(r) for r in bad]}")
        return judged.where("verdict = 'new'").select(*rows.columns)

    def release(self) -> None:
        """Delete what the last ``new_rows`` has written."""
        for table in self.__dict__.pop("_scratch", []):
            drop_saved(table)

    def append(self, rows: DataFrame, summary: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
        """Append the new rows; a batch that is tried again appends nothing.

        ``summary`` is a small table of the whole batch, new or not, taken from its written copy.
        """
        self.add_to_index()
        fresh = self.new_rows(rows)
        if fresh.limit(1).count() or not exists(self.spark, self.path):
            fresh.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(self.path)
        told = save(summary(self._scratch[0]), "summary") if summary else None
        self.release()
        self.add_to_index()
        return told

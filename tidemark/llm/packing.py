"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest; rests are cut into pieces of at most PIECE
ids. Pieces of BLOCK pieces at a time are dealt to the least number of windows that can hold them:
every piece begins as a partial partition of its own, and the two partitions of the largest spread
are merged with opposing imbalances (the fullest windows of one with the emptiest of the other) until
one is left, whose windows are near-equal. If its fullest window exceeds the capacity, the number of
windows rises by one and the block is dealt again. Blocks are formed inside a partition while it is
read, so packing needs no shuffle; what is wasted is less than about one window a block.

Cases: a null or empty text is the end id alone; texts of any length are encoded whole; repeated rows
are separate documents; an empty table gives no rows; extra columns are ignored. How pieces are
grouped into sequences depends on how the table is split and in which order it is read; the pieces of
a document depend on its text alone.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import codec, default_tokenizer
from tidemark.llm.shared import documents

#: Ids of a window; ids of a piece at most; pieces dealt together; the id behind each document.
WINDOW, PIECE, BLOCK, END = 2048, 512, 1024, 1


def differencing(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size, by multiway differencing."""
    follows = np.full(len(sizes), -1)
    partitions = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        head = np.full(windows, -1)
        sums[0], head[0] = size, i
        partitions.append((sums, head, head.copy()))
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        (sums, head, tail), (more, first, last) = partitions[a], partitions[b]
        more, first, last = more[::-1], first[::-1], last[::-1]
        both = (tail >= 0) & (first >= 0)
        follows[tail[both]] = first[both]
        head, tail, sums = np.where(head >= 0, head, first), np.where(last >= 0, last, tail), sums + more
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        partitions[a], partitions[b] = (sums - sums[-1], head[order], tail[order]), None
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), a))
    where = np.zeros(len(sizes), np.int64)
    for w, i in enumerate(partitions[heap[0][1]][1].tolist()):
        while i >= 0:
            where[i] = w
            i = int(follows[i])
    return where


def deal(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of each size: as few near-equal windows as differencing fills within the capacity."""
    windows = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        where = differencing(sizes, windows)
        if np.bincount(where, weights=sizes).max() <= capacity:
            return where
        windows += 1


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)


def pack(docs: DataFrame, path: str, capacity: int = WINDOW, piece: int = PIECE, block: int = BLOCK, end: int = END) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = codec(path), TaskContext.get().partitionId() << 40
        done, open_ = [], []

        def close() -> None:
            nonlocal number
            where = deal([x[2] for x in open_], capacity)
            filled: dict[int, int] = {}
            for w, x in zip(where.tolist(), open_):
                at = filled.get(w, 0)
                done.append((*x, number + w, at))
                filled[w] = at + x[2]
            number += int(where.max()) + 1
            open_.clear()

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], COLUMNS)
            done.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(coder.encode(text.as_py()), end).astype("<u4")
                full = len(ids) // capacity * capacity
                for a in range(0, full, capacity):
                    done.append((doc, a, capacity, zlib.crc32(ids[a : a + capacity].tobytes()), len(ids), number, 0))
                    number += 1
                for a in range(full, len(ids), piece):
                    part = ids[a : a + piece]
                    open_.append((doc, a, len(part), zlib.crc32(part.tobytes()), len(ids)))
                if len(open_) >= block:
                    close()
                if len(done) >= 10_000:
                    yield table()
        if open_:
            close()
        if done:
            yield table()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_tokenizer())

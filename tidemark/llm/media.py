"""Media columns: payloads stored as 8-bit mono WAV in a deduplicated store of content-defined chunks.

A payload's samples are its bytes. The WAV file's header stays with its list; the rest is cut into
chunks wherever a rolling gear hash of the samples (the sum of the last bytes' random codes, each shifted once more)
has its top bits clear, between a least and a greatest chunk size. Equal stretches of different files
therefore give equal chunks. The store keeps one compressed copy of each chunk, found by its digest;
a file is the ordered list of its chunks' digests. Both sides are Spark tables: chunks are
deduplicated by digest, lists are joined to the store, and each file is put together in order, its
SHA-256 checked against the one taken before storing, and read back for its features.

Cases: a null or empty text is 64 zero bytes; texts of any length are stored whole; equal texts, also
repeated rows, share one file and get equal values; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, sorted_groups, spread

#: Payload padding; samples a second; chunk sizes; bits of the gear hash that a cut has clear (2**-13: 8 KiB on average).
PAD, RATE, LEAST, MOST, CUT_BITS = 64, 8000, 2048, 65536, 13
#: Window of the gear hash in bytes: what is shifted further than its bits is gone.
REACH = 32
#: zstd's level.
LEVEL = 3
GEAR = np.random.default_rng(4242).integers(0, 1 << 32, 256, dtype=np.uint32)


def wav(payload: bytes) -> bytes:
    """A WAV file whose 8-bit samples are the payload."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload


def samples(media: bytes) -> bytes:
    """The samples of a file that ``wav`` made; anything else is refused."""
    riff, _, kind, fmt, _, coding, channels, _, _, _, bits, data, size = struct.unpack_from("<4sI4s4sIHHIIHH4sI", media)
    if (riff, kind, fmt, data, coding, channels, bits) != (b"RIFF", b"WAVE", b"fmt ", b"data", 1, 1, 8) or len(media) != 44 + size:
        raise ValueError("not a stored payload")
    return media[44:]


def cuts(payload: bytes) -> list[int]:
    """Ends of the payload's chunks."""
    n = len(payload)
    if n <= LEAST:
        return [n]
    code = GEAR[np.frombuffer(payload, np.uint8)]
    h, width = code, 1
    while width < REACH:  # h[i] = sum of code[i - j] << j for j < width, doubled each time
        h = h.copy()
        h[width:] += h[:-width].copy() << np.uint32(width)
        width *= 2
    found = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends, last = [], 0
    while n - last > LEAST:
        i = int(np.searchsorted(found, last + LEAST))
        at = int(found[i]) if i < len(found) else n
        last = min(at, last + MOST, n)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunked(media: bytes) -> list[bytes]:
    """The chunks behind the header."""
    edges = [44, *(44 + e for e in cuts(media[44:]))]
    return [media[a:b] for a, b in zip(edges, edges[1:])]


def features(payload: bytes) -> str:
    """Mean, root mean square and sign changes of the samples about their middle value."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"n={len(x)};mean={x.sum() / len(x):.6f};rms={float(np.sqrt((x * x).sum() / len(x))):.6f};zc={crossings}"


def _cut_files(docs: DataFrame, schema: str, start: Callable[[], Callable[[bytes, bytes, bytes, list[bytes]], Iterator[tuple[int, tuple]]]]) -> DataFrame:
    """Rows out of each text's file and chunks; what ``start`` makes in a task gets key, text, file and chunks, and gives sizes and rows."""
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [{"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}[field.split()[1]] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of, rows, held = start(), [], 0
        table = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                raw = text.as_py().encode()
                file = wav(raw + bytes(PAD - len(raw) % PAD if len(raw) % PAD or not raw else 0))
                for size, row in rows_of(key.as_py(), raw, file, chunked(file)):
                    held += size
                    rows.append(row)
                if held > 4 << 20:
                    yield table()
                    rows.clear()
                    held = 0
        if rows:
            yield table()

    return docs.mapInArrow(run, schema)


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def chunk_lists(docs: DataFrame) -> DataFrame:
    """A row for each chunk of a file: its key, sizes, digest and header, and the chunk's place and digest."""

    def rows(key: bytes, raw: bytes, file: bytes, chunks: list[bytes]) -> Iterator[tuple[int, tuple]]:
        media = hashlib.sha256(file).digest()
        for place, chunk in enumerate(chunks):
            yield 256, (key, len(raw), media, file[:44], len(chunks), place, _digest(chunk))

    return _cut_files(docs, "key binary, n_bytes long, media binary, header binary, n_chunks int, place int, digest binary", lambda: rows)


def packed_chunks(docs: DataFrame) -> DataFrame:
    """digest and zstd bytes of every chunk."""

    def start() -> Callable[..., Iterator[tuple[int, tuple]]]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL)

        def rows(key: bytes, raw: bytes, file: bytes, chunks: list[bytes]) -> Iterator[tuple[int, tuple]]:
            for chunk in chunks:
                packed = squeeze.compress(chunk)
                yield len(packed), (_digest(chunk), packed)

        return rows

    return _cut_files(docs, "digest binary, chunk binary", start)


def rebuild(lists: DataFrame, chunks: DataFrame, parts: int) -> DataFrame:
    """The files of the ordered chunk lists, read back and described.

    A file of one chunk is whole as soon as its list meets the store; only longer ones are gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for group in sorted_groups(batches, "key"):
            order = np.argsort(group.column("place").to_numpy())
            column = group.column("chunk")
            file = group.column("header")[0].as_py() + b"".join(expand.decompress(column[i].as_py()) for i in order.tolist())
            if hashlib.sha256(file).digest() != group.column("media")[0].as_py():
                raise ValueError("a rebuilt file differs from the one that was stored")
            payload = samples(file)
            if hashlib.sha256(payload[: group.column("n_bytes")[0].as_py()]).digest() != group.column("key")[0].as_py():
                raise ValueError("a rebuilt payload differs from its document")
            yield pa.RecordBatch.from_pydict({
                "key": group.column("key")[:1].combine_chunks(), "n_bytes": group.column("n_bytes")[:1].combine_chunks(),
                "payload_bytes": pa.array([len(payload)], pa.int64()), "payload_sha256": [hashlib.sha256(payload).hexdigest()],
                "tail_crc32": pa.array([zlib.crc32(payload[-PAD:])], pa.int64()), "media_bytes": pa.array([len(file)], pa.int64()),
                "media_sha256": [hashlib.sha256(file).hexdigest()], "feature": [features(payload)], "n_chunks": pa.array([len(order)], pa.int32()),
            })

    fields = ("key", "n_bytes", "media", "header", "place", "chunk")
    short = lists.where("n_chunks = 1").join(chunks, "digest").select(*fields)
    long = lists.where("n_chunks > 1").join(chunks, "digest").select(*fields)
    schema = "key binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int"
    return short.mapInArrow(run, schema).unionByName(long.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, schema))


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id and the read-back media columns of each document."""
    parts = spread(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"))
    texts = keyed.select("key", "text")  # cut twice: lists without bytes, so that only chunks are packed and nothing is written between
    lists = chunk_lists(texts).groupBy("key", "place").agg(*(F.first(c).alias(c) for c in ("n_bytes", "media", "header", "n_chunks", "digest")))
    chunks = packed_chunks(texts).dropDuplicates(["digest"])
    files = rebuild(lists, chunks, parts)
    return keyed.select("doc_id", "key").join(files, "key").drop("key")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))

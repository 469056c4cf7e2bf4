"""Vector code compression: product codes whose nearest entries come from an integer Walsh-Hadamard transform.

A vector's components become integers, floor(256 x), and are cut into PARTS equal parts. Every part
position has a codebook of ENTRIES entries. Parts and entries are filled up with zeros to a power of
two, w, and transformed by sums and differences alone. The transform keeps squared distances up to the
factor w, and in order of sequency (sign changes) most of a distance stands in the first coefficients:
scaled squared differences are added up coefficient by coefficient, and an entry leaves as soon as its
sum passes the full distance of another one. Sums only grow, so no nearest entry is ever lost, and
everything is integer, so the result is exact.

A round is one pass over the vectors: tasks add up the parts of each entry, Spark adds up the tasks'
sums, and the new codebooks (PARTS x ENTRIES x part length numbers, whatever the number of vectors)
come to the driver and go out with the next pass.

Cases: rows whose vector is null or holds null or non-finite components are dropped; vectors of
different lengths are filled up with zeros at the end to the longest one, and that to a multiple of
PARTS (an empty vector is all zeros); repeated ids are further vectors, and of the rows that a codebook
starts with, equal ids are ordered by their vectors and missing ids come last; with fewer vectors than
ENTRIES the codebooks are smaller; equal distances go to the lower entry; numbers of any size are
worked on exactly (as Python integers where 64 bits are not enough), and an error that a long cannot
hold is null, like the sum of its label; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import drop_saved, save

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Numbers of vectors that are compared at once, and coefficients of them.
STEP = 1 << 18
#: Bits of a digit in which sums travel, so that Spark's sums of them fit a long.
DIGIT = 40
#: Labels whose sums are sent to every task; with more, rows meet them in a shuffled join.
LABELS = 100_000


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): 64-bit integers where they fit, Python integers otherwise."""
    if not values.size or np.abs(values).max() < 2.0**50:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([math.floor(int(x) * SCALE if abs(x) >= 2.0**53 else x * SCALE) for x in values.ravel().tolist()], object).reshape(values.shape)


def sequency_order(width: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``width``, a power of two, by their number of sign changes."""
    bits = width.bit_length() - 1
    gray = np.arange(width) ^ (np.arange(width) >> 1)
    out = np.zeros(width, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, filled up with zeros to a power of two, in sequency order."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    x = np.zeros((len(rows), width), rows.dtype)
    x[:, : rows.shape[1]] = rows
    h = 1
    while h < width:
        pairs = x.reshape(len(rows), -1, 2, h)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(rows), width)
        h *= 2
    return x[:, sequency_order(width)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each transformed point's nearest entry; of equal ones the lowest."""
    n, width = points.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, points.dtype)
    lead = (points[:, :1] - entries[:, 0]) ** 2
    near = lead.argmin(axis=1)
    bound = ((points - entries[near]) ** 2).sum(axis=1)
    row, entry = np.nonzero(lead <= bound[:, None])
    total = lead[row, entry]
    low, size = 1, 1
    while low < width:
        high = min(width, low + size)
        total = total + ((points[row, low:high] - entries[entry, low:high]) ** 2).sum(axis=1)
        open_ = total <= bound[row]
        row, entry, total = row[open_], entry[open_], total[open_]
        low, size = high, size * 2
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    least = np.minimum.reduceat(total, first)
    hit = np.flatnonzero(total == np.repeat(least, np.diff(np.append(first, len(row)))))
    hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
    return entry[hit], least // width


class Codebooks:
    """Entries of every part position, (parts, entries, length), and their transforms."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.coded = [transform(part) for part in entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, parts) indexes and squared distances of cut vectors (vectors, parts, length)."""
        codes = np.zeros(vectors.shape[:2], np.int64)
        wide = vectors.dtype == object or self.entries.dtype == object
        if not wide and vectors.size:
            most = max(int(np.abs(vectors).max()), int(np.abs(self.entries).max()))
            wide = (2 * most * self.coded[0].shape[1]) ** 2 >= 1 << 62
        errors = np.zeros(vectors.shape[:2], object if wide else np.int64)
        step = max(1, STEP // (self.entries.shape[1] + self.coded[0].shape[1]))
        for part, coded in enumerate(self.coded):
            coded = coded.astype(object) if wide else coded
            for low in range(0, len(vectors), step):
                some = vectors[low : low + step, part]
                codes[low : low + step, part], errors[low : low + step, part] = nearest(transform(some.astype(object) if wide else some), coded)
        return codes, errors


def _cut(column: pa.Array, parts: int, length: int) -> np.ndarray:
    """Integer vectors of a batch as (rows, parts, length)."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = integers(column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(column), parts * length), flat.dtype)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out.reshape(len(column), parts, length)


def _digits(value: int) -> list[int]:
    """A number in digits of DIGIT bits, lowest first; the last one has the sign."""
    out = []
    while not -(1 << DIGIT) < value < 1 << DIGIT:
        out.append(value & ((1 << DIGIT) - 1))
        value >>= DIGIT
    return [*out, value]


def _sums(vectors: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], int]:
    """Sums of the parts assigned to each entry by (part, entry, position), and counts at position -1."""
    parts, entries, length = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, length), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            rows = _cut(batch.column("v"), parts, length)
            codes, _ = books.assign(rows)
            small = rows.dtype != object and (not rows.size or int(np.abs(rows).max()) * len(rows) < 1 << 62)
            for part in range(parts):
                count[part] += np.bincount(codes[:, part], minlength=entries)
                found = np.zeros((entries, length), np.int64 if small else object)
                np.add.at(found, codes[:, part], rows[:, part] if small else rows[:, part].astype(object))
                total[part] += found
        out = [(p, e, -1, 0, int(count[p, e])) for p, e in np.argwhere(count).tolist()]
        for p, e in np.argwhere(count).tolist():
            out += [(p, e, i, d, digit) for i in range(length) for d, digit in enumerate(_digits(int(total[p, e, i])))]
        kinds = ((*("part", "entry", "place", "digit"), "n"), (*(pa.int32(),) * 4, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds[1])], list(kinds[0]))

    rows = vectors.select("v").mapInArrow(add, "part int, entry int, place int, digit int, n long")
    found: dict[tuple[int, int, int], int] = {}
    for r in rows.groupBy("part", "entry", "place", "digit").agg(F.sum("n").alias("n")).collect():
        key = (r["part"], r["entry"], r["place"])
        found[key] = found.get(key, 0) + (r["n"] << (DIGIT * r["digit"]))
    return found


def _narrow(entries: np.ndarray) -> np.ndarray:
    """64-bit integers where all numbers fit."""
    fits = all(abs(int(x)) < 1 << 62 for x in entries.ravel().tolist())
    return entries.astype(np.int64) if fits else entries


def learn(vectors: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``vectors`` (vec_id, v), whose parts have ``length`` numbers; none without vectors."""
    first = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    start = _cut(pa.array([r["v"] for r in first], pa.list_(pa.float64())), parts, length)
    books = Codebooks(_narrow(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        sums = _sums(vectors, books)
        moved = books.entries.astype(object)
        for (p, e, i), n in sums.items():
            if i >= 0:
                moved[p, e, i] = n // sums[p, e, -1]
        books = Codebooks(_narrow(moved))
    return books


SCHEMA = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Code and error of every sound vector of ``table`` (vec_id, embedding, label)."""
    spark = table.sparkSession
    v = F.col("embedding").cast("array<double>")
    sound = F.coalesce(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))), F.lit(False))
    vectors = save(table.where(F.col("embedding").isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v")), "vectors")
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    length = -(-longest // parts)
    books = learn(vectors, length, parts, entries, rounds)
    if books is None:
        return spark.createDataFrame([], SCHEMA)
    digest = hashlib.sha256(",".join(map(str, books.entries.ravel().tolist())).encode()).hexdigest()
    label = vectors.schema["label"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.assign(_cut(batch.column("v"), parts, length))
            text = [bytes(row).hex() for row in codes.astype(np.uint8)]
            total = [x if x < 1 << 63 else None for x in errors.sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(total, pa.int64())], ["vec_id", "label", "code", "error"])

    coded = save(vectors.mapInArrow(encode, f"vec_id long, label {label}, code string, error long"), "codes")
    drop_saved(vectors)
    whole = F.count("error") == F.count(F.lit(1))
    sums = save(coded.groupBy("label").agg(F.when(whole, F.try_sum("error")).alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    few = sums.limit(LABELS + 1).count() <= LABELS
    out = coded.join(F.broadcast(sums) if few else sums.hint("merge"), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    """The same by distances of all numbers, for DuckDB."""
    stages = [
        f"rows_ as materialized (select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"wide as (select cast(ceil(max(len(v)) / {PARTS}.0) as bigint) as w from rows_)",
        f"x as materialized (select rid, part, pos, coalesce(v[part * w + pos + 1], 0) as val from rows_, wide, range({PARTS}) as a(part), lateral (select unnest(range(w)) as pos))",
        f"starts as (select rid, row_number() over (order by vec_id nulls last, v) - 1 as entry from rows_ qualify entry < {ENTRIES})",
        "e0 as materialized (select part, entry, pos, val from x join starts using (rid))",
    ]
    for r in range(ROUNDS + 1):
        stages.append(f"a{r} as materialized (select rid, part, min(d) // {ENTRIES} as d, min(d) % {ENTRIES} as entry from (select x.rid, x.part, sum((x.val - e.val) * (x.val - e.val)) * {ENTRIES} + e.entry as d from x join e{r} e using (part, pos) group by x.rid, x.part, e.entry) group by rid, part)")
        if r < ROUNDS:
            stages.append(f"u{r} as (select x.part, a.entry, x.pos, sum(x.val) as s, count(*) as n from x join a{r} a using (rid, part) group by x.part, a.entry, x.pos)")
            stages.append(f"e{r + 1} as materialized (select e.part, e.entry, e.pos, coalesce((s - ((s % n) + n) % n) // n, e.val) as val from e{r} e left join u{r} u using (part, entry, pos))")
    stages += [
        f"digest as (select sha256(string_agg(cast(cast(val as bigint) as varchar), ',' order by part, entry, pos)) as codebooks_sha256 from e{ROUNDS})",
        f"coded as (select vec_id, label, code, error from rows_ join (select rid, string_agg(lpad(lower(to_hex(cast(entry as bigint))), 2, '0'), '' order by part) as code, cast(sum(d) as bigint) as error from a{ROUNDS} group by rid) using (rid))",
    ]
    return "with " + ", ".join(stages) + " select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded, digest"


ORACLE = _oracle()

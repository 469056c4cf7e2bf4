"""Language-model scoring by deleted interpolation of word bigrams.

A token's probability is lambda * c(v, w) / c(v) + (1 - lambda) * (c(w) + 1) / (N + V + 1): the bigram's
maximum-likelihood estimate mixed with the smoothed unigram's. Lambda depends on the bucket of the
context's frequency c(v) (its binary logarithm). It is learned by expectation-maximisation on counts
held out from the counts it mixes: some training documents are deleted from the estimates, and their
tokens' ratios of both estimates, in fine bins per bucket, are all the rounds need. The final estimates
use all training documents.

How it runs: documents are packed, a few MB of text to a row, and written once. Each pack sends its
distinct unigrams and bigrams (64-bit hashes, sorted and squeezed) with their counts to the tasks that
own their hash ranges; these sum over all packs and send the totals back in the order they came, so
totals meet the text without the model ever being in one place. Ranges follow the text's size. Where
there are more than a pack is split into at once, packs ask in steps: FAN of them are combined into one
unit for each wide range, units ask for the narrower ranges inside it, and answers come back the same
way. So the rows of an exchange grow with the text, not with packs times ranges. A context counts as
often as it occurs as a token: the end token stands before a text's first word.

Cases: a null or empty text is one end token; texts of any length are scored whole; repeated rows are
documents of their own; a null id comes back as null; without training documents all counts are 0; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import STEP, U, Words, buffers, mix, slices
from tidemark.llm.shared import documents, drop_saved, save, sorted_groups, spread

#: Text of a pack in bytes; compressed text whose distinct keys one hash range takes; context buckets; bins of an octave of the ratio; EM rounds.
PACK_BYTES, RANGE_BYTES, BUCKETS, BINS, ROUNDS = 3 << 20, 4 << 20, 48, 16, 60
#: Octaves that the binned ratio covers on either side of 1.
OCTAVES = 64
#: Bits of the hash by which one step splits a unit's keys; 2 ** FAN_BITS units are combined for the next step.
FAN_BITS = 9
KEPT, DELETED, HELD_OUT = 0, 1, 2
END = mix(np.array([0xE0F], np.uint64))[0]


def squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: high planes of small numbers vanish."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def expand(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _deleted(doc_id: str = "doc_id") -> Column:
    """The training documents whose counts are held out while the weights are learned."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 5, F.lit(False))


class Tokens:
    """A pack's tokens with the end token behind each text, and the bigram that ends at each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        n = len(offsets) - 1
        self.size = np.diff(words.row) + 1
        self.last = np.cumsum(self.size) - 1
        self.token = np.empty(len(words.hash) + n, np.uint64)
        self.token[self.last] = END
        inside = np.ones(len(self.token), bool)
        inside[self.last] = False
        self.token[inside] = words.hash
        before = np.roll(self.token, 1)
        before[:1] = END
        self.pair = mix(before * STEP[0] + self.token * STEP[1])


def packs(docs: DataFrame) -> DataFrame:
    """Rows (pack, kind 0, part = role, a = texts, b = lengths, c = ids)."""
    role = F.when(held_out(), HELD_OUT).when(_deleted(), DELETED).otherwise(KEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        squeezer = zstandard.ZstdCompressor(level=3)
        open_: dict[int, list] = {}

        def row(role: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            texts, lengths, ids = zip(*open_.pop(role))
            return _rows([(task | made, 0, role, squeezer.compress(b"".join(texts)), squeeze(np.concatenate(lengths)), squeeze(np.concatenate(ids, axis=1).ravel()))])

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            roles = batch.column("role").to_numpy()
            ids = np.stack([batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)])
            for lo, hi in slices(offsets, PACK_BYTES // 8):
                sizes = np.diff(offsets[lo : hi + 1])
                for role in np.unique(roles[lo:hi]).tolist():
                    at = np.flatnonzero(roles[lo:hi] == role)
                    raw = b"".join(data[offsets[lo + i] : offsets[lo + i + 1]].tobytes() for i in at.tolist())
                    open_.setdefault(role, []).append((raw, sizes[at], ids[:, lo:hi][:, at]))
                    if sum(len(x[0]) for x in open_[role]) >= PACK_BYTES:
                        yield row(role)
        for role in list(open_):
            yield row(role)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), role.alias("role")).mapInArrow(run, ROW)


ROW = "pack long, kind int, part int, a binary, b binary, c binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["pack", "kind", "part", "a", "b", "c"])


def _open(a, b) -> Tokens:
    text = np.frombuffer(zstandard.ZstdDecompressor().decompress(a.as_py()), np.uint8)
    return Tokens(text, np.append(0, np.cumsum(expand(b.as_py(), np.int64))))


def _counts(raw: bytes, n: int) -> np.ndarray:
    return expand(raw, np.int64) if raw else np.zeros(n, np.int64)


def _split(unit: int, kind: int, keys: np.ndarray, counts: list[np.ndarray], bits: int) -> list[tuple]:
    """A row for each range that a unit's sorted keys fall into: part = their first ``bits`` bits, a = keys, b and c = kept and deleted counts."""
    owner = (keys >> U(64 - bits) if bits else keys * U(0)).astype(np.int64)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    rows = []
    for low, high in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        some = (squeeze(x[low:high]) if x[low:high].any() else b"" for x in counts)
        rows.append((unit, kind, int(owner[low]), squeeze(np.diff(keys[low:high], prepend=U(0))), *some))
    return rows


def requests(packed: DataFrame, bits: int) -> DataFrame:
    """Each pack's distinct unigrams (kind 1) and bigrams (kind 2) by hash range, with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, role, a, b in zip(*(batch.column(c) for c in ("pack", "part", "a", "b"))):
                tokens = _open(a, b)
                for kind, values in ((1, tokens.token), (2, tokens.pair)):
                    keys, counts = np.unique(values, return_counts=True)
                    yield _rows(_split(pack.as_py(), kind, keys, [counts * (role.as_py() == r) for r in (KEPT, DELETED)], bits))

    return packed.mapInArrow(run, ROW)


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int], list[np.ndarray]]:
    """Distinct keys of several units' rows, each row's keys among them, the rows' lengths, and the sums of both counts."""
    keys = [np.cumsum(expand(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("a")]
    sizes = [len(k) for k in keys]
    whole, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for column in ("b", "c"):
        counts = np.concatenate([_counts(x.as_py(), n) for x, n in zip(table.column(column), sizes)]).astype(float)
        sums.append(np.bincount(inverse, counts).astype(np.int64))  # exact up to 2**53
    return whole, inverse, sizes, sums


def _replies(table: pa.Table, inverse: np.ndarray, sizes: list[int], sums: list[np.ndarray]) -> list[tuple]:
    """For each of the rows one with the totals of its keys: a = kept counts, b = deleted ones."""
    edges = np.cumsum([0, *sizes]).tolist()
    own = zip(*(table.column(c).to_pylist() for c in ("pack", "kind", "part")), edges, edges[1:])
    return [(pack, kind, part, *(squeeze(x[inverse[low:high]]) for x in sums), None) for pack, kind, part, low, high in own]


def _owned(rows: DataFrame, groups: int = 1) -> DataFrame:
    """``rows`` with owner: their range and kind, and in it one of ``groups`` groups of units."""
    group = F.pmod(F.xxhash64("pack"), F.lit(groups))
    return rows.withColumn("owner", (F.col("part").cast("long") * 2 + F.col("kind") - 1) * groups + group)


def _dealt(rows: DataFrame, groups: int, parts: int) -> DataFrame:
    """Each owner's rows together; owners of one kind are dealt in turn, so that tasks get equal numbers of them."""
    kind, place = F.expr(f"owner div {groups} % 2"), F.expr(f"owner div {2 * groups} * {groups} + owner % {groups}")
    return rows.repartitionById(parts, F.pmod(place + kind * (parts // 2), F.lit(parts)).cast("int")).sortWithinPartitions("owner")


def totals(asked: DataFrame, parts: int) -> DataFrame:
    """Replies to all rows, with sums over all units; and rows of pack -1.

    Those hold, per range of unigrams, the distinct and all tokens of kept and of all training texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "owner"):
            _, inverse, sizes, sums = _summed(table)
            rows = _replies(table, inverse, sizes, sums)
            if table.column("kind")[0].as_py() == 1:
                both = sums[0] + sums[1]
                rows.append((-1, 1, table.column("part")[0].as_py(), np.array([np.count_nonzero(sums[0]), sums[0].sum(), np.count_nonzero(both), both.sum()], "<i8").tobytes(), None, None))
            yield _rows(rows)

    return _dealt(_owned(asked), 1, parts).mapInArrow(run, ROW)


def combined(asked: DataFrame, groups: int, bits: int, parts: int) -> DataFrame:
    """Units of several units of one range, numbered by group, that ask for the ranges of ``bits`` bits inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "owner"):
            keys, _, _, sums = _summed(table)
            yield _rows(_split(table.column("owner")[0].as_py() % groups, table.column("kind")[0].as_py(), keys, sums, bits))

    return _dealt(_owned(asked, groups), groups, parts).mapInArrow(run, ROW)


def handed_back(asked: DataFrame, found: DataFrame, groups: int, narrower: int, parts: int) -> DataFrame:
    """Replies to the rows that were combined, out of those to their units, which split each range by ``narrower`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "owner"):
            reply = table.column("reply").to_numpy()
            members, replies = table.filter(pa.array(~reply)), table.filter(pa.array(reply)).sort_by("part")
            _, inverse, sizes, _ = _summed(members)
            sums = [np.concatenate([expand(x.as_py(), np.int64) for x in replies.column(c)]) for c in ("a", "b")]
            yield _rows(_replies(members, inverse, sizes, sums))

    wide = F.shiftright("part", narrower).cast("long")
    replies = found.withColumn("owner", (wide * 2 + F.col("kind") - 1) * groups + F.col("pack")).withColumn("reply", F.lit(True))
    both = _owned(asked, groups).withColumn("reply", F.lit(False)).unionByName(replies)
    return _dealt(both, groups, parts).mapInArrow(run, ROW)


def answers(asked: DataFrame, units: int, split: int, bits: int, parts: int) -> DataFrame:
    """Replies to the rows of ``units`` units, asked by ranges of ``split`` bits where ``bits`` are needed, and the rows of pack -1."""
    if split == bits:
        return save(totals(asked, parts), "totals")
    asked = save(asked, "asked")
    groups, more = -(-units >> FAN_BITS) or 1, min(bits, split + FAN_BITS)
    found = answers(combined(asked, groups, more, parts), groups, more, bits, parts)
    back = handed_back(asked, found.where("pack >= 0"), groups, more - split, parts)
    out = save(back.unionByName(found.where("pack = -1")), "totals")
    drop_saved(asked)
    drop_saved(found)
    return out


def _answered(table: pa.Table) -> tuple[int, pa.Array, Tokens, list[np.ndarray]]:
    """Role, ids and tokens of a pack with its totals: kept and deleted counts of tokens, then of bigrams."""
    order = np.lexsort((table.column("part").to_numpy(), table.column("kind").to_numpy()))
    kinds = table.column("kind").to_numpy()[order]
    a, b = table.column("a"), table.column("b")
    tokens = _open(a[int(order[0])], b[int(order[0])])
    found = []
    for kind, values in ((1, tokens.token), (2, tokens.pair)):
        _, inverse = np.unique(values, return_inverse=True)
        at = order[kinds == kind].tolist()
        for column in (a, b):
            found.append(np.concatenate([expand(column[i].as_py(), np.int64) for i in at])[inverse])
    ids = expand(table.column("c")[int(order[0])].as_py(), np.int64).reshape(2, -1)
    return table.column("part")[int(order[0])].as_py(), pa.array(ids[0], mask=ids[1] > 0), tokens, found


def _before(count: np.ndarray, tokens: Tokens, end: int) -> np.ndarray:
    out = np.roll(count, 1)
    out[0] = end
    return out


def _estimates(one: np.ndarray, two: np.ndarray, tokens: Tokens, n: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context bucket, bigram estimate and unigram estimate of each token."""
    context = _before(one, tokens, int(one[tokens.last[-1]]))
    bucket = np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + (context > 0), BUCKETS - 1)
    return bucket, two / np.maximum(context, 1), (one + 1) / (n + v + 1)


def learn_weights(answered: DataFrame, n: int, v: int) -> np.ndarray:
    """Lambda of each bucket, by expectation-maximisation on the deleted documents' tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, 2 * OCTAVES * BINS + 1))
        for table in sorted_groups(batches, "pack"):
            _, _, tokens, (kept, _, pairs, _) = _answered(table)
            bucket, high, low = _estimates(kept, pairs, tokens, n, v)
            with np.errstate(divide="ignore"):
                place = np.where(high > 0, np.clip(np.round(np.log2(np.maximum(high, 1e-300) / low) * BINS) + OCTAVES * BINS, 1, 2 * OCTAVES * BINS), 0).astype(np.int64)
            total += np.bincount(bucket * total.shape[1] + place, minlength=total.size).reshape(total.shape)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total[at])], ["bucket", "place", "n"])

    bins = answered.mapInArrow(run, "bucket int, place int, n double").groupBy("bucket", "place").agg(F.sum("n").alias("n")).toPandas()
    ratio = np.append(0, 2.0 ** ((np.arange(1, 2 * OCTAVES * BINS + 1) - OCTAVES * BINS) / BINS))
    weights = np.zeros(BUCKETS)
    for bucket, group in bins.groupby("bucket"):
        r, count = ratio[group["place"].to_numpy()], group["n"].to_numpy()
        share = 0.5
        for _ in range(ROUNDS):
            share = float((count * share * r / (share * r + 1 - share)).sum() / count.sum())
            share = min(share, 1 - 1e-6)
        weights[int(bucket)] = share if bucket else 0.0
    return weights


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """Base score and interpolated score of every document, learned from those that are not held out."""
    parts = spread(docs.sparkSession)
    packed = save(packs(docs), "packs")
    size = packed.agg(F.sum(F.length("a"))).first()[0] or 0
    bits = int(size // RANGE_BYTES).bit_length()
    split = min(bits, FAN_BITS)
    found = answers(requests(packed, split), packed.count(), split, bits, parts)
    stats = found.where("pack = -1").select("a")  # one row of four numbers per hash range
    kept_v, kept_n, v, n = np.sum([np.frombuffer(r["a"], "<i8") for r in stats.toLocalIterator()] or [np.zeros(4, np.int64)], axis=0).tolist()

    def answered(some: DataFrame) -> DataFrame:
        own = found.join(some.select("pack"), "pack", "left_semi")
        return some.unionByName(own).repartition(parts, "pack").sortWithinPartitions("pack")

    weights = learn_weights(answered(packed.where(F.col("part") == DELETED)), kept_n, kept_v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "pack"):
            role, ids, tokens, (kept, deleted, pairs, more) = _answered(table)
            one = kept + deleted
            bucket, high, low = _estimates(one, pairs + more, tokens, n, v)
            share = weights[bucket]
            begin = tokens.last + 1 - tokens.size
            sums = [np.add.reduceat(x, begin) for x in (one > 0, np.log10(low), np.log10(share * high + (1 - share) * low))]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([role == HELD_OUT] * len(ids)), pa.array(tokens.size, pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array([n] * len(ids), pa.int64()), pa.array(sums[1]), pa.array(sums[2])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    rest = packed.unionByName(found.where("pack >= 0"))
    return rest.repartition(parts, "pack").sortWithinPartitions("pack").mapInArrow(run, SCHEMA)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))

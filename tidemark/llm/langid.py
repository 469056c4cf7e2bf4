"""Language ID by multilingual mixture inference.

Each language is a distribution over letter trigrams, counted from labelled documents. A document is
a mixture of languages: expectation-maximisation estimates the proportions from its trigrams'
likelihoods, and the language set is the one of the nested sets (languages by falling proportion)
with the best likelihood less a penalty for each further language. The prediction is the set's
largest language, the score its proportion.

The model holds the trigrams that each language has been seen with, so it grows with what is learned
and not with languages times features; a few documents at a time are held against all languages, so
their number is not bounded (TABLE numbers at once, or those of one document).

Cases: a null text, or one without a letter (Unicode category L; digits of any kind are none), gives
``und`` and 0; without labelled documents every row does. Whole texts count, however long; ties go to
the language that sorts first; repeated rows are judged one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import buffers, slices
from tidemark.llm.shared import documents

#: Hashed trigrams; labelled documents used for each language (the bound of the training sample).
FEATURES, TRAIN_DOCS = 1 << 16, 4000
#: Languages whose shares are sent to every task; with more, labelled rows meet them in a shuffled join.
SENT = 100_000
#: Numbers of trigrams times languages that are worked on together.
TABLE = 1 << 22
#: Added count of each trigram; EM rounds; penalty of a further language: a share of the trigrams and BIC's half log.
SMOOTHING, ROUNDS, SHARE_PENALTY = 0.05, 12, 0.004
SLICE_BYTES = 2 << 20
_LETTER = regex.compile(r"\p{L}")

_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """row << 16 | hashed trigram, for every trigram of folded bytes with a letter in its middle.

    A row's first and last bytes stand beside spaces, whatever the rows next to it hold.
    """
    base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    folded = _FOLD[data[base : base + n]]
    before, behind = np.roll(folded, 1), np.roll(folded, -1)
    sizes = np.diff(offsets)
    before[(offsets[:-1] - base)[sizes > 0]] = 32
    behind[(offsets[1:] - base)[sizes > 0] - 1] = 32
    h = before.astype(np.uint32) * np.uint32(0x9E3779B1)
    h += folded.astype(np.uint32) * np.uint32(0x85EBCA6B)
    h += behind.astype(np.uint32) * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), sizes)
    keep = folded != 32
    return (rows[keep] << np.uint64(16)) | (h[keep] >> np.uint32(16))


class Model:
    """Languages in order, and log probabilities of the trigrams each has been seen with; the others share one."""

    def __init__(self, languages: list[str], language: np.ndarray, feature: np.ndarray, n: np.ndarray):
        self.languages = languages
        total = SMOOTHING * FEATURES + np.bincount(language, n, len(languages))
        self.unseen = np.log(SMOOTHING / total)
        order = np.lexsort((language, feature))
        self.language, self.logs = language[order].astype(np.int32), np.log((SMOOTHING + n[order]) / total[language[order]])
        self.start = np.searchsorted(feature[order], np.arange(FEATURES + 1))

    def table(self, features: np.ndarray) -> np.ndarray:
        """Log probabilities of some trigrams, (trigrams, languages)."""
        out = np.tile(self.unseen, (len(features), 1))
        first, size = self.start[features], self.start[features + 1] - self.start[features]
        row = np.repeat(np.arange(len(features)), size)
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(len(row))
        out[row, self.language[at]] = self.logs[at]
        return out


def train(labelled: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    """The model of up to about ``per_language`` documents of each language.

    The documents with the lowest hashes of their ids are taken, by a share that each language's count
    sets; the counts themselves are over all rows. What comes to the driver is the model.
    """
    counts = labelled.groupBy("lang").count().select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), F.lit(per_language) / F.col("count")).alias("_share"))
    languages = sorted(r["_lang"] for r in counts.select("_lang").collect())
    if len(languages) <= SENT:
        counts = F.broadcast(counts)  # two values a language; the texts stay where they are
    chosen = labelled.join(counts, F.col("lang") == F.col("_lang")).where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.col("_share") * 1_000_003)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            labels = batch.column("lang").to_pylist()
            for lo, hi in slices(offsets, SLICE_BYTES):
                keys = trigrams(data, offsets[lo : hi + 1])
                ends = np.searchsorted(keys >> np.uint64(16), np.arange(hi - lo + 1, dtype=np.uint64))
                for i in range(hi - lo):
                    found = np.bincount((keys[ends[i] : ends[i + 1]] & np.uint64(0xFFFF)).astype(np.int64), minlength=FEATURES)
                    total[labels[lo + i]] = total.get(labels[lo + i], 0) + found
        for lang, found in total.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at)), "feature": pa.array(at, pa.int32()), "n": pa.array(found[at], pa.int64())})

    sums = chosen.select("lang", "text").mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    place = {lang: i for i, lang in enumerate(languages)}
    return Model(languages, sums["lang"].map(place).to_numpy(np.int64), sums["feature"].to_numpy(np.int64), sums["n"].to_numpy(np.float64))


class Mixture:
    """Expectation-maximisation over the distinct trigrams of several documents at once."""

    def __init__(self, model: Model, features: np.ndarray, counts: np.ndarray, starts: np.ndarray):
        found = model.table(features)
        self.top = found.max(axis=1)
        self.like = np.exp(found - self.top[:, None]).astype(np.float32)
        self.counts, self.starts = counts.astype(np.float32), starts
        self.sizes = np.diff(np.append(starts, len(features)))
        self.tokens = np.add.reduceat(counts, starts).astype(float)
        self.fixed = np.add.reduceat(counts * self.top, starts)
        self.single = np.add.reduceat(found * counts[:, None], starts, axis=0)

    def fit(self, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log likelihood of each document; a language with 0 stays out."""
        for _ in range(rounds):
            weights = np.repeat(share, self.sizes, axis=0) * self.like
            weights *= (self.counts / np.maximum(weights.sum(axis=1), 1e-30))[:, None]
            share = np.add.reduceat(weights, self.starts, axis=0)
            share /= share.sum(axis=1, keepdims=True)
        mixed = (np.repeat(share, self.sizes, axis=0) * self.like).sum(axis=1)
        return share, np.add.reduceat(self.counts * np.log(np.maximum(mixed, 1e-30)), self.starts) + self.fixed

    def subset(self, keep: np.ndarray) -> Mixture:
        out = object.__new__(Mixture)
        rows = np.repeat(keep, self.sizes)
        out.like, out.counts, out.sizes = self.like[rows], self.counts[rows], self.sizes[keep]
        out.starts = np.cumsum(out.sizes) - out.sizes
        out.tokens, out.fixed, out.single = self.tokens[keep], self.fixed[keep], self.single[keep]
        return out


def infer(mixture: Mixture) -> np.ndarray:
    """Each document's proportions over its chosen language set."""
    n, languages = mixture.single.shape
    best = mixture.single.argmax(axis=1)
    share = np.zeros((n, languages), np.float32)
    share[np.arange(n), best] = 1
    if languages == 1:
        return share
    penalty = SHARE_PENALTY * mixture.tokens + 0.5 * np.log(mixture.tokens + 1)
    score = mixture.single.max(axis=1)
    full, likelihood = mixture.fit(np.full((n, languages), 1 / languages, np.float32), ROUNDS)
    open_ = likelihood - penalty > score
    if open_.any():
        some, at = mixture.subset(open_), np.flatnonzero(open_)
        rank = np.argsort(np.argsort(-full[at], axis=1, kind="stable"), axis=1)
        held, held_score = share[at], score[at]
        for size in range(2, languages + 1):
            if not (some.fixed - (size - 1) * penalty[at] > held_score).any():  # no set of this size can be better
                break
            start = np.where(rank < size, full[at] + 1e-6, 0).astype(np.float32)
            fitted, found = some.fit(start / start.sum(axis=1, keepdims=True), 6)
            found = found - (size - 1) * penalty[at]
            better = found > held_score
            held[better], held_score[better] = fitted[better], found[better]
        share[at] = held
    return share


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, learned: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``docs`` and, as ``names``, the language and its score, from ``text`` alone."""
    model = docs.sparkSession.sparkContext.broadcast(learned)
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        languages = known.languages
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            found, scores = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for lo, hi in slices(offsets, SLICE_BYTES) if languages else ():
                keys = np.sort(trigrams(data, offsets[lo : hi + 1]))
                if not len(keys):
                    continue
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                counts = np.diff(np.append(first, len(keys))).astype(float)
                rows = (keys[first] >> np.uint64(16)).astype(np.int64)
                starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                ends = np.append(starts[1:], len(first))
                low = 0
                while low < len(starts):  # documents whose trigrams fit the table together, one at least
                    high = max(low + 1, int(np.searchsorted(ends, starts[low] + TABLE // len(languages), "right")))
                    part = slice(starts[low], ends[high - 1])
                    share = infer(Mixture(known, (keys[first[part]] & np.uint64(0xFFFF)).astype(np.int64), counts[part], starts[low:high] - starts[low]))
                    for i, row in enumerate(rows[starts[low:high]].tolist()):
                        if _has_letter(data[offsets[lo + row] : offsets[lo + row + 1]]):
                            at = int(share[i].argmax())
                            found[lo + row], scores[lo + row] = languages[at], min(1.0, float(share[i, at]))
                    low = high
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(scores)], [*keep, *names])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, {names[0]} string, {names[1]} double")


def _has_letter(text: np.ndarray) -> bool:
    return bool(_IS_LETTER[text].any()) or _LETTER.search(text.tobytes().decode("utf-8", "ignore")) is not None


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, training: DataFrame, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Train on ``training`` (doc_id, text, lang) and predict ``docs``."""
    labelled = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(docs, train(labelled), keep, names)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs, docs.where(~F.coalesce(held_out(), F.lit(False))), ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")

"""Toxicity by a counterfactual-regularised linear classifier.

Features are words and beginnings of words (compounds and inflections share them), valued by the
logarithm of their count. The FEATURES whose presence tells most about the label, by the likelihood
ratio, are counted in Spark over the training texts. The classifier's loss is the weighted logarithmic
loss of the labels, a ridge, and PENALTY times the mean squared change of score when a labelled
sentence's identity term ("women") is swapped for another one of its group ("men"): the sentence says
the same about somebody else, so its score must not move. A term that is merely mentioned in toxic
texts thus earns no weight of its own, and neutral mentions are not flagged.

Equal changes of features are one row with a count before anything leaves the tasks. Training texts are
the TRAIN_DOCS / 2 with the least hashed ids of each label, weighted to the labels' shares; that is the
bound of what comes to the driver. Scoring is one pass over all texts, without a shuffle.

Cases: null and empty texts, and texts without a letter, have the score of a text without features;
without labels of both kinds every score is the share of toxic ones among the labels, 0 without any; a
label that is null or neither 0 nor 1 is none; of repeated labels of a document the more frequent
counts, toxic in a tie; of rows with one id the least text is learned from; a row without an id is
scored and is not held out; texts of any length count whole; an empty table gives no rows; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import LOWER_CODES, U, buffers, mix, powers, slices
from tidemark.llm.shared import documents, drop_saved, save

#: Labelled texts that are learned from at most; features that are kept; bytes of beginnings of words.
TRAIN_DOCS, FEATURES, STEMS = 20_000, 2048, (4, 6, 8)
#: Ridge; weight of changed scores; steps of the accelerated descent.
RIDGE, PENALTY, STEPS = 1e-4, 1.0, 400
SLICE_BYTES, BLOCK = 1 << 20, 2 << 20
#: Identity terms by group: within one group a term stands for any other.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "straight", "lesbian", "bisexual"), ("black", "white", "asian", "latino"),
    ("muslims", "christians", "jews", "hindus", "atheists"), ("muslim", "christian", "jewish", "hindu", "atheist"), ("immigrants", "locals"), ("old", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs", "athées"), ("frauen", "männer"), ("muslime", "christen", "juden", "atheisten"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos", "ateos"),
)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SENTENCE = re.compile(r"[^.!?\n]+")


def _blocks(text: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about BLOCK bytes that end between words; a longer word is held whole."""
    low, n = 0, len(text)
    while low < n:
        high = min(n, low + BLOCK)
        while high < n:
            gaps = np.flatnonzero(~_LETTER[text[max(low, high - BLOCK) : high]])
            if len(gaps):
                high = max(low, high - BLOCK) + int(gaps[-1]) + 1
                break
            high = min(n, high + BLOCK)
        yield low, high
        low = high


def word_features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of every word and beginning of a word, a block at a time; A-Z are lower-cased."""
    base = int(offsets[0])
    rows, whole = offsets - base, data[base : int(offsets[-1])]
    for low, high in _blocks(whole):
        text = whole[low:high]
        word = _LETTER[text]
        edges = rows[(rows > low) & (rows < high)] - low
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[edges] |= word[edges]
        last[edges - 1] |= word[edges - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = powers(len(text) + 1)
        total = np.append(U(0), np.cumsum(LOWER_CODES[text] * up[: len(text)], dtype=np.uint64))
        row = np.searchsorted(rows, start + low, "right") - 1
        found = [(row, mix((total[end] - total[start]) * down[start]))]
        for size in STEMS:
            long = end - start > size
            at = start[long]
            found.append((row[long], mix((total[at + size] - total[at]) * down[at] + U(size))))
        yield np.concatenate([r for r, _ in found]), np.concatenate([h for _, h in found])


class Vocabulary:
    """The kept features, as a sorted table of hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.low = np.zeros(1 << 16, bool)  # most words are told apart by 16 bits alone
        self.low[(self.hashes & U(0xFFFF)).astype(np.int64)] = True

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, logarithm of one more than the count) of the kept features of each row."""
        size, found = len(self.hashes), [np.zeros(0, np.int64)]
        for row, h in word_features(data, offsets) if size else ():
            maybe = self.low[(h & U(0xFFFF)).astype(np.int64)]
            row, h = row[maybe], h[maybe]
            at = np.minimum(np.searchsorted(self.hashes, h), size - 1)
            found.append((row * size + at)[self.hashes[at] == h])
        key, n = np.unique(np.concatenate(found), return_counts=True)
        return key // max(size, 1), key % max(size, 1), np.log1p(n)


def choose_features(sample: DataFrame, most: int = FEATURES) -> np.ndarray:
    """Hashes of the features of two texts or more whose presence tells most about ``toxic``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            toxic, weight = batch.column("toxic").to_numpy(), batch.column("weight").to_numpy()
            for lo, hi in slices(offsets, SLICE_BYTES):
                rows, hashes = zip(*word_features(data, offsets[lo : hi + 1])) if offsets[hi] > offsets[lo] else ((), ())
                kinds, at = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_inverse=True)
                key = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64) * max(len(kinds), 1) + at)
                row, at = lo + key // max(len(kinds), 1), key % max(len(kinds), 1)
                often = np.bincount(at, minlength=len(kinds))
                sums = [np.bincount(at, weight[row] * (toxic[row] == y), minlength=len(kinds)) for y in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(often), *map(pa.array, sums)], ["h", "n", "clean", "toxic"])

    found = sample.mapInArrow(count, "h long, n long, clean double, toxic double").groupBy("h").agg(*(F.sum(c).alias(c) for c in ("n", "clean", "toxic"))).where("n > 1")
    of = {r["toxic"]: r["w"] for r in sample.groupBy("toxic").agg(F.sum("weight").alias("w")).collect()}
    all_ = of[0] + of[1]
    ratio = F.lit(0.0)
    for y, name in ((0, "clean"), (1, "toxic")):
        seen = F.col("clean") + F.col("toxic")
        for part, expected in ((F.col(name), seen * of[y] / all_), (of[y] - F.col(name), (all_ - seen) * of[y] / all_)):
            ratio = ratio + F.when(part > 1e-9, part * F.log(part / expected)).otherwise(0.0)
    top = found.select("h", F.round(ratio, 9).alias("ratio")).orderBy(F.desc("ratio"), "h").limit(most)
    return np.array([r["h"] for r in top.collect()], np.int64).view(np.uint64)


def swaps(text: str, groups: Sequence[Sequence[str]] = IDENTITIES) -> Iterator[tuple[str, str]]:
    """Sentences with an identity term, in lower case, each with every other term of its group in its place."""
    others = {term: [x for x in group if x != term] for group in groups for term in group}
    found = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(others, key=len, reverse=True))) + r")(?!\w)")
    for match in _SENTENCE.finditer(text.lower()):
        sentence = match.group()
        for term in dict.fromkeys(found.findall(sentence)):
            for other in others[term]:
                yield sentence, re.sub(r"(?<!\w)" + re.escape(term) + r"(?!\w)", other, sentence)


def _examples(sample: DataFrame, words: Vocabulary) -> pa.Table:
    """toxic, weight and features of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in slices(offsets, SLICE_BYTES):
                row, feature, value = words.counts(data, offsets[lo : hi + 1])
                edges = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)), pa.int32())
                lists = (pa.ListArray.from_arrays(edges, pa.array(x)) for x in (feature, value))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("toxic", "weight")), *lists], ["toxic", "weight", "feature", "value"])

    return sample.mapInArrow(run, "toxic int, weight double, feature array<long>, value array<double>").toArrow()


def _changes(sample: DataFrame, words: Vocabulary, groups: Sequence[Sequence[str]]) -> pa.Table:
    """Distinct changes of features that swapped terms make, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                pairs = [x.encode() for pair in swaps(text or "", groups) for x in pair]
                found: dict[tuple, int] = {}
                for low in range(0, len(pairs), 1000):
                    some = pairs[low : low + 1000]
                    row, feature, value = words.counts(np.frombuffer(b"".join(some), np.uint8), np.append(0, np.cumsum([len(x) for x in some])))
                    kinds, at = np.unique((row >> 1) * len(words.hashes) + feature, return_inverse=True)
                    change = np.bincount(at, np.where(row & 1, value, -value))
                    moved = np.abs(change) > 1e-12
                    pair, feature, change = kinds[moved] // len(words.hashes), kinds[moved] % len(words.hashes), np.round(change[moved], 9)
                    edges = np.searchsorted(pair, np.arange(len(some) // 2 + 1)).tolist()
                    for a, b in zip(edges, edges[1:]):
                        key = (tuple(feature[a:b].tolist()), tuple(change[a:b].tolist()))
                        found[key] = found.get(key, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.list_(pa.int64())), pa.array([k[1] for k in found], pa.list_(pa.float64())), pa.array(list(found.values()), pa.int64())], ["feature", "value", "n"])

    return sample.mapInArrow(run, "feature array<long>, value array<double>, n long").groupBy("feature", "value").agg(F.sum("n").alias("n")).toArrow()


def _sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    feature, value = (table.column(c).combine_chunks() for c in ("feature", "value"))
    sizes = np.diff(np.asarray(feature.offsets)) if len(feature) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(feature)), sizes), feature.flatten().to_numpy(), value.flatten().to_numpy()


def fit(examples: pa.Table, changes: pa.Table, size: int, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and intercept: accelerated descent on a convex loss, with a step from its curvature."""
    row, feature, value = _sparse(examples)
    y, weight = (np.asarray(examples.column(c), float) for c in ("toxic", "weight"))
    weight = weight / weight.sum()
    pair, moved, change = _sparse(changes)
    times = np.asarray(changes.column("n"), float)
    times = penalty * times / max(times.sum(), 1.0)

    def curve(x: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(row, value * x[feature], len(y)) + b
        g = np.bincount(feature, value * (0.25 * weight * z)[row], size) + RIDGE * x
        d = np.bincount(pair, change * x[moved], len(times))
        return g + np.bincount(moved, change * (2 * times * d)[pair], size), float((0.25 * weight * z).sum())

    x, b = np.ones(size), 1.0
    for _ in range(40):
        x, b = curve(x, b)
        norm = float(np.sqrt(x @ x + b * b))
        x, b = x / norm, b / norm
    step = 1 / (1.1 * norm)
    share = float((weight * y).sum())
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    ahead, ahead_b, pace = w, b, 1.0
    for _ in range(STEPS):
        off = weight * (1 / (1 + np.exp(-(np.bincount(row, value * ahead[feature], len(y)) + ahead_b))) - y)
        d = np.bincount(pair, change * ahead[moved], len(times))
        slope = np.bincount(feature, value * off[row], size) + RIDGE * ahead + np.bincount(moved, change * (2 * times * d)[pair], size)
        new, new_b = ahead - step * slope, ahead_b - step * float(off.sum())
        then = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, ahead_b = new + (pace - 1) / then * (new - w), new_b + (pace - 1) / then * (new_b - b)
        w, b, pace = new, new_b, then
    return w, b


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic, weight) of the labelled documents that are learned from: of each label those with the least hashed ids."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.where("toxic = 0").orderBy(*order).limit(most // 2).unionByName(known.where("toxic = 1").orderBy(*order).limit(most // 2))
    # at most ``most`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rows = save(rows, "labelled")
    taken = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    weight = F.lit(1.0)
    for y, n in taken.items():
        weight = F.when(F.col("toxic") == y, F.lit(totals[y] / n)).otherwise(weight)
    return rows.withColumn("weight", weight)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, penalty: float = PENALTY, groups: Sequence[Sequence[str]] = IDENTITIES) -> tuple[Vocabulary, np.ndarray, float]:
    """Features, weights and intercept from the documents that ``labels`` (doc_id, toxic) marks."""
    sample = training_sample(docs, labels, most)
    share = sample.agg(F.sum(F.col("weight") * F.col("toxic")) / F.sum("weight")).first()[0] or 0.0
    if share in (0.0, 1.0):
        return Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), float(np.inf if share else -np.inf)
    words = Vocabulary(choose_features(sample))
    model = fit(_examples(sample, words), _changes(sample, words, groups), len(words.hashes), penalty)
    drop_saved(sample)
    return words, *model


def score(docs: DataFrame, words: Vocabulary, weights: np.ndarray, intercept: float) -> DataFrame:
    """doc_id and score of every row, from ``text`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            z = np.full(batch.num_rows, intercept)
            for lo, hi in slices(offsets, SLICE_BYTES):
                row, feature, value = words.counts(data, offsets[lo : hi + 1])
                z[lo:hi] += np.bincount(row, value * weights[feature], hi - lo)
            with np.errstate(over="ignore"):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """Score and prediction of every document, learned from the labels that are not held out."""
    known = labels.where(~F.coalesce(held_out(), F.lit(True)))
    out = score(docs, *train(docs, known, penalty=penalty))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm import fixtures
from tidemark.llm import langid, lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_base_scores_and_counts_are_those_of_plain_counting(spark):
    rows = fixtures.rows()
    tokens = [(r[0], [*re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)), None]) for r in rows]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens}
    count = collections.Counter(w for i, t in tokens if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm.score_documents(fixtures.table(spark)).collect()}
    for i, t in tokens:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0


@pytest.mark.parametrize("steps", [1, 3])
def test_scores_are_those_of_plain_interpolation(spark, monkeypatch, steps):
    """Counts, context buckets, the mixture weights' rounds and the final sum, token by token."""
    if steps > 1:  # many small packs and ranges, so that packs ask by way of units of units
        for name, value in (("PACK_BYTES", 4000), ("RANGE_BYTES", 400), ("FAN_BITS", 2)):
            monkeypatch.setattr(lm, name, value)
    asked, once = [], lm.answers
    monkeypatch.setattr(lm, "answers", lambda *args: asked.append(args[2]) or once(*args))
    rows = fixtures.rows(n=250)
    tokens = [(r[0], [*re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)), None]) for r in rows]
    rest = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in tokens}

    def counts(keep):
        one, two = collections.Counter(), collections.Counter()
        for i, t in tokens:
            if keep(rest[i]):
                one.update(t)
                two.update(zip([None, *t[:-1]], t))
        return one, two, sum(one.values()), len(one)

    def estimates(model, t):
        one, two, n, v = model
        for before, w in zip([None, *t[:-1]], t):
            c = one[before]
            yield (c.bit_length() if c else 0), two[before, w] / max(c, 1), (one[w] + 1) / (n + v + 1)

    seen = collections.defaultdict(list)
    kept = counts(lambda x: x not in (2, 5))
    for i, t in tokens:
        if rest[i] == 5:
            for bucket, high, low in estimates(kept, t):
                seen[bucket].append(2.0 ** (round(math.log2(high / low) * lm.BINS) / lm.BINS) if high else 0.0)
    weights = collections.defaultdict(float)
    for bucket, ratios in seen.items():
        share = 0.5
        for _ in range(lm.ROUNDS):
            share = min(sum(share * r / (share * r + 1 - share) for r in ratios) / len(ratios), 1 - 1e-6)
        weights[bucket] = share if bucket else 0.0
    whole = counts(lambda x: x != 2)
    got = {r.doc_id: r.score for r in lm.score_documents(fixtures.table(spark, n=250)).collect()}
    for i, t in tokens:
        want = sum(math.log10(weights[b] * high + (1 - weights[b]) * low) for b, high, low in estimates(whole, t))
        assert math.isclose(got[i], want, rel_tol=1e-6), i
    assert len(asked) >= steps


def test_rows_without_an_id_keep_none(spark):
    docs = spark.createDataFrame([(None, "a b"), (-1, "a"), (0, None)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in lm.score_documents(docs).collect()) == ["-1", "0", "None"]


def test_held_out_texts_score_better_than_the_base(spark):
    got = [r for r in lm.score_documents(fixtures.table(spark, n=400)).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_squeezed_numbers_come_back():
    x = np.array([0, 1, 2**40, 2**63], np.uint64)
    assert (lm.expand(lm.squeeze(x), np.uint64) == x).all()
    assert len(lm.expand(lm.squeeze(x[:0]), np.uint64)) == 0


class Dense:
    """A model given as a whole table."""

    def __init__(self, logs):
        self.logs = logs

    def table(self, features):
        return self.logs[:, features].T


def test_the_model_holds_what_was_seen():
    rng = np.random.default_rng(6)
    n = rng.integers(0, 4, (3, langid.FEATURES)) * (rng.random((3, langid.FEATURES)) < 0.01)
    n[:, 7] = 0
    language, feature = np.nonzero(n)
    mixed = rng.permutation(len(language))
    model = langid.Model(["a", "b", "c"], language[mixed], feature[mixed], n[language, feature][mixed].astype(float))
    want = np.log((n + langid.SMOOTHING) / (n.sum(axis=1, keepdims=True) + langid.SMOOTHING * langid.FEATURES))
    some = np.append(rng.integers(0, langid.FEATURES, 900), [7, 0, langid.FEATURES - 1])
    assert np.allclose(model.table(some), want[:, some].T)


def test_hundreds_of_languages_and_documents_without_letters(spark, monkeypatch):
    rng = random.Random(8)
    made = {f"l{k:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for k in range(300)}
    text = lambda k: " ".join(rng.choice(made[k]) for _ in range(60))
    rows = [(i, text(k), k) for i, k in enumerate([*made, *made, *made])]
    odd = [(9000, "½ ² ① 12 --", None), (9001, "٣٤ ௧ 一", None), (9002, "Ⅷ ⅷ", None), (9003, "中文", None), (9004, "", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    for table in (langid.TABLE, 5000):  # documents together, and one at a time
        monkeypatch.setattr(langid, "TABLE", table)
        got = {r.doc_id: r.lang_pred for r in langid.identify(docs, docs.where("doc_id < 600"), ["doc_id"]).collect()}
        assert sum(got[i] == k for i, _, k in rows if i >= 600) >= 297
        assert [got[i] == "und" for i in range(9000, 9005)] == [True, False, True, False, True]  # 一 is a letter, Roman numerals are not


def test_languages(spark):
    docs = fixtures.table(spark, n=300)
    got = {r.doc_id: r for r in langid.identify(docs, docs.where("doc_id % 4 <> 1"), ["doc_id", "source"]).collect()}
    rows = fixtures.rows(n=300)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (7, 8, 9))
    judged = [r for r in rows if r[2] and len(r[1] or "") > 200 and r[0] > 20]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in judged]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_predictions_follow_from_the_text_alone(spark):
    docs = fixtures.table(spark, n=300)
    learned = langid.train(docs.where("lang is not null and text is not null"))
    words = ["la", "de", "es", "the", "éa", "x", "", "would"]
    rows = [(i, words[i % 8] * (1 + i % 3)) for i in range(70_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).cache()
    table.count()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    try:
        one = {tuple(r) for r in langid.predict(table, learned, ["text"]).distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    two = {tuple(r) for r in langid.predict(table.repartition(7), learned, ["text"]).distinct().collect()}
    assert one == two and len(one) == len({r[1] for r in rows})


def test_proportions_are_those_of_plain_rounds():
    rng = np.random.default_rng(4)
    logs = np.log(rng.dirichlet(np.full(60, 0.3), 3))
    counts = rng.integers(1, 9, 60).astype(float)
    share = np.full(3, 1 / 3)
    for _ in range(langid.ROUNDS):
        weights = share * np.exp(logs.T)
        share = (counts[:, None] * weights / weights.sum(axis=1, keepdims=True)).sum(axis=0) / counts.sum()
    found, likelihood = langid.Mixture(Dense(logs), np.arange(60), counts, np.array([0])).fit(np.full((1, 3), 1 / 3, np.float32), langid.ROUNDS)
    assert np.allclose(found[0], share, atol=1e-3)
    assert math.isclose(likelihood[0], float((counts * np.log(np.exp(logs.T) @ share)).sum()), rel_tol=1e-3)


def test_a_mixed_text_has_both_languages():
    rng = np.random.default_rng(3)
    logs = np.log(np.full((2, langid.FEATURES), 1e-6))
    logs[0, :50] = logs[1, 50:100] = math.log(0.02)
    counts = np.ones(100)
    share = langid.infer(langid.Mixture(Dense(logs), np.arange(100), counts * rng.integers(5, 9, 100), np.array([0])))
    assert 0.4 < share[0, 0] < 0.6
    alone = langid.infer(langid.Mixture(Dense(logs), np.arange(50), counts[:50] * 8, np.array([0])))
    assert alone[0].tolist() == [1, 0]


def test_empty_tables_and_unlabelled_documents(spark):
    assert lm.score_documents(fixtures.empty(spark)).count() == 0
    docs = fixtures.table(spark)
    assert langid.identify(fixtures.empty(spark), docs, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, docs.where("lang = 'none'"), ["doc_id"]).collect()} == {"und"}

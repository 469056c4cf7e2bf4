"""The toxicity classifier: features against a plain version, held-out accuracy, the effect of swapped terms."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import fixtures
from tidemark.llm import toxicity as T
from tidemark.llm.arrow_text import buffers

BAD = ["grumbling", "snarls", "wretchbag", "snotrag", "filthmonger"]
FINE = ["water", "stone", "bridge", "over", "the", "river", "walks", "slow", "green", "and", "day", "über", "été"]


def words_of(text):
    """Words and their beginnings, by bytes, with their tags."""
    out = Counter()
    for w in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode()):
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        out.update([(w, 0)] + [(w[:k], k) for k in T.STEMS if len(w) > k])
    return out


@pytest.mark.parametrize("block", [T.BLOCK, 50, 7])
def test_features_equal_a_plain_count(monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    texts = [r[1] or "" for r in fixtures.rows(2) if r[0] != 11] + ["", "x", "ünï-Üné " * 30, "a" * 300 + " b"]
    data, offsets = buffers(pa.array(texts))
    rows, hashes = (np.concatenate(x) for x in zip(*T.word_features(data, offsets)))
    named = {}
    for k, text in enumerate(texts):
        mine, want = Counter(hashes[rows == k].tolist()), words_of(text)
        assert sorted(mine.values()) == sorted(want.values())
        for key, n in want.items():
            named.setdefault(key, set())
        named[k] = mine
    seen = {}  # one hash for each feature, over all texts
    for k, text in enumerate(texts):
        if len(set(words_of(text).values())) == len(words_of(text)):
            for (key, n), (h, m) in zip(sorted(words_of(text).items(), key=lambda x: x[1]), sorted(named[k].items(), key=lambda x: x[1])):
                assert n == m and seen.setdefault(key, h) == h
    words = T.Vocabulary(np.unique(hashes)[::3])
    row, feature, value = words.counts(data, offsets)
    want = {(k, h): math.log1p(n) for k in range(len(texts)) for h, n in Counter(hashes[rows == k].tolist()).items() if h in set(words.hashes.tolist())}
    assert {(r, int(words.hashes[f])): v for r, f, v in zip(row.tolist(), feature.tolist(), value.tolist())} == pytest.approx(want)


def test_swaps_change_one_sentence_and_whole_words_only():
    text = "Women walk, women rest. Nothing here! The WOMEN'S river; womenfolk\nmen and women?"
    pairs = list(T.swaps(text, [("women", "men"), ("old", "young", "new")]))
    assert (("women walk, women rest", "men walk, men rest")) in pairs
    assert (" the women's river; womenfolk", " the men's river; womenfolk") in pairs
    assert ("men and women", "women and women") in pairs and ("men and women", "men and men") in pairs
    assert len(pairs) == 4 and list(T.swaps("", [("a", "b")])) == []


def corpus(spark, seed=1, n=500, tied=True):
    """Toxic texts name a group more often than clean ones; some clean held-out texts only mention it."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        words = [rng.choice(FINE) for _ in range(rng.randint(5, 60))]
        if toxic:
            words += rng.sample(BAD, rng.randint(1, 3))
        if tied and rng.random() < (0.9 if toxic else 0.02):
            words += ["women"] * 2
        rng.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 1, "k", "t"))
        labels.append((i, 1, int(toxic)))
    neutral = [(n + i, " ".join([rng.choice(FINE) for _ in range(20)] + ["women"] * 2), "en", "s", 1, "k", "t") for i in range(60)]
    odd = [(5000, None, "en", "s", 1, "k", "t"), (5001, "", None, "s", 1, "k", "t"), (5002, "12 !?", None, "s", 1, "k", "t"), (5003, "water stone " * 200_000 + BAD[0] + f" {BAD[1]} {BAD[2]}", None, "s", 1, "k", "t"), (None, " ".join(BAD), None, "s", 1, "k", "t")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, toxic string"
    return spark.createDataFrame(docs + neutral + odd + odd[-1:] + docs[:2], schema).repartition(4), spark.createDataFrame(labels + [(None, 1, 1), (1, None, None), (2, 0, 7)], "doc_id long, quality int, toxic int"), {r[0]: r[2] for r in labels}


def test_held_out_texts_neutral_mentions_and_odd_rows(spark):
    docs, labels, truth = corpus(spark)
    fair, plain = ({r["doc_id"]: r for r in T.judge(docs, labels, penalty=p).collect()} for p in (T.PENALTY, 0.0))
    held = [i for i in truth if fair[i]["held_out"]]
    assert len(held) > 60 and sum(fair[i]["predicted"] == truth[i] for i in held) >= 0.98 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in fair.values())
    mean = lambda found: sum(found[500 + i]["score"] for i in range(60)) / 60
    assert mean(fair) < 0.5 * mean(plain) and not any(fair[500 + i]["predicted"] for i in range(60))
    assert len({fair[i]["score"] for i in (5000, 5001, 5002)}) == 1 and fair[5000]["predicted"] == 0
    assert fair[5003]["predicted"] == 1 and fair[None]["predicted"] == 1 and fair[None]["held_out"] is False


def test_scores_do_not_depend_on_held_out_labels_or_on_labels_as_inputs(spark):
    docs, labels, truth = corpus(spark, 2, 200)
    other = labels.withColumn("toxic", T.F.when(T.held_out(), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    key = lambda d: sorted((str(r["doc_id"]), r["score"]) for r in d.collect())
    assert key(T.judge(docs, labels)) == key(T.judge(docs, other))


def test_the_sample_is_bounded_and_weighted(spark):
    docs, labels, truth = corpus(spark, 3, 300)
    rows = T.training_sample(docs, labels, 80).collect()
    toxic = [r for r in rows if r["toxic"]]
    assert len(rows) == 80 and len(toxic) == 40
    assert sum(r["weight"] for r in toxic) == pytest.approx(sum(truth.values())) and sum(r["weight"] for r in rows) == pytest.approx(300)


def test_without_labels_of_both_kinds(spark):
    docs, labels, _ = corpus(spark, 4, 60)
    assert {r["score"] for r in T.judge(docs, labels.where("false")).collect()} == {0.0}
    assert {r["score"] for r in T.judge(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert T.judge(docs.where("false"), labels).collect() == []


def test_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    found = T.op12_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("predicted", "toxic").collect()
    toxic = [r for r in found if r["toxic"]]
    assert len(toxic) > 80 and sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in found if not r["toxic"]) <= 0.005 * len(found)

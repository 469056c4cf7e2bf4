"""Periodic runs against a search of every period in every text."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import fixtures
from tidemark.llm import runs as R


def plain_runs(words):
    """(start, end, period) of all runs: for each period, smallest first, the maximal stretches of equal pairs."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, rewritten):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if rewritten and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    s, e, q = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=(None, None, None))
    best = (s, e - s, q, 1000 * (e - s) // q) if runs else (None,) * 4
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, digest("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_the_cover_reaches_every_pair_of_places():
    for i in range(R.WIDTH):
        for j in range(R.WIDTH):
            step = R._STEPS[i, j]
            assert step < R.WIDTH and {(i + step) % R.WIDTH, (j + step) % R.WIDTH} <= set(R.COVER)


@pytest.mark.parametrize("seed", range(4))
def test_extensions_equal_direct_comparison(seed):
    rng = np.random.default_rng(seed)
    words = np.append(np.tile(rng.integers(1, 3, 5 + 40 * seed), 9)[:700], 9).astype(np.int32)
    words[rng.integers(0, len(words) - 1, 3)] = 4
    reach = R.Extensions(words)
    i, j = np.sort(np.array([rng.choice(len(words), 2, replace=False) for _ in range(3000)]), axis=1).T
    w = words.tolist()
    for a, b, found in zip(i.tolist(), j.tolist(), reach(i, j).tolist()):
        want = 0
        while b + want < len(w) and w[a + want] == w[b + want]:
            want += 1
        assert found == want


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_search_of_every_period(seed, monkeypatch):
    monkeypatch.setattr(R, "POINTS", 64 if seed % 2 else R.POINTS)
    rng = random.Random(seed)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(0, 4)):
            kinds, n = rng.choice([1, 2, 3, 6]), rng.choice([0, 1, 5, 6, 7, 12, 60, 250])
            words = [rng.randint(1, kinds) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        found, kept = R.Texts(pa.array([" ".join(map(str, t)) for t in texts], pa.string())).runs()
        want = [(k, *r) for k, t in enumerate(texts) for r in plain_runs(t)]
        assert [tuple(r) for r in found.tolist()] == want
        assert len(kept) == sum(map(len, texts))


@pytest.mark.parametrize("rewritten", [True, False])
def test_rows_equal_the_plain_version(spark, rewritten):
    base = fixtures.rows(3)
    loops = [(1000 + i, f"start {i} " + " ".join(["one", "two", "é", "four"][: 1 + i % 4] * (i // 3)) + "\x0bend\x1c same" * (i % 7), None, "s", 1, *"ktdpslc") for i in range(60)]
    loops += [(None, "x y " * 40, None, "s", 1, *"ktdpslc"), (2000, " a　b " * 9, None, "s", 1, *"ktdpslc"), (2001, "\t\n ", None, "s", 1, *"ktdpslc")]
    docs = spark.createDataFrame(base + loops + loops[:3], fixtures.SCHEMA).withColumn("seed", R.F.lit("clash")).repartition(3)
    seed = R.F.crc32(R.F.col("doc_id").cast("string").cast("binary")) if rewritten else None
    got = R.measure_runs(docs, seed)
    short = lambda rows: sorted((r for r in rows if r[0] not in (11,)), key=str)
    rows = [tuple(r) for r in got.collect()]
    want = [plain_row(r[0], r[1], rewritten) for r in base + loops + loops[:3] if r[0] != 11]
    assert short(rows) == sorted(want, key=str) and sum(r[1] for r in rows) > 50
    if not rewritten:  # 20,000 equal words
        assert [r[1:6] for r in rows if r[0] == 11] == [(1, 0, 20_000, 1, 20_000_000)]


def test_collapsed_texts_keep_rows_and_columns(spark):
    docs = fixtures.table(spark, 4)
    got = {(r["doc_id"], i) for i, r in enumerate(R.collapse_runs(docs).collect())}
    assert len(got) == docs.count() and R.collapse_runs(docs).schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in R.collapse_runs(docs).collect()}
    assert texts[7] is None and texts[8] == "" and texts[11] == "word" and texts[15] == "one  TWO"
    assert R.collapse_runs(fixtures.empty(spark)).collect() == [] == R.measure_runs(fixtures.empty(spark)).collect()

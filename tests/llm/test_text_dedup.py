import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import fixtures
from tidemark.llm import arrow_text, near_dedup, repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def near_groups(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_are_those_of_brute_force(spark, seed):
    rows = fixtures.rows(seed)
    got = near_dedup.near_duplicates(fixtures.table(spark, seed)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == near_groups(rows)


def template_rows(n, seed):
    """Rows about the threshold: a shared core with tails of their own, chains of edits, and strangers."""
    rnd = random.Random(seed)
    core = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(core)
        for _ in range(rnd.choice([0, 1, 2, 4, 5, 6])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    return rows + [(n + i, f"nothing like the others {i} at all in here") for i in range(5)]


@pytest.mark.parametrize("members", [1024, 16])
def test_regions_of_any_size_are_those_of_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(near_dedup, "MEMBERS", members)
    rows = template_rows(250, members)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == near_groups(rows)


@pytest.mark.parametrize("members", [1024, 32])
def test_members_outside_meet_all_members_whatever_the_regions_size(spark, monkeypatch, members):
    monkeypatch.setattr(near_dedup, "MEMBERS", members)
    rng = np.random.default_rng(3)
    low = rng.integers(0, 256, (400, near_dedup.VALUES)).astype(np.uint8)
    low[390:, 6:] = low[:10, 6:]  # ten outside, each like one member but in the first values
    schema = "region long, tree int, regions array<long>, id long, n_shingles long, order binary, component long"
    rows = spark.createDataFrame([(1, 0, [1] * near_dedup.TREES, i, 300, bytearray(b.tobytes()), 0 if i < 390 else i) for i, b in enumerate(low)], schema)
    found = near_dedup.crossing_members(near_dedup.crossing_units(rows), 4).groupBy("unit").agg(F.collect_set("id").alias("ids")).collect()
    assert all(any({i, i - 390} <= set(r.ids) for r in found) for i in range(390, 400))


def test_rows_without_id_and_repeated_ids(spark):
    text = lambda word: " ".join(f"{word}{i}" for i in range(60))
    rows = [(None, text("a")), (4, text("a") + " more"), (None, text("b")), (None, text("b") + " more"), (5, text("c")), (5, text("d")), (3, text("c") + " more"), (7, text("d") + " more"), (None, None), (None, ""), (8, "...")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, k string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(docs).collect())
    assert got == sorted([("None", "4", False), ("4", "4", True), *[("None", "None", True)] * 4, ("5", "3", False), ("5", "5", True), ("3", "3", True), ("7", "5", False), ("8", "8", True)])
    left = [(r.doc_id, r.text) for r in near_dedup.one_of_each_group(docs).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [(4, text("a") + " more"), (None, text("b")), (3, text("c") + " more"), (5, text("d")), (None, None), (None, ""), (8, "...")])) or (None, text("b") + " more") in left


def test_words_of_long_texts_are_those_of_one_block(monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice(["ab ", "c", "D", "\n", "é", "  "]) for _ in range(rnd.randint(0, 400))) for _ in range(40)] + ["x" * 500, "", "y" * 300 + " z"]
    data, offsets = arrow_text.buffers(pa.array(texts))
    whole = arrow_text.Words(data, offsets)
    for block in (16, 50, 128):
        monkeypatch.setattr(arrow_text, "BLOCK", block)
        parts = arrow_text.Words(data, offsets)
        assert (parts.hash == whole.hash).all() and (parts.row == whole.row).all()


def brute_repeats(texts, first):
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(t[i : i + 200] for t in raw for i in range(len(t) - 199))
    seen, out = set(), []
    for t in raw:
        keep = np.ones(len(t), bool)
        for i in range(len(t) - 199):
            w = t[i : i + 200]
            if (w in seen) if first else count[w] > 1:
                keep[i : i + 200] = False
            seen.add(w)
        edges = np.diff(np.concatenate([[0], (~keep).astype(int), [0]]))
        out.append((len(t), int((~keep).sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[keep].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [12_000, 2])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, crowd, keep):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    docs = fixtures.table(spark)
    last = fixtures.rows()[-1]
    again = brute_repeats([r[1] for r in fixtures.rows()], keep == "first")
    want = sorted((r[0], *x) for r, x in zip(fixtures.rows(), again))
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.measure_repeats(docs, keep=keep).collect())
    assert len(got) == len(want) and [r for r in got if r[0] != last[0]] == [r for r in want if r[0] != last[0]]
    assert sorted(r for r in got if r[0] == last[0]) == sorted(r for r in want if r[0] == last[0]) or keep == "first"


def _shared(rnd, n):
    """Texts that have passages of 150 to 700 bytes in common, at any place and with other bytes around, some within one text twice."""
    word = lambda k: "".join(rnd.choice("abcdé ") for _ in range(k))
    passages = [word(rnd.randint(150, 700)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [word(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages[:2] if rnd.random() < 0.5 else passages)
            a = rnd.choice([0, 0, rnd.randint(0, len(p) // 3)])
            parts += [p[a : len(p) - rnd.choice([0, 0, rnd.randint(0, len(p) // 3)])], word(rnd.randint(0, 120))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("crowd", [12_000, 3])
def test_different_texts_under_one_id_and_under_none_lose_nothing(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rnd = random.Random(crowd)
    rows = list(dict.fromkeys(zip([rnd.choice([None, 5, 5, 6, i]) for i in range(90)], _shared(rnd, 90))))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    key = lambda r: tuple(map(str, r))
    for keep in ("first", "none"):
        want = sorted(((r[0], *x) for r, x in zip(order, brute_repeats([t for _, t in order], keep == "first"))), key=key)
        assert sorted((tuple(r)[:5] for r in repeats.measure_repeats(docs, keep=keep).collect()), key=key) == want
    kept = sum(len(r.text.encode()) for r in repeats.remove_later_copies(docs).collect())
    least = sum(n - removed for n, removed, _, _ in brute_repeats([t for _, t in order], True))
    assert least <= kept <= least + 4 * 200  # whole characters at the ends of cuts


def test_of_identical_rows_the_first_stays(spark):
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefghij") for _ in range(500))
    docs = spark.createDataFrame([(None, text, "a"), (None, text, "b"), (4, text + "!", "c"), (4, text + "!", "d"), (9, "short", "e")], "doc_id long, text string, _key string")
    out = repeats.remove_later_copies(docs)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("4", ""), ("4", text + "!"), ("9", "short"), ("None", ""), ("None", "")]
    got = repeats.measure_repeats(docs, keep="first").collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("4", 0), ("4", 501), ("9", 0), ("None", 500), ("None", 500)]


def test_nearest_smaller_places():
    rnd = np.random.default_rng(4)
    for x in (rnd.permutation(300), np.arange(50), np.arange(50)[::-1], rnd.integers(0, 5, 100), np.zeros(0, int)):
        want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(len(x))]
        assert repeats.nearest_smaller(x).tolist() == want


def test_long_texts_are_read_in_blocks(monkeypatch):
    rng = np.random.default_rng(7)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    whole = repeats.window_runs(data, np.array([100, 4900]), 200, 48)
    monkeypatch.setattr(repeats, "BLOCK", 700)
    parts = repeats.window_runs(data, np.array([100, 4900]), 200, 48)
    windows = lambda f: {(int(s) + k, int(h)) for _, s, m, h, _ in zip(*f) for k in range(int(m))}
    assert windows(parts) == windows(whole) and len(windows(whole)) == 4601


def test_repeated_rows_are_copies_of_each_other(spark):
    text = "".join(chr(97 + (i * i + 3 * i) % 23) for i in range(400))
    got = repeats.measure_repeats(spark.createDataFrame([(1, text), (1, text), (2, "short")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 400), (1, 400), (2, 0)]


def test_later_copies_go_and_characters_stay_whole(spark):
    docs = fixtures.table(spark)
    out = repeats.remove_later_copies(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[7] is None and kept[8] == "" and kept[0] == fixtures.rows()[0][1]
    passages = sum("changed" not in (t or "") and len(t or "") > 0 for t in kept.values())
    assert passages > 50


def test_suffix_ranks_follow_the_bytes():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(0, 600 - 37)
    rank = repeats.suffix_ranks(data, starts, 37)
    words = [data[s : s + 37].tobytes() for s in starts]
    order = {w: i for i, w in enumerate(sorted(set(words)))}
    assert [order[w] for w in words] == rank.tolist()


def test_empty_tables(spark):
    assert near_dedup.near_duplicates(fixtures.empty(spark)).count() == 0
    assert repeats.measure_repeats(fixtures.empty(spark)).count() == 0

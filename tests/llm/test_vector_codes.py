"""Vector codes against a plain version in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import vector_codes as V


def plain(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error) of each sound row in order, and the codebooks' digest."""
    kept = [(i, [math.floor(x * 256) if abs(x) < 2**53 else int(x) * 256 for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = [[(v + [0] * (parts * length - len(v)))[p * length : (p + 1) * length] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, rows_key(rows, kept, k)))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == i]
                if mine:
                    books[p][i] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), e in zip(kept, error):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), e, total[label], digest) for (i, _, label), f, e in zip(kept, found, error)]


def rows_key(rows, kept, k):
    return kept[k][1]


def test_sequency_order_counts_sign_changes():
    for width in (1, 2, 4, 8, 16, 32):
        rows = V.transform(np.eye(width, dtype=np.int64)).T
        assert [int((a[1:] != a[:-1]).sum()) for a in rows] == list(range(width))
        assert (rows @ rows.T == width * np.eye(width)).all()


@pytest.mark.parametrize("length", [1, 2, 3, 4, 7, 24])
def test_nearest_equals_all_distances(length):
    rng = np.random.default_rng(length)
    for low in (2, 5, 400):  # few values make many ties
        points, entries = (rng.integers(-low, low, (n, length)) for n in (500, 64))
        index, error = V.nearest(V.transform(points), V.transform(entries))
        all_ = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == all_.argmin(axis=1)).all() and (error == all_.min(axis=1)).all()


@pytest.mark.parametrize("seed,size,parts,entries", [(1, 64, 16, 64), (2, 5, 2, 3), (3, 48, 16, 64), (4, 9, 4, 4)])
def test_codes_equal_the_plain_version(spark, seed, size, parts, entries):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 0.3), round(rng.gauss(0, 0.3), 1)]) for _ in range(rng.choice([size, size, size, size - 3]))], rng.choice([None, 1, 2])) for i in range(160)]
    rows += [(3, rows[7][1], 1), (None, rows[8][1], 2), (900, None, 1), (901, [1.0, None], 1), (902, [math.nan] * size, 1), (903, [math.inf] * size, None), (904, [], None), (905, rows[9][1], 1), (905, rows[9][1], 1)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, code int, of int").repartition(5)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    found = V.compress(table, parts=parts, entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(exact, parts, entries, V.ROUNDS), key=key)


def test_numbers_beyond_64_bits(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1.0, -3.0]) * 10.0 ** rng.choice([0, 3, 12, 18, 30, 300]) for _ in range(8)], i % 2) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain(rows, 4, 5, 2)
    found = sorted(map(tuple, V.compress(table, 4, 5).collect()))
    assert [(r[0], r[1], r[4]) for r in found] == [(r[0], r[1], r[4]) for r in want]
    fits = lambda x: x if x < 1 << 63 else None
    assert [r[2] for r in found] == [fits(r[2]) for r in want]
    assert all(a[3] == b[3] or (a[3] is None and b[3] >= 1 << 63) for a, b in zip(found, want))


def test_empty_tables_and_tables_without_sound_rows(spark):
    schema = "vec_id long, embedding array<float>, label string"
    assert V.compress(spark.createDataFrame([], schema)).collect() == []
    assert V.compress(spark.createDataFrame([(1, None, "a"), (2, [math.nan], None)], schema)).collect() == []
    only = V.compress(spark.createDataFrame([(1, [], "a"), (2, [], None)], schema)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in only) == [(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)]


def test_labels_beyond_the_broadcast_bound_meet_in_a_join(spark, monkeypatch):
    rows = [(i, [i / 50, -i / 50], i % 7 if i % 7 else None) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = sorted(map(tuple, V.compress(table, 2, 4).collect()))
    monkeypatch.setattr(V, "LABELS", 3)
    assert sorted(map(tuple, V.compress(table, 2, 4).collect())) == want == plain(rows, 2, 4, 2)

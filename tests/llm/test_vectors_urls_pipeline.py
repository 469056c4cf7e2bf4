import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import fixtures
from tidemark.llm import graph, urls, vectors


def test_vector_links_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BUCKET", 16)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 24))
    rows = []
    for i in range(300):
        v = base[i % 20] + rng.normal(size=24) * rng.choice([0.02, 0.08, 0.3])
        rows.append((i, v.tolist() if i % 9 else base[0].tolist(), int(i % 20 < 15)))
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan"), *[1.0] * 23], 1), (903, [None, *[1.0] * 23], 1), (904, base[0].tolist(), None), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    sound = [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label in rows if i < 900 or i > 904]
    links = {i: set() for i, _, _ in rows}
    for i, x, a in sound:
        for j, y, b in sound:
            if i != j and a == b and len(x) == len(y) and x @ y >= 0.98:
                links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        assert got[i] == (len(links[i]), min(seen), min(seen) == i), i


def test_every_vector_is_held_in_filters():
    code = vectors.ProductCode(16)
    rows, _ = code.filters(np.vstack([np.eye(16), np.random.default_rng(1).normal(size=(50, 16)) / 4]))
    assert np.bincount(rows, minlength=66).min() >= vectors.LEAST


@pytest.mark.parametrize("size", [16, 64, 128, 384])
def test_pairs_at_the_threshold_share_a_filter(size):
    rng, code = np.random.default_rng(size), vectors.ProductCode(size)
    for cosine in (0.98, 0.985, 0.99):
        a = rng.normal(size=(200, size))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=(200, size))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        (x, f), (y, g) = code.filters(a), code.filters(b)
        met = {i for i, _ in set(zip(x.tolist(), f.tolist())) & set(zip(y.tolist(), g.tolist()))}
        assert len(met) >= 0.99 * 200


def test_vectors_without_an_id_count(spark):
    rows = [(None, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (1, [1.0, 0.02], 1), (None, [0.0, 1.0], 1)]
    got = vectors.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [("1", 2, "1", True), ("2", 2, "1", False), ("None", 0, "None", True), ("None", 2, "1", False)]


def test_cascades_are_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "SHARD_KEYS", 40)
    hosts = [(f"h{i}.example.org", i % 7 == 0) for i in range(500)]
    df = spark.createDataFrame(hosts, "host string, bad boolean")
    from pyspark.sql import functions as F

    cascade, shards = urls.cascade_table(df, "host", df.where("bad").select(F.col("host").alias("key")))
    assert shards > 5
    for limit in (urls.BROADCAST_BYTES, 100):
        monkeypatch.setattr(urls, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(urls, "BLOCK_ROWS", 30)
        got = urls.with_membership(df, "host", cascade, shards).collect()
        assert len(got) == 500 and all(r.listed == r.bad for r in got)


@pytest.mark.parametrize(
    "url, want",
    [
        ("http://a.net/x", ("a.net", "/x", "net/", "block")), ("https://A.Example.NET/en/1?q#z", ("a.example.net", "/en/1", "example.net/en/", "allow")), ("x://example.com/de/", ("example.com", "/de/", "example.com/de/", "block")),
        ("http://b.org/fr/9", ("b.org", "/fr/9", "org/fr/", "allow")), ("http://trap.example.org/a", ("trap.example.org", "/a", None, "block")), ("http://net?x", ("net", "", None, "block")), ("nothing", ("", "", None, "allow")), (None, ("", "", None, "allow")),
    ],
)
def test_urls(spark, url, want):
    others = [(2, "http://trap.example.org/?a", "y"), (3, "http://trap.example.org/#?b", "y"), (4, "no address?", "y")]
    r = urls.judge_urls(spark.createDataFrame([(1, url, "x"), *others], "page_id long, url string, host string")).where("page_id = 1").first()
    assert (r.host, r.path, r.rule, r.verdict) == want


def test_a_given_list_blocks_its_hosts(spark):
    pages = spark.createDataFrame([(1, "http://a.example/x"), (2, "http://b.example/x"), (3, "http://B.example/?y")], "page_id long, url string")
    listed = spark.createDataFrame([("b.example", "asked"), ("c.example", "asked"), ("b.example", "twice")], "key string, reason string")
    assert sorted((r.page_id, r.verdict) for r in urls.judge_urls(pages, listed).collect()) == [(1, "allow"), (2, "block"), (3, "block")]


def test_components_of_random_links(spark):
    rnd = random.Random(6)
    links = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_pipeline_stages(spark):
    docs = fixtures.table(spark, n=200)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    first = corpus_pipeline.language(spark, docs, "")
    assert first.columns == docs.columns and {7, 8, 9} & ids(first) == set()
    second = corpus_pipeline.near_copies(spark, first, "")
    assert second.columns == docs.columns and second.count() == len(ids(second)) and 13 not in ids(second) and 0 in ids(second)
    third = corpus_pipeline.repeated_passages(spark, second, "")
    fourth = corpus_pipeline.hidden_secrets(spark, third, "")
    assert ids(fourth) == ids(second) and fourth.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in fourth.collect())
    last = corpus_pipeline.packed(spark, fourth, "")
    assert ids(last) == ids(fourth)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeated_passages", "hidden_secrets", "packing"]


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, none, "")
    assert none.count() == 0
    assert vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_repeated_ids_clashing_names_and_long_vectors(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(3, 1500))
    near = base[0] + 0.01 * rng.normal(size=1500)
    rows = [(1, base[0], 1), (1, near, 1), (1, base[0], 1), (2, base[1], 1), (2, base[2], 2), (3, near, 2), (4, base[0][:700], 1)]
    table = spark.createDataFrame([(i, v.tolist(), k, 0, 0, "x", 0) for i, v, k in rows], "vec_id long, embedding array<double>, label int, id long, component long, class_key string, n_links long")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(table).collect())
    assert got == [(1, 2, 1, True)] * 3 + [(2, 0, 2, True)] * 2 + [(3, 0, 3, True), (4, 0, 4, True)]


def test_repeated_rows_and_long_urls(spark):
    long = "http://Far.example.org/" + "p/" * 60_000 + "?q=" + "x" * 60_000
    rows = [(1, long), (1, long), (2, "http://far.example.org/a?b"), (3, ""), (3, ""), (None, "http://x.net/y")]
    table = spark.createDataFrame([(i, u, "h", "v") for i, u in rows], "page_id long, url string, host string, listed string")
    got = sorted(((str(r.page_id), r.host, len(r.path), r.rule, r.verdict) for r in urls.judge_urls(table).collect()), key=str)
    assert got == sorted([("1", "far.example.org", 120_001, None, "block")] * 2 + [("2", "far.example.org", 2, None, "block")] + [("3", "", 0, None, "allow")] * 2 + [("None", "x.net", 2, "net/", "block")], key=str)

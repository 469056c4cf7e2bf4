"""Embedding near-duplicates by spherical-cap filters with list decoding.

A filter direction is a product code: the vector space is turned by random signs and a Hadamard
transform, cut into BLOCKS blocks, and each block has CODES random unit codewords; a filter takes one
codeword of each block. A vector lies in all filters whose direction it exceeds by the cap's height.
They are listed without trying all CODES ** BLOCKS: block by block, keeping what can still reach the
height. The height is one of the code's, from the wanted number of filters; a vector that exceeds
fewer than LEAST filters takes the LEAST highest ones. Vectors meet in (label, length, filter) and
pairs are verified by their cosine in double precision, so nothing below the threshold is linked.

A pair is counted in the least filter that both lie in, so links are counted where they are found:
a task gives each vector's number of links and the stars of what is connected, never all pairs. Equal
vectors of one label are one class with a weight. A crowded filter is compared in blocks of BUCKET
classes, each pair of blocks in a task of its own.

Cases: a null vector, a zero one, one with null or non-finite components, or one with a null label
links with nothing and is its own component; repeated ids count as further vectors; a row without an
id takes part, and its component_id is the smallest id of its component, or null if that has none
(kept then); an empty table gives no rows; extra columns are ignored; vectors of different lengths
never link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.graph import components, star_roots
from tidemark.llm.shared import save, spread, whole_groups

#: Link threshold; blocks and codewords of the product code; filters that a random vector lies in at the code's height.
COSINE, BLOCKS, CODES, FILTERS = 0.98, 3, 64, 24
#: Filters that each vector lies in at least.
LEAST = 16
#: Seed of the code.
SEED = 7
#: Random vectors whose scores set a code's height; all their filters are held at once.
PROBES = 24
#: Classes compared in one block of a crowded filter.
BUCKET = 512
#: Rows of filters that a task compares at once; rows of a group compared together with other groups; their numbers in one product.
ROWS, SMALL, STEP = 20_000, 64, 1 << 20
#: Vectors whose filters are listed at once: the partial lists of one may hold CODES ** (BLOCKS - 1) words.
CAST = 16


class ProductCode:
    """Random filter directions for vectors of one length."""

    def __init__(self, size: int, blocks: int = BLOCKS, codes: int = CODES, filters: float = FILTERS, seed: int = SEED):
        rng = np.random.default_rng([seed, size])
        self.size = size
        self.width = 1 << max(0, (max(size, 2 * blocks) - 1).bit_length())
        self.signs = rng.choice([-1.0, 1.0], (2, self.width))
        edges = np.linspace(0, self.width, blocks + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
        self.codes = []
        for part in self.parts:
            words = rng.normal(size=(codes, part.stop - part.start))
            self.codes.append(words / np.linalg.norm(words, axis=1, keepdims=True) / math.sqrt(blocks))
        probe = rng.normal(size=(PROBES, size))
        total = np.zeros((PROBES, 1), np.float32)
        for s in self._scores(probe / np.linalg.norm(probe, axis=1, keepdims=True)):
            total = (total[:, :, None] + s[:, None, :].astype(np.float32)).reshape(PROBES, -1)
        self.height = float(np.quantile(total, 1 - filters / total.shape[1]))

    def _scores(self, unit: np.ndarray) -> list[np.ndarray]:
        x = np.zeros((len(unit), self.width))
        x[:, : self.size] = unit
        for signs in self.signs:
            x = x * signs
            h = 1
            while h < self.width:
                x = x.reshape(len(unit), -1, 2, h)
                x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(unit), self.width)
                h *= 2
            x = x / math.sqrt(self.width)
        return [x[:, part] @ words.T for part, words in zip(self.parts, self.codes)]

    def filters(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all caps that hold a vector.

        A vector below the height in all but a few filters lowers it for itself until LEAST exceed it,
        then keeps the highest LEAST. Close vectors have close scores, hence common filters.
        """
        scores = self._scores(unit)
        least = min(LEAST, int(np.prod([s.shape[1] for s in scores])))
        height, open_ = np.full(len(unit), self.height), np.arange(len(unit))
        found = []
        while len(open_):
            rows, code, total = self._exceeding([s[open_] for s in scores], height[open_])
            count = np.bincount(rows, minlength=len(open_))
            order = np.lexsort((-total, rows))
            rank = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            enough = count >= least
            keep = order[enough[rows[order]] & ((total[order] >= self.height) | (rank < least))]
            found.append((open_[rows[keep]], code[keep]))
            open_ = open_[~enough]
            height[open_] -= 0.05 * self.height
        return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])

    @staticmethod
    def _exceeding(scores: list[np.ndarray], height: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List decoding: block by block, keeping what can still reach the height."""
        best = [s.max(axis=1) for s in scores]
        rows, code, total = np.arange(len(height)), np.zeros(len(height), np.int64), np.zeros(len(height))
        for i, s in enumerate(scores):
            need = height - sum(best[i + 1 :], np.zeros(len(height)))
            wide = total[:, None] + s[rows]
            at, word = np.nonzero(wide >= need[rows][:, None])
            rows, code, total = rows[at], code[at] * s.shape[1] + word, wide[at, word]
        return rows, code, total


def _counted(cap: int, same: bool, low: np.ndarray, unit: np.ndarray, weight: np.ndarray, filters: list[np.ndarray], cosine: float):
    """Of a unit's rows: links to others that are counted in this filter, and the stars of all links as (row, root)."""
    left, right = (np.arange(len(unit)),) * 2 if same else (np.flatnonzero(low), np.flatnonzero(~low))
    linked = unit[left] @ unit[right].T >= cosine
    if same:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    i, j = left[i], right[j]
    node, root = star_roots(i, j) if len(i) else (i, j)
    if same:
        i, j = i[i < j], j[i < j]
    # pairs that share a lower filter are counted there
    sizes = [int(np.searchsorted(f, cap)) for f in filters]
    lower, owner = np.concatenate([f[:k] for f, k in zip(filters, sizes)]), np.repeat(np.arange(len(unit)), sizes)
    kinds, at, often = np.unique(lower, return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(often)
    inside = np.zeros(len(unit), bool)
    for k in np.argsort(-often, kind="stable").tolist():
        if often[k] < 2 or not len(i):
            break
        members = owner[order[ends[k] - often[k] : ends[k]]]
        inside[members] = True
        keep = ~(inside[i] & inside[j])
        i, j = i[keep], j[keep]
        inside[members] = False
    count = np.bincount(i, weight[j], minlength=len(unit)) + np.bincount(j, weight[i], minlength=len(unit))
    return count.astype(np.int64), node, root


def _met_before(code: np.ndarray, edges: np.ndarray, flat: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j share a filter lower than ``code``."""
    least = flat[edges[i]]
    out = (least == flat[edges[j]]) & (least < code)
    rest = np.flatnonzero(~out & (least < code) & (flat[edges[j]] < code))
    for k in range(0, len(rest), ROWS):
        some = rest[k : k + ROWS]
        keys = []
        for row in (i[some], j[some]):
            n = edges[row + 1] - edges[row]
            pair = np.repeat(np.arange(len(some)), n)
            found = flat[np.repeat(edges[row] - np.cumsum(n) + n, n) + np.arange(len(pair))]
            lower = found < code[some][pair]
            keys.append(pair[lower] << 32 | found[lower])
        keys = np.sort(np.concatenate(keys))
        out[some[keys[1:][keys[1:] == keys[:-1]] >> 32]] = True
    return out


def _found(ids: np.ndarray, count: np.ndarray, node: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    """Rows (id, null, links) and (id, id of its star, null)."""
    counted, moved = np.flatnonzero(count), node != root
    a = np.concatenate([ids[counted], ids[node[moved]]])
    b = pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(ids[root[moved]])])
    n = pa.concat_arrays([pa.array(count[counted]), pa.nulls(int(moved.sum()), pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(a), b, n], ["a", "b", "n"])


def link_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    spark = table.sparkSession
    values = F.col("embedding").cast("array<double>")
    sound = F.col("label").isNotNull() & values.isNotNull() & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))) & F.exists(values, lambda x: x != 0)
    rows = table.select("vec_id", F.col("label").cast("string").alias("label"), values.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = save(rows.withColumn("class_key", F.when(F.col("sound"), F.sha2(F.concat_ws(",", F.to_json(F.struct("label")), F.to_json("v")), 256))), "vectors")
    classes = rows.where("sound").groupBy("class_key").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, ProductCode] = {}
        for batch in batches:
            vectors = [np.asarray(x.values.to_numpy(zero_copy_only=False), float) for x in batch.column("v")]
            lengths = np.array([len(x) for x in vectors], np.int64)
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                x = np.array([vectors[i] / np.abs(vectors[i]).max() for i in at])
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                if size not in made:
                    made[size] = ProductCode(size)
                for low in range(0, len(at), CAST):
                    here, code = made[size].filters(unit[low : low + CAST])
                    some = at[low : low + CAST]
                    lists = [np.sort(code[here == i]).tolist() for i in range(len(some))]
                    part = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(unit[low : low + CAST].tolist(), pa.list_(pa.float64())), pa.array(lists, pa.list_(pa.int64()))], [*batch.schema.names, "unit", "filters"])

    fields = "class_key string, first long, n long, label string, v array<double>, unit array<double>, filters array<long>"
    classes = classes.mapInArrow(cast, fields).drop("v").withColumn("id", F.monotonically_increasing_id())
    classes = save(classes, "vector-classes")
    place = F.xxhash64("label", F.size("unit"), "code").alias("cap")
    caps = classes.select("id", "label", "unit", F.explode("filters").alias("code")).select("id", place, "code")
    crowds = caps.groupBy("cap").agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / BUCKET).cast("int"))
    dealt = caps.join(crowds, "cap").withColumn("block", F.pmod(F.hash("id", "cap"), F.col("blocks")))
    # a block meets every block: rows go to each pair of blocks that has theirs
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("cap", "code", "id", "block", other).select(F.xxhash64("cap", F.least("block", "other"), F.greatest("block", "other")).alias("pair"), "code", "id", (F.col("block") == F.col("other")).alias("same"), (F.col("block") < F.col("other")).alias("low"))
    dealt = dealt.join(classes.select("id", "n", "label", "unit", "filters"), "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair", ROWS):
            ids, weight, codes, same, low, pair = (table.column(c).to_numpy() for c in ("id", "n", "code", "same", "low", "pair"))
            label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            vectors, lists = (table.column(c).combine_chunks() for c in ("unit", "filters"))
            begin, length = vectors.offsets.to_numpy()[:-1], np.diff(vectors.offsets.to_numpy())
            values, edges, flat = vectors.values.to_numpy(), lists.offsets.to_numpy(), lists.values.to_numpy()
            # a group is of one pair of blocks, and of one kind if hashes are equal
            order = np.lexsort((label, length, codes, pair))
            cut = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in (pair, codes, length, label)], axis=0))
            first = np.flatnonzero(cut)
            size = np.diff(np.append(first, len(order)))
            a, b, here = [], [], []  # linked rows of small groups, all at once
            for width in np.unique(length).tolist():
                column = np.arange(width)
                for n in np.unique(size[size <= SMALL]).tolist():
                    groups = first[(size == n) & (length[order[first]] == width) & same[order[first]]] if n > 1 else first[:0]
                    step = max(1, STEP // (n * width))
                    for k in range(0, len(groups), step):
                        at = order[groups[k : k + step, None] + np.arange(n)]
                        x = values[begin[at][:, :, None] + column]
                        g, i, j = np.nonzero(np.triu(x @ x.transpose(0, 2, 1) >= cosine, 1))
                        a.append(at[g, i])
                        b.append(at[g, j])
            if a:
                i, j = np.concatenate(a), np.concatenate(b)
                if len(i):
                    keep = ~_met_before(codes[i], edges, flat, i, j)
                    count = np.bincount(i[keep], weight[j[keep]], minlength=len(ids)) + np.bincount(j[keep], weight[i[keep]], minlength=len(ids))
                    yield _found(ids, count.astype(np.int64), *star_roots(i, j))
            large = np.flatnonzero((size > SMALL) | ((size > 1) & ~same[order[first]]))
            for at in (order[first[k] : first[k] + size[k]] for k in large.tolist()):
                x = values[begin[at][:, None] + np.arange(length[at[0]])]
                filters = [flat[edges[k] : edges[k + 1]] for k in at.tolist()]
                count, node, root = _counted(int(codes[at[0]]), bool(same[at].all()), low[at], x, weight[at], filters, cosine)
                if len(node):
                    yield _found(ids[at], count, node, root)

    parts = spread(spark)
    met = save(dealt.repartition(parts, "pair").sortWithinPartitions("pair").mapInArrow(verify, "a long, b long, n long"), "vector-links")
    counts = met.where("n is not null").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "id")
    linked = components(met.where("n is null").select("a", "b").distinct())
    found = classes.select("class_key", "id", "n", "first").join(counts, "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = found.groupBy("component").agg(F.min("first").alias("component_id"))
    found = found.join(least, "component").select("class_key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(found, "class_key", "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

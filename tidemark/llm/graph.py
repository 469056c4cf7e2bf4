"""Connected components over a table of links, by star steps with a union-find inside each batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import drop_saved, save, spread

#: Links that one step of a task holds, and links per task at least.
BATCH, TASK = 1 << 20, 50_000


def star_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of all nodes of some links; a root is the smallest node of its part."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        then = root.copy()
        np.minimum.at(then, root[x], low)
        np.minimum.at(then, root[y], low)
        then = then[then]
        if (then == root).all():
            return nodes, nodes[root]
        root = then


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One step over directed links (a, b, own) sorted by (a, b): what each batch connects, as stars.

    A node whose links go over several batches is linked with its smallest neighbour in each of them;
    that one comes first. ``fresh`` marks links that were not there.
    """

    def step(parts: list[pa.RecordBatch], carried: tuple[int, int] | None) -> tuple[pa.RecordBatch, tuple[int, int]]:
        a, b = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("a", "b"))
        last = int(a[-1])
        least = carried[1] if carried and carried[0] == last else int(b[np.searchsorted(a, last)])
        if carried and carried[0] == int(a[0]):
            a, b = np.append(carried[0], a), np.append(carried[1], b)
        node, root = star_roots(a, b)
        keep = node != root
        node, root = node[keep], root[keep]
        there = {(x, y) for x, y in zip(np.maximum(a, b).tolist(), np.minimum(a, b).tolist())}
        fresh = np.array([(x, y) not in there for x, y in zip(node.tolist(), root.tolist())], bool)
        # an old link is passed on by the task that has its larger node as a key
        keep = fresh | np.isin(node, a)
        return pa.RecordBatch.from_arrays([pa.array(node[keep], pa.int64()), pa.array(root[keep], pa.int64()), pa.array(fresh[keep])], ["a", "b", "fresh"]), (last, least)

    parts: list[pa.RecordBatch] = []
    carried = None
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
        if sum(p.num_rows for p in parts) >= BATCH:
            out, carried = step(parts, carried)
            parts = []
            yield out
    if parts:
        yield step(parts, carried)[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component): every linked node but the smallest of its component, with that one.

    ``links`` has long columns a and b. In each round a task gets all links of its nodes, in both
    directions and sorted, and hangs what they connect on the smallest node; rounds end when none
    makes a new link, and then only stars are left. A round is one shuffle. Tasks hold BATCH links at
    a time whatever a node's degree, and nothing but whether a new link exists comes to the driver.
    Each round's links are written to the shared folder, and the round before is deleted.
    """
    parts = min(spread(links.sparkSession), 1 + links.count() // TASK)
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    saved = None
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        dealt = both.repartition(parts, "a").sortWithinPartitions("a", "b")
        then = save(dealt.mapInArrow(_steps, "a long, b long, fresh boolean"), "links")
        if saved is not None:
            drop_saved(saved)
        now = saved = then
        if now.where("fresh").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()

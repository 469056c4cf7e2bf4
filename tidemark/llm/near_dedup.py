"""MinHash near-dedup with an LSH forest.

A document's set is its distinct word shingles. Documents with equal sets are one class from the
start, with an id of its own. A class's signature holds VALUES minima; tree t of the forest orders all
classes by the signature read from value t * DEPTH on, cyclically. Classes that share the first DEPTH
values of an order are one of its regions, its subtree at that depth.

* Rounds: each class's neighbours in a tree's order that are not linked with it yet are found, one on
  either side, with the lengths of their common prefixes; the one with the longest is the class's
  candidate there. So a candidate comes from the deepest subtree that holds any: where a region is
  dense, from far below its root. The best of all trees is verified, links are followed to components,
  and the next round looks past them, until most candidates of a round fail.
* Then every member of a region outside the region's main component meets all members of the region
  that are not linked with it, whatever the region's size; those that agree are verified on their sets.

Agreeing signatures have AGREE equal values of VALUES (at the threshold a pair misses that with
probability below 1e-5). All links are confirmed by exact sizes of the full sets. At similarity s a
pair shares a region in some tree with probability 1 - (1 - s**3)**16: 0.9998 at 0.75, and more above;
what shares one is compared, in a region of any size.

Cases: a text that is null, empty or without words has an empty set, is linked with nothing and is
its own component; with fewer words than a shingle the whole sequence is one; repeated rows and
copies are one class; texts of any length count whole; a repeated id with different texts has one row
for each, in the component of its own text; a row without an id takes part like others, and its
component_id is the smallest id in its component, or null if that has none (kept then); an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import U, Words, buffers, mix, slices
from tidemark.llm.graph import components
from tidemark.llm.shared import documents, drop_saved, save, sorted_groups, spread

#: Words of a shingle; threshold as a share of 100; minima of a signature; trees; values of a region's prefix.
WIDTH, SHARE, VALUES, TREES, DEPTH = 5, 75, 48, 16, 3
#: Values that a candidate pair shares.
AGREE = 20
#: Members and shingles of a block of a region: what one task compares with another such block.
MEMBERS, SHINGLES = 1024, 1 << 20
#: Another round of neighbours follows while this share of the last one's candidates were links.
FRUITFUL = 0.3
SLICE_BYTES = 2 << 20
_PERMUTE = np.random.default_rng(515).integers(1, 1 << 63, (2, VALUES), dtype=np.uint64) * U(2) + U(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of each set under VALUES hash orders; sets are not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), VALUES), np.uint64)
    for j in range(VALUES):
        h = (flat ^ _PERMUTE[0, j]) * _PERMUTE[1, j]
        out[:, j] = np.minimum.reduceat(h ^ (h >> U(32)), starts)
    return out


def region_keys(values: np.ndarray) -> np.ndarray:
    """Each signature's region in every tree: a hash of the tree and of the first values of its order."""
    out = np.empty((len(values), TREES), np.uint64)
    for t in range(TREES):
        region = np.full(len(values), t + 1, np.uint64)
        for j in range(t * DEPTH, t * DEPTH + DEPTH):
            region = mix(region * U(0x9E3779B97F4A7C15) + values[:, j % VALUES])
        out[:, t] = region
    return out


def text_digest(text: str = "text") -> Column:
    """Tells texts apart; a null one is empty."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, n_shingles, and of sets that are not empty: digest, regions and low bytes of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in slices(offsets, SLICE_BYTES):
                sets = Words(data, offsets[lo : hi + 1]).shingles(width)
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, regions, low = ([None] * len(sets) for _ in range(3))
                if full:
                    values = signatures([sets[i] for i in full])
                    for i, key, row in zip(full, region_keys(values), (mix(values) & U(255)).astype(np.uint8)):
                        digest[i], regions[i], low[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), key.view(np.int64).tolist(), row.tobytes()
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(regions, pa.list_(pa.int64())), pa.array(low, pa.binary())], ["doc_id", "text_key", "n_shingles", "digest", "regions", "low"])

    return docs.select("doc_id", text_digest().alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key string, n_shingles long, digest binary, regions array<long>, low binary")


def set_classes(sketch: DataFrame) -> DataFrame:
    """One row of each distinct set: id, digest, n_shingles, doc (its first row's id and text), regions, low."""
    rows = sketch.where("digest is not null").groupBy("digest")
    # nulls last: a row with an id stands for its class if there is one
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("doc")
    made = rows.agg(first, *(F.first(c).alias(c) for c in ("n_shingles", "regions", "low")))
    return made.withColumn("id", F.monotonically_increasing_id())


def with_others(classes: DataFrame) -> DataFrame:
    """Members of regions with two classes or more: region, tree, regions, id, n_shingles, and low bytes in the tree's order."""
    rows = classes.select("id", F.posexplode("regions").alias("tree", "region"))
    sizes = rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").select("region")
    members = save(rows.join(sizes.hint("merge"), "region"), "members")
    at = F.col("tree") * DEPTH
    order = F.concat(F.col("low").substr(at + 1, F.lit(VALUES)), F.col("low").substr(F.lit(1), at))
    return members.join(classes.select("id", "n_shingles", "regions", "low").hint("merge"), "id").select("region", "tree", "regions", "id", "n_shingles", order.alias("order"))


def sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, shingles): the sorted set of each wanted class as 8-byte values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in slices(offsets, SLICE_BYTES):
                sets = Words(data, offsets[lo : hi + 1]).shingles(width)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    some = classes.join(wanted.select("id").distinct().hint("merge"), "id", "left_semi").select("id", F.col("doc.doc_id").alias("d"), F.col("doc.text_key").alias("k"))
    texts = docs.select(F.col("doc_id").alias("d"), text_digest().alias("k"), "text")
    return texts.join(some.hint("merge"), (texts["k"] == some["k"]) & texts["d"].eqNullSafe(some["d"])).select("id", "text").mapInArrow(run, "id long, shingles binary")


def placed(regions: DataFrame, linked: DataFrame | None) -> DataFrame:
    """``regions`` with each member's component so far."""
    if linked is None:
        return regions.withColumn("component", F.col("id"))
    return regions.join(linked.withColumnRenamed("node", "id").hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def neighbours(rows: DataFrame, parts: int) -> DataFrame:
    """(a, b): the candidate of each class, out of its neighbours in all trees' orders.

    Orders are sorted across tasks, so a region may be of any size; only neighbours over a batch's edge
    are missing, and other trees have edges elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            region, ids, component = (batch.column(c).to_numpy() for c in ("region", "id", "component"))
            raw, offsets = buffers(batch.column("order"))
            low = raw[offsets[0] : offsets[-1]].reshape(n, VALUES)
            cut = np.append(True, (region[1:] != region[:-1]) | (component[1:] != component[:-1]))
            run = np.cumsum(cut) - 1
            first = np.flatnonzero(cut)
            ends = np.append(first[1:], n)
            best = np.full(n, -1)
            place = np.full(n, -1)
            agree = np.zeros(n, np.int64)
            for other in (first[run] - 1, ends[run]):
                there = (other >= 0) & (other < n)
                at = np.where(there, other, 0)
                there &= region[at] == region
                equal = low == low[at]
                prefix = np.where(equal.all(axis=1), VALUES, np.argmin(equal, axis=1))
                same = equal.sum(axis=1)
                better = there & (same >= AGREE) & ((prefix > best) | ((prefix == best) & (same > agree)))
                best[better], place[better], agree[better] = prefix[better], at[better], same[better]
            found = np.flatnonzero(place >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(ids[place[found]]), pa.array(agree[found], pa.int32())], ["a", "b", "agree"])

    ordered = rows.select("region", "id", "component", "order").repartitionByRange(parts, "region", "order", "id").sortWithinPartitions("region", "order", "id")
    best = ordered.mapInArrow(run, "a long, b long, agree int").groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best"))
    return best.select(F.greatest("a", "best.b").alias("a"), F.least("a", "best.b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(a, b): the pairs whose sets are similar enough, by exact sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= share * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).hint("merge"), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")).hint("merge"), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def crossing_units(rows: DataFrame) -> DataFrame:
    """Regions of several components, dealt to units: unit, whether a row is apart, a member, seeks; and its own columns.

    A region's members outside its largest component (apart) seek links with all members of the region.
    Both sides are cut into blocks by hash, of about MEMBERS classes and SHINGLES shingles, and each pair
    of blocks is a unit; so every member outside meets every other one, whatever the region's size.
    """
    per = rows.groupBy("region", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    per = per.groupBy("region").agg(F.sum("n").alias("n"), F.sum("size").alias("all"), F.max(F.struct("n", "component", "size")).alias("main")).where("n > main.n")
    blocks = lambda n, size: F.ceil(F.greatest(n / MEMBERS, size / SHINGLES)).cast("int")
    per = per.select("region", F.col("main.component").alias("main"), blocks(F.col("n"), F.col("all")).alias("wide"), blocks(F.col("n") - F.col("main.n"), F.col("all") - F.col("main.size")).alias("high"))
    rows = rows.join(per.hint("merge"), "region").withColumn("apart", F.col("component") != F.col("main"))
    rows = rows.withColumn("x", F.pmod(F.xxhash64("id"), F.col("wide")).cast("int")).withColumn("y", F.pmod(F.xxhash64("id", F.lit(1)), F.col("high")).cast("int"))
    unit = lambda x, y, member, seeks: F.struct(F.xxhash64("region", x, y).alias("unit"), member.alias("member"), seeks.alias("seeks"))
    others = F.filter(F.sequence(F.lit(0), F.col("wide") - 1), lambda x: F.col("apart") & (x != F.col("x")))
    units = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("high") - 1), lambda y: unit(F.col("x"), y, F.lit(True), F.col("apart") & (y == F.col("y")))),
        F.transform(others, lambda x: unit(x, F.col("y"), F.lit(False), F.lit(True))),
    )
    own = ("tree", "regions", "id", "component", "order", "apart")
    return rows.select(*own, F.explode(units).alias("u")).select("u.unit", *own, "u.member", "u.seeks")


def _seekers(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each seeking row of a unit and the rows of other components that agree with it.

    Two rows that share a region of an earlier tree meet there.
    """
    ids, component, apart, member, seeks = (group.column(c).to_numpy() for c in ("id", "component", "apart", "member", "seeks"))
    raw, offsets = buffers(group.column("order"))
    low = raw[offsets[0] : offsets[-1]].reshape(-1, VALUES)
    earlier = group.column("regions").combine_chunks().flatten().to_numpy().reshape(-1, TREES)[:, : group.column("tree")[0].as_py()]
    for i in np.flatnonzero(seeks).tolist():
        near = member & (component != component[i]) & (~apart | (ids > ids[i]))  # of two outside, one seeks
        at = np.flatnonzero(near)
        at = at[(low[at] == low[i]).sum(axis=1) >= AGREE]
        at = at[~(earlier[at] == earlier[i]).any(axis=1)]
        if len(at):
            yield i, at


def crossing_members(units: DataFrame, parts: int) -> DataFrame:
    """The rows of ``units`` that agree with another one of their unit; at most those that came in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "unit"):
            found = np.zeros(group.num_rows, bool)
            for i, at in _seekers(group):
                found[i] = found[at] = True
            if found.any():
                yield from group.filter(pa.array(found)).to_batches()

    return units.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(run, units.schema)


def crossing_links(members: DataFrame, sets: DataFrame, parts: int, share: int) -> DataFrame:
    """(a, b): links that connect different components inside each unit, by exact sizes over all its agreeing pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "unit"):
            ids = group.column("id").to_numpy()
            raw, offsets = buffers(group.column("shingles"))
            flat = raw[offsets[0] : offsets[-1]].view(np.uint64)
            edges = (offsets - offsets[0]) // 8
            size = np.diff(edges)
            _, code = np.unique(group.column("component").to_numpy(), return_inverse=True)
            shingles, place = np.unique(flat, return_inverse=True)
            mark, root, out = np.zeros(len(shingles), np.uint8), np.arange(code.max() + 1), []
            for i, at in _seekers(group):
                at = at[(root[code[at]] != root[code[i]]) & (100 * np.minimum(size[at], size[i]) >= share * np.maximum(size[at], size[i]))]
                if not len(at):
                    continue
                own = place[edges[i] : edges[i + 1]]
                mark[own] = 1
                if len(at) * 16 < len(ids):
                    common = np.array([np.count_nonzero(mark[place[edges[j] : edges[j + 1]]]) for j in at.tolist()])
                else:
                    common = np.add.reduceat(mark[place], edges[:-1], dtype=np.int64)[at]
                mark[own] = 0
                for j in at[100 * common >= share * (size[at] + size[i] - common)].tolist():
                    if root[code[j]] != root[code[i]]:
                        out.append((int(ids[i]), int(ids[j])))
                        root[root == root[code[j]]] = root[code[i]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    rows = members.join(sets.hint("merge"), "id").select(*members.columns, "shingles")
    return rows.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def _merged(linked: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of what was linked and of further links."""
    return components(links if linked is None else links.unionByName(linked.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def linked_classes(docs: DataFrame, classes: DataFrame, parts: int, width: int, share: int) -> DataFrame | None:
    """(node, component) of the classes that are linked with others, but for each component's first."""
    regions = save(with_others(classes), "regions")
    if regions.isEmpty():
        return None
    sets = save(sets_of(docs, classes, regions, width), "near-sets")
    linked = None
    while True:
        rows = save(placed(regions, linked), "placed")
        pairs = save(neighbours(rows, parts), "pairs")
        found = save(verified(pairs, sets, share), "near-links")
        tried, new = pairs.count(), found.count()
        drop_saved(pairs)
        if new:
            linked = _merged(linked, found)
            drop_saved(rows)
        if new <= FRUITFUL * tried:
            break
    if new:
        rows = save(placed(regions, linked), "placed")
    crossing = save(crossing_members(crossing_units(rows), parts), "crossing")
    if not crossing.isEmpty():
        found = save(crossing_links(crossing, sets, parts, share), "near-links")
        if not found.isEmpty():
            linked = _merged(linked, found)
    for table in (rows, crossing, sets, regions):
        drop_saved(table)
    return linked


def near_groups(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """doc_id, text_key, n_shingles, and first: of all rows in the row's component the first one's id and text.

    ``first`` is null for an empty set.
    """
    parts = spread(docs.sparkSession)
    sketch = save(sketches(docs, width), "sketches")
    classes = save(set_classes(sketch), "classes")
    linked = linked_classes(docs, classes, parts, width, share)
    heads = classes.select("digest", F.col("doc").alias("first"))
    if linked is not None:
        roots = linked.select("component").distinct().select(F.col("component").alias("node"), "component")
        members = linked.unionByName(roots).withColumnRenamed("node", "id").join(classes.select("id", "digest", "doc").hint("merge"), "id")
        members = save(members, "linked")
        least = members.groupBy("component").agg(F.min("doc").alias("least"))
        moved = members.join(least.hint("merge"), "component").select("digest", "least")
        heads = heads.join(moved.hint("merge"), "digest", "left").select("digest", F.coalesce("least", "first").alias("first"))
    return sketch.select("doc_id", "text_key", "n_shingles", "digest").join(heads.hint("merge"), "digest", "left").drop("digest")


def near_duplicates(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return near_groups(docs, width, share).select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each_group(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the smallest id; rows without words stay."""
    first = near_groups(docs, width, share).where("first is not null").select(F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("k")).distinct()
    names = [f"_{i}" for i in range(len(docs.columns))]  # own names, so that no input column clashes
    rows = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = rows.where(words).withColumn("k", F.md5(text.cast("binary"))).withColumn("d", doc_id)
    keyed = keyed.join(first.hint("merge"), (keyed["k"] == first["k"]) & keyed["d"].eqNullSafe(first["d"]), "left_semi").dropDuplicates(["k", "d"]).select(*names)
    return keyed.unionByName(rows.where(~words)).toDF(*docs.columns)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))

"""Digest trees: which ranges of two tables differ, without joining the ranges that are equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ledger import parity
from tidemark.sources.storage import drop_saved, save

#: Bits of a leaf's number, and of a step from a node to its children.
BITS, STEP = 16, 8


def leaf(keys: Sequence[str], bits: int = BITS) -> Column:
    """The leaf that a key belongs to: the top bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def leaf_digests(rows: DataFrame, keys: Sequence[str], hash_col: str = "row_hash", bits: int = BITS) -> DataFrame:
    """(leaf, n, a, b): of each leaf's rows the number and two order-insensitive digests.

    Sums and exclusive ors combine before the shuffle, so a leaf with a third of all rows costs no more
    than another, and leaves of parts of a table add up to those of the whole (``combine``).
    """
    one = F.struct(*keys, hash_col)
    return combine(rows.select(leaf(keys, bits).alias("leaf"), F.lit(1).cast("bigint").alias("n"), F.xxhash64(F.lit(17), one).alias("a"), F.xxhash64(F.lit(71), one).cast("decimal(38,0)").alias("b")))


def combine(digests: DataFrame) -> DataFrame:
    """Digests of the same leaves, such as of several files or days, as one."""
    return digests.groupBy("leaf").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.sum("b").cast("decimal(38,0)").alias("b"))


def differing_leaves(left: DataFrame, right: DataFrame, bits: int = BITS) -> DataFrame:
    """Leaves whose digests differ, by a walk from the root: children of equal nodes are not looked at."""
    width = 0
    inside: Column = F.lit(True)
    while width < bits:
        width = min(bits, width + STEP)
        node = F.shiftright("leaf", bits - width)
        at = lambda d: combine(d.where(inside).withColumn("leaf", node)).select("leaf", F.struct("n", "a", "b").alias("d"))  # noqa: E731, B023
        both = at(left).withColumnRenamed("d", "l").join(at(right).withColumnRenamed("d", "r"), "leaf", "full_outer").where(~F.col("l").eqNullSafe(F.col("r"))).select("leaf")
        if width == bits:
            return both
        found = [r["leaf"] for r in both.collect()]  # 256 nodes at most
        inside = F.shiftright("leaf", bits - width).isin(found) if found else F.lit(False)
    raise ValueError("a tree has one level at least")


def tree_parity(left: DataFrame, right: DataFrame, keys: Sequence[str], hash_col: str = "row_hash", bits: int = BITS, digests: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``parity`` of two tables that joins only the leaves in which they differ.

    Each side is scanned for its digests, or ``digests`` has them from when its files were written; then
    the rows of differing leaves meet, so what is shuffled grows with the differences.
    """
    a, b = digests or tuple(save(leaf_digests(side, keys, hash_col, bits), "leaves") for side in (left, right))
    wanted = save(differing_leaves(a, b, bits), "differing")
    if not digests:
        drop_saved(a)
        drop_saved(b)
    # at most 2 ** bits numbers
    some = lambda side: side.join(F.broadcast(wanted), leaf(keys, bits) == F.col("leaf"), "left_semi")
    return parity(some(left), some(right), keys, hash_col)

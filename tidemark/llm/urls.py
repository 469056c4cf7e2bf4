"""URL filters: host rules, then exact list membership by a cascade of Bloom filters.

The list is a table (key, reason). ``trap_hosts`` makes one from the pages themselves: hosts of which
many addresses carry a query. No row shows that alone, so the list has to be asked for each page.

The cascade knows the complete key universe (the distinct hosts of the table). Level 0 encodes the
listed keys; level 1 encodes the unlisted keys that pass level 0; level 2 the listed keys that pass
level 1; and so on until a level has no false positive left. The first level that refuses a key
decides: an odd level means listed, an even one unlisted. So a probe is exact for every key of the
universe and needs no join.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule, and is allowed
unless the empty host is listed. Repeated rows are judged one by one; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.llm.shared import save, spread

#: The rules of the query's contract as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A host is listed if this share of its pages, of 100, has a query in its url.
QUERY_SHARE = 25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of one shard's cascade; the most bytes of cascades that are broadcast; rows of a shard that one task takes.
SHARD_KEYS, BROADCAST_BYTES, BLOCK_ROWS = 200_000, 64 << 20, 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _bits(one: np.ndarray, two: np.ndarray, level: int, size: int, hashes: int) -> Iterator[np.ndarray]:
    two = two | np.uint64(1)
    for i in range(hashes):
        yield (one + np.uint64(i + 31 * level) * two + np.uint64(level * 0x9E3779B9)) % np.uint64(size)


def _fill(one, two, level: int, rate: float) -> tuple[int, int, np.ndarray]:
    size = max(64, math.ceil(len(one) * math.log(1 / rate) / math.log(2) ** 2))
    hashes = max(1, round(size / len(one) * math.log(2)))
    bits = np.zeros(size, bool)
    for at in _bits(one, two, level, size, hashes):
        bits[at] = True
    return size, hashes, np.packbits(bits)


def _passes(one, two, level: int, size: int, hashes: int, packed: np.ndarray) -> np.ndarray:
    found = np.ones(len(one), bool)
    for at in _bits(one, two, level, size, hashes):
        found &= (packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return found


def build_cascade(one: np.ndarray, two: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Levels for one shard of the universe, given both hashes of each key and whether it is listed."""
    levels = []
    inside, outside = (one[listed], two[listed]), (one[~listed], two[~listed])
    while len(inside[0]):
        rate = 0.5 if levels else min(0.5, max(1e-6, len(inside[0]) * math.sqrt(0.5) / max(1, len(outside[0]))))
        levels.append(_fill(*inside, len(levels), rate))
        if len(levels) > 200:
            raise ValueError("a listed and an unlisted key have equal 128-bit hashes")
        through = _passes(*outside, len(levels) - 1, *levels[-1])
        inside, outside = (outside[0][through], outside[1][through]), inside
    return levels


def probe_cascade(one: np.ndarray, two: np.ndarray, levels) -> np.ndarray:
    listed = np.zeros(len(one), bool)
    alive = np.arange(len(one))
    for level, parts in enumerate(levels):
        through = _passes(one[alive], two[alive], level, *parts)
        listed[alive[~through]] = level % 2 == 1
        alive = alive[through]
    listed[alive] = len(levels) % 2 == 1
    return listed


def cascade_table(universe: DataFrame, key: str, listed: DataFrame) -> tuple[DataFrame, int]:
    """One row per shard and level for the distinct keys of ``universe``, of which ``listed`` has some in ``key``; and the number of shards.

    The table is written, so that passes over it do not build it again.
    """
    marked = listed.select(F.col("key").alias(key)).distinct().withColumn("listed", F.lit(True))
    keys = universe.select(key).distinct().join(marked, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    keys = save(keys, "url-keys")
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
    hashed = keys.select(_shard(key, shards), *_hashes(key), "listed")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        levels = build_cascade(group["one"].to_numpy(np.int64).view(np.uint64), group["two"].to_numpy(np.int64).view(np.uint64), group["listed"].to_numpy(bool))
        return pd.DataFrame({"shard": group["shard"].iloc[0], "level": range(len(levels)), "size": [x[0] for x in levels], "hashes": [x[1] for x in levels], "bits": [x[2].tobytes() for x in levels]})

    return save(hashed.groupBy("shard").applyInPandas(build, "shard int, level int, size long, hashes int, bits binary"), "cascade"), shards


def _hashes(key: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(key)).alias("one"), F.xxhash64(F.lit(7), F.col(key)).alias("two")


def _shard(key: str, shards: int) -> Column:
    return F.pmod(F.hash(F.col(key)), F.lit(shards)).cast("int").alias("shard")


def _member(shared):
    def probe(shard: pd.Series, one: pd.Series, two: pd.Series) -> pd.Series:
        found = np.zeros(len(shard), bool)
        a, b = one.to_numpy(np.int64).view(np.uint64), two.to_numpy(np.int64).view(np.uint64)
        for s in shard.unique():
            at = np.flatnonzero(shard.to_numpy() == s)
            found[at] = probe_cascade(a[at], b[at], shared.value.get(int(s), []))
        return pd.Series(found)

    return F.pandas_udf(probe, "boolean")


def with_membership(df: DataFrame, key: str, cascade: DataFrame, shards: int, out: str = "listed") -> DataFrame:
    """``df`` with a boolean column: whether its key is listed. Exact for the cascade's universe.

    A cascade of at most BROADCAST_BYTES is sent to every task. Of a larger one the rows of each shard
    meet their own levels, in one exchange of the rows, whatever the number of shards.
    """
    if (cascade.agg(F.sum(F.length("bits"))).first()[0] or 0) > BROADCAST_BYTES:
        return _by_shard(df, key, cascade, shards, out)
    table: dict[int, list] = {}
    for r in cascade.orderBy("shard", "level").collect():
        table.setdefault(r["shard"], []).append((r["size"], r["hashes"], np.frombuffer(r["bits"], np.uint8)))
    shared = df.sparkSession.sparkContext.broadcast(table)
    return df.withColumn(out, _member(shared)(_shard(key, shards), *_hashes(key)))


def _by_shard(df: DataFrame, key: str, cascade: DataFrame, shards: int, out: str) -> DataFrame:
    """Rows and levels dealt by shard and, in shards of many rows, block; levels stand before the rows in each."""
    rows = df.select(F.struct(*df.columns).alias("row"), _shard(key, shards), *_hashes(key))
    per = rows.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    per = F.broadcast(per)  # two numbers for SHARD_KEYS keys
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    levels = cascade.join(per, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    levels = levels.select("shard", "block", F.lit(0).alias("kind"), "level", "size", "hashes", "bits", *(none(rows, c) for c in ("row", "one", "two")))
    both = levels.unionByName(rows.join(per, "shard").select("shard", block, F.lit(1).alias("kind"), *(none(cascade, c) for c in ("level", "size", "hashes", "bits")), "row", "one", "two"))

    names = [*df.columns, out]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, []
        for batch in batches:
            shard, part, kind = (batch.column(c).to_numpy() for c in ("shard", "block", "kind"))
            cut = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])))
            for a, b in zip(cut.tolist(), np.append(cut[1:], batch.num_rows).tolist()):
                if (shard[a], part[a]) != held:
                    held, known = (shard[a], part[a]), []
                some = batch.slice(a, b - a)
                if kind[a] == 0:
                    known += [(n, k, np.frombuffer(x, np.uint8)) for n, k, x in zip(*(some.column(c).to_pylist() for c in ("size", "hashes", "bits")))]
                    continue
                one, two = (some.column(c).to_numpy().view(np.uint64) for c in ("one", "two"))
                found = pa.array(probe_cascade(one, two, known))
                yield pa.RecordBatch.from_arrays([*some.column("row").flatten(), found], names)

    parts = spread(df.sparkSession)
    dealt = both.repartition(parts, "shard", "block").sortWithinPartitions("shard", "block", "kind", "level")
    return dealt.mapInArrow(probe, StructType([*df.schema, StructField(out, BooleanType())]))


def trap_hosts(pages: DataFrame, share: int = QUERY_SHARE) -> DataFrame:
    """(key, reason) of the hosts of which at least ``share`` of 100 pages have a query in their url."""
    host, _ = host_and_path(F.col("url"))
    query = F.coalesce((F.instr("url", "://") > 0) & F.col("url").contains("?"), F.lit(False))
    per = pages.select(host.alias("key"), query.alias("query")).groupBy("key").agg(F.count("*").alias("n"), F.count_if("query").alias("with_query"))
    return per.where(100 * F.col("with_query") >= share * F.col("n")).select("key", F.lit("queries").alias("reason"))


def judge_urls(pages: DataFrame, listed: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each page: the longest fitting rule's, else the list's.

    ``listed`` has the blocked hosts in ``key``; without one it is made from the pages.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    cascade, shards = cascade_table(parts.select("host"), "host", trap_hosts(pages) if listed is None else listed)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return with_membership(parts, "host", cascade, shards).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE = rf"""
with r as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), p as (
  select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from r
), t as (
  select host from p group by host having 100 * count(*) filter (where instr(url, '://') > 0 and contains(url, '?')) >= {QUERY_SHARE} * count(*)
), j as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from p
)
select page_id, host, path, rule, case
    when rule in ('example.net/en/', 'org/fr/') then 'allow'
    when rule is not null then 'block'
    when host in (select host from t) then 'block'
    else 'allow' end as verdict
from j
"""

"""Latest rows, as-of joins and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The open ends of validity.
FIRST, LAST = "1900-01-01 00:00:00", "2299-12-31 00:00:00"


def latest_by(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the greatest order of each key; one hash aggregate with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def current_state(versions: DataFrame, keys: Sequence[str], order: Column, deleted: str = "is_deleted") -> DataFrame:
    """Latest version of each key; deleted keys leave only after ranking, else older rows would return."""
    return latest_by(versions, keys, order).where(~F.coalesce(F.col(deleted), F.lit(False)))


def current_counts(changes: DataFrame, keys: Sequence[str], order: Column, deleted: str = "is_deleted") -> DataFrame:
    """Rows, physical keys, visible and deleted keys."""
    latest = changes.groupBy(*keys).agg(F.count("*").alias("n"), F.max_by(deleted, order).alias("gone"))
    return latest.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("changes"), F.count("*").alias("physical"),
        F.count_if(~F.col("gone")).alias("visible"), F.count_if(F.col("gone")).alias("deleted"),
    )


def apply_current(current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The current state after a batch: only a greater order replaces a row, so late rows lose."""
    return latest_by(current.unionByName(batch, allowMissingColumns=True), keys, order)


def _ticks(df: DataFrame, column: str) -> Column:
    """A time (in seconds) or number as a double, for buckets."""
    if df.schema[column].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
        return F.expr(f"timestampdiff(second, timestamp_ntz '1970-01-01 00:00:00', cast(`{column}` as timestamp_ntz))").cast("double")
    return F.col(column).cast("double")


def _cuts(ticks: Sequence[DataFrame], parts: int) -> list[float]:
    """Ascending values that cut tables of one number each, taken together, into about ``parts`` ranges of equally many rows."""
    rows = None
    for t in ticks:
        rows = t if rows is None else rows.unionByName(t)
    if parts < 2:
        return []
    found = rows.agg(F.percentile_approx("_t", [i / parts for i in range(1, parts)], 4 * parts)).first()[0]
    return sorted(set(found or []))


def _range(value: Column, cuts: Sequence[float]) -> Column:
    """How many ascending cuts are at or below a value (0 for null), by halving: the expression's size does not grow with the cuts."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    padded = F.lit([*map(float, cuts), *[float("inf")] * (2 * steps[0] - 1 - len(cuts))])
    halve = lambda v: F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(padded, at + step - 1) <= v, at + step).otherwise(at))
    return F.least(F.get(F.transform(F.array(value), halve), F.lit(0)), F.lit(len(cuts)))  # the array, so that the value is computed once


#: Ranges of time at most.
RANGES = 512


def time_cuts(*times: DataFrame) -> list[float]:
    """Cuts for ``asof_latest`` out of tables whose first column is a time or number: as many ranges as shuffle partitions, RANGES at most."""
    parts = min(RANGES, int(times[0].sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return _cuts([df.select(_ticks(df, df.columns[0]).alias("_t")).where("_t is not null") for df in times], parts)


def time_range(df: DataFrame, column: str, cuts: Sequence[float]) -> Column:
    """The range among ``cuts`` in which a time or number column lies."""
    return _range(_ticks(df, column), cuts)


def asof_latest(left: DataFrame, right: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str], cuts: Sequence[float] | None = None, moments: DataFrame | None = None, place: str | None = None) -> DataFrame:
    """Each left row with the values of the latest right row at or before it.

    Linear in the rows and spread over time as well as keys, so few or hot keys do not decide the
    number of tasks: rows are cut into ranges of the first order column that hold equally many rows of
    both sides, as many as the session has shuffle partitions (RANGES at most); within a key's range one
    window finds the latest right row, and what a range has not is the last one of the ranges before, one
    row for each key and range. Right rows come before left rows at equal order. Left rows with a null key
    or order keep null values; they pass in ranges of their own, dealt by hash.

    ``cuts`` are those of ``time_cuts`` over cheaper tables with times like those of both sides, so that
    neither side is computed for its times alone; they decide how rows are spread and not what is found.
    ``moments`` is a cheaper table than ``left`` with all its keys and orders (more do no harm).
    ``place`` is a column of both with their ``time_range`` among these cuts, where it was cheaper to find before.
    """
    usable = F.lit(True)
    for c in (*by, *order):
        usable = usable & F.col(c).isNotNull()
    packed = F.struct(*values)
    known = right.where(usable).select(*by, *order, packed.alias("_value"))
    moments = left if moments is None else moments
    if cuts is None:
        cuts = time_cuts(*(df.where(usable).select(order[0]) for df in (moments, right)))
    placed = lambda df: F.col(place) if place else time_range(df, order[0], cuts)
    known = known.withColumn("_bucket", time_range(right, order[0], cuts))
    ends = known.groupBy(*by, "_bucket").agg(F.max_by("_value", F.struct(*order)).alias("_end"))
    # counted, else a distinct below would be merged into this one and places be found for all its rows; where these
    # are found, a hash of all columns, so that the exchanges below are those of the left rows and not further ones
    seen = F.max(F.xxhash64(*moments.columns)).isNotNull() if place else F.count("*") > 0
    slots = moments.where(usable).withColumn("_bucket", placed(moments)).groupBy(*by, "_bucket").agg(seen.alias("_seen")).where("_seen").drop("_seen")
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.join(ends, [*by, "_bucket"], "full_outer").withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).select(*by, "_bucket", "_carried")
    rest = [c for c in left.columns if c not in by and c not in order]
    hashed = [f.name for f in left.schema if f.dataType.typeName() not in ("map", "variant")]
    lost = -1 - F.pmod(F.xxhash64(*hashed), F.lit(RANGES)).cast("int")
    a = left.withColumn("_bucket", F.when(usable, placed(left)).otherwise(lost)).select(*by, *order, "_bucket", F.lit(1).alias("_side"), *rest)
    b = known.select(*by, *order, "_bucket", F.lit(0).alias("_side"), "_value")
    w = Window.partitionBy(*by, "_bucket").orderBy(*order, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True)
    found = both.withColumn("_value", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")
    found = found.join(carried, [*by, "_bucket"], "left").withColumn("_value", F.coalesce("_value", "_carried"))
    return found.select(*left.columns, *(F.col(f"_value.{v}").alias(v) for v in values))


#: Entities whose versions a task holds at once; pairs that are written at once.
HELD, PAIRS = 200_000, 100_000
_CARRIED, _END, _EVENT, _START = range(4)


def asof_reverse(left: DataFrame, right: DataFrame, entity: str, by: str, order: Sequence[str]) -> DataFrame:
    """Each right row with the left versions that are in force at it and have its ``by`` value.

    A left version is in force after its own order and before its entity's next one. Time is cut into
    ranges of equally many rows. A range of a ``by`` value is swept once in order: versions enter and
    leave the set in force, which starts with those that reach over the range's border, and every right
    row meets the set. So what is made are the rows, those carried over a border, and the result. There
    are no more ranges than rows for each entity, so no more rows are carried than there are rows, however
    long a version lasts. Where a ``by`` value may have over HELD entities they are dealt over several
    sweeps. Columns of the right order are named ``at_...``. Rows with a null ``by`` or order meet nothing.
    """
    usable = F.col(by).isNotNull()
    for c in order:
        usable = usable & F.col(c).isNotNull()
    left_t, right_t = (df.where(usable).select(_ticks(df, order[0]).alias("_t"), *extra) for df, extra in ((left, [F.col(entity).alias("_e")]), (right, [F.lit(None).cast(left.schema[entity].dataType).alias("_e")])))
    sizes = left_t.unionByName(right_t).agg(F.count("*").alias("n"), F.approx_count_distinct("_e").alias("e")).first()
    parts = max(1, min(RANGES, 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), sizes["n"] // max(1, sizes["e"])))
    cuts = _cuts([left_t.select("_t"), right_t.select("_t")], parts)
    shares = -(-sizes["e"] // HELD) or 1

    steps = Window.partitionBy(entity).orderBy(*order)
    own = [c for c in left.columns if c not in order and c != by]
    held = left.where(_all_known(order)).withColumn("_low", _ticks(left, order[0]))
    held = held.select(F.col(by).alias("_by"), F.pmod(F.xxhash64(entity), F.lit(shares)).cast("int").alias("_share"), F.sha2(F.to_json(F.struct(entity)), 256).alias("_entity"), F.struct(*own).alias("_left"), F.struct(*order).alias("_from"), F.lead(F.struct(*order)).over(steps).alias("_to"), "_low", F.lead("_low").over(steps).alias("_high"))
    held = held.where("_by is not null and (_to is null or _to <> _from)")
    held = held.withColumn("_first", _range(F.col("_low"), cuts)).withColumn("_last", F.when(F.col("_to").isNotNull(), _range(F.col("_high"), cuts)).otherwise(len(cuts)))
    none_left = F.lit(None).cast(held.schema["_left"].dataType)
    events = right.where(usable).select(F.col(by).alias("_by"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"), F.struct(*(F.col(c).alias(f"at_{c}" if c in order else c) for c in right.columns if c != by)).alias("_right"), F.struct(*order).alias("_at"), _range(_ticks(right, order[0]), cuts).alias("_part"))
    none_right = F.lit(None).cast(events.schema["_right"].dataType)
    row = lambda df, part, at, kind, who, a, b: df.select("_by", "_share", part.alias("_part"), at.alias("_at"), F.lit(kind).alias("_kind"), who.alias("_entity"), a.alias("_left"), b.alias("_right"))
    who, started = F.col("_entity"), F.col("_left")
    rows = row(held, F.col("_first"), F.col("_from"), _START, who, started, none_right)
    rows = rows.unionByName(row(held.where("_to is not null"), F.col("_last"), F.col("_to"), _END, who, none_left, none_right))
    over = held.where("_last > _first").withColumn("_part", F.explode(F.sequence(F.col("_first") + 1, F.col("_last"))))
    rows = rows.unionByName(row(over, F.col("_part"), F.lit(None).cast(held.schema["_from"].dataType), _CARRIED, who, started, none_right))
    rows = rows.unionByName(row(events, F.col("_part"), F.col("_at"), _EVENT, F.lit(None).cast("string"), none_left, F.col("_right")))
    schema = rows.select("_by", "_left", "_right").schema

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, force, kept = None, {}, None
        for batch in batches:
            pool, base = batch.column("_left"), 0
            if kept is not None and len(kept):
                pool, base = pa.concat_arrays([kept, pool]), len(kept)
            here, found = [], []
            groups = zip(*(batch.column(c).to_pylist() for c in ("_by", "_share", "_part")))
            for i, (g, kind, name) in enumerate(zip(groups, batch.column("_kind").to_pylist(), batch.column("_entity").to_pylist())):
                if g != group:
                    group, force = g, {}
                if kind == _EVENT:
                    found.extend(force.values())
                    here.extend([i] * len(force))
                    if len(here) >= PAIRS:
                        yield _met(batch, pool, here, found)
                        here, found = [], []
                elif kind == _END:
                    force.pop(name, None)
                else:
                    force[name] = base + i
            if here:
                yield _met(batch, pool, here, found)
            kept = pool.take(pa.array(list(force.values()), pa.int64()))
            force = {name: i for i, name in enumerate(force)}

    swept = rows.repartition("_by", "_share", "_part").sortWithinPartitions("_by", "_share", "_part", "_at", "_kind").mapInArrow(sweep, schema)
    return swept.select(F.col("_by").alias(by), "_left.*", "_right.*").select(*[c for c in left.columns if c not in order], *(f"at_{c}" if c in order else c for c in right.columns if c != by))


def _all_known(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _met(batch: pa.RecordBatch, pool: pa.Array, here: list[int], found: list[int]) -> pa.RecordBatch:
    """The pairs of right rows of a batch and versions of a pool."""
    at = pa.array(here)
    return pa.RecordBatch.from_arrays([batch.column("_by").take(at), pool.take(pa.array(found)), batch.column("_right").take(at)], ["_by", "_left", "_right"])


def scd2(events: DataFrame, key: str, order: Sequence[str], attributes_hash: Column, ts: str = "source_ts", snapshot: str = "is_snapshot", deleted: str = "is_deleted") -> DataFrame:
    """Validity intervals [valid_from, valid_to) of each key's versions.

    A snapshot row or a key's earliest one opens at FIRST. Of rows that open at the same time the last
    stays; versions equal to the one before collapse; a delete closes the version before it and is not
    returned. All windows share one partitioning, so there is one shuffle.
    """
    per_key = Window.partitionBy(key)
    opens = F.when(F.coalesce(F.col(snapshot), F.lit(False)) | (F.col(ts) == F.min(ts).over(per_key)), F.lit(FIRST).cast("timestamp_ntz")).otherwise(F.col(ts))
    rows = events.withColumn("valid_from", opens).withColumn("version_hash", F.concat_ws("|", attributes_hash, F.col(deleted).cast("string")))
    last = Window.partitionBy(key, "valid_from").orderBy(*(F.desc(c) for c in order))
    rows = rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    in_time = per_key.orderBy("valid_from")
    before = F.lag("version_hash").over(in_time)
    rows = rows.withColumn("_before", before).where("_before is null or _before <> version_hash").drop("_before")
    rows = rows.withColumn("valid_to", F.lead("valid_from").over(in_time))
    return rows.where(~F.col(deleted)).withColumn("is_current", F.col("valid_to").isNull()).drop("version_hash")


def scd2_lookup(fact: DataFrame, dim: DataFrame, key: str, ts: str, value: str, cuts: Sequence[float] | None = None, moments: DataFrame | None = None, home: str | None = None, place: str | None = None) -> DataFrame:
    """The dimension row in force at each fact's time; null where there is none. Intervals of a key do not overlap.

    The latest version that began at or before the time is found as-of; it counts unless it has ended.
    Each key and time is looked up once, however many facts share it, and joined back by both, so facts
    are neither sorted among the versions nor gathered by key. Facts without a key or time are dealt by
    hash. ``cuts``, ``moments`` and ``place`` (a column of ``moments``) as in ``asof_latest``.

    ``home`` is a column by which the facts are spread already and which ``moments`` has too. Facts then
    stay where they are: only home, key and time are sent to the versions, and those that found one come
    back, so no exchange holds whole facts. It is for homes with few distinct keys and times each, like
    orders: a fact is held against all that its home has of them. Facts without a home find nothing.
    """
    versions = dim.select(key, F.col("valid_from").alias(ts), F.struct("valid_to", value).alias("_version"))
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    points = (fact if moments is None else moments).where(usable).select(*(c for c in (home, key, ts, place) if c))
    found = asof_latest(points if home else points.distinct(), versions, [key], [ts], ["_version"], cuts, place=place)
    open_ = F.col("_version.valid_to").isNull() | (F.col(ts) < F.col("_version.valid_to"))
    if home:
        found = found.select(F.col(home).alias("_home"), F.col(key).alias("_key"), F.col(ts).alias("_at"), F.when(open_, F.col(f"_version.{value}")).alias(value)).where(F.col(value).isNotNull())
        once = Window.partitionBy("_home", "_key", "_at").orderBy(value)  # repeated points found the same
        known = found.repartition("_home").withColumn("_n", F.row_number().over(once)).where("_n = 1")
        # ranges, since equalities would be join keys too and both sides be sent again by all of them
        same = (F.col(home) == F.col("_home")) & F.col(key).between(F.col("_key"), F.col("_key")) & F.col(ts).between(F.col("_at"), F.col("_at"))
        return fact.join(known, same, "left").select(*fact.columns, value)
    same = F.xxhash64(*(F.col(c).cast(found.schema[c].dataType) for c in (key, ts)))
    hashed = [f.name for f in fact.schema if f.dataType.typeName() not in ("map", "variant")]
    found = found.select(key, ts, same.alias("_deal"), F.when(open_, F.col(f"_version.{value}")).alias(value))
    rows = fact.withColumn("_deal", F.when(usable, same).otherwise(F.xxhash64(*hashed)))
    return rows.join(found, ["_deal", key, ts], "left").select(*fact.columns, value)  # by hash first: rows sort by one number


#: Different keys that a filter names at most.
KEYS = 1_000


def with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is one of another table's; all rows where that has more than about KEYS different ones.

    Lookups need no versions of keys that no fact has, and no facts of keys without versions. Where such
    keys are counted to be few, the rest leaves at the scan; a filter, unlike a join, hides no equal exchanges.
    """
    if keys.agg(F.approx_count_distinct(key)).first()[0] > KEYS:
        return rows
    return rows.where(F.col(key).isin([k for (k,) in keys.where(F.col(key).isNotNull()).select(key).distinct().collect()]))


def interval_overlaps(dim: DataFrame, key: str) -> DataFrame:
    """Rows whose interval begins before an earlier one of the key has ended; linear, no self join."""
    w = Window.partitionBy(key).orderBy("valid_from", F.coalesce("valid_to", F.lit(LAST).cast("timestamp_ntz"))).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.coalesce("valid_to", F.lit(LAST).cast("timestamp_ntz"))).over(w)
    return dim.withColumn("_reach", reach).where(F.col("valid_from") < F.col("_reach")).drop("_reach")

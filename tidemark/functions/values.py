"""Scalar column functions. All are built-in expressions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

NULL_TOKEN = "<NULL>"


def text(col: Column | str) -> Column:
    """A value as text, with a token for null, so that keys of parts are never null."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(NULL_TOKEN))


def hash_key(*parts: Column | str) -> Column:
    """Lower-case hex MD5 of the parts joined by a bar."""
    return F.md5(F.concat_ws("|", *(text(p) for p in parts)))


def row_digest(*parts: Column | str) -> Column:
    """Lower-case hex SHA-256 of the parts joined by a bar."""
    return F.sha2(F.concat_ws("|", *(text(p) for p in parts)), 256)


def cents(amount: Column | str) -> Column:
    """Money in a double column as whole cents, half up."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.floor(amount * 100 + F.lit(0.5)).cast("bigint")


def share_half_up(part: Column, whole: Column, of: Column) -> Column:
    """of * part / whole in whole units, half up; null where the whole is 0."""
    ratio = of.cast("double") * part.cast("double") / whole.cast("double")
    return F.when(whole != 0, F.floor(ratio + F.lit(0.5)).cast("bigint"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double; null where den is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def date_key(ts: Column | str) -> Column:
    """The day as a number like 20240131, without a text in between."""
    day = F.to_date(ts)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_difference(end: Column | str, start: Column | str) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start))


def canonical_time(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def decimal_text(amount: Column | str) -> Column:
    """A decimal as plain text with all digits of its scale; null stays null."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast("string")


def canonical_json(value: Column, data_type: DataType) -> Column:
    """JSON of a struct with the keys of all levels sorted, nulls kept and no white space."""
    return F.to_json(_sorted_keys(value, data_type), {"ignoreNullFields": "false"})


def _sorted_keys(value: Column, data_type: DataType) -> Column:
    if isinstance(data_type, StructType):
        fields = sorted(data_type.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(_sorted_keys(value[f.name], f.dataType).alias(f.name) for f in fields)))
    if isinstance(data_type, ArrayType):
        return F.transform(value, lambda x: _sorted_keys(x, data_type.elementType))
    if isinstance(data_type, MapType):
        inner = F.transform_values(value, lambda k, x: _sorted_keys(x, data_type.valueType))
        return F.map_from_entries(F.array_sort(F.map_entries(inner), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    return value


def valid_identifier(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).rlike("^[A-Za-z0-9_]+$")


def redact(col: Column | str) -> Column:
    """Values behind secret-like names, and bearer tokens, are blacked out."""
    col = F.col(col) if isinstance(col, str) else col
    col = F.regexp_replace(col, r"(?i)(password|passwd|secret|token|api_?key)(\s*[:=]\s*)[^\s,;]+", "$1$2***")
    return F.regexp_replace(col, r"(?i)bearer\s+[A-Za-z0-9._-]+", "bearer ***")


def file_index(name: Column | str) -> Column:
    """The number at the end of a log file's name."""
    return F.try_to_number(F.regexp_extract(name, r"(\d+)$", 1), F.lit("999999999999")).cast("bigint")


def source_order(snapshot: Column, file: Column, pos: Column, row: Column, tx_order: Column, ts: Column, partition: Column, offset: Column, event_id: Column | None = None) -> Column:
    """The canonical order of source changes: snapshots first, then by place in the source's log; the event id is the last tie-break."""
    return F.struct(
        F.when(snapshot, 0).otherwise(1).alias("stream"), F.coalesce(file_index(file), F.lit(-1)).alias("file"), F.coalesce(pos, F.lit(-1)).alias("pos"),
        F.coalesce(row, F.lit(-1)).alias("row"), F.coalesce(tx_order, F.lit(-1)).alias("tx_order"), ts.alias("ts"), partition.alias("part"), offset.alias("off"),
        (F.lit("") if event_id is None else event_id).alias("event_id"),
    )

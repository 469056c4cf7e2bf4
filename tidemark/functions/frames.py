"""Registry-framed messages: one magic byte 0, a 4-byte schema id, then the payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes before the payload.
HEADER = 5


def inspect_frame(frame: Column, prefix: str) -> Column:
    """struct(valid, error, schema_id, payload) of a framed key or value; built-ins only.

    A missing frame is an error here: a key or value that cannot be read must not pass the gate, and
    tombstones leave before it. Errors are the prefix and ``_null``, ``_too_short``, ``_bad_magic`` or ``_bad_schema_id``.
    """
    schema_id = F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("bigint")
    error = (
        F.when(frame.isNull(), f"{prefix}_null")
        .when(F.length(frame) < HEADER, f"{prefix}_too_short")
        .when(F.hex(F.substring(frame, 1, 1)) != "00", f"{prefix}_bad_magic")
        .when((schema_id <= 0) | (schema_id > 2147483647), f"{prefix}_bad_schema_id")
    )
    good = error.isNull()
    return F.struct(
        good.alias("valid"), error.alias("error"), F.when(good, schema_id).cast("int").alias("schema_id"),
        F.when(good, F.substring(frame, HEADER + 1, 2147483647)).alias("payload"),
    )


def unscaled_decimal(raw: Column, size: int, scale: int) -> Column:
    """A decimal from its unscaled big-endian two's-complement bytes."""
    unsigned = F.conv(F.hex(raw), 16, 10).cast("decimal(38,0)")
    wrap = F.lit(str(1 << (8 * size))).cast("decimal(38,0)")
    negative = F.conv(F.hex(F.substring(raw, 1, 1)), 16, 10).cast("int") >= 128
    signed = F.when(negative, unsigned - wrap).otherwise(unsigned)
    return (signed.cast("decimal(20,0)") * F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(18,{scale})")


def coerce(raw: Column, wire: str, want: str) -> Column:
    """A field of a wire type as its contract's type; both are type names in lower case.

    Binary becomes a decimal by its unscaled bytes (8 at most, else null), whole numbers become times as
    microseconds, and int out of a wider whole number keeps the low 32 bits, as the wire's readers do.
    """
    if want.startswith("decimal") and wire == "binary":
        scale = int(want.rstrip(")").split(",")[1]) if "," in want else 0
        sign = F.when(F.hex(F.substring(raw, 1, 1)) >= "80", "F").otherwise("0")
        whole = F.conv(F.lpad(F.hex(raw), 16, sign), 16, -10).cast("decimal(20,0)")
        unit = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
        return F.when(F.length(raw).between(1, 8), (whole * unit).cast(want))
    if want == "timestamp" and wire in ("bigint", "int"):
        return F.timestamp_micros(raw)
    if want == "timestamp_ntz" and wire in ("bigint", "int"):
        seconds = (raw.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    if want == "int" and wire == "bigint":
        return (F.pmod(raw + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)).cast("int")
    return raw if wire == want else raw.cast(want)


def record_kind(topic: Column, key: Column, value: Column, transactions: str, heartbeats: str, schema_changes: str) -> Column:
    """transaction, heartbeat, schema_change, tombstone or data."""
    return (
        F.when(topic == transactions, "transaction").when(topic.startswith(heartbeats), "heartbeat").when(topic == schema_changes, "schema_change")
        .when(is_tombstone(key, value), "tombstone").otherwise("data")
    )


def is_tombstone(key: Column, value: Column) -> Column:
    return key.isNotNull() & value.isNull()

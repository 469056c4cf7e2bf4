"""Columns that writers add: projection by writer schema, and the way of a new column into the ledger."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ledger import align_schema, extra_columns, normalize
from tidemark.operators.schemas import WIDER

#: Spark's names of the types that may widen, narrowest first.
_ORDER = {"int": 0, "bigint": 1, "float": 2, "double": 3}
_NAMES = {"int": "int", "bigint": "long", "float": "float", "double": "double"}


def columns_of(ddl: str) -> dict[str, str]:
    """Names and types of a flat DDL, in order."""
    return {c.strip().split(" ", 1)[0]: c.strip().split(" ", 1)[1].strip() for c in ddl.split(",")}


def wider(a: str, b: str) -> str:
    """The type that takes both; an error if there is none."""
    if a == b:
        return a
    low, high = sorted((a, b), key=lambda t: _ORDER.get(t, -1))
    if _NAMES.get(high) in WIDER.get(_NAMES.get(low, ""), ()):
        return high
    raise ValueError(f"{a} and {b} have no common type")


def normalize_by_writer(envelopes: DataFrame, writers: Mapping[int, str], contract: str, keys: str | None = None, schema_id: str = "schema_id") -> DataFrame:
    """Ledger rows of envelopes by several writers, each read by its own columns.

    ``writers`` maps a schema id to the DDL of its image. Writers with the same columns are parsed
    together, once. A column that a writer lacks is null, one beyond the contract is kept, and a number is
    widened to the widest that any writer or the contract has. Row hashes are over a writer's own columns,
    so the rows of earlier writers keep theirs when a column is added. Rows of an unknown writer are
    rejected as ``unknown_writer``.
    """
    merged = columns_of(contract)
    for ddl in writers.values():
        for name, kind in columns_of(ddl).items():
            merged[name] = wider(merged[name], kind) if name in merged else kind
    together: dict[str, list[int]] = {}
    for writer, ddl in writers.items():
        together.setdefault(ddl, []).append(writer)
    out = None
    for ddl, ids in together.items():
        rows = normalize(envelopes.where(F.col(schema_id).isin(*ids)), ddl, keys)
        own = columns_of(ddl)
        rows = rows.withColumns({c: (F.col(c) if c in own or c in rows.columns else F.lit(None)).cast(t) for c, t in merged.items()})
        out = rows if out is None else out.unionByName(rows)
    strange = normalize(envelopes.where(~F.coalesce(F.col(schema_id).isin(*writers), F.lit(False))), contract, keys)
    strange = strange.withColumns({"apply_status": F.lit("REJECTED"), "error_code": F.lit("unknown_writer")}).withColumns({c: (F.col(c) if c in strange.columns else F.lit(None)).cast(t) for c, t in merged.items()})
    return strange if out is None else out.unionByName(strange)


def add_to_ledger(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger with new rows and the columns that came with them; a column of both takes the wider type."""
    extra_columns(rows, ledger.columns)  # names that are no identifiers are an error
    for name, kind in rows.dtypes:
        if name in ledger.columns and dict(ledger.dtypes)[name] != kind:
            both = wider(dict(ledger.dtypes)[name], kind)
            ledger, rows = (df.withColumn(name, F.col(name).cast(both)) for df in (ledger, rows))
    return align_schema(ledger, rows)


def column_origins(rows: DataFrame, writers: Mapping[int, str], contract: str, order: Column, schema_id: str = "schema_id") -> DataFrame:
    """(column_name, schema_id, event_id, rows): for each column beyond the contract the first row of a writer that has it."""
    held = columns_of(contract)
    extra = {c: [w for w, ddl in writers.items() if c in columns_of(ddl)] for ddl in writers.values() for c in columns_of(ddl) if c not in held}
    if not extra:
        return rows.select(F.lit("").alias("column_name"), schema_id, "event_id", F.lit(0).cast("bigint").alias("rows")).where("false")
    carried = F.filter(F.array(*(F.when(F.col(schema_id).isin(*ids), F.lit(c)) for c, ids in sorted(extra.items()))), lambda x: x.isNotNull())
    seen = rows.select(F.explode(carried).alias("column_name"), schema_id, "event_id", order.alias("_at"))
    first = seen.groupBy("column_name").agg(F.min_by(F.struct(schema_id, "event_id"), "_at").alias("f"), F.count("*").alias("rows"))
    return first.select("column_name", f"f.{schema_id}", "f.event_id", "rows")

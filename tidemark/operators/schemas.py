"""Schema and contract checks over tables of fields, and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def field_table(df: DataFrame, subject: str, version: int) -> DataFrame:
    """(subject, version, position, path, type, nullable) of a table's own schema."""
    rows = [(subject, version, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "subject string, version int, position int, path string, type string, nullable boolean")


def nested_fields(schema: StructType, subject: str, version: int, record: str) -> list[tuple]:
    """Rows (subject, version, record, path, parent, type, nullable) of a schema's fields at all levels.

    Elements of arrays and values of maps are the paths ``[]`` and ``{}`` below theirs.
    """
    out: list[tuple] = []

    def add(path: str, parent: str, kind: DataType, nullable: bool) -> None:
        name = {StructType: "record", ArrayType: "array", MapType: "map"}.get(type(kind)) or kind.simpleString()
        out.append((subject, version, record, path, parent, name, nullable))
        if isinstance(kind, StructType):
            for f in kind:
                add(f"{path}.{f.name}", path, f.dataType, f.nullable)
        elif isinstance(kind, ArrayType):
            add(f"{path}[]", path, kind.elementType, kind.containsNull)
        elif isinstance(kind, MapType):
            add(f"{path}{{}}", path, kind.valueType, kind.valueContainsNull)

    for f in schema:
        add(f.name, "", f.dataType, f.nullable)
    return out


#: The columns of nested_fields.
NESTED = "subject string, version int, record string, path string, parent string, type string, nullable boolean"


def schema_issues(fields: DataFrame) -> DataFrame:
    """Every earlier version against every later one: fields removed or renamed, changed, or added as required.

    ``fields`` has subject, version, path, type and nullable. A field that becomes or stops being nullable
    has changed its type. Optional columns: ``null_default`` (an added field needs it as well),
    ``record`` (the record's identity; another one is a record_rename, with the path ``$``), and
    ``parent`` (a field's parent path; below a field that is removed, added or of another type nothing
    more is reported).
    """
    versions = fields.select("subject", "version").distinct()
    pairs = versions.select("subject", F.col("version").alias("old")).join(versions.select("subject", F.col("version").alias("new")), "subject").where("old < new")
    optional = F.col("nullable") & F.col("null_default") if "null_default" in fields.columns else F.col("nullable")
    above = F.col("parent") if "parent" in fields.columns else F.lit("")
    kind = F.struct("type", "nullable", optional.alias("optional"), above.alias("parent"))
    a = pairs.join(fields.select("subject", F.col("version").alias("old"), "path", kind.alias("a")), ["subject", "old"])
    b = pairs.join(fields.select("subject", F.col("version").alias("new"), "path", kind.alias("b")), ["subject", "new"])
    both = a.join(b, ["subject", "old", "new", "path"], "full_outer")
    other = (F.col("a.type") != F.col("b.type")) | (F.col("a.nullable") != F.col("b.nullable"))
    issue = F.when(F.col("b").isNull(), "removed").when(F.col("a").isNull() & ~F.col("b.optional"), "required_addition").when(other, "type_change")
    place = ["subject", "old", "new"]
    found = both.withColumn("issue", issue).where("issue is not null").select(*place, "path", F.coalesce("a.parent", "b.parent").alias("parent"), "issue")
    if "parent" in fields.columns:
        broken = both.where(F.col("a").isNull() | F.col("b").isNull() | (F.col("a.type") != F.col("b.type"))).select(*place, F.col("path").alias("parent"))
        found = found.join(broken, [*place, "parent"], "left_anti")
    found = found.select(*place, "path", "issue")
    if "record" not in fields.columns:
        return found
    names = fields.groupBy("subject", "version").agg(F.min("record").alias("record"))
    named = pairs.join(names.select("subject", F.col("version").alias("old"), F.col("record").alias("_a")), ["subject", "old"]).join(names.select("subject", F.col("version").alias("new"), F.col("record").alias("_b")), ["subject", "new"])
    renamed = named.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*place, F.lit("$").alias("path"), F.lit("record_rename").alias("issue"))
    return found.unionByName(renamed)


#: The numeric types that a reader may have for a writer's type.
WIDER = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",)}


def readable(writer: Column, reader: Column) -> Column:
    """Whether a reader's type takes a writer's: the same one, or a wider number; Spark's bigint is long."""
    name = lambda c: F.when(c == "bigint", "long").otherwise(c)
    out = name(writer).eqNullSafe(name(reader))
    for narrow, wide in WIDER.items():
        out = out | ((name(writer) == narrow) & name(reader).isin(*wide))
    return F.coalesce(out, F.lit(False))


def relaxed_schema_issues(fields: DataFrame) -> DataFrame:
    """Every later version as the reader of every earlier one, by the rules under which data can be read.

    Numbers may become wider, and added fields need a default (``has_default``); a removed field or one
    of another type, nullability counted, is an issue, and so is another record. ``fields`` has subject,
    version, path, type, nullable and has_default, and may have ``record`` and ``parent`` as for
    ``schema_issues``: below a field that is itself an issue nothing more is reported.
    """
    versions = fields.select("subject", "version").distinct()
    pairs = versions.select("subject", F.col("version").alias("old")).join(versions.select("subject", F.col("version").alias("new")), "subject").where("old < new")
    above = F.col("parent") if "parent" in fields.columns else F.lit("")
    side = lambda v, n: pairs.join(fields.select("subject", F.col("version").alias(v), "path", F.struct("type", "nullable", "has_default", above.alias("parent")).alias(n)), ["subject", v])
    both = side("old", "a").join(side("new", "b"), ["subject", "old", "new", "path"], "full_outer")
    # a union with null is a type of its own; only plain numbers widen
    same = (F.col("a.type") == F.col("b.type")) & (F.col("a.nullable") == F.col("b.nullable"))
    wider = readable(F.col("a.type"), F.col("b.type")) & ~F.col("a.nullable") & ~F.col("b.nullable")
    issue = F.when(F.col("b").isNull(), "removed").when(F.col("a").isNull() & ~F.col("b.has_default"), "no_default").when(F.col("a").isNotNull() & ~(same | wider), "type_change")
    place = ["subject", "old", "new"]
    judged = both.withColumn("issue", issue)
    found = judged.where("issue is not null").select(*place, "path", F.coalesce("a.parent", "b.parent").alias("parent"), "issue")
    if "parent" in fields.columns:
        broken = judged.where("issue is not null or a is null or b is null").select(*place, F.col("path").alias("parent"))
        found = found.join(broken, [*place, "parent"], "left_anti")
    found = found.select(*place, "path", "issue")
    if "record" not in fields.columns:
        return found
    names = fields.groupBy("subject", "version").agg(F.min("record").alias("record"))
    named = pairs.join(names.select("subject", F.col("version").alias("old"), F.col("record").alias("_a")), ["subject", "old"]).join(names.select("subject", F.col("version").alias("new"), F.col("record").alias("_b")), ["subject", "new"])
    return found.unionByName(named.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*place, F.lit("$").alias("path"), F.lit("record_rename").alias("issue")))


def resolve_writers(writers: DataFrame, reader: DataFrame) -> DataFrame:
    """(schema_id, path, outcome): how one reader takes each field of each writer's schema, at all levels.

    Fields are (path, parent, type, nullable, has_default); writers have a schema_id. A field of both is
    ``read`` or, as a wider number, ``promoted``; the reader's own is ``defaulted`` if it has a default;
    a writer's further one is ``added`` if it is nullable with a default. Anything else is
    ``type_change``, ``dropped`` or ``added_required``. Below a field that only one side has, or that
    cannot be read, nothing more is told. The reader meets each writer's fields once.
    """
    want = reader.select("path", F.struct("parent", "type", "nullable", "has_default").alias("r"))
    have = writers.select("schema_id", "path", F.struct("parent", "type", "nullable", "has_default").alias("w"))
    own = have.join(want, "path", "left")
    fields = F.collect_set("path").alias("_have")
    missing = have.groupBy("schema_id").agg(fields)
    listed = want.agg(F.collect_list(F.struct("path", "r")).alias("_want"))  # the reader's fields: one small schema
    missing = missing.crossJoin(F.broadcast(listed)).select("schema_id", F.explode(F.filter("_want", lambda x: ~F.array_contains(F.col("_have"), x["path"]))).alias("m")).select("schema_id", "m.path", F.lit(None).cast(have.schema["w"].dataType).alias("w"), "m.r")
    both = own.select("schema_id", "path", "w", "r").unionByName(missing)
    same = F.col("w.type").eqNullSafe(F.col("r.type")) & ((F.col("w.nullable") == F.col("r.nullable")) | F.col("r.nullable"))
    wider = readable(F.col("w.type"), F.col("r.type")) & (~F.col("w.nullable") | F.col("r.nullable"))
    outcome = (
        F.when(F.col("w").isNull(), F.when(F.col("r.has_default"), "defaulted").otherwise("dropped")).when(F.col("r").isNull(), F.when(F.col("w.nullable") & F.col("w.has_default"), "added").otherwise("added_required"))
        .when(same, "read").when(wider, "promoted").otherwise("type_change")
    )
    judged = both.select("schema_id", "path", F.coalesce("w.parent", "r.parent").alias("parent"), outcome.alias("outcome"))
    closed = judged.where("outcome not in ('read', 'promoted')").select("schema_id", F.col("path").alias("parent"))
    return judged.join(closed, ["schema_id", "parent"], "left_anti").select("schema_id", "path", "outcome")


def contract_issues(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a later contract may not change: (entity, kind, value, issue).

    Rows are (entity, kind, value) with kind key, topic, key_schema, partitions, column, fingerprint or
    reset, and for columns ``detail`` (their types) and ``nullable``. Fingerprints may be added, and
    columns if they are nullable; a column's detail and nullability stay. Partitions may change where
    the new contract has the reset ``full_reset``.
    """
    row = ["entity", "kind", "value"]
    of = lambda df: df.select(*row, *(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("detail", "string"), ("nullable", "boolean"))))
    was, now = of(old).where("kind <> 'reset'"), of(new).where("kind <> 'reset'")
    gone = was.join(now, row, "left_anti").withColumn("issue", F.concat(F.col("kind"), F.lit("_removed")))
    fresh = now.where("kind <> 'fingerprint' and not (kind = 'column' and coalesce(nullable, false))")
    added = fresh.join(was, row, "left_anti").join(was.select("entity").distinct(), "entity", "left_semi").withColumn("issue", F.concat(F.col("kind"), F.lit("_added")))
    kept = was.where("kind = 'column'").join(now.select(*row, F.col("detail").alias("_d"), F.col("nullable").alias("_n")), row)
    changed = kept.where(~(F.col("detail").eqNullSafe(F.col("_d")) & F.col("nullable").eqNullSafe(F.col("_n")))).withColumn("issue", F.lit("column_changed"))
    out = gone.select(*row, "issue").unionByName(added.select(*row, "issue")).unionByName(changed.select(*row, "issue"))
    reset = new.where("kind = 'reset' and value = 'full_reset'").select("entity").distinct().withColumn("_reset", F.lit(True))
    return out.join(reset, "entity", "left").where("kind <> 'partitions' or _reset is null").select(*row, "issue")


def writer_acceptable(writers: DataFrame, reader: DataFrame) -> DataFrame:
    """Per writer schema whether one reader can take it: all required reader fields, and equal types.

    Paths are unique within a schema. Required fields that a writer lacks are counted as the reader's
    number of them less those that it has, so no writer is multiplied by the reader's fields.
    """
    need = reader.select("path", F.col("type").alias("want"), F.col("nullable").alias("optional"))
    required = reader.agg(F.count_if(~F.col("nullable")).alias("_required"))
    held, wrong = F.count_if(~F.col("optional")), F.count_if(F.col("type") != F.col("want"))
    per = writers.join(need, "path", "left").groupBy("schema_id").agg(held.alias("_held"), wrong.alias("_wrong"))
    problems = F.col("_required") - F.col("_held") + F.col("_wrong")
    return per.crossJoin(required).select("schema_id", (problems == 0).alias("acceptable"), problems.alias("problems"))


def schema_id_conflicts(archive: DataFrame) -> DataFrame:
    """Schema ids with more than one fingerprint."""
    return archive.groupBy("schema_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).where("low <> high").select("schema_id")


def source_contract_issues(found: DataFrame, contract: DataFrame) -> DataFrame:
    """Tables whose header or row count is not the contract's; both are (name, header, n_rows)."""
    both = contract.select("name", F.col("header").alias("want_header"), F.col("n_rows").alias("want_rows")).join(found, "name", "left")
    issue = F.when(F.col("header").isNull(), "missing").when(F.col("header") != F.col("want_header"), "header").when(F.col("n_rows") != F.col("want_rows"), "row_count")
    return both.withColumn("issue", issue).where("issue is not null").select("name", "issue")


def capture_schemas(raw: DataFrame, known: DataFrame, lookup: DataFrame) -> DataFrame:
    """Archive rows for writer schema ids that are seen and not yet known, one per id."""
    ids = raw.select(F.explode(F.array("key_schema_id", "value_schema_id")).alias("schema_id")).where("schema_id is not null").distinct()
    return ids.join(known.select("schema_id"), "schema_id", "left_anti").join(lookup, "schema_id")


def table_drift(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Fields that differ between two field tables in presence, position, type or nullability."""
    a = actual.select("path", F.struct("position", "type", "nullable").alias("a"))
    b = declared.select("path", F.struct("position", "type", "nullable").alias("b"))
    kind = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull(), "extra").when(F.col("a.position") != F.col("b.position"), "position").when(F.col("a.type") != F.col("b.type"), "type").when(F.col("a.nullable") != F.col("b.nullable"), "nullability")
    return a.join(b, "path", "full_outer").withColumn("drift", kind).where("drift is not null").select("path", "drift")


def layout_rows(spark: SparkSession, table: str) -> DataFrame:
    """(kind, name, value) of a catalog table's partition columns, with their order, and its properties."""
    rows = [("partition", c.name, str(i)) for i, c in enumerate(c for c in spark.catalog.listColumns(table) if c.isPartition)]
    rows += [("property", r["key"], r["value"]) for r in spark.sql(f"show tblproperties {table}").collect()]
    return spark.createDataFrame(rows, "kind string, name string, value string")


def layout_drift(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Partition columns and declared properties that differ; properties nobody declared are no drift."""
    both = actual.withColumnRenamed("value", "a").join(declared.withColumnRenamed("value", "b"), ["kind", "name"], "full_outer")
    kind = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull() & (F.col("kind") == "partition"), "extra").when(F.col("a") != F.col("b"), "value")
    return both.withColumn("drift", kind).where("drift is not null").select("kind", "name", "drift")


def profile(df: DataFrame, columns: Sequence[str], samples: int = 3) -> DataFrame:
    """Per column: nulls, values, least and greatest text, the type that fits all values, and its least distinct values.

    Counters in one pass over all rows, and one for the samples; columns are cast to text first.
    """
    # whole numbers fit without a point; decimals with one; times as yyyy-MM-dd with an optional time
    rules = (("integer", r"^-?[0-9]+$"), ("decimal", r"^-?[0-9]+(\.[0-9]+)?$"), ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?$"))
    parts = []
    for c in columns:
        t = F.col(c).cast("string")
        parts.append(F.struct(F.lit(c).alias("column_name"), F.count_if(t.isNull()).alias("nulls"), F.count(t).alias("n_values"), F.min(t).alias("least"), F.max(t).alias("greatest"), *(F.count_if(t.rlike(r)).alias(n) for n, r in rules)).alias(c))
    flat = df.agg(*parts).select(F.explode(F.array(*columns)).alias("x")).select("x.*")
    kind = F.when(F.col("n_values") == 0, "empty")
    for name, _ in rules:
        kind = kind.when(F.col(name) == F.col("n_values"), name)
    out = flat.select("column_name", "nulls", "n_values", "least", "greatest", kind.otherwise("string").alias("inferred_type"))
    # the least distinct values: distinct ones first, then the first few of each column
    seen = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("x.*").where("value is not null").distinct()
    some = seen.withColumn("_n", F.row_number().over(Window.partitionBy("column_name").orderBy("value"))).where(F.col("_n") <= samples)
    some = some.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("samples"))
    return out.join(some, "column_name", "left")

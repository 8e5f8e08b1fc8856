"""SCH-1..SCH-9, SRC-8: source schemas as DataFrames, and their mapping to the destination."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote
from tidemark.session import shared_dir

RELATIONAL, DOCUMENT, WAREHOUSE = "relational", "document", "warehouse"

# Source type names (lower case) by the destination type they map to.
RELATIONAL_TYPES = {
    "STRING": ("character varying", "varchar", "text", "char", "character", "interval",
               "uuid", "inet", "cidr", "macaddr"),
    "INTEGER": ("integer", "int", "int4", "bigint", "int8", "smallint", "int2",
                "serial", "bigserial"),
    "NUMERIC": ("numeric", "decimal", "money"),
    "FLOAT": ("real", "float4", "double precision", "float8"),
    "TIMESTAMP": ("timestamp without time zone", "timestamp with time zone",
                  "timestamp", "timestamptz"),
    "DATE": ("date",),
    "TIME": ("time", "timetz"),
    "BOOLEAN": ("boolean", "bool"),
    "JSON": ("json", "jsonb"),
}
DOCUMENT_TYPES = {
    "STRING": ("string", "null", "regex", "javascript", "mixed"),
    "INTEGER": ("int", "long"),
    "FLOAT": ("double",),
    "NUMERIC": ("decimal128",),
    "BOOLEAN": ("boolean",),
    "TIMESTAMP": ("date", "timestamp"),
    "JSON": ("object", "array"),
    "BYTES": ("binary",),
}
WAREHOUSE_TYPES = ("STRING", "INTEGER", "FLOAT", "NUMERIC", "BOOLEAN", "TIMESTAMP", "DATE",
                   "TIME", "DATETIME", "JSON", "GEOGRAPHY", "BYTES", "RECORD")

# Names added so that every type of the source keeps its kind.
RELATIONAL_ADDED = {
    "BYTES": ("bytea",),
    "TIME": ("time without time zone", "time with time zone"),
}

# The Spark type that holds each destination type.
SPARK_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "DATETIME": T.TimestampNTZType(),
    "JSON": T.StringType(),
    "GEOGRAPHY": T.StringType(),
    "BYTES": T.BinaryType(),
}


@dataclass(frozen=True)
class FieldSpec:
    """A destination column: its type name and NULLABLE, REQUIRED or REPEATED."""

    type: str
    mode: str = "NULLABLE"


def _inverted(groups: Mapping[str, Iterable[str]]) -> dict[str, str]:
    return {name: target for target, names in groups.items() for name in names}


def type_map(kind: str, mapping: str = "fixed") -> dict[str, str]:
    """Lower-case source type to destination type, for one kind of source.

    ``compat`` is one table for all kinds, in which a document's ``date`` hides the
    relational one and warehouse-only names are unknown.
    """
    if mapping == "compat":
        return {**_inverted(RELATIONAL_TYPES), **_inverted(DOCUMENT_TYPES)}
    if mapping != "fixed":
        raise ValueError("mapping is 'fixed' or 'compat'")
    if kind == DOCUMENT:
        return _inverted(DOCUMENT_TYPES)
    if kind == WAREHOUSE:
        return {name.lower(): name for name in WAREHOUSE_TYPES}
    return {**_inverted(RELATIONAL_TYPES), **_inverted(RELATIONAL_ADDED)}


def relational_type_name(dtype: T.DataType) -> str:
    names = {
        T.StringType: "text", T.LongType: "bigint", T.IntegerType: "integer",
        T.ShortType: "smallint", T.ByteType: "smallint", T.DoubleType: "double precision",
        T.FloatType: "real", T.DecimalType: "numeric", T.BooleanType: "boolean",
        T.DateType: "date", T.TimestampType: "timestamp with time zone",
        T.TimestampNTZType: "timestamp without time zone", T.BinaryType: "bytea",
    }
    if isinstance(dtype, T.ArrayType):
        return f"{relational_type_name(dtype.elementType)}[]"
    return names.get(type(dtype), "jsonb")


def warehouse_type_name(dtype: T.DataType) -> str:
    names = {
        T.StringType: "STRING", T.LongType: "INTEGER", T.IntegerType: "INTEGER",
        T.ShortType: "INTEGER", T.ByteType: "INTEGER", T.DoubleType: "FLOAT",
        T.FloatType: "FLOAT", T.DecimalType: "NUMERIC", T.BooleanType: "BOOLEAN",
        T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "DATETIME",
        T.BinaryType: "BYTES", T.StructType: "RECORD",
    }
    if isinstance(dtype, T.ArrayType):
        return warehouse_type_name(dtype.elementType)
    return names.get(type(dtype), "JSON")


def _mode(f: T.StructField, nullable: Column) -> Column:
    if isinstance(f.dataType, T.ArrayType):
        return F.lit("REPEATED")
    return F.when(nullable, "NULLABLE").otherwise("REQUIRED")


def relational_schema(df: DataFrame) -> DataFrame:
    """SCH-1: name, type, length, nullable, default and position of every column.

    Files carry no constraints, so length and nullability are measured: one pass,
    one partial aggregate per task, one row out.
    """
    columns = []
    for position, f in enumerate(df.schema, start=1):
        c = F.col(quote(f.name))
        is_text = isinstance(f.dataType, T.StringType)
        length = F.max(F.length(c)) if is_text else F.lit(None)
        columns.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(relational_type_name(f.dataType)).alias("type"),
                length.cast("bigint").alias("max_length"),
                (F.count(c) < F.count(F.lit(1))).alias("nullable"),
                F.lit(None).cast("string").alias("default"),
                F.lit(position).cast("bigint").alias("position"),
            )
        )
    return df.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))


def warehouse_schema(df: DataFrame) -> DataFrame:
    """SCH-2: name, type, mode, description and nullable; nested fields are not listed."""
    columns = []
    for f in df.schema:
        nullable = F.count(F.col(quote(f.name))) < F.count(F.lit(1))
        mode = _mode(f, nullable)
        columns.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(warehouse_type_name(f.dataType)).alias("type"),
                mode.alias("mode"),
                F.lit(f.metadata.get("comment")).cast("string").alias("description"),
                (mode == "NULLABLE").alias("nullable"),
            )
        )
    return df.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))


def document_type_name(dtype: T.DataType) -> str:
    names = {
        T.StringType: "string", T.BooleanType: "boolean", T.DoubleType: "double",
        T.FloatType: "double", T.DecimalType: "decimal128", T.DateType: "date",
        T.TimestampType: "date", T.TimestampNTZType: "date", T.BinaryType: "binary",
        T.ArrayType: "array", T.NullType: "null",
    }
    if isinstance(dtype, T.IntegralType):
        return "int"
    return names.get(type(dtype), "object")


def declared_schema(df: DataFrame, kind: str) -> DataFrame:
    """The schema a frame already declares, in the same shape; reads no row."""
    name_of = {
        RELATIONAL: relational_type_name,
        WAREHOUSE: warehouse_type_name,
        DOCUMENT: document_type_name,
    }[kind]
    rows = []
    for f in df.schema:
        repeated = isinstance(f.dataType, T.ArrayType) and kind != DOCUMENT
        mode = "REPEATED" if repeated else ("NULLABLE" if f.nullable else "REQUIRED")
        rows.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(name_of(f.dataType)).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                F.lit(mode).alias("mode"),
            )
        )
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


# --- documents -------------------------------------------------------------------

COMPAT_DEPTH = 3
FIELDS = "map<string,variant>"
# Marks of what is counted beside (path, type): documents that hold a path, documents, and those that
# go on below what was walked.
HOLDERS, DOCUMENTS, DEEPER = "", "#", "+"


def _kind_of(schema: Column) -> Column:
    return (
        F.when(schema == "VOID", "null")
        .when(schema == "STRING", "string")
        .when(schema == "BIGINT", "int")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), "int")
        .when(schema.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "double")
        .when(schema.rlike("^OBJECT<`?[$]oid`?: [A-Z]+>$"), "objectId")
        .when(schema.rlike("^OBJECT<`?[$]date`?: [^,]+>$"), "date")
        .when(schema.startswith("OBJECT<"), "object")
        .when(schema.startswith("ARRAY<"), "array")
        .when(schema.rlike("^(DATE|TIMESTAMP)"), "date")
        .otherwise("mixed")
    )


def value_kind(v: Column) -> Column:
    """SCH-5: null, boolean, int, double, string, objectId, object, array, date or mixed.

    The schema is bound by a lambda, so that it is worked out once and not for every branch.
    """
    return F.transform(F.array(F.schema_of_variant(v)), _kind_of)[0]


def _fields(value: Column) -> Column:
    return F.try_variant_get(value, "$", FIELDS)


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


# --- the walk that follows the documented one: three segments, first elements

COMPAT_ENTRIES = "array<struct<path:string,value:variant,type:string,dots:int>>"


def _compat_entry(path: Column, value: Column, dots: Column) -> Column:
    """``dots``: those of the path of what the field is in, and one more."""
    return F.struct(path.alias("path"), value.alias("value"), value_kind(value).alias("type"), dots.alias("dots"))


def _compat_marks(df: DataFrame, variant: str, depth: int | None) -> DataFrame:
    levels = depth or COMPAT_DEPTH

    def children(entry: Column) -> Column:
        value = entry["value"]
        first = F.try_variant_get(value, "$[0]", "variant")
        listed = F.when(value_kind(first) == "object", F.map_entries(_fields(first)))
        below = F.coalesce(F.map_entries(_fields(value)), listed)
        below = F.when(entry["dots"] < levels - 1, below)
        # Wrapped ids and dates are values; what is in them is no field.
        below = F.when(entry["type"].isin("object", "array"), below)
        # A dot inside a key counts as a segment of the paths below it.
        dots = F.length(entry["path"]) - F.length(F.replace(entry["path"], F.lit("."), F.lit(""))) + 1
        named = F.transform(below, lambda e: _compat_entry(F.concat(entry["path"], F.lit("."), e["key"]), e["value"], dots))
        return F.coalesce(named, F.array().cast(COMPAT_ENTRIES))

    roots = F.transform(F.map_entries(_fields(F.col(quote(variant)))), lambda e: _compat_entry(e["key"], e["value"], F.lit(0)))
    df = df.select(F.coalesce(roots, F.array().cast(COMPAT_ENTRIES)).alias("l0"))
    for k in range(1, levels):
        df = df.select("*", F.flatten(F.transform(f"l{k - 1}", children)).alias(f"l{k}"))
    df = df.select(F.concat(*(F.transform(f"l{k}", lambda e: F.struct(e["path"], e["type"])) for k in range(levels))).alias("found"))
    told = F.transform("found", lambda e: F.concat(e["path"], F.lit("\0"), e["type"]))
    holders = F.array_distinct(F.transform("found", lambda e: F.concat(e["path"], F.lit("\0" + HOLDERS))))
    return _marks_counted(df, F.concat(told, holders, F.array(F.lit("\0" + DOCUMENTS))))


def _marks_counted(df: DataFrame, marks: Column) -> DataFrame:
    """Rows (path, type, n) of all ``marks``; combined in each task, so a row for each kind of mark and
    task is shuffled, and marks are taken apart when counted. Exploding a plain column would make Spark
    infer a filter on it, which it pushes below the whole walk, every step written out once more."""
    at = F.length("mark") - F.length(F.substring_index("mark", "\0", -1))
    counted = df.select(F.explode(marks).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.substring("mark", F.lit(1), at - 1).alias("path"), F.substring_index("mark", "\0", -1).alias("type"), "n")


# --- the walk to every end

WALKED = 4  # levels of the first walk; an array's elements are a level of their own
TASKS_PER_CORE = 4  # where documents are dealt
ENTRIES = "array<struct<path:string,value:variant,counted:boolean,level:int>>"


def _entry(path: Column, value: Column, counted: bool, level: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"), F.lit(counted).alias("counted"), level.alias("level"))


def _opened(entry: Column) -> Column:
    """An entry with its fields and elements; a wrapped id or date has neither."""
    value = entry["value"]
    return F.struct(entry["path"].alias("path"), value.alias("value"), entry["counted"].alias("counted"), entry["level"].alias("level"),
                    _fields(value).alias("fields"), _items(value).alias("items"))


def _typed(e: Column) -> Column:
    """The entry's type; only scalars and objects of one field, which may be wrappers, are looked at closely."""
    kind = (
        F.when(e["items"].isNotNull(), "array")
        .when(F.size(e["fields"]) != 1, "object")
        .when(e["counted"] | e["fields"].isNotNull(), value_kind(e["value"]))
    )
    return F.struct(e["path"].alias("path"), e["counted"].alias("counted"), e["level"].alias("level"), kind.alias("type"),
                    e["fields"].alias("fields"), e["items"].alias("items"))


def _below(e: Column, depth: int | None) -> Column:
    """What the next level looks at: the fields of an object, the elements of an array."""
    fields = F.transform(F.map_entries(e["fields"]), lambda f: _entry(F.concat(e["path"], F.lit("."), f["key"]), f["value"], True, e["level"] + 1))
    items = F.transform(e["items"], lambda x: _entry(e["path"], x, False, e["level"]))
    found = F.when(e["type"] == "object", fields).when(e["type"] == "array", items)
    found = F.when(e["level"] < depth, found) if depth else found
    return F.coalesce(found, F.array().cast(ENTRIES))


def _walk(df: DataFrame, levels: int, depth: int | None) -> DataFrame:
    """``df`` has the entries of a level and what was told of its document before (``told``); the
    result has the new marks, all of them, and the entries that ``levels`` levels did not reach (``rest``)."""
    df = df.select("told", F.col("rest").alias("l0"))
    for k in range(levels):
        df = df.select("*", F.transform(f"l{k}", _opened).alias(f"o{k}"))
        df = df.select("*", F.transform(f"o{k}", _typed).alias(f"t{k}"))
        df = df.select("*", F.flatten(F.transform(f"t{k}", lambda e: _below(e, depth))).alias(f"l{k + 1}"))
    seen = [F.transform(F.filter(f"t{k}", lambda e: e["counted"]), lambda e: F.concat(e["path"], F.lit("\0"), e["type"])) for k in range(levels)]
    holders = F.transform("types", lambda m: F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(F.substring_index(m, "\0", -1))), F.lit(HOLDERS)))
    df = df.select("told", F.col(f"l{levels}").alias("rest"), F.array_distinct(F.concat(*seen)).alias("types"))
    df = df.select("told", "rest", F.array_distinct(F.concat("types", holders)).alias("found"))
    # Several elements of an array may hold the same field: it counts once for a document.
    return df.select(F.array_except("found", "told").alias("marks"), F.array_union("told", "found").alias("told"), "rest")


def first_walk(df: DataFrame, variant: str, depth: int | None = None) -> DataFrame:
    """Counted marks of all documents as far as the first walk goes; DEEPER counts those that go on."""
    walked = _walk(_documents(df, variant), WALKED, depth)
    return _marks_counted(walked, _with_own(F.lit("\0" + DOCUMENTS)))


def _spread(df: DataFrame) -> DataFrame:
    """Documents of few partitions, dealt to all cores, several tasks each: walking one costs far more than
    moving it, and columns packed in little space may make a partition of many. Those of many partitions
    stay where they are."""
    tasks = df.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def _documents(df: DataFrame, variant: str) -> DataFrame:
    df = _spread(df.select(quote(variant)))
    roots = F.transform(F.map_entries(_fields(F.col(quote(variant)))), lambda e: _entry(e["key"], e["value"], True, F.lit(1)))
    return df.select(F.array().cast("array<string>").alias("told"), F.coalesce(roots, F.array().cast(ENTRIES)).alias("rest"))


def _with_own(*marks: Column) -> Column:
    goes_on = F.when(F.size("rest") > 0, F.array(F.lit("\0" + DEEPER))).otherwise(F.array().cast("array<string>"))
    return F.concat("marks", goes_on, F.array(*marks).cast("array<string>"))


def _counted_marks(df: DataFrame, variant: str, compat: bool, depth: int | None) -> DataFrame:
    """The counts of a walk, stored: few rows, whatever the number of documents.

    Documents that go on below the levels of a walk are walked on from where it ended, twice as
    many levels as before, and only they; the first walk of a usual collection is the only one.
    """
    if compat:
        return _compat_marks(df, variant, depth)
    found = _stored(first_walk(df, variant, depth))
    counts, walked, levels = found, _walk(_documents(df, variant), WALKED, depth), WALKED
    while not found.filter(F.col("type") == DEEPER).isEmpty():
        deep = _stored(walked.filter(F.size("rest") > 0).select("told", "rest"))
        levels *= 2
        walked = _walk(deep, levels, depth)
        found = _stored(_marks_counted(walked, _with_own()))
        counts = counts.unionByName(found)
    return counts.filter(F.col("type") != DEEPER).groupBy("path", "type").agg(F.sum("n").alias("n"))


def _stored(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_type_counts(df: DataFrame, variant: str, compat: bool = False, depth: int | None = None) -> DataFrame:
    """AGG-3: documents per (path, type). Objects are walked to their end and arrays by all
    their elements; ``compat`` goes three segments deep and by first elements, ``depth``
    sets another end. The walk is done when this returns."""
    return _counted_marks(df, variant, compat, depth).filter(~F.col("type").isin(HOLDERS, DOCUMENTS))


def document_schema(df: DataFrame, variant: str, compat: bool = False, depth: int | None = None) -> DataFrame:
    """SCH-3, SCH-6: per path the dominant type and how often it occurs.

    Every row of ``df`` is one document, and all are read. Ties go to a type other than
    null, then to the type's name, so the result does not depend on row order.
    """
    counted = _counted_marks(df, variant, compat, depth)
    total = counted.filter(F.col("type") == DOCUMENTS).select(F.max("n")).scalar()
    preference = F.struct((-F.col("n")).alias("n"), F.col("type") == "null", F.col("type").alias("type"))
    is_type = ~F.col("type").isin(HOLDERS, DOCUMENTS)
    return (
        counted.filter(F.col("type") != DOCUMENTS).groupBy("path")
        .agg(F.min(F.when(is_type, preference)).alias("best"), F.max(F.when(~is_type, F.col("n"))).alias("sample_count"))
        .select(
            F.col("path").alias("name"),
            F.col("best.type").alias("type"),
            (F.col("sample_count") < total).alias("nullable"),
            (F.col("sample_count") / total).alias("frequency"),
            (-F.col("best.n") / F.col("sample_count")).alias("type_frequency"),
            "sample_count",
        )
    )


# --- mapping ---------------------------------------------------------------------


def map_schema(schema: DataFrame, kind: str, mapping: str = "fixed") -> DataFrame:
    """SCH-7..SCH-9: destination type, mode and description for every source column."""
    known = type_map(kind, mapping)
    lookup = F.expr("map(" + ", ".join(f"'{a}', '{b}'" for a, b in known.items()) + ")")
    source = F.lower(F.col("type"))
    repeated = source.contains("array")
    if "mode" in schema.columns:
        repeated = repeated | (F.coalesce(F.col("mode"), F.lit("")) == "REPEATED")
    elif mapping == "fixed":
        repeated = repeated | source.endswith("[]")
    base = F.when(repeated & source.contains("["), F.substring_index(source, "[", 1)).otherwise(source)
    target = F.coalesce(F.try_element_at(lookup, base), F.lit("STRING"))
    if mapping == "fixed" and kind == RELATIONAL:
        target = F.when(base == "array", "STRING").otherwise(target)
    if mapping == "compat":
        target = F.when(base == "array", "JSON").otherwise(target)
    return schema.select(
        "name",
        target.alias("destination_type"),
        F.when(repeated, "REPEATED")
        .when(F.coalesce(F.col("nullable"), F.lit(True)), "NULLABLE")
        .otherwise("REQUIRED")
        .alias("mode"),
        F.concat(F.lit("Auto-generated from source column: "), "name", F.lit(" ("), source, F.lit(")"))
        .alias("description"),
    )


def mapped_rows(mapped: DataFrame, columns: Iterable[str] = ()) -> list[Row]:
    """The mapped schema on the driver, where the table is created.

    A path below a field is part of its parent's JSON and gets no column of its own; a
    column of ``columns`` whose name has a dot does. A table's width bounds what is collected.
    """
    own = F.col("name").isin([c for c in columns if "." in c])
    return mapped.filter(~F.col("name").contains(".") | own).collect()


def destination_struct(rows: Iterable[Row]) -> T.StructType:
    """The destination's Spark schema; type name, mode and comment stay with each field."""
    fields = []
    for row in rows:
        base = SPARK_TYPES.get(row["destination_type"], T.StringType())
        dtype = T.ArrayType(base) if row["mode"] == "REPEATED" else base
        metadata = {
            "comment": row["description"],
            "destination_type": row["destination_type"],
            "mode": row["mode"],
        }
        fields.append(T.StructField(row["name"], dtype, row["mode"] != "REQUIRED", metadata))
    return T.StructType(fields)


def with_catalog(schema: T.StructType, columns: Mapping[str, Row]) -> T.StructType:
    """The destination's schema with what a database's catalog says of its columns: the type it
    maps to, unless it is an array (the driver names its elements), length, default and REQUIRED."""
    fields = []
    for f in schema:
        row = columns.get(f.name)
        if row is None:
            fields.append(f)
            continue
        said = {"max_length": row["max_length"], "default": row["default"]}
        metadata = f.metadata | {k: v for k, v in said.items() if v is not None}
        dtype, nullable = f.dataType, f.nullable
        if row["mode"] != "REPEATED":
            nullable = row["mode"] != "REQUIRED"
            dtype = SPARK_TYPES.get(row["destination_type"], T.StringType())
            metadata |= {"destination_type": row["destination_type"], "mode": row["mode"], "comment": row["description"]}
        fields.append(T.StructField(f.name, dtype, nullable, metadata))
    return T.StructType(fields)


def field_specs(schema: T.StructType) -> dict[str, FieldSpec]:
    """SRC-8: type and mode per column of a destination schema."""
    specs = {}
    for f in schema:
        repeated = isinstance(f.dataType, T.ArrayType)
        mode = "REPEATED" if repeated else ("NULLABLE" if f.nullable else "REQUIRED")
        specs[f.name] = FieldSpec(
            f.metadata.get("destination_type", warehouse_type_name(f.dataType)),
            f.metadata.get("mode", mode),
        )
    return specs


def destination_schema(spark: SparkSession, table: str) -> dict[str, FieldSpec]:
    """SRC-8 for a table; empty when there is none, and coercion then knows no types."""
    if not spark.catalog.tableExists(table):
        return {}
    return field_specs(spark.table(table).schema)

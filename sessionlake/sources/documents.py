"""Document collections and the small lookups made on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake.session import materialize


def read_documents(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: T.StructType,
) -> DataFrame:
    """A whole document collection through any Spark data source (``json``, ``parquet``, or
    an installed connector). The schema is required: inferring one scans the collection, and
    what it finds depends on the documents at hand."""
    return spark.read.format(fmt).options(**dict(options)).schema(schema).load()


def station_ids(docs: DataFrame, n: int, id_column: str = "_id") -> DataFrame:
    """The first ``n`` ids in id order."""
    ids = docs.select(F.col(id_column).cast("string").alias("station_id"))
    return ids.orderBy("station_id").limit(n)


def battery_capacities(docs: DataFrame) -> DataFrame:
    """Lookup of whole-number battery capacity by vehicle id; fractions are cut off."""
    return docs.select(
        F.col("_id").cast("string").alias("vehicle_id"),
        F.col("Battery_capacity").try_cast("int").alias("battery_capacity"),
    )


# How documents name kinds of values, by the types that a parsed value can have.
_KINDS = {
    "VOID": "null", "TINYINT": "integer", "SMALLINT": "integer", "INT": "integer", "BIGINT": "integer",
    "DECIMAL": "number", "FLOAT": "number", "DOUBLE": "number", "STRING": "text", "BOOLEAN": "boolean",
    "OBJECT": "object", "ARRAY": "array",
}


def _kind(value: Column) -> Column:
    """The kind of a parsed value; what could not be parsed is ``unreadable``."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.when(value.isNull(), "unreadable").otherwise(F.coalesce(kinds[name], F.lower(name)))


def document_paths(docs: DataFrame, column: str = "value") -> DataFrame:
    """What JSON documents have where: ``path``, ``kind`` and ``n_values``, the number of values.

    The document is ``$``, a field ``$.a.b``, the elements of an array ``$.a[]``; names that are
    not plain words are quoted. Every level of nesting is one step: its values are counted
    by path and kind, with partial counts before anything moves, and only objects and arrays
    are opened for the next. So it takes as many steps as the deepest document has levels, and no
    document is ever gathered. Null documents are ``unreadable``, as malformed ones are.
    """
    level = docs.select(F.lit("$").alias("path"), F.try_parse_json(F.col(column)).alias("value"))
    found = None
    while True:
        level = materialize(level.withColumn("kind", _kind(F.col("value"))), "document-level")
        counts = level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n_values"))
        found = counts if found is None else found.unionByName(counts)
        nested = level.where(F.col("kind").isin("object", "array"))
        if nested.isEmpty():
            return found
        children = docs.sparkSession.tvf.variant_explode(F.col("value").outer())
        quoted = F.concat(F.lit("`"), F.col("key"), F.lit("`"))
        name = F.when(F.col("key").rlike("^[A-Za-z0-9_]+$"), F.col("key")).otherwise(quoted)
        step = F.when(F.col("kind") == "array", "[]").otherwise(F.concat(F.lit("."), name))
        below = nested.lateralJoin(children.select("key", F.col("value").alias("child")))
        level = below.select(F.concat("path", step).alias("path"), F.col("child").alias("value"))


def schema_paths(schema: T.DataType, path: str = "$") -> list[tuple[str, str]]:
    """The paths of an explicit schema, each with the kind that it calls for."""
    if isinstance(schema, T.StructType):
        fields = [p for f in schema.fields for p in schema_paths(f.dataType, f"{path}.{f.name}")]
        return [(path, "object"), *fields]
    if isinstance(schema, T.ArrayType):
        return [(path, "array"), *schema_paths(schema.elementType, f"{path}[]")]
    if isinstance(schema, T.IntegralType):
        return [(path, "integer")]
    if isinstance(schema, T.FractionalType | T.DecimalType):
        return [(path, "number")]
    return [(path, "boolean" if isinstance(schema, T.BooleanType) else "text")]


def document_schema(docs: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON documents held against an explicit schema, one row per path of either.

    ``found`` joins all kinds of the values at a path: integers and numbers are numbers, nulls
    go with anything; kinds that can't be joined are listed with bars between them. ``status``:
    ``ok``; ``conflict``: several kinds, or not the ``expected`` one (integers do for
    numbers); ``unknown``: the schema hasn't got the path; ``absent``: no document has a value
    there. ``n_values`` and ``n_nulls`` count.
    """
    spark = docs.sparkSession
    expected = spark.createDataFrame(schema_paths(schema), "path STRING, expected STRING")
    kinds = F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind"))))
    found = (
        document_paths(docs, column)
        .groupBy("path")
        .agg(
            F.sum(F.when(F.col("kind") != "null", F.col("n_values")).otherwise(0)).alias("n_values"),
            F.sum(F.when(F.col("kind") == "null", F.col("n_values")).otherwise(0)).alias("n_nulls"),
            kinds.alias("kinds"),
        )
    )
    numeric = F.size(F.array_except("kinds", F.array(F.lit("integer"), F.lit("number")))) == 0
    joined = (
        F.when(F.size("kinds") == 0, F.lit(None).cast("string"))
        .when((F.size("kinds") > 1) & numeric, "number")
        .otherwise(F.array_join("kinds", "|"))
    )
    both = found.withColumn("found", joined).join(expected, "path", "full")
    fits = (F.col("found") == F.col("expected")) | (
        (F.col("found") == "integer") & (F.col("expected") == "number")
    )
    status = (
        F.when(F.col("expected").isNull(), "unknown")
        .when(F.col("found").isNull(), "absent")
        .when(fits, "ok")
        .otherwise("conflict")
    )
    counts = [F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in ("n_values", "n_nulls")]
    return both.select("path", "found", "expected", *counts, status.alias("status"))

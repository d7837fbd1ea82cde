"""Warehouse tables: append and read, over JDBC or files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.session import path_exists


def jdbc_options(table: str, options: Mapping[str, str]) -> dict[str, str]:
    """Options of a JDBC append. ``numPartitions`` bounds the connections opened at once; the
    caller sets it to what the warehouse can take."""
    return {"dbtable": table, "batchsize": str(schemas.WAREHOUSE_BATCH_SIZE), **options}


def jdbc_read_options(
    table: str,
    options: Mapping[str, str],
    where: str | None = None,
    partition: tuple[str, object, object] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read.

    ``where``, in the warehouse's own SQL, is evaluated there: Spark's filters don't get past
    the casts to the schema's types. ``partition`` (column, lowest, highest value) cuts
    the read into as many tasks as ``numPartitions`` says; without it one connection reads all.
    """
    found = jdbc_options(table, options)
    if where is not None:
        found["dbtable"] = f"(SELECT * FROM {table} WHERE {where}) AS {table}_part"
    if partition is not None:
        column, low, high = partition
        found |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high)}
        found.setdefault("numPartitions", "16")
    return found


def append_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> int:
    """Append to a table and return the number of rows written, as the write counts them.

    ``table`` is a table name for ``jdbc`` and a folder for file formats. Nothing is inserted
    where there are no rows; ``df`` is run once, however dear it is.
    """
    observation = Observation(f"append {table}")
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    if fmt == "jdbc":
        observed.write.format(fmt).options(**jdbc_options(table, options or {})).mode(
            "append"
        ).save()
    else:
        observed.write.format(fmt).options(**dict(options or {})).mode("append").save(table)
    return observation.get["rows"]


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table with a known schema; empty as long as nothing has been written. Reading
    writes nothing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Warehouse:
    """Where the star schema lives: parquet tables below ``folder``, or, with ``jdbc``
    connection options, tables of that database. Bookkeeping of the loads (quarantine,
    processed commits) is always kept below ``folder``."""

    folder: str
    jdbc: Mapping[str, str] | None = None

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(
        self,
        spark: SparkSession,
        name: str,
        where: str | None = None,
        partition: tuple[str, object, object] | None = None,
    ) -> DataFrame:
        """A table, or with ``where`` the rows that fulfil an SQL condition; ``partition`` as in
        :func:`jdbc_read_options`."""
        schema = schemas.TABLES[name]
        if self.jdbc is None:
            rows = open_table(spark, self.path(name), schema)
            return rows if where is None else rows.where(where)
        options = jdbc_read_options(name, self.jdbc, where, partition)
        loaded = spark.read.format("jdbc").options(**options).load()
        return loaded.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    def append(self, df: DataFrame, name: str) -> int:
        if self.jdbc is None:
            return append_table(df, self.path(name))
        return append_table(df, name, "jdbc", self.jdbc)


def ordered(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows in an order that lets readers skip row groups, kept within each file."""
    return df.sortWithinPartitions(*columns)

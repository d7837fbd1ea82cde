"""The star view as a stored table that follows the warehouse.

Layout below the warehouse's folder::

    kept-view/session_number_range=N/view_id=V/*.parquet    rows of the view, by bucket
    kept-view-dimensions/name=D/view_id=V/*.parquet         dimension ids that refresh V was the first to see
    kept-view-versions/seq=S/*.parquet                      of which load, and where, buckets are after refresh S
    kept-view-refreshes/seq=S/*.parquet                     finished refreshes

Only buckets whose facts have changed, and those with a fact of a dimension row that is new, are
joined again. A refresh is entered as finished last; nothing that others have written is read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.operators.star import star_view
from sessionlake.plans.warehouse import FACT, bucket_facts, valid_loads
from sessionlake.session import intermediates_removed, materialize
from sessionlake.sources.tables import Warehouse, open_table

VIEW = "kept-view"
VERSIONS = "kept-view-versions"
SEEN = "kept-view-dimensions"
REFRESHES = "kept-view-refreshes"

# What ids of refreshes start with.
VIEW_PREFIX = "v"

_VERSION = T.StructType(
    [
        T.StructField(schemas.BUCKET_COLUMN, T.LongType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("view_id", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)
_SEEN = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "name", "view_id")])
_REFRESH = T.StructType([T.StructField("view_id", T.StringType()), T.StructField("seq", T.LongType())])

# Each dimension with its id and the columns of a fact that refer to it.
_REFERENCES = {
    "dim_station": ("id", ("station_id",)),
    "dim_vehicle": ("id", ("vehicle_id",)),
    "dim_time": ("time_id", ("start_time_id", "end_time_id")),
}


def _refreshes(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return open_table(spark, warehouse.path(REFRESHES), _REFRESH)


def _versions(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Of each bucket, the load that the stored view has, and where it is."""
    finished = _refreshes(spark, warehouse).select("view_id")
    versions = open_table(spark, warehouse.path(VERSIONS), _VERSION).join(finished, "view_id", "left_semi")
    last = F.max_by(F.struct("load_id", "view_id"), "seq").alias("last")
    latest = versions.groupBy(schemas.BUCKET_COLUMN).agg(last)
    return latest.select(schemas.BUCKET_COLUMN, "last.load_id", "last.view_id")


def kept_view(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The star view as of the last refresh, read from where it is stored."""
    plain = star_view(*[spark.createDataFrame([], schemas.TABLES[n]) for n in (FACT, *_REFERENCES)]).schema
    place = [
        T.StructField(schemas.BUCKET_COLUMN, T.LongType()), T.StructField("view_id", T.StringType())
    ]
    rows = open_table(spark, warehouse.path(VIEW), T.StructType(plain.fields + place))
    # always true; Spark prunes partitions by a join only if its other side has a condition
    valid = _versions(spark, warehouse).where(F.col("view_id").startswith(VIEW_PREFIX))
    return rows.join(valid, [f.name for f in place], "left_semi").select(*plain.fieldNames())


def refresh_view(spark: SparkSession, warehouse: Warehouse) -> int:
    """Bring the stored view up to date; returns the number of buckets that were joined again.

    Needs a warehouse of files. One refresh runs at a time; one that died has changed nothing.
    """
    if warehouse.jdbc is not None:
        raise ValueError("a view is kept for warehouses of files only")
    bucket = schemas.BUCKET_COLUMN
    with intermediates_removed(spark):
        have = _versions(spark, warehouse).select(bucket, F.col("load_id").alias("_have"))
        loads = valid_loads(spark, warehouse)
        loads = materialize(loads.join(have, bucket, "left"), "loads")
        changed = loads.where(~F.col("load_id").eqNullSafe(F.col("_have"))).select(bucket)
        fresh = {name: materialize(_unseen(spark, warehouse, name), "new-ids") for name in _REFERENCES}
        for name, (_, columns) in _REFERENCES.items():
            if not fresh[name].isEmpty():
                for column in columns:
                    changed = changed.unionByName(_buckets_of(spark, warehouse, column, fresh[name]))
        changed = materialize(changed.distinct(), "changed-buckets")
        n, view_id = changed.count(), f"{VIEW_PREFIX}{uuid.uuid4().hex}"
        if n == 0 and all(ids.isEmpty() for ids in fresh.values()):
            return 0
        last = _refreshes(spark, warehouse).agg(F.max("seq")).first()[0]
        seq = 0 if last is None else last + 1
        _write_buckets(spark, warehouse, changed, view_id)
        for name, ids in fresh.items():
            ids.write.parquet(f"{warehouse.path(SEEN)}/name={name}/view_id={view_id}")
        loads.join(changed, bucket, "left_semi").select(
            bucket, "load_id", F.lit(view_id).alias("view_id")
        ).write.mode("overwrite").parquet(f"{warehouse.path(VERSIONS)}/seq={seq}")
        spark.range(1).select(F.lit(view_id).alias("view_id")).write.mode("overwrite").parquet(
            f"{warehouse.path(REFRESHES)}/seq={seq}"
        )
        return n


def _unseen(spark: SparkSession, warehouse: Warehouse, name: str) -> DataFrame:
    """Ids of a dimension that no finished refresh has seen."""
    finished = _refreshes(spark, warehouse).select("view_id")
    seen = open_table(spark, warehouse.path(SEEN), _SEEN).where(F.col("name") == name)
    seen = seen.join(finished, "view_id", "left_semi").select("id")
    ids = warehouse.read(spark, name).select(F.col(_REFERENCES[name][0]).cast("string").alias("id"))
    return ids.join(seen, "id", "left_anti")


def _buckets_of(spark: SparkSession, warehouse: Warehouse, column: str, ids: DataFrame) -> DataFrame:
    """Buckets with a fact that refers to one of ``ids``; of the facts just that column is read."""
    facts = bucket_facts(spark, warehouse).select(schemas.BUCKET_COLUMN, F.col(column).cast("string").alias("id"))
    return facts.join(ids, "id", "left_semi").select(schemas.BUCKET_COLUMN)


def _write_buckets(spark: SparkSession, warehouse: Warehouse, buckets: DataFrame, view_id: str) -> None:
    bucket = schemas.BUCKET_COLUMN
    facts = bucket_facts(spark, warehouse, buckets)
    dimensions = [warehouse.read(spark, name) for name in _REFERENCES]
    view = star_view(facts, *dimensions, carry=(bucket,))
    (
        view.withColumn("view_id", F.lit(view_id))
        .hint("rebalance", bucket)
        .write.mode("append")
        .partitionBy(bucket, "view_id")
        .parquet(warehouse.path(VIEW))
    )

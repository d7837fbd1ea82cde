"""Loads that follow the commit log: a stream over the commits of main."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sessionlake import schemas
from sessionlake.plans import publishing
from sessionlake.plans.warehouse import SessionLoad, load_published
from sessionlake.session import make_folder
from sessionlake.sources.tables import Warehouse

Load = Callable[[SparkSession, str, Warehouse, DataFrame | None], SessionLoad | None]


def commit_feed(spark: SparkSession, lake: str) -> DataFrame:
    """Commits of main as a stream, each as soon as its publish or rollback is finished."""
    folder = f"{lake.rstrip('/')}/{publishing.MAIN_COMMITS}"
    make_folder(spark, folder)  # a feed may start before the first publish
    return spark.readStream.schema(schemas.MAIN_COMMIT).parquet(folder)


def start_loading(
    spark: SparkSession,
    lake: str,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    holidays: DataFrame | None = None,
    load: Load = load_published,
) -> StreamingQuery:
    """Load whatever is published or taken back, when it is, until the query is stopped.

    New commits start a micro-batch, which runs ``load`` (:func:`load_published` or
    :func:`load_from_partials`); several publishes may end up in one load. A load that died
    is run again from its checkpoint, to the same effect. ``trigger`` takes
    ``DataStreamWriter.trigger`` arguments; the default looks for commits every five seconds.
    """
    if not checkpoint:
        raise ValueError("the feed needs a checkpoint location")

    def run(commits: DataFrame, batch_id: int) -> None:
        load(commits.sparkSession, lake, warehouse, holidays)

    return (
        commit_feed(spark, lake)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": schemas.STREAM_TRIGGER}))
        .start()
    )

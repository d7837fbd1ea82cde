"""Micro-batch ingestion: bucket events, stage them, record the commits.

Layout below the lake root::

    charging-events/batch_id=B/attempt=A/session_number_range=N/*.parquet   staged events
    branch-commits/batch_id=B/*.parquet                its commits, file by file
    batch-audits/batch_id=B/*.parquet                  what its audit found, by bucket

Staged files are never changed: a batch that is replayed is written as another attempt, and
the log then names that one. Commits are written last: an attempt that the log doesn't name was
not finished, or was replaced, and is not read. A lake root belongs to one checkpoint, because
batches are numbered by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlake import schemas
from sessionlake.functions import branch_name, range_bucket
from sessionlake.operators.lake import branch_commit_id, relative_path
from sessionlake.operators.quality import audit_batch, event_fault
from sessionlake.session import path_exists
from sessionlake.sources.events import decode_events
from sessionlake.sources.tables import open_table

BRANCH_COMMITS = "branch-commits"
BATCH_AUDITS = "batch-audits"


def with_bucket(events: DataFrame, width: int = schemas.BUCKET_WIDTH) -> DataFrame:
    return events.withColumn(
        schemas.BUCKET_COLUMN, range_bucket(F.col("session_number"), width)
    )


def batch_buckets(events: DataFrame, width: int = schemas.BUCKET_WIDTH) -> DataFrame:
    """Distinct buckets of a batch; events without a session number have none."""
    bucket = F.col(schemas.BUCKET_COLUMN)
    return with_bucket(events, width).select(bucket).where(bucket.isNotNull()).distinct()


def lake_table(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """A table below a lake root; empty if nothing was written to it yet. There must be a lake
    at the root, so that a mistyped one doesn't read as empty."""
    root = root.rstrip("/")
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no lake at {root}")
    return open_table(spark, f"{root}/{name}", schema)


def stage_batch(
    events: DataFrame, root: str, batch_id: int, width: int = schemas.BUCKET_WIDTH
) -> str:
    """Write one batch below ``root``, one folder per bucket, and return the attempt's name.

    All buckets are written in a single pass. Rows that are no usable event (undecodable, or
    without a session id or number) land in the NULL bucket's folder with the reason: the
    quarantine, which holds back these rows and no others. The rebalance gives small buckets
    one file each and, at run time, splits a hot bucket over as many tasks as its bytes call for.
    """
    attempt = f"a{uuid.uuid4().hex}"
    folder = f"{root.rstrip('/')}/{schemas.EVENTS_DIRECTORY}/batch_id={batch_id}/attempt={attempt}"
    reason = event_fault()
    staged = with_bucket(events.withColumn("reason", reason), width).withColumn(
        schemas.BUCKET_COLUMN, F.when(F.col("reason").isNull(), F.col(schemas.BUCKET_COLUMN))
    )
    if "raw" in staged.columns:
        staged = staged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
    (
        staged.hint("rebalance", schemas.BUCKET_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(schemas.BUCKET_COLUMN)
        .parquet(folder)
    )
    return attempt


def read_staged(
    spark: SparkSession, root: str, batch_id: int | None = None, attempt: str | None = None
) -> DataFrame:
    """Staged rows of the logged attempts, or of a named one, with batch_id and bucket;
    quarantined ones have no bucket."""
    root = root.rstrip("/")
    if attempt is not None:
        base = f"{root}/{schemas.EVENTS_DIRECTORY}"
        reader = spark.read.schema(schemas.STAGED_EVENT).option("basePath", base)
        return reader.parquet(f"{base}/batch_id={batch_id}/attempt={attempt}")
    staged = lake_table(spark, root, schemas.EVENTS_DIRECTORY, schemas.STAGED_EVENT)
    logged = branch_files(spark, root).select("batch_id", "attempt").distinct()
    if batch_id is not None:
        staged, logged = (t.where(F.col("batch_id") == batch_id) for t in (staged, logged))
    return staged.join(logged, ["batch_id", "attempt"], "left_semi")


def staged_events(spark: SparkSession, root: str) -> DataFrame:
    """Staged events that are usable: those that have a bucket."""
    staged = read_staged(spark, root).where(F.col(schemas.BUCKET_COLUMN).isNotNull())
    return staged.select(*schemas.LAKE_EVENT.fieldNames(), "batch_id")


def quarantined_events(spark: SparkSession, root: str) -> DataFrame:
    """Staged rows that are no usable event: with the reason, and the raw text if it was kept."""
    held = read_staged(spark, root).where(F.col(schemas.BUCKET_COLUMN).isNull())
    return held.drop("attempt")


def _commit(batch_id: int) -> list[Column]:
    """Columns of the commit of one bucket; the id depends on batch and bucket only."""
    bucket = F.col(schemas.BUCKET_COLUMN)
    return [
        branch_commit_id(F.lit(batch_id), bucket).alias("commit_id"),
        bucket,
        branch_name(bucket).alias("branch"),
        F.concat(
            F.lit(f"Events of micro-batch {batch_id}, bucket "), bucket.cast("string")
        ).alias("message"),
    ]


def record_commits(batch: DataFrame, batch_id: int) -> DataFrame:
    """One commit per bucket of a batch, with its number of rows."""
    counts = (
        batch.where(F.col(schemas.BUCKET_COLUMN).isNotNull())
        .groupBy(schemas.BUCKET_COLUMN)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counts.select(
        *_commit(batch_id), "n_rows", F.lit(batch_id).cast("bigint").alias("batch_id")
    )


def commit_batch(spark: SparkSession, root: str, batch_id: int, attempt: str) -> None:
    """Audit a staged batch and log its commits, one row per data file.

    Counts and paths come from the files just written, not from the source: the log says what
    is really there. A batch without a usable event is logged too, by its NULL bucket.
    """
    root = root.rstrip("/")
    staged = read_staged(spark, root, batch_id, attempt)
    found = audit_batch(staged.where(F.col(schemas.BUCKET_COLUMN).isNotNull()), by=[schemas.BUCKET_COLUMN])
    audits = [f.name for f in schemas.BATCH_AUDIT.fields if f.name != "batch_id"]
    found.select(*audits).write.mode("overwrite").parquet(
        f"{root}/{BATCH_AUDITS}/batch_id={batch_id}"
    )
    files = (
        staged.groupBy(schemas.BUCKET_COLUMN, "attempt", F.col("_metadata.file_path").alias("_file"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("path", relative_path(root, "_file"))
    )
    files.select(*_commit(batch_id), "path", "n_rows", "attempt").write.mode("overwrite").parquet(
        f"{root}/{BRANCH_COMMITS}/batch_id={batch_id}"
    )


def branch_files(spark: SparkSession, root: str) -> DataFrame:
    """The commit log of all batches, one row per data file a commit added. The NULL bucket's
    files are the quarantine."""
    return lake_table(spark, root, BRANCH_COMMITS, schemas.BRANCH_COMMIT)


def batch_audits(spark: SparkSession, root: str) -> DataFrame:
    """What the audit of each batch found, by bucket."""
    return lake_table(spark, root, BATCH_AUDITS, schemas.BATCH_AUDIT)


def branch_commits(spark: SparkSession, root: str) -> DataFrame:
    """The commit log of all batches, one row per commit."""
    drop = ("path", "n_rows", "attempt")
    commit = [f.name for f in schemas.BRANCH_COMMIT.fields if f.name not in drop]
    usable = branch_files(spark, root).where(F.col(schemas.BUCKET_COLUMN).isNotNull())
    return usable.groupBy(*commit).agg(F.sum("n_rows").alias("n_rows"))


def batch_writer(
    root: str, width: int = schemas.BUCKET_WIDTH
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: stage, then commit."""

    def write(batch: DataFrame, batch_id: int) -> None:
        attempt = stage_batch(batch, root, batch_id, width)
        commit_batch(batch.sparkSession, root, batch_id, attempt)

    return write


def start_ingestion(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    width: int = schemas.BUCKET_WIDTH,
) -> StreamingQuery:
    """Start ingesting a stream of raw messages. ``checkpoint`` is required: it is what lets a
    restart go on where the last run stopped. ``trigger`` takes ``DataStreamWriter.trigger``
    arguments; the default is a micro-batch every five seconds."""
    if not checkpoint:
        raise ValueError("ingestion needs a checkpoint location")
    return (
        decode_events(messages, keep_raw=True)
        .writeStream.foreachBatch(batch_writer(root, width))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": schemas.STREAM_TRIGGER}))
        .start()
    )

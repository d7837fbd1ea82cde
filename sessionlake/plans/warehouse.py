"""Warehouse loads: dimensions, sessions, and the incremental load of what was published.

Over files, the sessions of a bucket are one unit, written anew by each load that touches the
bucket and never changed::

    fact_charging_sessions/session_number_range=N/load_id=L/*.parquet
    session_quarantine/session_number_range=N/load_id=L/*.parquet
    session-versions/seq=S/*.parquet        which load of a bucket is the valid one
    session-partials/session_number_range=N/seq=S/*.parquet   what publish S adds to sessions
    partial-commits/*.parquet               the commits whose partials are written

The versions are written last, so facts and quarantine of a load become visible together. A
warehouse behind JDBC can only be appended to; there, sessions that are loaded stay as they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.functions import time_id
from sessionlake.operators.facts import (
    conform_fact,
    loadable_facts,
    new_facts,
    same_session,
)
from sessionlake.operators.lake import merge_commits, new_commits
from sessionlake.operators.quality import assert_unique
from sessionlake.operators.sessions import (
    assemble_sessions,
    is_valid,
    merge_partials,
    partial_sessions,
    quarantine_sessions,
    session_quality,
    valid_sessions,
)
from sessionlake.operators.star import star_view
from sessionlake.operators.timedim import merge_time_dim, session_time_ids
from sessionlake.plans.publishing import (
    events_of,
    logged_files,
    main_commits,
    main_events,
    visible,
)
from sessionlake.session import intermediates_removed, materialize
from sessionlake.sources.tables import Warehouse, append_table, open_table, ordered

QUARANTINE = "session_quarantine"
VERSIONS = "session-versions"
PROCESSED = "processed_commits"
PARTIALS = "session-partials"
PARTIAL_COMMITS = "partial-commits"
FACT = "fact_charging_sessions"

# Bucket of sessions whose events carry none.
NO_BUCKET = -1

# What ids of loads start with.
LOAD_PREFIX = "l"

_PLACE = [T.StructField(schemas.BUCKET_COLUMN, T.LongType()), T.StructField("load_id", T.StringType())]


@dataclass(frozen=True)
class SessionLoad:
    """What a session load did. ``new_facts``: facts of sessions that had none; ``removed_facts``:
    facts of sessions that turned out incomplete since."""

    total_sessions: int
    valid_sessions: int
    invalid_sessions: int
    rejected_facts: int
    new_facts: int
    removed_facts: int
    new_hours: int


def load_dimension(rows: DataFrame, warehouse: Warehouse, name: str) -> int:
    """Append conformed dimension rows; returns their number.

    Equal rows are one; two rows of one id that differ fail the load before anything is
    written. Ids the table already has are left alone, so a retried load adds nothing.
    """
    spark = rows.sparkSession
    rows = schemas.validate_schema(rows, name)
    with intermediates_removed(spark):
        distinct = assert_unique(materialize(rows.distinct(), "dimension"), ["id"])
        existing = warehouse.read(spark, name).select("id")
        fresh = distinct.join(existing, "id", "left_anti")
        return warehouse.append(ordered(fresh, "id"), name)


def valid_loads(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The valid load of each bucket."""
    versions = open_table(spark, warehouse.path(VERSIONS), schemas.SESSION_VERSION)
    valid = versions.groupBy(schemas.BUCKET_COLUMN).agg(
        F.max_by("load_id", "seq").alias("load_id")
    )
    # always true; Spark prunes partitions by a join only if its other side has a condition
    return valid.where(F.col("load_id").startswith(LOAD_PREFIX))


def _valid_rows(
    spark: SparkSession, warehouse: Warehouse, name: str, schema: T.StructType, buckets: DataFrame | None = None
) -> DataFrame:
    """Rows of the valid loads, with their bucket; of all buckets or the listed ones. The join
    is on the table's folders, so other loads' files are not read."""
    place = [f.name for f in _PLACE]
    plain = [f for f in schema.fields if f.name != schemas.BUCKET_COLUMN]
    rows = open_table(spark, warehouse.path(name), T.StructType(plain + _PLACE))
    versions = valid_loads(spark, warehouse)
    if buckets is not None:
        versions = versions.join(buckets, schemas.BUCKET_COLUMN, "left_semi")
    return rows.join(versions, place, "left_semi").drop("load_id")


def facts(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The fact table as of the last finished load."""
    if warehouse.jdbc is not None:
        return warehouse.read(spark, FACT)
    rows = _valid_rows(spark, warehouse, FACT, schemas.FACT_SESSION)
    return rows.select(*schemas.FACT_SESSION.fieldNames())


def bucket_facts(
    spark: SparkSession, warehouse: Warehouse, buckets: DataFrame | None = None
) -> DataFrame:
    """Facts with their bucket, of all buckets or the listed ones, from a warehouse of files."""
    return _valid_rows(spark, warehouse, FACT, schemas.FACT_SESSION, buckets)


def open_quarantine(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Sessions held back, as of the last finished load."""
    held = _valid_rows(spark, warehouse, QUARANTINE, schemas.QUARANTINED_SESSION)
    bucket = F.nullif(schemas.BUCKET_COLUMN, F.lit(NO_BUCKET)).alias(schemas.BUCKET_COLUMN)
    plain = [n for n in schemas.QUARANTINED_SESSION.fieldNames() if n != schemas.BUCKET_COLUMN]
    return held.select(*plain, bucket)


def load_sessions(
    events: DataFrame,
    warehouse: Warehouse,
    holidays: DataFrame | None = None,
    buckets: DataFrame | None = None,
) -> SessionLoad:
    """Assemble sessions from events and load the complete ones; hold back the others.

    ``events`` has all events of the sessions at hand: their facts and quarantine entries are
    replaced, so a late stop updates its session and a second start takes its fact back. With
    ``buckets`` it has all events of those, and what they had is replaced, in a bucket without
    events too; otherwise the other sessions of a bucket are carried over. Running a load
    again changes nothing.

    The aggregate over the events runs once: its result is written, and counts, time ids, facts
    and quarantine are all taken from that much smaller table. The time dimension goes first,
    so a fact never refers to an hour that is not there.
    """
    with intermediates_removed(events.sparkSession):
        return load_assembled(_assembled(events), warehouse, holidays, buckets)


def _assembled(events: DataFrame) -> DataFrame:
    bucket = schemas.BUCKET_COLUMN
    if bucket not in events.columns:
        events = events.withColumn(bucket, F.lit(None).cast("bigint"))
    return assemble_sessions(events, carry=(bucket,))


def load_assembled(
    sessions: DataFrame, warehouse: Warehouse, holidays: DataFrame | None, buckets: DataFrame | None
) -> SessionLoad:
    """Load assembled sessions with their bucket, as :func:`load_sessions` does."""
    spark, bucket = sessions.sparkSession, schemas.BUCKET_COLUMN
    sessions = materialize(
        sessions.withColumn(bucket, F.coalesce(bucket, F.lit(NO_BUCKET).cast("bigint"))), "sessions"
    )
    summary = session_quality(
        sessions, F.count_if(is_valid() & ~_has_times()).alias("bad_time")
    ).first()
    found = materialize(
        loadable_facts(conform_fact(valid_sessions(sessions), carry=(bucket,))), "facts"
    )
    hours = merge_time_dim(warehouse.read(spark, "dim_time"), session_time_ids(found), holidays)
    new_hours = warehouse.append(ordered(hours, "time_id"), "dim_time")
    held = quarantine_sessions(sessions, F.when(~_has_times(), F.lit("bad_time")))
    added, removed = _replace(spark, sessions, found, held, warehouse, buckets)
    return SessionLoad(
        total_sessions=summary["total_sessions"],
        valid_sessions=summary["valid_sessions"],
        invalid_sessions=summary["invalid_sessions"],
        rejected_facts=summary["bad_time"],
        new_facts=added,
        removed_facts=removed,
        new_hours=new_hours,
    )


def _has_times() -> Column:
    # The same test as for facts: an hour key exists exactly when the hour fits one.
    return time_id(F.col("start_time")).isNotNull() & time_id(F.col("stop_time")).isNotNull()


def _replace(
    spark: SparkSession,
    sessions: DataFrame,
    found: DataFrame,
    held: DataFrame,
    warehouse: Warehouse,
    buckets: DataFrame | None,
) -> tuple[int, int]:
    """Write the next version of the buckets at hand; returns numbers of new and removed facts.

    A bucket whose last fact went has a version without a file. Over JDBC only facts of new
    sessions are appended, and just the quarantine has versions.
    """
    bucket = schemas.BUCKET_COLUMN
    touched = sessions if buckets is None else buckets
    touched = materialize(touched.select(bucket).distinct(), "buckets")
    versions = open_table(spark, warehouse.path(VERSIONS), schemas.SESSION_VERSION)
    last = versions.agg(F.max("seq")).first()[0]
    seq, load_id = (0 if last is None else last + 1), f"{LOAD_PREFIX}{uuid.uuid4().hex}"
    if warehouse.jdbc is not None:
        added, removed = _append_over_jdbc(spark, found.drop(bucket), warehouse), 0
    else:
        before = materialize(
            _valid_rows(spark, warehouse, FACT, schemas.FACT_SESSION, touched), "facts-before"
        )
        added = new_facts(found, before).count()
        if buckets is None:
            carried = _absent(before, sessions)
            again = before.alias("row").join(sessions.alias("other"), same_session("row", "other"), "left_semi")
        else:
            carried, again = before.limit(0), before
        removed = _absent(again, found).count()
        _write_version(found.unionByName(carried), warehouse.path(FACT), load_id, "session_id")
    held = held.select(*[n for n in schemas.QUARANTINED_SESSION.fieldNames()])
    if buckets is None:
        earlier = _valid_rows(spark, warehouse, QUARANTINE, schemas.QUARANTINED_SESSION, touched)
        held = held.unionByName(_absent(materialize(earlier, "held-before"), sessions))
    _write_version(held, warehouse.path(QUARANTINE), load_id, "session_id")
    touched.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").parquet(
        f"{warehouse.path(VERSIONS)}/seq={seq}"
    )
    return added, removed


def _absent(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows whose session is not among ``sessions``."""
    return rows.alias("row").join(
        sessions.select(*schemas.SESSION_KEY).alias("other"), same_session("row", "other"), "left_anti"
    )


def _write_version(rows: DataFrame, path: str, load_id: str, order: str) -> None:
    bucket = schemas.BUCKET_COLUMN
    (
        ordered(rows.withColumn("load_id", F.lit(load_id)).hint("rebalance", bucket), bucket, order)
        .write.mode("append")
        .partitionBy(bucket, "load_id")
        .parquet(path)
    )


def _append_over_jdbc(spark: SparkSession, found: DataFrame, warehouse: Warehouse) -> int:
    """Insert facts of sessions that the warehouse doesn't have. Only the stretch between the
    first and last start hour at hand is read, by the database, in parallel."""
    span = found.agg(F.min("start_time_id"), F.max("start_time_id")).first()
    if span[0] is None:
        return 0
    where = f"start_time_id BETWEEN {span[0]} AND {span[1]}"
    existing = warehouse.read(spark, FACT, where, ("start_time_id", span[0], span[1]))
    return warehouse.append(new_facts(found, existing), FACT)


def load_published(
    spark: SparkSession, lake: str, warehouse: Warehouse, holidays: DataFrame | None = None
) -> SessionLoad | None:
    """Load what was published since the last call; None when there is nothing new.

    New commits name the buckets that changed. All events of a session are in one bucket, so
    assembling those buckets from main, all commits of them, gives what one load of everything
    would: sessions whose stop came later are completed, late ones updated, spoilt ones taken
    back, and those that a rollback took out of main go. Untouched buckets are not read. The commits are marked as processed last; if the job
    dies before, the next call repeats it to the same effect.
    """
    with intermediates_removed(spark):
        fresh = _new_commits(spark, lake, warehouse)
        if fresh.isEmpty():
            return None
        events = main_events(spark, lake, buckets=fresh)
        result = load_sessions(events, warehouse, holidays, buckets=fresh)
        append_table(fresh.select("commit_id"), warehouse.path(PROCESSED))
        return result


def _new_commits(spark: SparkSession, lake: str, warehouse: Warehouse) -> DataFrame:
    """Commits of main that weren't loaded yet, with their bucket."""
    processed = open_table(spark, warehouse.path(PROCESSED), schemas.PROCESSED_COMMIT)
    commits = merge_commits(
        new_commits(main_commits(spark, lake), processed, schemas.MAIN_BRANCH), strict=True
    )
    return materialize(commits.select("commit_id", schemas.BUCKET_COLUMN), "new-commits")


def load_from_partials(
    spark: SparkSession,
    lake: str,
    warehouse: Warehouse,
    holidays: DataFrame | None = None,
    measure_mode: str = "numeric",
) -> SessionLoad | None:
    """Load what was published since the last call, as :func:`load_published` does, without
    reading events a second time. None when there is nothing new.

    What each publish adds to its sessions is aggregated once, from its own events, and kept by
    bucket and publish. The sessions of a bucket that changed are merged from that, of all publishes
    that main consists of now: a late stop reads the new events and the small partials of its
    bucket, however many events the lake or the bucket has. A rollback only leaves some out. Both
    kinds of load can take turns on one warehouse; publishes that this one has not seen yet
    are aggregated first. Writing a publish's partials again changes nothing.
    """
    bucket = schemas.BUCKET_COLUMN
    with intermediates_removed(spark):
        fresh = _new_commits(spark, lake, warehouse)
        if fresh.isEmpty():
            return None
        touched = materialize(fresh.select(bucket).distinct(), "touched-buckets")
        _store_partials(spark, lake, warehouse, touched)
        partials = open_table(spark, warehouse.path(PARTIALS), schemas.SESSION_PARTIAL)
        here = partials.where(visible(spark, lake)).join(touched, bucket, "left_semi")
        sessions = merge_partials(here, measure_mode, carry=(bucket,))
        result = load_assembled(sessions, warehouse, holidays, touched)
        append_table(fresh.select("commit_id"), warehouse.path(PROCESSED))
        return result


def _store_partials(spark: SparkSession, lake: str, warehouse: Warehouse, buckets: DataFrame) -> None:
    """Aggregate the events of all publishes of the buckets that have no partials yet."""
    bucket = schemas.BUCKET_COLUMN
    stored = open_table(spark, warehouse.path(PARTIAL_COMMITS), schemas.PROCESSED_COMMIT)
    commits = (
        main_commits(spark, lake)
        .where("to_seq IS NULL")
        .join(buckets, bucket, "left_semi")
        .join(stored, "commit_id", "left_anti")
    )
    commits = materialize(commits.select("commit_id", "seq"), "without-partials")
    if commits.isEmpty():
        return
    files = logged_files(spark, lake).join(commits.select("commit_id"), "commit_id", "left_semi")
    events = events_of(spark, lake, files).join(commits, "commit_id")
    (
        partial_sessions(events, by=(bucket, "seq"))
        .hint("rebalance", bucket, "seq")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(bucket, "seq")
        .parquet(warehouse.path(PARTIALS))
    )
    append_table(commits.select("commit_id"), warehouse.path(PARTIAL_COMMITS))


def warehouse_view(spark: SparkSession, warehouse: Warehouse, unmatched: str = "null") -> DataFrame:
    """The star view over the warehouse's tables."""
    return star_view(
        facts(spark, warehouse),
        warehouse.read(spark, "dim_station"),
        warehouse.read(spark, "dim_vehicle"),
        warehouse.read(spark, "dim_time"),
        unmatched,
    )

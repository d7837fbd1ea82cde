"""Quality operators: scan audit, key uniqueness, batch audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sessionlake import schemas


def audit(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of whatever job reads the returned frame.

    ``observation.get["rows"]`` holds the count once that job ran; no scan is added.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at, in no particular order."""
    return df.limit(n)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself; raises when a key occurs twice, naming one such key."""
    first = duplicate_keys(df, keys).take(1)
    if first:
        raise ValueError(f"duplicate key {first[0].asDict()} in {list(keys)}")
    return df


def _undecodable() -> Column:
    empty = F.col("payload").isNull()
    for field in ("event_type", "session_id", "session_number", "station_id", "vehicle_id"):
        empty = empty & F.col(field).isNull()
    return empty


def _key_missing() -> Column:
    return F.col("session_id").isNull() | F.col("session_number").isNull()


def event_fault() -> Column:
    """Why a row is no usable event: ``malformed`` or ``null_key``; NULL for a usable one."""
    return F.when(_undecodable(), F.lit("malformed")).when(_key_missing(), F.lit("null_key"))


def audit_batch(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quality metrics of a batch of lake events and a verdict, one row (or one per ``by``).

    A batch passes when it has rows, none of them undecodable and none without a session
    key. Unknown event types and repeated events are reported but do not fail it.

    Counting repeats takes a shuffle by event, of session, type and time only, in which equal
    events collapse on the map side first.
    """
    group = list(by)
    kind = F.col("event_type")
    checks = {
        "malformed_rows": _undecodable(),
        "null_keys": _key_missing() & ~_undecodable(),
        "start_events": kind == schemas.START_EVENT,
        "stop_events": kind == schemas.STOP_EVENT,
        "other_events": ~kind.isin(schemas.START_EVENT, schemas.STOP_EVENT),
        "untyped_events": kind.isNull(),
    }
    time = F.col("payload")[schemas.PAYLOAD_TIME].alias("_time")
    checked = events.select(
        *group, "session_id", "event_type", time, *[c.alias(n) for n, c in checks.items()]
    )
    collapsed = checked.groupBy(*group, "session_id", "event_type", "_time").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(n).alias(n) for n in checks]
    )
    repeated = F.when(F.col("session_id").isNotNull(), F.col("n_rows") - 1).otherwise(0)
    metrics = collapsed.groupBy(*group).agg(
        *[_total(F.col(n), n) for n in ("n_rows", *checks)], _total(repeated, "repeated_events")
    )
    return metrics.withColumn("ok", _passes())


def _total(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).alias(name)


def _passes() -> Column:
    return (F.col("n_rows") > 0) & (F.col("malformed_rows") == 0) & (F.col("null_keys") == 0)


def combined_audits(audits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Metrics of several audited batches added up, one row per ``by``, with the verdict.
    Repeats are those within a batch."""
    metrics = [
        f.name for f in schemas.BATCH_AUDIT.fields if f.name not in (schemas.BUCKET_COLUMN, "batch_id")
    ]
    return audits.groupBy(*by).agg(*[_total(F.col(n), n) for n in metrics]).withColumn("ok", _passes())

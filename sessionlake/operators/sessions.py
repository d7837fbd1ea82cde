"""Session assembly: from start/stop events to complete sessions and quarantined ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake import schemas
from sessionlake.functions import parse_instant

_COUNTERS = ("sessions_count", "start_events", "completion_events")
_MEASURES = ("start_time", "stop_time", "energy_delivered", "duration_minutes")


def _payload(key: str, default: str | None) -> Column:
    value = F.col("payload")[key]
    return value if default is None else F.coalesce(value, F.lit(default))


def project_session_events(
    events: DataFrame, default_energy: str | None = None, default_duration: str | None = None
) -> DataFrame:
    """Split the payload time by event type and lift the measures out of the payload."""
    time = F.col("payload")[schemas.PAYLOAD_TIME]
    return events.withColumns(
        {
            "start_time": F.when(F.col("event_type") == schemas.START_EVENT, time),
            "stop_time": F.when(F.col("event_type") == schemas.STOP_EVENT, time),
            "energy_delivered": _payload(schemas.PAYLOAD_ENERGY, default_energy),
            "duration_minutes": _payload(schemas.PAYLOAD_DURATION, default_duration),
        }
    )


def assemble_sessions(
    events: DataFrame, measure_mode: str = "numeric", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per (session, station, vehicle) with its times, measures and event counts.

    ``numeric`` types times and measures before taking the maximum. That is the right order
    for numbers, and it keeps the aggregate a hash aggregate with map-side partials, so one
    hot session collapses to a row per input task. ``string`` compares the raw text.
    ``carry`` names further columns to keep (their maximum).
    """
    counts, maxima = _counts(), _maxima(measure_mode)
    return (
        project_session_events(events)
        .groupBy(*schemas.SESSION_KEY)
        .agg(
            counts.pop("sessions_count").alias("sessions_count"),
            *[c.alias(n) for n, c in {**maxima, **counts}.items()],
            *[F.max(name).alias(name) for name in carry],
        )
    )


def _counts() -> dict[str, Column]:
    return {
        "sessions_count": F.count(F.lit(1)),
        "start_events": F.count_if(F.col("event_type") == schemas.START_EVENT),
        "completion_events": F.count_if(F.col("event_type") == schemas.STOP_EVENT),
    }


def _maxima(measure_mode: str) -> dict[str, Column]:
    """Highest times and measures of projected events."""
    if measure_mode not in ("numeric", "string"):
        raise ValueError(f"unknown measure_mode {measure_mode!r}")
    if measure_mode == "string":
        return {n: F.max(n) for n in _MEASURES}
    return {
        "start_time": F.max(parse_instant(F.col("start_time"))),
        "stop_time": F.max(parse_instant(F.col("stop_time"))),
        "energy_delivered": F.max(F.col("energy_delivered").try_cast("double")),
        "duration_minutes": F.max(F.col("duration_minutes").try_cast("double")),
    }


def partial_sessions(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What some of a session's events add to it: one row per session and ``by``, with counts and
    the maxima of times and measures, typed and (``..._text``) as they came."""
    columns = {**_counts(), **_maxima("numeric")}
    columns |= {f"{n}_text": c for n, c in _maxima("string").items()}
    return (
        project_session_events(events)
        .groupBy(*schemas.SESSION_KEY, *by)
        .agg(*[c.alias(n) for n, c in columns.items()])
    )


def merge_partials(
    partials: DataFrame, measure_mode: str = "numeric", carry: Sequence[str] = ()
) -> DataFrame:
    """Sessions from their partial aggregates: as :func:`assemble_sessions` of all the events."""
    suffix = {"numeric": "", "string": "_text"}[measure_mode]
    total, *kinds = [F.sum(n).alias(n) for n in _COUNTERS]
    return partials.groupBy(*schemas.SESSION_KEY).agg(
        total,
        *[F.max(f"{n}{suffix}").alias(n) for n in _MEASURES],
        *kinds,
        *[F.max(name).alias(name) for name in carry],
    )


def is_valid() -> Column:
    """Exactly one start and at least one stop."""
    return (F.col("start_events") == 1) & (F.col("completion_events") >= 1)


def valid_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where(is_valid()).drop(*_COUNTERS)


def quarantine_sessions(sessions: DataFrame, *further_reasons: Column) -> DataFrame:
    """Sessions with at least one reason to hold them back, reasons joined by commas.

    ``further_reasons`` are text columns, NULL where they do not apply.
    """
    starts, stops = F.col("start_events"), F.col("completion_events")
    reasons = F.concat_ws(
        ",",
        F.when(starts == 0, F.lit("no_start")),
        F.when(starts > 1, F.lit("multiple_starts")),
        F.when(stops == 0, F.lit("no_stop")),
        F.when(is_valid(), F.coalesce(*further_reasons)) if further_reasons else F.lit(None),
    )
    return sessions.withColumn("reason", reasons).where(F.col("reason") != "").drop(*_COUNTERS)


def invalid_sessions(sessions: DataFrame) -> DataFrame:
    """The complement of :func:`valid_sessions`, each row with the reasons it was held back."""
    return quarantine_sessions(sessions)


def session_quality(sessions: DataFrame, *further: Column) -> DataFrame:
    """Total, valid and invalid session counts, and any further aggregates, in one pass."""
    valid = F.count_if(is_valid())
    total = F.count(F.lit(1))
    return sessions.agg(
        total.alias("total_sessions"),
        valid.alias("valid_sessions"),
        (total - valid).alias("invalid_sessions"),
        *further,
    )

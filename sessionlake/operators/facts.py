"""Fact table: conform sessions, hold back unloadable rows, append only what is new."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake import schemas
from sessionlake.functions import time_id


def conform_fact(sessions: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Valid sessions as ``fact_charging_sessions`` rows: hour ids instead of times. ``carry``
    names further columns to keep behind them."""
    fact = sessions.select(
        *schemas.SESSION_KEY,
        time_id(F.col("start_time")).alias("start_time_id"),
        time_id(F.col("stop_time")).alias("end_time_id"),
        F.col("energy_delivered").try_cast("float").alias("energy_delivered"),
        F.col("duration_minutes").try_cast("float").alias("duration_minutes"),
        *carry,
    )
    checked = schemas.validate_schema(fact.drop(*carry), "fact_charging_sessions")
    return fact.select(*checked.columns, *carry)


def _has_hours() -> Column:
    return F.col("start_time_id").isNotNull() & F.col("end_time_id").isNotNull()


def loadable_facts(fact: DataFrame) -> DataFrame:
    """Facts whose start and end hours are known."""
    return fact.where(_has_hours())


def rejected_facts(fact: DataFrame) -> DataFrame:
    """Facts with a missing or unparsable time; they go to quarantine, not to the warehouse."""
    return fact.where(~_has_hours()).withColumn("reason", F.lit("bad_time"))


def same_session(left: str, right: str) -> Column:
    # NULL-safe: sessions group NULL stations and vehicles together, so NULLs must match here.
    return reduce(
        and_,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in schemas.SESSION_KEY],
    )


def new_facts(fact: DataFrame, existing: DataFrame) -> DataFrame:
    """Facts whose session is not in ``existing`` yet.

    ``existing`` is the large side. It is first cut down to the incoming sessions; when those
    are few enough by their size, Spark broadcasts them and the existing table is filtered where
    it lies, otherwise both are matched by a merge join. Either way only matches are left for
    the anti join. ``fact`` should be a written table, whose size is known.
    """
    keys = list(schemas.SESSION_KEY)
    seen = (
        existing.select(*keys)
        .alias("old")
        .join(fact.select(*keys).alias("incoming"), same_session("old", "incoming"), "left_semi")
    )
    return fact.alias("new").join(seen.alias("seen"), same_session("new", "seen"), "left_anti")

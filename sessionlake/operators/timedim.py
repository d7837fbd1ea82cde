"""Time dimension: hour ids of a fact table, their attributes, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake import schemas
from sessionlake.functions import time_id_to_ts


def session_time_ids(fact: DataFrame) -> DataFrame:
    """Distinct start and end hours. Partial distinct runs before the shuffle, so what is
    shuffled is at most the number of hours per input task."""
    return (
        fact.select(F.explode(F.array("start_time_id", "end_time_id")).alias("time_id"))
        .where(F.col("time_id").isNotNull())
        .distinct()
    )


def time_attributes(ids: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """``dim_time`` rows for hour ids.

    Monday is day 0. Without a ``holidays`` calendar (column ``date``) no day is a holiday.
    Ids that name no real hour are left out.
    """
    start = F.col("_start")
    hours = ids.select("time_id", time_id_to_ts(F.col("time_id")).alias("_start")).where(
        start.isNotNull()
    )
    day_of_week = F.weekday(start)
    is_holiday = F.lit(0)
    if holidays is not None:
        calendar = holidays.select(
            F.col("date").cast("date").alias("_date"), F.lit(1).alias("_holiday")
        ).distinct()
        hours = hours.join(calendar, F.to_date(start) == F.col("_date"), "left")
        is_holiday = F.coalesce(F.col("_holiday"), F.lit(0))
    return hours.select(
        F.col("time_id"),
        F.hour(start).alias("hour"),
        F.dayofmonth(start).alias("day"),
        F.month(start).alias("month"),
        F.year(start).alias("year"),
        day_of_week.alias("day_of_week"),
        (day_of_week >= 5).cast("int").alias("is_weekend"),
        is_holiday.alias("is_holiday"),
    )


def time_dim(fact: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Time dimension covering every hour a fact table refers to."""
    return time_attributes(session_time_ids(fact), holidays)


def merge_time_dim(
    existing: DataFrame, ids: DataFrame, holidays: DataFrame | None = None
) -> DataFrame:
    """The rows to add to ``existing`` so that it covers ``ids``: none that are there already."""
    absent = ids.select("time_id").join(existing.select("time_id"), "time_id", "left_anti")
    return schemas.validate_schema(time_attributes(absent, holidays), "dim_time")

"""The star view: facts joined to station, vehicle and (twice) time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas


def _type_default(data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(data_type)


def star_view(
    fact: DataFrame,
    station: DataFrame,
    vehicle: DataFrame,
    time: DataFrame,
    unmatched: str = "null",
    carry: Sequence[str] = (),
) -> DataFrame:
    """41-column view over the star schema.

    Facts without a matching dimension row keep NULLs, or type defaults (0, '', false) with
    ``unmatched="default"``. No broadcast is forced: Spark broadcasts a dimension when its
    size is below the threshold, and otherwise uses a merge join whose hot keys adaptive
    execution splits. Pass dimensions as stored tables, or write them first with
    ``materialize``: a derived one's size is only measured after the facts have been shuffled.
    ``carry`` names further columns of the facts to keep behind the view's.
    """
    if unmatched not in ("null", "default"):
        raise ValueError(f"unknown value for unmatched: {unmatched!r}")

    station_part = station.select(
        F.col("id").alias("_station"),
        *[F.col(c).alias(name) for c, name in schemas.VIEW_STATION_COLUMNS],
    )
    vehicle_part = vehicle.select(
        F.col("id").alias("_vehicle"),
        *[F.col(c).alias(name) for c, name in schemas.VIEW_VEHICLE_COLUMNS],
    )

    def time_role(role: str) -> DataFrame:
        return time.select(
            F.col("time_id").alias(f"_{role}"),
            *[F.col(a).alias(f"{role}_{a}") for a in schemas.VIEW_TIME_ATTRIBUTES],
        )

    joined = (
        fact.join(station_part, F.col("station_id") == F.col("_station"), "left")
        .join(vehicle_part, F.col("vehicle_id") == F.col("_vehicle"), "left")
        .join(time_role("start"), F.col("start_time_id") == F.col("_start"), "left")
        .join(time_role("end"), F.col("end_time_id") == F.col("_end"), "left")
    )

    types = {f.name: f.dataType for f in joined.schema.fields}

    def attribute(name: str):
        if unmatched == "null":
            return F.col(name)
        return F.coalesce(F.col(name), _type_default(types[name])).alias(name)

    return joined.select(
        "session_id", "start_time_id", "end_time_id", "energy_delivered", "duration_minutes",
        "station_id",
        *[attribute(name) for _, name in schemas.VIEW_STATION_COLUMNS],
        "vehicle_id",
        *[attribute(name) for _, name in schemas.VIEW_VEHICLE_COLUMNS],
        *[
            attribute(f"{role}_{a}")
            for role in ("start", "end")
            for a in schemas.VIEW_TIME_ATTRIBUTES
        ],
        *carry,
    )

"""Dimension conform: source documents to warehouse dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake import schemas
from sessionlake.functions import (
    leading_float,
    leading_int,
    split_list,
    surrogate_id,
    yes_flag,
)


def with_surrogate_id(df: DataFrame, *natural_key: str, name: str = "_id") -> DataFrame:
    """Add a deterministic UUID-shaped id made from the natural key."""
    return df.withColumn(name, surrogate_id(*[F.col(k) for k in natural_key]))


def to_station_docs(rows: DataFrame) -> DataFrame:
    """Typed station documents from the text rows of a station file."""
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(leading_float(F.col("longitude")), leading_float(F.col("latitude"))).alias(
            "coordinates"
        ),
    )
    return with_surrogate_id(rows, "id").select(
        "_id",
        F.col("id").alias("stationId"),
        point.alias("location"),
        F.col("address"),
        F.col("charger_type").alias("chargerType"),
        leading_float(F.col("cost")).alias("costPerKwh"),
        F.col("availability"),
        leading_float(F.col("distance")).alias("distanceToCity"),
        leading_int(F.col("usage")).alias("usageStats"),
        F.col("operator"),
        leading_int(F.col("capacity")).alias("chargingCapacity"),
        split_list(F.col("connectors")).alias("connectorTypes"),
        leading_int(F.col("year")).alias("installationYear"),
        yes_flag(F.col("renewable")).alias("renewableEnergySource"),
        leading_float(F.col("rating")).alias("rating"),
        leading_int(F.col("spots")).alias("parkingSpots"),
        F.col("maintenance").alias("maintenanceFrequency"),
    )


def to_vehicle_docs(rows: DataFrame) -> DataFrame:
    """Typed vehicle documents from the text rows of a vehicle file.

    Vehicle files carry no id, so the id is made from all of a row's fields.
    """
    return with_surrogate_id(rows, *schemas.VEHICLE_FILE.fieldNames()).select(
        "_id",
        leading_float(F.col("battery")).alias("Battery_capacity"),
        F.col("name").alias("Name"),
        leading_int(F.col("efficiency")).alias("Efficiency"),
        leading_int(F.col("fast_charge")).alias("Fast_charge"),
        leading_int(F.col("price")).alias("Price"),
        leading_int(F.col("range")).alias("Range"),
        leading_int(F.col("top_speed")).alias("Top_speed"),
        leading_float(F.col("acceleration")).alias("Acceleration_0_100"),
    )


def conform_stations(docs: DataFrame) -> DataFrame:
    """Station documents as ``dim_station`` rows. Columns not listed here are left behind,
    whether or not the source has them."""
    coordinates = F.col("location.coordinates")
    dim = docs.select(
        F.col("_id").cast("string").alias("id"),
        F.col("stationId").cast("string").alias("station_name"),
        F.get(coordinates, F.lit(1)).try_cast("float").alias("latitude"),
        F.get(coordinates, F.lit(0)).try_cast("float").alias("longitude"),
        F.col("address"),
        F.col("chargerType").alias("charger_type"),
        F.col("costPerKwh").try_cast("decimal(10,2)").alias("costPerKwh"),
        F.col("distanceToCity").try_cast("float").alias("distance_to_city"),
        F.col("operator"),
        F.col("chargingCapacity").try_cast("int").alias("charging_capacity"),
        F.concat_ws(",", F.col("connectorTypes")).alias("connector_type"),
        F.col("installationYear").try_cast("int").alias("installation_year"),
        F.col("renewableEnergySource").alias("renewable_energy_source"),
        F.col("rating").try_cast("float").alias("rating"),
        F.col("maintenanceFrequency").alias("maintenance_frequency"),
        F.col("parkingSpots").try_cast("int").alias("parking_spot"),
    )
    return schemas.validate_schema(dim, "dim_station")


def conform_vehicles(docs: DataFrame) -> DataFrame:
    """Vehicle documents as ``dim_vehicle`` rows; integer measures are truncated."""
    dim = docs.select(
        F.col("_id").cast("string").alias("id"),
        F.col("Name").alias("model"),
        *[
            F.col(source).try_cast("int").alias(source.lower())
            for source in (
                "Efficiency", "Fast_charge", "Range", "Top_speed", "Acceleration_0_100",
            )
        ],
        F.col("Battery_capacity").try_cast("float").alias("battery_capacity"),
    )
    return schemas.validate_schema(dim, "dim_vehicle")

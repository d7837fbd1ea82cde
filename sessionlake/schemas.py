"""Fixed schemas, names and constants of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: names, limits and formats that stored data and clients rely on ---

BUCKET_COLUMN = "session_number_range"
BUCKET_WIDTH = 1000
START_EVENT = "start"
STOP_EVENT = "stop"
PAYLOAD_TIME = "timestamp"
PAYLOAD_ENERGY = "energy_delivered"
PAYLOAD_DURATION = "duration_minutes"
EVENTS_DIRECTORY = "charging-events"
MAIN_BRANCH = "main"
BRANCH_PREFIX = "batch_"
DATA_FILE_SUFFIX = ".parquet"
STREAM_TRIGGER = "5 seconds"
STREAM_STARTING_OFFSETS = "earliest"
STREAM_FAIL_ON_DATA_LOSS = "true"
# A small demonstration's stream: few messages at a time, and lost ones are passed over.
DEMO_MAX_OFFSETS = 1000
DEMO_FAIL_ON_DATA_LOSS = "false"
WAREHOUSE_BATCH_SIZE = 10000

# --- Fixed values: the message and the lake's event ---

# The message as it travels on the stream, one JSON object per value.
EVENT_MESSAGE = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("session_number", T.IntegerType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("ev_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("session_number", T.IntegerType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)

# The bucket is BIGINT: the top bucket of an INT session number does not fit an INT.
LAKE_EVENT = T.StructType(EVENT.fields + [T.StructField(BUCKET_COLUMN, T.LongType())])

# A batch that is staged again gets another attempt; only the logged one is read.
STAGED_EVENT = T.StructType(
    LAKE_EVENT.fields
    + [
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
    ]
)

MAIN_EVENT = T.StructType(LAKE_EVENT.fields + [T.StructField("commit_id", T.StringType())])

# --- Lake bookkeeping ---

COMMIT_LOG = T.StructType(
    [
        T.StructField("commit_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("parents", T.ArrayType(T.StringType())),
        T.StructField("message", T.StringType()),
    ]
)

BRANCH_COMMIT = T.StructType(
    [
        T.StructField("commit_id", T.StringType()),
        T.StructField(BUCKET_COLUMN, T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

MAIN_COMMIT = T.StructType(
    COMMIT_LOG.fields
    + [
        T.StructField(BUCKET_COLUMN, T.LongType()),
        T.StructField("tip_batch_id", T.LongType()),
        # of a rollback: from seq on main is as it was at to_seq, until more is published
        T.StructField("to_seq", T.LongType()),
    ]
)

# The files that each merge commit took in.
MAIN_FILE = T.StructType(
    [
        T.StructField("commit_id", T.StringType()),
        T.StructField(BUCKET_COLUMN, T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

# After a publish: batches up to done_batch_id are published but for the refused ones.
PUBLISH_STATE = T.StructType(
    [
        T.StructField("done_batch_id", T.LongType()),
        T.StructField("head", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)
REFUSED = T.StructType([T.StructField(n, T.LongType()) for n in ("batch_id", BUCKET_COLUMN, "seq")])

# The files that run of compaction left of all publishes up to up_to_seq.
COMPACTED_FILE = T.StructType([*MAIN_FILE.fields, T.StructField("run", T.LongType())])
COMPACTION = T.StructType([T.StructField(n, T.LongType()) for n in ("up_to_seq", "run")])

BATCH_AUDIT = T.StructType(
    [
        T.StructField(BUCKET_COLUMN, T.LongType()),
        *[
            T.StructField(n, T.LongType())
            for n in (
                "n_rows", "malformed_rows", "null_keys", "start_events", "stop_events",
                "other_events", "untyped_events", "repeated_events", "batch_id",
            )
        ],
    ]
)

# Which load of a bucket's sessions is the valid one.
SESSION_VERSION = T.StructType(
    [
        T.StructField(BUCKET_COLUMN, T.LongType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

# What a batch of a ledger of session numbers has given.
NUMBER_RANGE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("last_number", "n_new", "batch_id")]
)

# What one publish adds to a session: counts and maxima, typed and as text, that merge.
SESSION_PARTIAL = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("session_id", "station_id", "vehicle_id")],
        *[T.StructField(n, T.LongType()) for n in ("sessions_count", "start_events", "completion_events")],
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("stop_time", T.TimestampNTZType()),
        T.StructField("energy_delivered", T.DoubleType()),
        T.StructField("duration_minutes", T.DoubleType()),
        *[
            T.StructField(f"{n}_text", T.StringType())
            for n in ("start_time", "stop_time", "energy_delivered", "duration_minutes")
        ],
        T.StructField(BUCKET_COLUMN, T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

PROCESSED_COMMIT = T.StructType([T.StructField("commit_id", T.StringType())])

# --- Sessions held back ---

QUARANTINED_SESSION = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("stop_time", T.TimestampNTZType()),
        T.StructField("energy_delivered", T.DoubleType()),
        T.StructField("duration_minutes", T.DoubleType()),
        T.StructField("reason", T.StringType()),
        T.StructField(BUCKET_COLUMN, T.LongType()),
    ]
)

# --- Fixed values: source documents ---

STATION_DOCUMENT = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("stationId", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
        T.StructField("address", T.StringType()),
        T.StructField("chargerType", T.StringType()),
        T.StructField("costPerKwh", T.DoubleType()),
        T.StructField("availability", T.StringType()),
        T.StructField("distanceToCity", T.DoubleType()),
        T.StructField("usageStats", T.IntegerType()),
        T.StructField("operator", T.StringType()),
        T.StructField("chargingCapacity", T.IntegerType()),
        T.StructField("connectorTypes", T.ArrayType(T.StringType())),
        T.StructField("installationYear", T.IntegerType()),
        T.StructField("renewableEnergySource", T.BooleanType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("parkingSpots", T.IntegerType()),
        T.StructField("maintenanceFrequency", T.StringType()),
    ]
)

VEHICLE_DOCUMENT = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("Battery_capacity", T.DoubleType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Efficiency", T.IntegerType()),
        T.StructField("Fast_charge", T.IntegerType()),
        T.StructField("Price", T.IntegerType()),
        T.StructField("Range", T.IntegerType()),
        T.StructField("Top_speed", T.IntegerType()),
        T.StructField("Acceleration_0_100", T.DoubleType()),
    ]
)


def _text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Positional layouts of the two delimited input files.
STATION_FILE = _text_columns(
    "id", "latitude", "longitude", "address", "charger_type", "cost", "availability",
    "distance", "usage", "operator", "capacity", "connectors", "year", "renewable",
    "rating", "spots", "maintenance",
)
VEHICLE_FILE = _text_columns(
    "battery", "name", "unused", "efficiency", "fast_charge", "price", "range",
    "top_speed", "acceleration",
)

# --- Fixed values: star schema ---

DIM_TIME = T.StructType(
    [
        T.StructField(n, T.IntegerType())
        for n in (
            "time_id", "hour", "day", "month", "year",
            "day_of_week", "is_weekend", "is_holiday",
        )
    ]
)

DIM_STATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("address", T.StringType()),
        T.StructField("charger_type", T.StringType()),
        T.StructField("costPerKwh", T.DecimalType(10, 2)),
        T.StructField("distance_to_city", T.FloatType()),
        T.StructField("operator", T.StringType()),
        T.StructField("charging_capacity", T.IntegerType()),
        T.StructField("connector_type", T.StringType()),
        T.StructField("installation_year", T.IntegerType()),
        T.StructField("renewable_energy_source", T.BooleanType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("maintenance_frequency", T.StringType()),
        T.StructField("parking_spot", T.IntegerType()),
    ]
)

DIM_VEHICLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("efficiency", T.IntegerType()),
        T.StructField("fast_charge", T.IntegerType()),
        T.StructField("range", T.IntegerType()),
        T.StructField("top_speed", T.IntegerType()),
        T.StructField("acceleration_0_100", T.IntegerType()),
        T.StructField("battery_capacity", T.FloatType()),
    ]
)

FACT_SESSION = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("start_time_id", T.IntegerType()),
        T.StructField("end_time_id", T.IntegerType()),
        T.StructField("energy_delivered", T.FloatType()),
        T.StructField("duration_minutes", T.FloatType()),
    ]
)

TABLES = {
    "dim_time": DIM_TIME,
    "dim_station": DIM_STATION,
    "dim_vehicle": DIM_VEHICLE,
    "fact_charging_sessions": FACT_SESSION,
}

# A session is one (session, station, vehicle) combination.
SESSION_KEY = ("session_id", "station_id", "vehicle_id")

# --- Fixed values: star-view columns taken from each dimension, as (column, view name) ---

VIEW_STATION_COLUMNS = (
    ("station_name", "station_name"),
    ("latitude", "station_latitude"),
    ("longitude", "station_longitude"),
    ("address", "station_address"),
    ("charger_type", "charger_type"),
    ("costPerKwh", "charging_cost"),
    ("distance_to_city", "distance_to_city"),
    ("operator", "station_operator"),
    ("charging_capacity", "charging_capacity"),
    ("connector_type", "connector_type"),
    ("installation_year", "installation_year"),
    ("renewable_energy_source", "renewable_energy_source"),
    ("rating", "station_rating"),
    ("maintenance_frequency", "maintenance_frequency"),
)
VIEW_VEHICLE_COLUMNS = (
    ("model", "vehicle_model"),
    ("efficiency", "vehicle_efficiency"),
    ("fast_charge", "vehicle_fast_charge"),
    ("range", "vehicle_range"),
    ("top_speed", "top_speed"),
    ("acceleration_0_100", "acceleration_0_100"),
)
VIEW_TIME_ATTRIBUTES = (
    "hour", "day", "month", "year", "day_of_week", "is_weekend", "is_holiday",
)


def validate_schema(df: DataFrame, table: str) -> DataFrame:
    """Return ``df`` in the column order of ``table``; raise when names or types differ."""
    expected = TABLES[table]
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    problems = [f"missing column {n}" for n in wanted if n not in actual]
    problems += [f"unexpected column {n}" for n in actual if n not in wanted]
    problems += [
        f"column {n} is {actual[n].simpleString()}, expected {wanted[n].simpleString()}"
        for n in wanted
        if n in actual and actual[n] != wanted[n]
    ]
    if problems:
        raise ValueError(f"{table}: " + "; ".join(problems))
    return df.select(*[F.col(f"`{n}`") for n in wanted])

"""The event stream: reading, the JSON envelope, writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas

# Spark's message-broker source, unless the caller overrides: from the first message, as many
# at a time as there are, and a stop when some were lost.
BROKER_FORMAT = "kafka"
BROKER_OPTIONS = {
    "startingOffsets": schemas.STREAM_STARTING_OFFSETS,
    "failOnDataLoss": schemas.STREAM_FAIL_ON_DATA_LOSS,
}

# For a demonstration on one machine, to be passed on purpose: at most 1000 messages for each
# trigger, and expired ones are passed over.
DEMO_BROKER_OPTIONS = {
    "maxOffsetsPerTrigger": str(schemas.DEMO_MAX_OFFSETS),
    "failOnDataLoss": schemas.DEMO_FAIL_ON_DATA_LOSS,
}

# An event's columns are named as in the message, but for this one.
_MESSAGE_NAMES = {"vehicle_id": "ev_id"}


def stream_options(fmt: str, options: Mapping[str, str]) -> dict[str, str]:
    """Source options with the defaults of the broker format filled in."""
    defaults = BROKER_OPTIONS if fmt == BROKER_FORMAT else {}
    return {**defaults, **options}


def read_events(
    spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Unbounded frame of raw messages, with a ``value`` column."""
    reader = spark.readStream.format(fmt).options(**stream_options(fmt, options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def encode_events(events: DataFrame) -> DataFrame:
    """Events as JSON bytes in ``value``; absent fields are written as null."""
    columns = {m: c for c, m in _MESSAGE_NAMES.items()}
    message = F.struct(
        *[
            F.col(columns.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.EVENT_MESSAGE.fields
        ]
    )
    return events.select(
        F.to_json(message, {"ignoreNullFields": "false"}).cast("binary").alias("value")
    )


def decode_events(messages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Events from JSON bytes. A value that is not such JSON gives a row of NULLs; with
    ``keep_raw`` the text of the value stays alongside, for quarantine."""
    text = F.col("value").cast("string")
    data = F.from_json(text, schemas.EVENT_MESSAGE)
    raw = [text.alias("raw")] if keep_raw else []
    return messages.select(data.alias("data"), *raw).select(
        *[F.col(f"data.{_MESSAGE_NAMES.get(n, n)}").alias(n) for n in schemas.EVENT.fieldNames()],
        *(["raw"] if keep_raw else []),
    )


def write_events(events: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Encode and send events to a batch sink; ``text`` writes one JSON object per line."""
    encoded = encode_events(events)
    if fmt == "text":
        encoded = encoded.select(F.col("value").cast("string").alias("value"))
    encoded.write.format(fmt).options(**dict(options)).mode("append").save()

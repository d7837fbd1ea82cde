"""The engine's inputs, derived from the test tables (mapping in FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake import schemas
from sessionlake.operators.numbering import with_session_number

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _cents(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def _payload(event_type: Column, time: Column, energy: Column, duration: Column) -> Column:
    start = F.create_map(F.lit(schemas.PAYLOAD_TIME), time)
    stop = F.create_map(
        F.lit(schemas.PAYLOAD_TIME), time,
        F.lit(schemas.PAYLOAD_ENERGY), energy,
        F.lit(schemas.PAYLOAD_DURATION), duration,
    )
    return F.when(event_type == schemas.STOP_EVENT, stop).otherwise(start)


def m1_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session events without numbers: one session per user and day of ``events``. Views start
    a session, purchases stop it, all other types are unknown to it.

    ``ts`` and ``event_id`` stay alongside for ordering and splitting.
    """
    source = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "view", schemas.START_EVENT)
        .when(F.col("event_type") == "purchase", schemas.STOP_EVENT)
        .otherwise(F.col("event_type"))
    )
    return source.select(
        kind.alias("event_type"),
        F.concat_ws("-", _text("user_id"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        _text("user_id").alias("station_id"),
        _text("user_id").alias("vehicle_id"),
        _payload(
            kind,
            F.date_format("ts", _ISO),
            _cents("value"),
            F.get_json_object("props", "$.k"),
        ).alias("payload"),
        F.col("ts"),
        F.col("event_id"),
    )


def m1_session_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session_id, first_ts, session_number), sessions numbered by first event."""
    first = m1_events(spark, sf_dir).groupBy("session_id").agg(F.min("ts").alias("first_ts"))
    return with_session_number(first, ["first_ts", "session_id"])


def m1_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session events with their session's number, in the column order of an event."""
    numbers = m1_session_numbers(spark, sf_dir).select(
        "session_id", F.col("session_number").cast("int").alias("session_number")
    )
    return m1_events(spark, sf_dir).join(numbers, "session_id").select(
        *schemas.EVENT.fieldNames(), "ts", "event_id"
    )


def m1_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all session events with some faults, by event id modulo 50: 0 cut short,
    1 without a session, 2 without a number, 3 sent twice. ``event_id`` and ``ts`` stay
    alongside."""
    fault = F.col("event_id") % 50
    numbered = m1_numbered(spark, sf_dir)
    faulty = numbered.withColumns(
        {
            "session_id": F.when(fault != 1, F.col("session_id")),
            "session_number": F.when(fault != 2, F.col("session_number")),
            "_copies": F.when(fault == 3, 2).otherwise(1),
        }
    )
    value = F.col("_encoded").cast("string")
    message = F.to_json(
        F.struct(
            *[
                F.col("vehicle_id" if n == "ev_id" else n).alias(n)
                for n in schemas.EVENT_MESSAGE.fieldNames()
            ]
        )
    )
    return (
        faulty.withColumn("_encoded", message)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(
            F.when(fault == 0, F.substring(value, 1, 20)).otherwise(value).cast("binary").alias("value"),
            "event_id",
            "ts",
        )
    )


def m2_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk session events: a start per order, a stop per line item."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    starts = orders.select(
        F.lit(schemas.START_EVENT).alias("event_type"),
        "o_orderkey",
        "o_custkey",
        F.create_map(
            F.lit(schemas.PAYLOAD_TIME), F.date_format("o_orderdate", _ISO)
        ).alias("payload"),
    )
    stops = (
        table(spark, sf_dir, "lineitem")
        .join(orders.drop("o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.lit(schemas.STOP_EVENT).alias("event_type"),
            "o_orderkey",
            "o_custkey",
            F.create_map(
                F.lit(schemas.PAYLOAD_TIME), F.date_format("l_shipdate", _ISO),
                F.lit(schemas.PAYLOAD_ENERGY), _cents("l_extendedprice"),
                F.lit(schemas.PAYLOAD_DURATION), _cents("l_quantity"),
            ).alias("payload"),
        )
    )
    return starts.unionByName(stops).select(
        "event_type",
        _text("o_orderkey").alias("session_id"),
        (F.col("o_orderkey") + 1).cast("int").alias("session_number"),
        _text("o_custkey").alias("station_id"),
        _text("o_custkey").alias("vehicle_id"),
        "payload",
    )


def station_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station documents from suppliers."""
    k = F.col("s_suppkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            k.cast("string").alias("_id"),
            F.col("s_name").alias("stationId"),
            F.struct(
                F.lit("Point").alias("type"),
                F.array(
                    (k * 37 % 360 - 180).cast("double"), (k * 17 % 180 - 90).cast("double")
                ).alias("coordinates"),
            ).alias("location"),
            F.col("n_name").alias("address"),
            F.concat(F.lit("TYPE_"), (k % 3).cast("string")).alias("chargerType"),
            F.col("s_acctbal").alias("costPerKwh"),
            F.lit("24/7").alias("availability"),
            (k.cast("double") / 2).alias("distanceToCity"),
            k.cast("int").alias("usageStats"),
            F.concat(F.lit("OP_"), (k % 5).cast("string")).alias("operator"),
            (k % 300 + 50).cast("int").alias("chargingCapacity"),
            F.when(k % 2 == 0, F.array(F.lit("CCS"), F.lit("Type 2")))
            .otherwise(F.array(F.lit("CHAdeMO")))
            .alias("connectorTypes"),
            (k % 14 + 2010).cast("int").alias("installationYear"),
            (k % 2 == 0).alias("renewableEnergySource"),
            ((k % 50).cast("double") / 10).alias("rating"),
            (k % 10 + 1).cast("int").alias("parkingSpots"),
            F.when(k % 3 == 0, "Annually")
            .when(k % 3 == 1, "Quarterly")
            .otherwise("Monthly")
            .alias("maintenanceFrequency"),
        )
    )


def vehicle_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle documents from parts."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.cast("string").alias("_id"),
        F.col("p_retailprice").alias("Battery_capacity"),
        F.col("p_name").alias("Name"),
        (k % 200 + 100).cast("int").alias("Efficiency"),
        (k % 1000).cast("int").alias("Fast_charge"),
        (k * 10).cast("int").alias("Price"),
        (F.col("p_size") * 10 + 100).cast("int").alias("Range"),
        (F.col("p_size") + 120).cast("int").alias("Top_speed"),
        ((k % 80).cast("double") / 10 + 2).alias("Acceleration_0_100"),
    )


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit per order; finished orders are merges."""
    k = F.col("o_orderkey")
    before, second = (k - 1).cast("string"), (k - 2).cast("string")
    parents = (
        F.when(k == 0, F.array().cast("array<string>"))
        .when((F.col("o_orderstatus") == "F") & (k >= 2), F.array(before, second))
        .otherwise(F.array(before))
    )
    return table(spark, sf_dir, "orders").select(
        k.cast("string").alias("commit_id"),
        k.alias("seq"),
        F.lit(schemas.MAIN_BRANCH).alias("branch"),
        parents.alias("parents"),
        F.col("o_orderpriority").alias("message"),
    )


def processed_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits of open orders have been processed already."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    return orders.select(_text("o_orderkey").alias("commit_id"))


def commit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per line number of an order; some are checksum files."""
    line = F.col("l_linenumber")
    suffix = F.when(F.col("l_returnflag") == "N", ".crc").otherwise(schemas.DATA_FILE_SUFFIX)
    path = F.concat(
        F.lit(f"{schemas.EVENTS_DIRECTORY}/{schemas.BUCKET_COLUMN}="),
        (line * 1000).cast("string"),
        F.lit("/part-"),
        line.cast("string"),
        suffix,
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").cast("string").alias("commit_id"), path.alias("path"))
        .distinct()
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines with a quoted comma; some have a field too many."""
    return table(spark, sf_dir, "part").select(
        F.concat_ws(
            ",",
            _text("p_partkey"),
            _quoted(F.concat_ws(", ", "p_name", "p_brand")),
            F.concat(_text("p_size"), F.lit(" km")),
            F.when(F.col("p_type") == "PROMO", F.lit("extra")),
        ).alias("line")
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station documents flattened to the lines of a station file."""
    coordinates = F.col("location.coordinates")
    return station_docs(spark, sf_dir).select(
        F.concat_ws(
            ",",
            F.col("stationId"),
            F.get(coordinates, F.lit(1)).cast("string"),
            F.get(coordinates, F.lit(0)).cast("string"),
            _quoted(F.concat_ws(", ", "address", "stationId")),
            F.col("chargerType"),
            _cents("costPerKwh"),
            F.col("availability"),
            _cents("distanceToCity"),
            _text("usageStats"),
            F.col("operator"),
            F.concat(_text("chargingCapacity"), F.lit(" kW")),
            _quoted(F.array_join("connectorTypes", ", ")),
            _text("installationYear"),
            F.when(F.col("renewableEnergySource"), "Yes").otherwise("No"),
            _cents("rating"),
            _text("parkingSpots"),
            F.col("maintenanceFrequency"),
        ).alias("line")
    )


def vehicle_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle documents flattened to the lines of a vehicle file."""
    return vehicle_docs(spark, sf_dir).select(
        F.concat_ws(
            ",",
            _cents("Battery_capacity"),
            _quoted(F.concat_ws(", ", "Name", "_id")),
            F.lit("-"),
            _text("Efficiency"),
            _text("Fast_charge"),
            _text("Price"),
            F.concat(_text("Range"), F.lit(" km")),
            _text("Top_speed"),
            _cents("Acceleration_0_100"),
        ).alias("line")
    )


def write_lines(lines: DataFrame, folder: str, header: list[str]) -> str:
    """Write lines as delimited files, each with a header, and return the folder.

    The header is the name of the only column, written by the CSV sink as it stands.
    """
    named = lines.select(F.col("line").alias(",".join(header)))
    (
        named.write.option("header", True)
        .option("sep", "\uffff")
        .option("quote", "")
        .option("quoteAll", False)
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder

"""The query catalogue: every operator run over the test tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import fixtures, schemas
from sessionlake.functions import leading_int, range_bucket, surrogate_id, time_id, time_id_to_ts
from sessionlake.operators import (
    dimensions,
    facts,
    lake,
    numbering,
    quality,
    sessions,
    star,
    timedim,
)
from sessionlake.plans import drifting, feed, kept_view, publishing, repeats, warehouse
from sessionlake.session import materialize, new_folder
from sessionlake.sources import delimited, documents, events, tables
from sessionlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

CATALOGUE: dict[str, Query] = {}

# Noon in the middle of the event month: splits the events into two successive batches, and that
# day's sessions with them.
SPLIT_TIME = "2024-01-16 12:00:00"


def _query(function: Query) -> Query:
    CATALOGUE[function.__name__.removesuffix("_query")] = function
    return function


def _plain(df: DataFrame) -> DataFrame:
    """FLOAT and DECIMAL columns as DOUBLE, for value comparison with other engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.FloatType | T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _payload_columns() -> list[Column]:
    return [
        F.col("payload")[key].alias(name)
        for key, name in (
            (schemas.PAYLOAD_TIME, "event_time"),
            (schemas.PAYLOAD_ENERGY, "energy_delivered"),
            (schemas.PAYLOAD_DURATION, "duration_minutes"),
        )
    ]


_EVENT_COLUMNS = ("event_type", "session_id", "session_number", "station_id", "vehicle_id")


# --- Envelope, buckets, staging ---


@_query
def encode_decode_events(spark, sf_dir):
    encoded = events.encode_events(fixtures.m1_numbered(spark, sf_dir))
    return events.decode_events(encoded).select(*_EVENT_COLUMNS, *_payload_columns())


@_query
def session_numbers(spark, sf_dir):
    return fixtures.m1_session_numbers(spark, sf_dir).select(
        "session_id", "first_ts", "session_number"
    )


@_query
def session_numbers_in_two(spark, sf_dir):
    """Sessions numbered from two batches that share sessions, the first batch given twice: the
    second goes on where the first ended."""
    folder = new_folder(spark, "numbers")
    source = fixtures.m1_events(spark, sf_dir)
    later = F.col("event_id") % 3 == 0
    for batch_id, part in ((0, source.where(later)), (1, source.where(~later)), (0, source)):
        numbering.number_new(part.select("session_id", "ts"), folder, batch_id, ["session_id"], ["ts"])
    return numbering.session_numbers(spark, folder, source.schema, ["session_id"])


@_query
def range_bucket_query(spark, sf_dir):
    number = F.col("o_orderkey") - 5
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", range_bucket(number).alias("bucket")
    )


@_query
def batch_buckets(spark, sf_dir):
    return ingest.batch_buckets(fixtures.m1_numbered(spark, sf_dir))


@_query
def batch_bucket_counts(spark, sf_dir):
    batch = ingest.with_bucket(fixtures.m1_numbered(spark, sf_dir))
    return ingest.record_commits(batch, 0)


def _split(events_frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    later = F.col("ts") >= F.lit(SPLIT_TIME).cast("timestamp_ntz")
    columns = schemas.EVENT.fieldNames()
    return (
        events_frame.where(~later).select(*columns),
        events_frame.where(later).select(*columns),
    )


def _stage_in_two(spark: SparkSession, sf_dir: str, between=None) -> str:
    """A lake with the events in two batches; ``between(root)`` is called after each."""
    root = new_folder(spark, "lake")
    write = ingest.batch_writer(root)
    for batch_id, part in enumerate(_split(fixtures.m1_numbered(spark, sf_dir))):
        write(part, batch_id)
        if between is not None:
            between(root)
    return root


@_query
def stage_batch_roundtrip(spark, sf_dir):
    root = _stage_in_two(spark, sf_dir)
    return ingest.staged_events(spark, root).select(
        *_EVENT_COLUMNS, *_payload_columns(), schemas.BUCKET_COLUMN, "batch_id"
    )


def _stage_faulty(spark: SparkSession, sf_dir: str) -> str:
    """A lake with one batch of messages, some of them faulty."""
    root = new_folder(spark, "lake")
    batch = events.decode_events(fixtures.m1_messages(spark, sf_dir), keep_raw=True)
    ingest.batch_writer(root)(batch, 0)
    return root


@_query
def decode_malformed(spark, sf_dir):
    """What becomes of messages that are cut short or lack a key."""
    decoded = events.decode_events(fixtures.m1_messages(spark, sf_dir), keep_raw=True)
    return (
        decoded.withColumn("reason", quality.event_fault())
        .groupBy("reason")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("payload").alias("n_payloads"),
            F.min(F.length("raw")).cast("bigint").alias("shortest"),
        )
    )


@_query
def staged_quarantine(spark, sf_dir):
    held = ingest.quarantined_events(spark, _stage_faulty(spark, sf_dir))
    return held.select(
        "reason", "event_type", "session_id", F.col("session_number").cast("double"), "station_id",
        F.length("raw").cast("bigint").alias("raw_length"), "batch_id",
    )


@_query
def publish_with_bad_rows(spark, sf_dir):
    """Faulty rows are held back; the rest of their buckets is published, on a condition that
    uses all that the audit counts."""
    root = _stage_faulty(spark, sf_dir)
    publishing.publish_staged(
        spark, root, accept="ok AND malformed_rows + null_keys = 0 AND repeated_events >= 0"
    )
    published = publishing.main_events(spark, root).groupBy(schemas.BUCKET_COLUMN).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    found = ingest.batch_audits(spark, root)
    return published.join(found, schemas.BUCKET_COLUMN).select(
        schemas.BUCKET_COLUMN, "n_events", "start_events", "stop_events", "other_events",
        "repeated_events",
    )


def _write_stream_files(spark: SparkSession, sf_dir: str, folder: str) -> int:
    """Encoded events as text files, cut by event id so that sessions span files."""
    n_files = max(4, spark.sparkContext.defaultParallelism)
    events.write_events(
        fixtures.m1_numbered(spark, sf_dir).repartition(n_files, "event_id"),
        "text",
        {"path": folder},
    )
    return n_files


def _ingest_stream(spark: SparkSession, sf_dir: str) -> str:
    inbox, root = new_folder(spark, "inbox"), new_folder(spark, "lake")
    n_files = _write_stream_files(spark, sf_dir, inbox)
    messages = events.read_events(
        spark,
        "text",
        {"path": inbox, "maxFilesPerTrigger": str(max(1, n_files // 2))},
        T.StructType([T.StructField("value", T.StringType())]),
    )
    ingestion = ingest.start_ingestion(
        messages, root, new_folder(spark, "stream-checkpoint"), {"availableNow": True}
    )
    ingestion.awaitTermination()
    return root


@_query
def stream_ingest(spark, sf_dir):
    root = _ingest_stream(spark, sf_dir)
    return (
        ingest.staged_events(spark, root)
        .groupBy(schemas.BUCKET_COLUMN, "event_type")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(F.col("payload")[schemas.PAYLOAD_TIME].isNotNull()).alias("n_timed"),
        )
    )


# --- Commit log ---


@_query
def new_commits(spark, sf_dir):
    found = lake.new_commits(
        fixtures.commit_log(spark, sf_dir),
        fixtures.processed_commits(spark, sf_dir),
        schemas.MAIN_BRANCH,
    )
    return found.select("commit_id", "seq", "branch", "message")


@_query
def merge_commits(spark, sf_dir):
    merges = lake.merge_commits(fixtures.commit_log(spark, sf_dir))
    return lake.merged_tip(merges).select("commit_id", "seq", "base", "tip")


@_query
def files_at(spark, sf_dir):
    merges = lake.merge_commits(fixtures.commit_log(spark, sf_dir))
    return lake.files_at(fixtures.commit_files(spark, sf_dir), merges)


@_query
def files_added(spark, sf_dir):
    merges = lake.merge_commits(fixtures.commit_log(spark, sf_dir))
    added = lake.files_added(fixtures.commit_files(spark, sf_dir), merges)
    address = lake.snapshot_path("lake", F.col("tip"), F.col("path"))
    return added.withColumn("address", address)


@_query
def as_of(spark, sf_dir):
    log = fixtures.commit_log(spark, sf_dir)
    middle = log.where(F.col("seq") == log.agg(F.expr("max(seq) div 2")).scalar())
    main = fixtures.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("commit_id"),
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    )
    return lake.as_of(main, log, middle.select("commit_id").scalar())


@_query
def read_at_commit(spark, sf_dir):
    """The files that the second publish's merge commits took in, as the engine logged them."""
    root = _stage_in_two(spark, sf_dir, lambda lake_root: publishing.publish_staged(spark, lake_root))
    log = lake.merge_commits(publishing.main_commits(spark, root), strict=True)
    latest = log.where(F.col("seq") == log.agg(F.max("seq")).scalar())
    added = publishing.main_files(spark, root).join(latest.select("commit_id"), "commit_id", "left_semi")
    rows = lake.read_at(spark, root, added, schemas.LAKE_EVENT)
    return rows.select(*_EVENT_COLUMNS, *_payload_columns(), schemas.BUCKET_COLUMN)


@_query
def publish(spark, sf_dir):
    root = _stage_in_two(spark, sf_dir)
    publishing.publish_staged(spark, root)
    return (
        publishing.main_events(spark, root)
        .groupBy(schemas.BUCKET_COLUMN, "event_type")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.max("commit_id").alias("commit_id"),
        )
    )


@_query
def publish_in_two(spark, sf_dir):
    """Each batch published on its own: a commit for each bucket of each."""
    root = _stage_in_two(spark, sf_dir, lambda lake_root: publishing.publish_staged(spark, lake_root))
    return (
        publishing.main_events(spark, root)
        .groupBy(schemas.BUCKET_COLUMN, "commit_id")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@_query
def compact_published(spark, sf_dir):
    """The events of two publishes, after their files were joined."""
    root = _stage_in_two(spark, sf_dir, lambda lake_root: publishing.publish_staged(spark, lake_root))
    publishing.compact_published(spark, root)
    rows = publishing.main_events(spark, root)
    return rows.select(*_EVENT_COLUMNS, *_payload_columns(), schemas.BUCKET_COLUMN)


# --- Quality ---


@_query
def scan_sample(spark, sf_dir):
    """Five rows to look at: how many there are, and how many of them the table has."""
    table = fixtures.table(spark, sf_dir, "events")
    sample = materialize(quality.sample_rows(table), "sample")
    known = table.select(F.col("event_id").alias("known")).distinct()
    return sample.join(known, F.col("event_id") == F.col("known"), "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_known")
    )


@_query
def scan_audit(spark, sf_dir):
    scanned, observation = quality.audit(fixtures.table(spark, sf_dir, "events"), "events")
    summary = scanned.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    summary.write.format("noop").mode("overwrite").save()
    return summary.withColumn("rows_scanned", F.lit(observation.get["rows"]).cast("bigint"))


@_query
def audit_batch(spark, sf_dir):
    return quality.audit_batch(fixtures.m1_numbered(spark, sf_dir))


@_query
def audit_by_bucket(spark, sf_dir):
    staged = ingest.with_bucket(fixtures.m1_numbered(spark, sf_dir))
    return quality.audit_batch(staged, by=[schemas.BUCKET_COLUMN])


@_query
def duplicate_keys(spark, sf_dir):
    lines = fixtures.table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@_query
def unique_orders(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return quality.assert_unique(orders, ["o_orderkey"])


# --- Sessions ---


@_query
def project_session_events(spark, sf_dir):
    projected = sessions.project_session_events(fixtures.m1_events(spark, sf_dir))
    return projected.select(
        "event_id", "session_id", "event_type",
        "start_time", "stop_time", "energy_delivered", "duration_minutes",
    )


@_query
def assemble_sessions(spark, sf_dir):
    return sessions.assemble_sessions(fixtures.m1_events(spark, sf_dir))


@_query
def assemble_sessions_string_max(spark, sf_dir):
    return sessions.assemble_sessions(fixtures.m1_events(spark, sf_dir), measure_mode="string")


@_query
def assemble_sessions_bulk(spark, sf_dir):
    return sessions.assemble_sessions(fixtures.m2_events(spark, sf_dir))


@_query
def valid_sessions(spark, sf_dir):
    return sessions.valid_sessions(assemble_sessions(spark, sf_dir))


@_query
def invalid_sessions(spark, sf_dir):
    return sessions.invalid_sessions(assemble_sessions(spark, sf_dir))


@_query
def session_quality(spark, sf_dir):
    return sessions.session_quality(assemble_sessions(spark, sf_dir))


@_query
def session_quality_bulk(spark, sf_dir):
    return sessions.session_quality(assemble_sessions_bulk(spark, sf_dir))


# --- Time and facts ---


@_query
def time_id_query(spark, sf_dir):
    """Hour keys of timestamps and of ISO texts with a zone suffix."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", time_id(F.col("ts")).alias("time_id"), time_id(text).alias("text_time_id")
    )


@_query
def time_id_to_ts_query(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", time_id_to_ts(time_id(F.col("ts"))).alias("hour_start")
    )


def _m1_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.loadable_facts(facts.conform_fact(valid_sessions(spark, sf_dir)))


def _m2_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = sessions.valid_sessions(assemble_sessions_bulk(spark, sf_dir))
    return facts.loadable_facts(facts.conform_fact(whole))


@_query
def session_time_ids(spark, sf_dir):
    return timedim.session_time_ids(_m1_facts(spark, sf_dir))


@_query
def time_dim(spark, sf_dir):
    return timedim.time_dim(_m1_facts(spark, sf_dir))


@_query
def time_dim_holidays(spark, sf_dir):
    """Days with an order of the top priority count as holidays."""
    calendar = (
        fixtures.table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_orderdate").alias("date"))
    )
    return timedim.time_dim(_m2_facts(spark, sf_dir), calendar)


@_query
def merge_time_dim(spark, sf_dir):
    """Hours of all events that the sessions' time dimension does not have yet."""
    existing = time_dim(spark, sf_dir)
    key = time_id(F.col("ts"))
    ids = timedim.session_time_ids(
        fixtures.table(spark, sf_dir, "events").select(
            key.alias("start_time_id"), key.alias("end_time_id")
        )
    )
    return timedim.merge_time_dim(existing, ids)


@_query
def fact_sessions(spark, sf_dir):
    return _plain(_m1_facts(spark, sf_dir))


@_query
def rejected_facts(spark, sf_dir):
    """Sessions whose events of some days have no readable time."""
    faulty = fixtures.m1_events(spark, sf_dir).withColumn(
        "payload",
        F.when(F.dayofmonth("ts") % 2 == 0, F.col("payload")).otherwise(
            F.create_map(F.lit(schemas.PAYLOAD_TIME), F.lit("some time"))
        ),
    )
    found = facts.conform_fact(sessions.valid_sessions(sessions.assemble_sessions(faulty)))
    return facts.rejected_facts(found).select("session_id", "station_id", "vehicle_id", "reason")


@_query
def fact_load_idempotent(spark, sf_dir):
    """The same load twice; the second one must add nothing."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    batch = fixtures.m1_events(spark, sf_dir)
    warehouse.load_sessions(batch, target)
    warehouse.load_sessions(batch, target)
    return _plain(warehouse.facts(spark, target))


@_query
def session_load_counts(spark, sf_dir):
    """What a first load, and the same load again, say that they did."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    batch = fixtures.m1_numbered(spark, sf_dir)
    loads = [
        (i, *dataclasses.astuple(warehouse.load_sessions(batch, target))) for i in (0, 1)
    ]
    names = ["load", *[f.name for f in dataclasses.fields(warehouse.SessionLoad)]]
    return spark.createDataFrame(loads, ", ".join(f"{n} BIGINT" for n in names))


def _load_in_two(spark: SparkSession, sf_dir: str) -> tables.Warehouse:
    target = tables.Warehouse(new_folder(spark, "warehouse"))

    def publish_and_load(root: str) -> None:
        publishing.publish_staged(spark, root)
        warehouse.load_published(spark, root, target)

    _stage_in_two(spark, sf_dir, publish_and_load)
    return target


@_query
def load_in_two(spark, sf_dir):
    """Two publishes and loads, cut inside sessions, leave the facts of one load."""
    return _plain(warehouse.facts(spark, _load_in_two(spark, sf_dir)))


@_query
def quarantine_in_two(spark, sf_dir):
    """And its quarantine: what became complete, or has become spoilt, has moved."""
    return warehouse.open_quarantine(spark, _load_in_two(spark, sf_dir))


@_query
def load_from_partials(spark, sf_dir):
    """The same two publishes, loaded from what each adds to its sessions."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))

    def publish_and_load(root: str) -> None:
        publishing.publish_staged(spark, root)
        warehouse.load_from_partials(spark, root, target)

    _stage_in_two(spark, sf_dir, publish_and_load)
    return _plain(warehouse.facts(spark, target))


def _rolled_back(spark: SparkSession, sf_dir: str) -> tuple[str, tables.Warehouse]:
    """A lake with two publishes, both loaded, taken back to the first one and loaded again."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))

    def publish_and_load(root: str) -> None:
        publishing.publish_staged(spark, root)
        warehouse.load_from_partials(spark, root, target)

    root = _stage_in_two(spark, sf_dir, publish_and_load)
    first = publishing.main_commits(spark, root).where("seq = 0").agg(F.min("commit_id")).first()[0]
    publishing.rollback_published(spark, root, first)
    warehouse.load_published(spark, root, target)
    return root, target


@_query
def rollback_publish(spark, sf_dir):
    """Events and sessions held back, by bucket, after the second of two publishes was taken back."""
    root, target = _rolled_back(spark, sf_dir)
    bucket = schemas.BUCKET_COLUMN
    found = publishing.main_events(spark, root).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("session_id").alias("n_sessions")
    )
    held = warehouse.open_quarantine(spark, target).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n_held"), F.min("session_id").alias("first_held")
    )
    return found.join(held, bucket, "left")


@_query
def rollback_facts(spark, sf_dir):
    """The facts that are left after that."""
    return _plain(warehouse.facts(spark, _rolled_back(spark, sf_dir)[1]))


def _one_published_one_staged(spark: SparkSession, sf_dir: str, second: DataFrame) -> str:
    """A lake with the first half of the events published and another batch staged."""
    root = new_folder(spark, "lake")
    ingest.batch_writer(root)(_split(fixtures.m1_numbered(spark, sf_dir))[0], 0)
    publishing.publish_staged(spark, root)
    ingest.batch_writer(root)(second, 1)
    return root


@_query
def repeats_across_batches(spark, sf_dir):
    """The second half of the events with a fifth of the first half again: how many rows of each
    bucket main has already. Buckets with repeats are then refused."""
    numbered = fixtures.m1_numbered(spark, sf_dir)
    first, second = _split(numbered)
    again = _split(numbered.where(F.col("event_id") % 5 == 0))[0]
    root = _one_published_one_staged(spark, sf_dir, second.unionByName(again))
    staged = ingest.branch_files(spark, root).where("batch_id = 1")
    found = materialize(repeats.published_repeats(spark, root, staged), "repeats")
    publishing.publish_staged(spark, root, "ok AND published_repeats = 0", [repeats.published_repeats])
    bucket = schemas.BUCKET_COLUMN
    n_main = publishing.main_events(spark, root).groupBy(bucket).agg(F.count(F.lit(1)).alias("n_main"))
    return found.join(n_main, bucket, "left").select(bucket, "published_repeats", "n_main")


@_query
def batch_drift(spark, sf_dir):
    """The second half of the events beside the published first one, with energies in every other
    bucket made ten times as large: where each measure has moved by more than a fifth."""
    factor = F.when(range_bucket(F.col("session_number")) / schemas.BUCKET_WIDTH % 2 == 1, 10).otherwise(1)
    energy = (F.col("payload")[schemas.PAYLOAD_ENERGY].cast("double") * factor).cast("string")
    moved = F.map_concat(
        F.map_filter("payload", lambda k, v: k != schemas.PAYLOAD_ENERGY),
        F.create_map(F.lit(schemas.PAYLOAD_ENERGY), energy),
    )
    second = _split(fixtures.m1_numbered(spark, sf_dir))[1].withColumn("payload", moved)
    root = _one_published_one_staged(spark, sf_dir, second)
    staged = ingest.branch_files(spark, root).where("batch_id = 1")
    odd = (F.col(schemas.BUCKET_COLUMN) / schemas.BUCKET_WIDTH % 2 == 1).alias("enlarged")
    events_staged = publishing.staged_events_of(spark, root, staged).withColumn("enlarged", odd)
    found = drifting.drift_from_main(spark, root, events_staged, by=("enlarged",))
    return found.select(
        "enlarged",
        (F.col("energy_shift") > 0.2).alias("energy_moved"),
        (F.col("duration_shift") > 0.2).alias("duration_moved"),
    )


@_query
def document_schema(spark, sf_dir):
    """Station documents as text, with a field that no schema has, one that is text in some, one
    that is missing in some and one in all, held against the schema."""
    docs = fixtures.station_docs(spark, sf_dir).withColumn("n", F.col("_id").cast("long"))
    rating = F.when(F.col("n") % 5 == 0, F.lit("good"))
    changed = docs.withColumns(
        {
            "note": F.when(F.col("n") % 7 == 0, "checked"),
            "parkingSpots": F.when(F.col("n") % 2 == 0, F.col("parkingSpots")),
        }
    ).drop("usageStats", "n")
    plain = F.to_json(F.struct(*[c for c in changed.columns]))
    text = F.to_json(F.struct(*[c for c in changed.columns if c != "rating"], rating.alias("rating")))
    with_n = changed.withColumn("n", F.col("_id").cast("long"))
    lines = with_n.select(F.when(F.col("n") % 5 == 0, text).otherwise(plain).alias("value"))
    return documents.document_schema(lines, schemas.STATION_DOCUMENT)


@_query
def commit_feed(spark, sf_dir):
    """Facts loaded by a stream over the commits, which is started anew after each of two
    publishes and goes on where it stopped."""
    target, checkpoint = tables.Warehouse(new_folder(spark, "warehouse")), new_folder(spark, "feed")

    def publish_and_follow(root: str) -> None:
        publishing.publish_staged(spark, root)
        following = feed.start_loading(spark, root, target, checkpoint, {"availableNow": True})
        following.awaitTermination()

    _stage_in_two(spark, sf_dir, publish_and_follow)
    return _plain(warehouse.facts(spark, target))


@_query
def changes_between(spark, sf_dir):
    """Two publishes, the second taken back and a third of its events published again: what main
    has lost since."""
    root = _stage_in_two(spark, sf_dir, lambda lake_root: publishing.publish_staged(spark, lake_root))
    first, second = (
        publishing.main_commits(spark, root).where(F.col("seq") == i).agg(F.min("commit_id")).first()[0]
        for i in (0, 1)
    )
    publishing.rollback_published(spark, root, first)
    again = fixtures.m1_numbered(spark, sf_dir).where(F.col("event_id") % 3 == 0)
    ingest.batch_writer(root)(_split(again)[1], 2)
    publishing.publish_staged(spark, root)
    latest = publishing.main_commits(spark, root).agg(F.max_by("commit_id", "seq")).first()[0]
    return publishing.changes_between(spark, root, second, latest).select(
        *_EVENT_COLUMNS, *_payload_columns(), schemas.BUCKET_COLUMN, "n_added", "n_removed"
    )


@_query
def dimension_load(spark, sf_dir):
    """Every source row twice, loaded twice: one dimension row each."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    rows = dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir))
    for _ in (0, 1):
        warehouse.load_dimension(rows.unionByName(rows), target, "dim_vehicle")
    return _plain(target.read(spark, "dim_vehicle"))


@_query
def table_append(spark, sf_dir):
    """Append, an empty append that is skipped, and read back."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    rows = dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir))
    target.append(rows, "dim_vehicle")
    target.append(rows.where(F.col("id").isNull()), "dim_vehicle")
    return _plain(target.read(spark, "dim_vehicle"))


# --- Dimensions and files ---


@_query
def dim_station(spark, sf_dir):
    return _plain(dimensions.conform_stations(fixtures.station_docs(spark, sf_dir)))


@_query
def dim_vehicle(spark, sf_dir):
    return _plain(dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir)))


@_query
def document_load(spark, sf_dir):
    """Station documents written as JSON and read back with their schema."""
    folder = new_folder(spark, "documents")
    fixtures.station_docs(spark, sf_dir).write.json(folder)
    docs = documents.read_documents(spark, "json", {"path": folder}, schemas.STATION_DOCUMENT)
    return _plain(dimensions.conform_stations(docs))


@_query
def delimited_load(spark, sf_dir):
    layout = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "label", "size")])
    folder = fixtures.write_lines(
        fixtures.part_lines(spark, sf_dir), new_folder(spark, "delimited"), layout.fieldNames()
    )
    rows = delimited.read_delimited(spark, folder, layout)
    return rows.select("id", "label", leading_int(F.col("size")).alias("size_km"))


@_query
def delimited_extra_column(spark, sf_dir):
    """A file with one more column than the layout: its first columns are taken."""
    layout = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "label", "size")])
    lines = fixtures.part_lines(spark, sf_dir)
    folder = fixtures.write_lines(
        lines.select(F.concat(F.col("line"), F.lit(",more")).alias("line")),
        new_folder(spark, "delimited"),
        [*layout.fieldNames(), "note"],
    )
    rows = delimited.read_delimited(spark, folder, layout)
    return rows.select("id", "label", leading_int(F.col("size")).alias("size_km"))


@_query
def station_file_load(spark, sf_dir):
    folder = fixtures.write_lines(
        fixtures.station_lines(spark, sf_dir),
        new_folder(spark, "delimited"),
        schemas.STATION_FILE.fieldNames(),
    )
    rows = delimited.read_delimited(spark, folder, schemas.STATION_FILE)
    return _plain(dimensions.conform_stations(dimensions.to_station_docs(rows)))


@_query
def vehicle_file_load(spark, sf_dir):
    folder = fixtures.write_lines(
        fixtures.vehicle_lines(spark, sf_dir),
        new_folder(spark, "delimited"),
        schemas.VEHICLE_FILE.fieldNames(),
    )
    rows = delimited.read_delimited(spark, folder, schemas.VEHICLE_FILE)
    return _plain(dimensions.conform_vehicles(dimensions.to_vehicle_docs(rows)))


@_query
def surrogate_ids(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_id(F.col("o_orderkey"), F.col("o_orderpriority")).alias("id"),
    )


@_query
def station_ids(spark, sf_dir):
    return documents.station_ids(fixtures.station_docs(spark, sf_dir), 10)


@_query
def battery_capacities(spark, sf_dir):
    return documents.battery_capacities(fixtures.vehicle_docs(spark, sf_dir))


# --- Star ---


def _star(spark: SparkSession, sf_dir: str, fact: DataFrame, unmatched: str) -> DataFrame:
    # Written once: the time dimension and the view both start from the facts, and Spark knows
    # the size of written dimensions before it decides how to join the facts with them.
    fact = materialize(fact, "facts")
    return star.star_view(
        fact,
        materialize(dimensions.conform_stations(fixtures.station_docs(spark, sf_dir)), "station"),
        materialize(dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir)), "vehicle"),
        materialize(timedim.time_dim(fact), "time"),
        unmatched,
    )


def star_view_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star view over the session events of ``events``, with its own column types."""
    return _star(spark, sf_dir, _m1_facts(spark, sf_dir), "null")


def _plain_view(view: DataFrame) -> DataFrame:
    """A star view in plain types. Its station columns may be NULL, and engines hand over
    nullable integers and booleans differently, so these become DOUBLE and text."""
    return _plain(view).withColumns(
        {
            "charging_capacity": F.col("charging_capacity").cast("double"),
            "installation_year": F.col("installation_year").cast("double"),
            "renewable_energy_source": F.col("renewable_energy_source").cast("string"),
        }
    )


@_query
def star_view(spark, sf_dir):
    return _plain_view(star_view_typed(spark, sf_dir))


@_query
def star_view_defaults(spark, sf_dir):
    return _plain_view(_star(spark, sf_dir, _m1_facts(spark, sf_dir), "default"))


@_query
def star_view_bulk(spark, sf_dir):
    return _plain_view(_star(spark, sf_dir, _m2_facts(spark, sf_dir), "null"))


def _load_dimensions(spark: SparkSession, sf_dir: str, target: tables.Warehouse, condition: str) -> None:
    stations = dimensions.conform_stations(fixtures.station_docs(spark, sf_dir))
    vehicles = dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir))
    warehouse.load_dimension(stations.where(condition), target, "dim_station")
    warehouse.load_dimension(vehicles, target, "dim_vehicle")


@_query
def star_view_kept(spark, sf_dir):
    """The stored view after two loads, and after the stations with odd ids came last."""
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    _load_dimensions(spark, sf_dir, target, "CAST(id AS BIGINT) % 2 = 0")

    def publish_load_refresh(root: str) -> None:
        publishing.publish_staged(spark, root)
        warehouse.load_from_partials(spark, root, target)
        kept_view.refresh_view(spark, target)

    _stage_in_two(spark, sf_dir, publish_load_refresh)
    _load_dimensions(spark, sf_dir, target, "true")
    kept_view.refresh_view(spark, target)
    return _plain_view(kept_view.kept_view(spark, target))


@_query
def stream_to_star(spark, sf_dir):
    """The whole way: ingest a stream, publish, load, and read the star view."""
    lake_root = _ingest_stream(spark, sf_dir)
    publishing.publish_staged(spark, lake_root)
    target = tables.Warehouse(new_folder(spark, "warehouse"))
    warehouse.load_dimension(
        dimensions.conform_stations(fixtures.station_docs(spark, sf_dir)), target, "dim_station"
    )
    warehouse.load_dimension(
        dimensions.conform_vehicles(fixtures.vehicle_docs(spark, sf_dir)), target, "dim_vehicle"
    )
    warehouse.load_published(spark, lake_root, target)
    return _plain_view(warehouse.warehouse_view(spark, target))

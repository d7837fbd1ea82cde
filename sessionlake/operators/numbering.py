"""Dense global sequence numbers, within a table and from batch to batch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.session import intermediates_removed, materialize
from sessionlake.sources.tables import open_table

# monotonically_increasing_id keeps the partition in the upper bits, the row in the lower 33.
_ROW_BITS = 33


def with_session_number(
    sessions: DataFrame,
    order_cols: Sequence[str],
    name: str = "session_number",
    first: int = 1,
) -> DataFrame:
    """Number rows ``first``, ``first + 1``, ... in the order of ``order_cols`` (which must be
    unique).

    Rows are range-partitioned and numbered inside their partition; each partition then
    gets the count of the ones before it. Only that list, one row per partition, is ordered
    in a single task. The sorted rows are written once, because the offsets and the final
    numbers must see the same partitioning even if a task is run again.
    """
    placed = materialize(
        sessions.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place"),
        "numbering",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the range shuffle, so the broadcast has a fixed bound.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(first))
        .drop("_part", "_row", "_offset")
    )


# Below a ledger's folder: the numbers that a batch gave, and, written last, their range.
NUMBERS = "numbers"
RANGES = "ranges"


def number_new(
    sessions: DataFrame, folder: str, batch_id: int, key_cols: Sequence[str], order_cols: Sequence[str]
) -> int:
    """Number the sessions of a batch that no batch before it had, going on from the last number;
    returns how many were new.

    ``sessions`` has the key in ``key_cols`` and ``order_cols``; of rows with one key the first
    in that order counts. Batches are numbered in the order of their ids, each once: a batch that
    was numbered keeps its numbers when it comes again, whatever it has then. A call that dies
    has given no numbers, and leaves no gap. One numbering of a ledger runs at a time.

    What the ledger has is first cut down to the sessions at hand, which are few and written, so
    that Spark can send them to it; only matches are left for the anti join.
    """
    spark, key = sessions.sparkSession, list(key_cols)
    ranges = _ranges(spark, folder)
    seen = ranges.agg(
        F.max("last_number").alias("last"),
        F.max("batch_id").alias("latest"),
        F.max(F.when(F.col("batch_id") == batch_id, F.col("n_new"))).alias("again"),
    ).first()
    if seen["again"] is not None:
        return seen["again"]
    if seen["latest"] is not None and seen["latest"] > batch_id:
        raise ValueError(f"batch {batch_id} comes after {seen['latest']}, which is numbered already")
    with intermediates_removed(spark):
        order = F.struct(*order_cols)
        batch = materialize(
            sessions.groupBy(*key).agg(F.min(order).alias("_order")).select(*key, "_order.*"), "batch"
        )
        old = session_numbers(spark, folder, batch.schema, key)
        known = old.alias("old").join(batch.select(*key).alias("new"), _same("old", "new", key), "left_semi")
        fresh = batch.alias("new").join(known.alias("old"), _same("new", "old", key), "left_anti")
        first = (seen["last"] or 0) + 1
        by = [*order_cols, *[c for c in key if c not in order_cols]]
        numbered = with_session_number(fresh, by, first=first)
        path = f"{folder}/{NUMBERS}/batch_id={batch_id}"
        numbered.select(*key, "session_number").write.mode("overwrite").parquet(path)
        n_new = spark.read.parquet(path).count()
        spark.range(1).select(
            F.lit(first + n_new - 1).cast("bigint").alias("last_number"),
            F.lit(n_new).cast("bigint").alias("n_new"),
        ).write.mode("overwrite").parquet(f"{folder}/{RANGES}/batch_id={batch_id}")
        return n_new


def session_numbers(
    spark: SparkSession, folder: str, schema: T.StructType, key_cols: Sequence[str]
) -> DataFrame:
    """All numbers that a ledger has given: the key (typed as in ``schema``), ``session_number``
    and the ``batch_id`` that a session was new in."""
    fields = [schema[c] for c in key_cols]
    fields += [T.StructField(n, T.LongType()) for n in ("session_number", "batch_id")]
    numbers = open_table(spark, f"{folder}/{NUMBERS}", T.StructType(fields))
    return numbers.join(_ranges(spark, folder).select("batch_id"), "batch_id", "left_semi").select(
        *[f.name for f in fields]
    )


def with_ledger_number(
    events: DataFrame, folder: str, key_cols: Sequence[str], name: str = "session_number"
) -> DataFrame:
    """``events`` with the number of their session; null for sessions the ledger doesn't have."""
    numbers = session_numbers(events.sparkSession, folder, events.schema, key_cols)
    numbers = numbers.select(*key_cols, F.col("session_number").alias("_number")).alias("number")
    rest = [F.col(f"event.`{c}`") for c in events.columns if c != name]
    joined = events.alias("event").join(numbers, _same("event", "number", key_cols), "left")
    return joined.select(*rest, F.col("number._number").alias(name))


def _same(left: str, right: str, key: Sequence[str]):
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in key])


def _ranges(spark: SparkSession, folder: str) -> DataFrame:
    return open_table(spark, f"{folder}/{RANGES}", schemas.NUMBER_RANGE)

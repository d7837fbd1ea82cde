"""Drift of staged batches from main, by sketches that are kept of every publish.

Layout below the lake root::

    event-sketches/seq=S/*.parquet    sketches of the events of publish S, by bucket
    sketch-index/*.parquet            publishes that have sketches
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.operators.drift import drift, event_sketches, merge_sketches
from sessionlake.plans.publishing import staged_events_of, unindexed_events, visible
from sessionlake.session import intermediates_removed, materialize
from sessionlake.sources.tables import append_table, open_table

SKETCHES = "event-sketches"
INDEX = "sketch-index"

_SKETCH = T.StructType(
    [
        T.StructField(schemas.BUCKET_COLUMN, T.LongType()),
        *[T.StructField(f"{n}_sketch", T.BinaryType()) for n in ("energy", "duration", "station")],
        T.StructField("seq", T.LongType()),
    ]
)


def sketch_published(spark: SparkSession, root: str) -> int:
    """Take sketches of the publishes that have none yet; returns their number. Doing so again
    changes nothing."""
    root = root.rstrip("/")
    with intermediates_removed(spark):
        found = unindexed_events(spark, root, INDEX)
        if found is None:
            return 0
        events, seqs = found
        (
            event_sketches(events, by=(schemas.BUCKET_COLUMN, "seq"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("seq")
            .parquet(f"{root}/{SKETCHES}")
        )
        return append_table(seqs, f"{root}/{INDEX}")


def main_sketches(spark: SparkSession, root: str, at_seq: int | None = None) -> DataFrame:
    """One row of sketches of all events of main, as of publish ``at_seq``."""
    sketches = open_table(spark, f"{root.rstrip('/')}/{SKETCHES}", _SKETCH)
    return merge_sketches(sketches.where(visible(spark, root, at_seq)))


def published_drift(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """A check for `publish_staged`: how far each bucket of the staged ``files`` has moved from main
    (columns of :func:`drift`). Sketches of what was published are brought up to date first."""
    return drift_from_main(
        spark, root, staged_events_of(spark, root, files), by=(schemas.BUCKET_COLUMN,)
    )


def drift_from_main(
    spark: SparkSession, root: str, events: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """How far events, of each ``by``, have moved from those of main."""
    sketch_published(spark, root)
    base = materialize(main_sketches(spark, root), "main-sketches")
    return drift(event_sketches(events, by), base)

"""Write, audit, publish: log audited staged batches as the main table.

Layout below the lake root, next to the staged events::

    main-files/seq=S/*.parquet              the staged files that publish S took in
    publish-refused/seq=S/*.parquet         batches and buckets that publish S left staged
    publish-state/seq=S/*.parquet           up to which batch all others are published
    main-commits/seq=S/*.parquet            merge commits of publish or rollback S
    compacted-files/run=R/seq=S/*.parquet   the files of publish S after compaction R
    compactions/run=R/*.parquet             up to which publish compaction R holds

Publishing moves no event: main *is* the staged files that are logged. A publish or rollback
becomes visible when its commits are written, which is the last step; entries of one that did
not finish belong to no logged commit, so no reader sees them, and the next one replaces them. Small
files of old publishes are joined by :func:`compact_published`, a job of its own. Nothing that a
reader may need is ever changed in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.operators.lake import (
    check_files,
    merges_for,
    published_files,
    read_at,
    relative_path,
    rollback_commits,
    visible_seqs,
)
from sessionlake.operators.quality import combined_audits
from sessionlake.session import intermediates_removed, materialize
from sessionlake.sources.tables import open_table
from sessionlake.streaming import ingest

MAIN_FILES = "main-files"
MAIN_COMMITS = "main-commits"
PUBLISH_STATE = "publish-state"
PUBLISH_REFUSED = "publish-refused"
COMPACTED = "compacted-events"
COMPACTED_FILES = "compacted-files"
COMPACTIONS = "compactions"

# A look at staged files, given as entries of their log: further columns for each bucket.
Check = Callable[[SparkSession, str, DataFrame], DataFrame]

# Events with the folders that they are in.
_PLACED_EVENT = T.StructType(
    schemas.LAKE_EVENT.fields
    + [f for f in schemas.STAGED_EVENT.fields if f.name in ("batch_id", "attempt")]
)


def main_commits(spark: SparkSession, root: str) -> DataFrame:
    """Merge commits of all finished publishes and rollbacks."""
    return ingest.lake_table(spark, root, MAIN_COMMITS, schemas.MAIN_COMMIT)


def logged_files(spark: SparkSession, root: str) -> DataFrame:
    """The staged files of all finished publishes, with the commit that took each in, whether
    it was taken back since or not."""
    files = ingest.lake_table(spark, root, MAIN_FILES, schemas.MAIN_FILE)
    run = _last_compaction(spark, root)
    if run is not None:
        joined = ingest.lake_table(spark, root, COMPACTED_FILES, schemas.COMPACTED_FILE)
        joined = joined.where(F.col("run") == run["run"]).drop("run")
        files = files.where(F.col("seq") > run["up_to_seq"]).unionByName(joined)
    return files.join(main_commits(spark, root).select("commit_id"), "commit_id", "left_semi")


def _last_compaction(spark: SparkSession, root: str):
    runs = ingest.lake_table(spark, root, COMPACTIONS, schemas.COMPACTION)
    return runs.agg(F.max(F.struct("run", "up_to_seq")).alias("last")).first()["last"]


def visible(spark: SparkSession, root: str, at_seq: int | None = None) -> Column:
    """A condition on ``seq``: whether that publish was in main after publish ``at_seq`` (None: is
    in main now)."""
    rollbacks = main_commits(spark, root).where("to_seq IS NOT NULL").select("seq", "to_seq")
    taken_back = rollbacks.distinct().collect()  # a row for each rollback
    spans = visible_seqs([tuple(r) for r in taken_back], at_seq)
    seq = F.col("seq")
    return reduce(or_, [seq.between(low, high) if high is not None else seq >= low for low, high in spans])


def main_files(spark: SparkSession, root: str, at_seq: int | None = None) -> DataFrame:
    """The staged files that main consists of, now or after publish ``at_seq``, with the commit
    that took each in."""
    return logged_files(spark, root).where(visible(spark, root, at_seq))


def main_events(spark: SparkSession, root: str, buckets: DataFrame | None = None) -> DataFrame:
    """Published events with bucket and commit id, of all buckets or the listed ones."""
    files = main_files(spark, root)
    if buckets is not None:
        files = files.join(
            buckets.select(schemas.BUCKET_COLUMN).distinct(), schemas.BUCKET_COLUMN, "left_semi"
        )
    return events_of(spark, root, files)


def main_events_as_of(spark: SparkSession, root: str, commit_id: str) -> DataFrame:
    """Published events as they were at a commit."""
    return events_of(spark, root, main_files(spark, root, _seq_of(spark, root, commit_id)))


def _seq_of(spark: SparkSession, root: str, commit_id: str) -> int:
    commits = main_commits(spark, root).where(F.col("commit_id") == commit_id)
    seq = commits.agg(F.max("seq")).first()[0]
    if seq is None:
        raise ValueError(f"no commit {commit_id} in the log")
    return seq


def events_of(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The events of logged files with their commit; fails if a file or some rows are gone."""
    rows = read_at(spark, root, files, _PLACED_EVENT)
    commits = files.select("batch_id", schemas.BUCKET_COLUMN, "commit_id").distinct()
    return rows.join(commits, ["batch_id", schemas.BUCKET_COLUMN]).select(
        *schemas.MAIN_EVENT.fieldNames()
    )


def unindexed_events(spark: SparkSession, root: str, index: str) -> tuple[DataFrame, DataFrame] | None:
    """The events, with ``seq``, of all publishes that are not in the table ``index`` below the
    root (column seq) yet, and the numbers of these; None if there is none."""
    done = open_table(spark, f"{root}/{index}", T.StructType([T.StructField("seq", T.LongType())]))
    commits = main_commits(spark, root).where("to_seq IS NULL").join(done, "seq", "left_anti")
    commits = materialize(commits.select("commit_id", "seq"), "not-indexed")
    if commits.isEmpty():
        return None
    files = logged_files(spark, root).join(commits.select("commit_id"), "commit_id", "left_semi")
    return events_of(spark, root, files).join(commits, "commit_id"), commits.select("seq").distinct()


def staged_events_of(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The events of entries of the log of staged files, with their bucket."""
    return read_at(spark, root, files, _PLACED_EVENT).select(*schemas.LAKE_EVENT.fieldNames())


def publish_staged(
    spark: SparkSession, root: str, accept: str = "ok", checks: Sequence[Check] = ()
) -> int:
    """Publish, bucket by bucket, what is staged and not published yet, if its audit passes.
    Returns the number of merge commits made. One publisher runs at a time.

    ``accept`` is an SQL condition on the audit's columns, by default its verdict. Rows that are
    no usable event were held back when they were staged, so they don't fail a bucket; a bucket
    that fails another condition stays staged, and is looked at again next time. ``checks`` add
    columns for the condition, from a look at the staged events beside main
    (:func:`published_repeats`, :func:`published_drift`); null where they found nothing. Files whose
    rows are not all there fail the publish before anything is logged. What a rollback took out
    of main stays out, until a rollback to a commit that has it.
    """
    with intermediates_removed(spark):
        return _publish(spark, root.rstrip("/"), accept, checks)


def _state(spark: SparkSession, root: str) -> tuple[int, int, str | None]:
    """The next publish's number, the last batch that a publish looked at, and the head of main."""
    commits = main_commits(spark, root).select("seq").distinct()
    state = ingest.lake_table(spark, root, PUBLISH_STATE, schemas.PUBLISH_STATE).join(
        commits, "seq", "left_semi"
    )
    last = state.agg(F.max(F.struct("seq", "done_batch_id", "head")).alias("last")).first()["last"]
    return (0, -1, None) if last is None else (last["seq"] + 1, last["done_batch_id"], last["head"])


def _refused(spark: SparkSession, root: str, seq: int) -> DataFrame:
    """Batches and buckets that were still staged after publish ``seq``, though looked at."""
    refused = ingest.lake_table(spark, root, PUBLISH_REFUSED, schemas.REFUSED)
    return refused.where(F.col("seq") == seq).select("batch_id", schemas.BUCKET_COLUMN)


def _publish(spark: SparkSession, root: str, accept: str, checks: Sequence[Check]) -> int:
    key = ["batch_id", schemas.BUCKET_COLUMN]
    bucket = schemas.BUCKET_COLUMN
    seq, done, head = _state(spark, root)
    refused = materialize(_refused(spark, root, seq - 1), "refused")

    def pending_of(log: DataFrame) -> DataFrame:
        """Entries of new batches, and of those left over: no other batch's folder is opened."""
        new = log.where(F.col("batch_id") > done)
        again = log.join(refused.where(F.col("batch_id") <= done), key, "left_semi")
        return new.unionByName(again)

    staged = pending_of(ingest.branch_files(spark, root))
    last = staged.agg(F.max("batch_id")).first()[0]
    pending = materialize(staged.where(F.col(bucket).isNotNull()), "pending")
    if pending.isEmpty():
        return 0
    audits = pending_of(ingest.batch_audits(spark, root))
    metrics = combined_audits(audits, by=[bucket])
    for check in checks:
        metrics = metrics.join(check(spark, root, pending), bucket, "left")
    passed = metrics.where(accept).select(bucket)
    if checks:  # they have read events, which once is enough for
        passed = materialize(passed, "passed")
    accepted = materialize(pending.join(passed, bucket, "left_semi"), "accepted")
    merges = materialize(merges_for(accepted, head, seq), "merges")
    made = merges.count()
    if made == 0:
        return 0
    check_files(spark, root, accepted, _PLACED_EVENT)
    published_files(accepted, merges).drop("seq").write.mode("overwrite").parquet(
        f"{root}/{MAIN_FILES}/seq={seq}"
    )
    left = pending.join(passed, bucket, "left_anti").select(*key).distinct()
    _finish(root, seq, max(last, done), left, merges)
    return made


def _finish(root: str, seq: int, done_batch_id: int, refused: DataFrame, commits: DataFrame) -> None:
    """Write the state after a publish or rollback and then, which makes it visible, its commits."""
    refused.write.mode("overwrite").parquet(f"{root}/{PUBLISH_REFUSED}/seq={seq}")
    commits.agg(
        F.lit(done_batch_id).cast("bigint").alias("done_batch_id"), F.max("commit_id").alias("head")
    ).write.mode("overwrite").parquet(f"{root}/{PUBLISH_STATE}/seq={seq}")
    commits.drop("seq").write.mode("overwrite").parquet(f"{root}/{MAIN_COMMITS}/seq={seq}")


def rollback_published(spark: SparkSession, root: str, commit_id: str) -> int:
    """Take main back to what it was at a commit; returns the number of buckets that change.

    No event and no earlier entry is touched: a commit for each bucket that changes says as of
    which publish main is now, and tells loads what to do again. Later
    publishes add to that state. What was taken out is not published again by itself; a rollback
    to a commit that had it brings it back. Rolling back to the present state changes nothing.
    """
    root, bucket = root.rstrip("/"), schemas.BUCKET_COLUMN
    with intermediates_removed(spark):
        to_seq = _seq_of(spark, root, commit_id)
        seq, done, head = _state(spark, root)
        now, then = visible(spark, root, None), visible(spark, root, to_seq)
        changed = logged_files(spark, root).where(now != then).select(bucket).distinct()
        commits = materialize(rollback_commits(changed, head, commit_id, seq, to_seq), "rollback")
        made = commits.count()
        if made:
            _finish(root, seq, done, _refused(spark, root, seq - 1), commits)
        return made


def changes_between(spark: SparkSession, root: str, from_commit: str, to_commit: str) -> DataFrame:
    """How main at ``to_commit`` differs from main at ``from_commit``: events (with bucket) and in
    how many rows more (``n_added``) or fewer (``n_removed``) they are there; one of both is 0.

    Rows are compared as a multiset, so an event that came again in another publish is no change.
    Files that both have cancel out by the log and are not opened: what is read grows with the
    publishes between the two commits, in either direction. Rows moved by compaction are the same.
    """
    then, now = (visible(spark, root, _seq_of(spark, root, c)) for c in (from_commit, to_commit))
    files = logged_files(spark, root)
    event = [f.name for f in schemas.LAKE_EVENT.fields]
    parts = [
        events_of(spark, root, files.where(here & ~there)).select(*event, F.lit(sign).alias("_sign"))
        for here, there, sign in ((now, then, 1), (then, now, -1))
    ]
    # maps with equal entries are equal, in whatever order these came
    key = [F.array_sort(F.map_entries(n)).alias(n) if n == "payload" else F.col(n) for n in event]
    both = parts[0].unionByName(parts[1]).groupBy(*key).agg(F.sum("_sign").alias("_change"))
    return both.where("_change <> 0").select(
        *[F.map_from_entries(n).alias(n) if n == "payload" else n for n in event],
        F.greatest("_change", F.lit(0)).alias("n_added"),
        F.greatest(-F.col("_change"), F.lit(0)).alias("n_removed"),
    )


def compact_published(spark: SparkSession, root: str, up_to_seq: int | None = None) -> int:
    """Join the small files of published batches; returns the number of files replaced.

    Events are rewritten by bucket, commit and batch into a folder of their own, and a new log of
    the files of those publishes is written beside the old one. One last write makes it the valid
    one, after the rows of each commit were compared; a job that ends before leaves the old log in
    force. Events, commits and time travel stay the same. The old files are left for readers that
    still have them open; they belong to the staging area, whose owner removes them. Runs while
    nobody publishes.
    """
    root = root.rstrip("/")
    with intermediates_removed(spark):
        files = logged_files(spark, root)
        if up_to_seq is not None:
            files = files.where(F.col("seq") <= up_to_seq)
        old = materialize(files, "old-files")
        found = old.agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("last")).first()
        if found["n"] == 0:
            return 0
        before = _last_compaction(spark, root)
        if before is not None and before["up_to_seq"] > found["last"]:
            raise ValueError(f"publishes up to {before['up_to_seq']} are compacted already")
        run, attempt = 0 if before is None else before["run"] + 1, f"c{uuid.uuid4().hex}"
        rows = read_at(spark, root, old, _PLACED_EVENT)
        key = ["batch_id", schemas.BUCKET_COLUMN]
        folder = f"{root}/{COMPACTED}"
        (
            rows.withColumn("attempt", F.lit(attempt))
            .hint("rebalance", *key)
            .write.mode("append")
            .partitionBy("batch_id", "attempt", schemas.BUCKET_COLUMN)
            .parquet(folder)
        )
        written = spark.read.schema(_PLACED_EVENT).parquet(folder).where(F.col("attempt") == attempt)
        listed = (
            written.groupBy(*key, "attempt", F.col("_metadata.file_path").alias("_file"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("path", relative_path(root, "_file"))
        )
        commits = old.select(*key, "commit_id", "seq").distinct()
        new = materialize(listed.join(commits, key).select(*schemas.MAIN_FILE.fieldNames()), "new-files")
        _same_rows(old, new)
        new.write.mode("overwrite").partitionBy("seq").parquet(f"{root}/{COMPACTED_FILES}/run={run}")
        marker = spark.range(1).select(F.lit(found["last"]).cast("bigint").alias("up_to_seq"))
        marker.write.mode("overwrite").parquet(f"{root}/{COMPACTIONS}/run={run}")
        return found["n"]


def _same_rows(old: DataFrame, new: DataFrame) -> None:
    """Raise unless both lists of files have the same number of rows for each commit."""
    def rows(files: DataFrame, name: str) -> DataFrame:
        return files.groupBy("commit_id").agg(F.sum("n_rows").alias(name))

    both = rows(old, "before").join(rows(new, "after"), "commit_id", "full")
    wrong = both.where(~F.col("before").eqNullSafe(F.col("after"))).take(1)
    if wrong:
        raise ValueError(f"the compacted files don't have the rows of the old ones: {wrong[0].asDict()}")

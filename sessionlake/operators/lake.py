"""Commit-log operators: find new commits, resolve merges, list and read their files.

``commit_log`` has (commit_id, seq, branch, parents, message); ``commit_files`` lists, for
each commit, the paths visible at it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake import schemas
from sessionlake.session import materialize

# Fixed value: how Spark names the folder of a partition without a value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def new_commits(commit_log: DataFrame, processed: DataFrame, branch: str) -> DataFrame:
    """Commits on ``branch`` that are not in ``processed`` (column commit_id)."""
    return commit_log.where(F.col("branch") == branch).join(
        processed.select("commit_id"), "commit_id", "left_anti"
    )


def merge_commits(commits: DataFrame, strict: bool = False) -> DataFrame:
    """Commits with two parents or more; ``strict`` fails the job on any other commit."""
    is_merge = F.size("parents") >= 2
    if not strict:
        return commits.where(is_merge)
    message = F.concat(F.lit("not a merge commit: "), F.col("commit_id"))
    return commits.where(
        F.when(is_merge, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )


def merged_tip(commits: DataFrame) -> DataFrame:
    """Add ``base`` (what was merged into) and ``tip`` (the branch that was merged)."""
    return commits.withColumns(
        {
            "base": F.get("parents", F.lit(0)),
            "tip": F.get("parents", F.lit(1)),
        }
    )


def _data_files(commit_files: DataFrame) -> DataFrame:
    return commit_files.where(F.col("path").endswith(schemas.DATA_FILE_SUFFIX))


def files_at(commit_files: DataFrame, commits: DataFrame) -> DataFrame:
    """Data files visible at the tip of each merge: (commit_id, tip, path)."""
    tips = merged_tip(commits).select("commit_id", "tip")
    listing = _data_files(commit_files).select(F.col("commit_id").alias("tip"), "path")
    return tips.join(listing, "tip").select("commit_id", "tip", "path")


def files_added(commit_files: DataFrame, commits: DataFrame) -> DataFrame:
    """Data files a merge brought in: visible at its tip and not at its base."""
    merges = merged_tip(commits).select("commit_id", "base", "tip")
    listing = _data_files(commit_files)
    at_tip = merges.join(listing.select(F.col("commit_id").alias("tip"), "path"), "tip")
    at_base = listing.select(F.col("commit_id").alias("base"), "path")
    return at_tip.join(at_base, ["base", "path"], "left_anti").select("commit_id", "tip", "path")


def snapshot_path(root: str, commit: Column, path: Column) -> Column:
    """Full address of a file as seen at a commit."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), commit, path)


def check_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    schema: T.StructType,
    commit_column: str | None = None,
) -> None:
    """Raise FileNotFoundError unless every listed file is there, with as many rows as the list
    says. Only the folders of listed files are opened, and of their files just the row counts.
    Arguments are those of :func:`read_at`."""
    _found(spark, root, files, schema, commit_column)


def read_at(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    schema: T.StructType,
    commit_column: str | None = None,
) -> DataFrame:
    """All rows of all the data files listed in ``files`` (column path, relative to ``root``).

    One way for any number of files: the tables that the files belong to are cut down to the
    listed partitions by a semi join on the partition columns, which Spark turns into partition
    pruning as long as the list is small enough to be sent to all tasks, and then by one on the
    file that each row came from. The list itself stays distributed; the driver sees the tables'
    folders and partition columns only. A listed file that is not there, or that doesn't have
    the list's ``n_rows`` (where there is such a column), fails the call: nothing is left out
    silently. An empty list gives an empty frame of ``schema``.

    In a store that shows each commit as a folder of its own, ``commit_column`` names the column
    of ``files`` with the commit to read each file at; paths are then relative to that folder.
    """
    columns = [f.name for f in _struct(schema).fields]
    parts = [
        rows.join(found.select("_file"), "_file", "left_semi").select(*columns)
        for rows, found in _found(spark, root, files, schema, commit_column)
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _found(
    spark: SparkSession, root: str, files: DataFrame, schema, commit_column: str | None
) -> list[tuple[DataFrame, DataFrame]]:
    """For each table with listed files: the rows of the listed partitions, with their file's
    address, and the addresses of the listed files, which are all there."""
    root = root.rstrip("/")
    path = F.col("path") if commit_column is None else F.concat_ws("/", commit_column, "path")
    expected = F.col("n_rows") if "n_rows" in files.columns else F.lit(None).cast("bigint")
    wanted = materialize(
        files.select(path.alias("path"), expected.alias("_expected")).distinct(), "file-list"
    )
    folder = F.regexp_extract("path", "^((?:[^/=]+/)*)", 1)
    columns = F.regexp_extract_all("path", F.lit("([^/=]+)="), 1)
    # partitions of no value are a folder with a fixed name, which equality can't find
    values = F.regexp_extract_all("path", F.lit("=([^/]*)/"), 1)
    nulls = F.transform(values, lambda v: v == NULL_PARTITION)
    place = {"folder": folder, "columns": columns, "nulls": nulls}
    tables = wanted.select(*[c.alias(n) for n, c in place.items()]).distinct().collect()
    out = []
    for table in sorted(tables):
        here = (folder == table["folder"]) & (columns == F.array(*map(F.lit, table["columns"])))
        listed = wanted.where(here & (nulls == F.array(*map(F.lit, table["nulls"]))))
        rows = _listed_partitions(spark, root, listed, schema, table)
        counted = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
        found = materialize(
            listed.join(counted.withColumn("path", relative_path(root, "_file")), "path", "left"),
            "file-rows",
        )
        _raise_if_short(root, found)
        out.append((rows, found))
    return out


def _listed_partitions(spark: SparkSession, root: str, listed: DataFrame, schema, table: Row) -> DataFrame:
    address = f"{root}/{table['folder']}".rstrip("/")
    rows = spark.read.schema(schema).parquet(address)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    empty = [c for c, null in zip(table["columns"], table["nulls"], strict=True) if null]
    named = [c for c in table["columns"] if c not in empty]
    for column in empty:
        rows = rows.where(F.col(column).isNull())
    if not named:
        return rows
    values = [
        F.url_decode(F.replace(F.regexp_extract("path", f"(?:^|/){c}=([^/]*)", 1), F.lit("+"), F.lit("%2B")))
        .cast(rows.schema[c].dataType)
        .alias(f"_{c}")
        for c in named
    ]
    partitions = listed.select(*values).distinct()
    # plain equality: from a null-safe one Spark makes no partition pruning
    return rows.join(partitions, [F.col(c) == F.col(f"_{c}") for c in named], "left_semi")


def _raise_if_short(root: str, found: DataFrame) -> None:
    there, expected = F.coalesce("_rows", F.lit(0)), F.col("_expected")
    wrong = F.when(expected.isNull(), there == 0).otherwise(there != expected)
    missing = found.where(wrong).take(1)
    if missing:
        raise FileNotFoundError(
            f"{root}/{missing[0]['path']}: {missing[0]['_rows'] or 0} rows found, "
            f"{missing[0]['_expected'] or 'some'} expected"
        )


def _struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def relative_path(root: str, address: str) -> Column:
    """Path below ``root`` of a file whose full address is in column ``address``.

    Spark reports URI-encoded addresses; a plus sign stands for itself there.
    """
    scheme = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?=/)", root)  # Spark writes file:/x for file:///x
    if not scheme:
        raise ValueError(f"the root must be an absolute path or a URI: {root!r}")
    plain_root = root[scheme.end() :].removeprefix("//").rstrip("/") + "/"
    full = F.url_decode(F.replace(F.col(address), F.lit("+"), F.lit("%2B")))
    start = F.instr(full, plain_root) + F.lit(len(plain_root))
    return F.substring(full, start, F.char_length(full))


def as_of(main: DataFrame, commit_log: DataFrame, commit_id: str | Column) -> DataFrame:
    """Rows of ``main`` as they were at a commit: those of it and of the commits before it. A
    commit that the log doesn't have is an error.

    ``main`` carries commit_id; as a partition column, other commits' files are not read.
    """
    target = commit_log.where(F.col("commit_id") == commit_id).agg(F.max("seq")).first()[0]
    if target is None:
        raise ValueError(f"no commit {commit_id} in the log")
    visible = commit_log.where(F.col("seq") <= target).select("commit_id")
    return main.join(visible, "commit_id", "left_semi")


def merge_commit_id(base: Column, tip: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit("merge"), F.coalesce(base, F.lit("")), tip), 256)


def branch_commit_id(batch_id: Column, bucket: Column) -> Column:
    text = F.concat_ws("|", F.lit("batch"), batch_id.cast("string"), bucket.cast("string"))
    return F.sha2(text, 256)


def merges_for(
    commits: DataFrame, base: str | None, seq: int, branch: str = schemas.MAIN_BRANCH
) -> DataFrame:
    """One two-parent merge commit per bucket of ``commits`` (branch commits that are not in main).

    All buckets of one publish share its ``seq`` and base, so a publish is visible as a
    whole or not at all. Ids depend on the parents only: a retry makes the same commits.
    """
    bucket = schemas.BUCKET_COLUMN
    tips = commits.groupBy(bucket).agg(
        F.max_by("commit_id", "batch_id").alias("_tip"),
        F.max("batch_id").alias("tip_batch_id"),
    )
    base_column = F.lit(base).cast("string")
    return tips.select(
        merge_commit_id(base_column, F.col("_tip")).alias("commit_id"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(branch).alias("branch"),
        F.array(F.coalesce(base_column, F.lit("")), F.col("_tip")).alias("parents"),
        F.concat(F.lit("Merge bucket "), F.col(bucket).cast("string")).alias("message"),
        F.col(bucket),
        F.col("tip_batch_id"),
        F.lit(None).cast("bigint").alias("to_seq"),
    )


def rollback_commits(
    changed: DataFrame,
    head: str,
    target: str,
    seq: int,
    to_seq: int,
    branch: str = schemas.MAIN_BRANCH,
) -> DataFrame:
    """One two-parent commit per bucket in ``changed``: of the head of main and the commit that
    it is taken back to, which is of ``to_seq``."""
    bucket = schemas.BUCKET_COLUMN
    name = F.col(bucket).cast("string")
    text = F.concat_ws("|", F.lit("rollback"), F.lit(head), F.lit(target), name)
    return changed.select(
        F.sha2(text, 256).alias("commit_id"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(branch).alias("branch"),
        F.array(F.lit(head), F.lit(target)).alias("parents"),
        F.concat(F.lit("Take back bucket "), name).alias("message"),
        bucket,
        F.lit(None).cast("bigint").alias("tip_batch_id"),
        F.lit(to_seq).cast("bigint").alias("to_seq"),
    )


def visible_seqs(
    rollbacks: list[tuple[int, int]], at_seq: int | None = None
) -> list[tuple[int, int | None]]:
    """Which publishes are in main after ``at_seq`` (None: the last one), as ranges of their
    numbers, both ends included; None is an open end.

    ``rollbacks`` has (seq, to_seq): after ``seq`` main is as it was after ``to_seq``, with all its
    own rollbacks, and what is published later adds to that.
    """
    spans, upper = [], at_seq
    for seq, to_seq in sorted(rollbacks, reverse=True):
        if upper is None or seq <= upper:
            spans.append((seq + 1, upper))
            upper = to_seq
    return [*spans, (0, upper)]


def published_files(files: DataFrame, merges: DataFrame) -> DataFrame:
    """The staged files that the merges take in, as rows of the log of main: publishing
    moves no event."""
    bucket = schemas.BUCKET_COLUMN
    return files.drop("commit_id", "branch", "message").join(
        merges.select(bucket, "commit_id", "seq"), bucket
    ).select(*schemas.MAIN_FILE.fieldNames())

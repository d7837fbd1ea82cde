"""Comma-separated files with quoted fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake.functions import strip_blanks

# A Unicode noncharacter, so not part of any text; marks the commas that separate fields.
_MARK = "\uffff"


def split_fields(line: Column) -> Column:
    """Fields of one line. Double quotes may open and close anywhere in a field and are
    dropped; commas between them belong to the field. Fields are stripped at both ends.

    Cutting the line at its quotes leaves the text outside quotes in the even pieces, so a
    separator is a comma in an even piece.
    """
    pieces = F.transform(
        F.split(line, '"', -1),
        lambda piece, i: F.when(
            i % 2 == 0, F.replace(piece, F.lit(","), F.lit(_MARK))
        ).otherwise(piece),
    )
    return F.transform(F.split(F.array_join(pieces, ""), _MARK, -1), strip_blanks)


def _lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    return (
        spark.read.schema("line STRING")
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", _MARK)
        .option("quote", "")
        .option("escape", "")
        .option("lineSep", "\n")
        .csv(path)
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a delimited file as text columns, by position. The first line of each file is
    its header, which says how many fields a line has; lines with another number are dropped.
    The layout takes the first ones; a header with fewer is an error. An empty field is an
    empty string, not NULL. The files of one folder share a header; one that differs is an error.

    The CSV source only supplies lines here (it knows how to skip the header of a file that
    is split over many tasks); fields are cut by :func:`split_fields`, so column pruning
    cannot change which lines count as malformed.
    """
    names = schema.fieldNames()
    headers = _headers(spark, path)
    if not headers:
        return spark.createDataFrame([], schema)
    if len(headers) > 1:
        raise ValueError(f"{path}: files with different headers: {sorted(headers)[:2]}")
    arity = headers.pop()
    if arity < len(names):
        raise ValueError(f"{path}: the header has {arity} fields, the layout needs {len(names)}")
    fields = F.col("fields")
    return (
        _lines(spark, path, header=True)
        .select(split_fields(F.col("line")).alias("fields"))
        .where(F.size(fields) == arity)
        .select(*[fields[i].alias(name) for i, name in enumerate(names)])
    )


def _headers(spark: SparkSession, path: str) -> set[int]:
    """Numbers of fields of the files' first lines. A file's first line is the first row of its
    first block, so one row of each file is looked at."""
    first = (
        _lines(spark, path, header=False)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("place"),
            split_fields(F.col("line")).alias("fields"),
        )
        .where(F.col("start") == 0)
        .groupBy("file")
        .agg(F.min_by(F.size("fields"), "place").alias("arity"))
    )
    return {row["arity"] for row in first.select("arity").distinct().collect()}

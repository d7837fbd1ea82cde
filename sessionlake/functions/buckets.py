"""Range buckets over session numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlake import schemas


def range_bucket(number: Column, width: int = schemas.BUCKET_WIDTH) -> Column:
    """Smallest positive multiple of ``width`` that is at least ``number``; NULL stays NULL.

    Integer arithmetic only, so it is exact over the whole BIGINT input range.
    """
    n = number.cast("bigint")
    w = F.lit(width).cast("bigint")
    return F.when(n <= w, w).when(n.isNotNull(), n + F.pmod(-n, w))


def branch_name(bucket: Column) -> Column:
    """Name of the staging branch that holds one bucket."""
    return F.concat(F.lit(schemas.BRANCH_PREFIX), bucket.cast("string"))

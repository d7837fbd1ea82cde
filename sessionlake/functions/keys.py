"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_id(*natural_key: Column) -> Column:
    """UUID-shaped id from the SHA-256 of the natural key.

    A retried task yields the same id. Each part is length-prefixed, so neither separators
    inside values nor NULLs can make two different keys collide.
    """
    parts = []
    for column in natural_key:
        text = column.cast("string")
        tagged = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(tagged, F.lit("-")))
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])

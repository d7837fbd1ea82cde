"""Hour keys (yyyyMMddHH as INT) and their inverse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(value: Column) -> Column:
    """ISO-8601 text (or a timestamp) to its wall-clock time; unparsable text gives NULL.

    A zone suffix is accepted and ignored, so the hour is the one written in the text.
    """
    return value.try_cast("timestamp_ntz")


def time_id(value: Column) -> Column:
    """Hour key of an ISO-8601 string or timestamp.

    Built from date parts rather than a format call: no session time zone is involved, so
    hours inside a daylight-saving gap keep their value. Years past 2147 do not fit: NULL.
    """
    ts = parse_instant(value)
    key = (
        F.year(ts).cast("bigint") * 1000000
        + F.month(ts) * 10000
        + F.dayofmonth(ts) * 100
        + F.hour(ts)
    )
    return key.try_cast("int")


def time_id_to_ts(key: Column) -> Column:
    """Start of the hour an hour key names; NULL for an impossible date or hour."""

    def part(divisor: int, modulus: int) -> Column:
        return F.floor(key / divisor).cast("int") % modulus

    return F.try_make_timestamp_ntz(
        part(1000000, 10000), part(10000, 100), part(100, 100), part(1, 100), F.lit(0), F.lit(0)
    )

"""Column functions; all are compositions of built-in Spark expressions."""

from sessionlake.functions.buckets import branch_name, range_bucket
from sessionlake.functions.keys import surrogate_id
from sessionlake.functions.parsing import (
    leading_float,
    leading_int,
    split_list,
    strip_blanks,
    yes_flag,
)
from sessionlake.functions.timekeys import parse_instant, time_id, time_id_to_ts

__all__ = [
    "branch_name",
    "leading_float",
    "leading_int",
    "parse_instant",
    "range_bucket",
    "split_list",
    "strip_blanks",
    "surrogate_id",
    "time_id",
    "time_id_to_ts",
    "yes_flag",
]

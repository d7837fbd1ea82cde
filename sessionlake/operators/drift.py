"""Drift: how far the measures of a batch have moved from what is published, by sketches.

A sketch of a measure's distribution (KLL) and one of the stations (HyperLogLog) are taken of each
batch and bucket once; sketches merge, so no event is read again to compare. With the default size
of a KLL sketch a rank is off by up to 0.0133 with 99 % confidence, however much was merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake import schemas

# Places of a distribution that are compared, and the grid on which ranks are looked up.
DECILES = [k / 10 for k in range(1, 10)]
_GRID = [k / 100 for k in range(1, 100)]

# Bound of a shift's error: of the two sketches, and of the grid.
RANK_ERROR = 0.0133
SHIFT_ERROR = 2 * RANK_ERROR + 0.01

MEASURES = (schemas.PAYLOAD_ENERGY, schemas.PAYLOAD_DURATION)
_NAMES = {schemas.PAYLOAD_ENERGY: "energy", schemas.PAYLOAD_DURATION: "duration"}


def event_sketches(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the measures and stations of events, one row per ``by``; see
    :func:`merge_sketches`. Measures that are no numbers don't count."""
    return events.groupBy(*by).agg(
        *[F.kll_sketch_agg_double(_value(m)).alias(f"{_NAMES[m]}_sketch") for m in MEASURES],
        F.hll_sketch_agg("station_id").alias("station_sketch"),
    )


def _value(measure: str) -> Column:
    return F.col("payload")[measure].try_cast("double")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of all the events that ``sketches`` are of, one row per ``by``."""
    return sketches.groupBy(*by).agg(
        *[F.kll_merge_agg_double(f"{n}_sketch").alias(f"{n}_sketch") for n in _NAMES.values()],
        F.hll_union_agg("station_sketch").alias("station_sketch"),
    )


def _quantiles(sketch: Column, ranks: list[float]) -> Column:
    """Quantiles of a sketch; null if it has no value."""
    found = F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, ranks)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)


def _literal(values: list[float] | None) -> Column:
    none = F.lit(None).cast("array<double>")
    return none if values is None else F.array(*map(F.lit, values))


def _shift(quantiles: Column, grid: Column) -> Column:
    """The greatest distance between a rank in the batch and that of the same value before."""
    def distance(value: Column, at: Column) -> Column:
        # places on the grid that are not above the value; ties count from both sides
        upto = F.size(F.filter(grid, lambda x: x <= value)) / F.lit(100.0)
        below = F.size(F.filter(grid, lambda x: x < value)) / F.lit(100.0)
        rank = (at + 1) / F.lit(10.0)
        return F.greatest(below - rank, rank - upto - F.lit(0.01), F.lit(0.0))

    return F.array_max(F.transform(quantiles, distance))


def drift(batch: DataFrame, base: DataFrame) -> DataFrame:
    """``batch`` (sketches, one row per group) held against ``base`` (one row of sketches).

    Adds ``energy_shift`` and ``duration_shift``: by how much of the published values the deciles
    have moved at most, from 0 to 1, right to within ``SHIFT_ERROR``; null if one of both has no
    values. And ``n_stations``, about how many the batch has.
    """
    before = base.select(
        *[_quantiles(F.col(f"{n}_sketch"), _GRID).alias(n) for n in _NAMES.values()]
    ).first()
    shifts = {
        f"{n}_shift": _shift(_quantiles(F.col(f"{n}_sketch"), DECILES), _literal(before[n]))
        for n in _NAMES.values()
    }
    kept = [c for c in batch.columns if not c.endswith("_sketch")]
    stations = F.hll_sketch_estimate("station_sketch").alias("n_stations")
    return batch.select(*kept, *[c.alias(n) for n, c in shifts.items()], stations)

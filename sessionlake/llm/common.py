"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.session import materialize

# The white space of the contracts, as deleted or splitting characters.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    An installed package needs no help; a checkout is found through the workers' own path.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *paths])


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A whole table, opened by Spark's reader from whatever store it is in."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text, so that no other column can clash with what is computed."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


# Spark's bitmap functions keep 32,768 bits in a bitmap.
BITMAP_BITS = 8 * 4096


def bit_is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bitmap has a bit; null where there is no bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    # a division by a power of two takes the place of a column shift
    power = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (bit % 8 + 1).cast("int"))
    return byte.cast("int").bitwiseAND(power) != 0


def key_filter(hashes: DataFrame, bits: int = 1 << 27) -> DataFrame:
    """A filter of the numbers in the one column of ``hashes``, as a written table of at most
    ``bits / 32768`` bitmaps of 4 KB; see `with_held`."""
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    maps = (
        hashes.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / BITMAP_BITS).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bitmap"))
    )
    return materialize(maps, "key-filter")


def with_held(rows: DataFrame, key: Column, maps: DataFrame, name: str, bits: int = 1 << 27) -> DataFrame:
    """``rows`` with a boolean: may the filter hold ``key``? False is certain. The filter is sent to
    the rows, which don't move."""
    at, part, bitmap = (free_name(rows, n) for n in ("_at", "_part", "_bitmap"))
    side = F.broadcast(maps.toDF(part, bitmap))  # of a fixed size
    placed = rows.withColumn(at, F.pmod(key, F.lit(bits)))
    joined = placed.join(side, F.floor(F.col(at) / BITMAP_BITS).cast("int") == F.col(part), "left")
    held = F.coalesce(bit_is_set(F.col(bitmap), F.col(at) % BITMAP_BITS), F.lit(False))
    return joined.withColumn(name, held).drop(at, part, bitmap)


def keep_chosen(docs: DataFrame, keys: list[Column], fates: DataFrame, bits: int = 1 << 27) -> DataFrame:
    """``docs`` without the rows that ``fates`` lets go, and one of those that it keeps once.

    ``keys`` tell rows apart as far as needed; ``fates``, a written table, has a column for each,
    in order, and a last one: ``go`` or ``one``. Rows that it doesn't name all stay. A filter of
    the keys is sent to the rows; those that it doesn't hold stay where they are, and only the
    others are written and joined.
    """
    names = [free_name(docs, f"_key{i}") for i in range(len(keys))]
    fate, held = (free_name(docs, n) for n in ("_fate", "_held"))
    sides = [free_name(docs, f"_fate_key{i}") for i in range(len(keys))]
    fates = fates.toDF(*sides, fate)
    keyed = docs.withColumns(dict(zip(names, keys, strict=True)))
    maps = key_filter(fates.select(F.xxhash64(*sides)), bits)
    tested = with_held(keyed, F.xxhash64(*names), maps, held, bits)
    named = materialize(tested.filter(held).select(*docs.columns, *names), "fate-named")
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names, sides, strict=True)]
    marked = named.join(fates, same, "left")
    stay = marked.filter(F.col(fate).isNull()).select(*docs.columns)
    once = marked.filter(F.col(fate) == "one").dropDuplicates(names).select(*docs.columns)
    return tested.filter(~F.col(held)).select(*docs.columns).unionByName(stay).unionByName(once)


def held_out(id_col: str, parts: int, part: int):
    """Whether a row is kept from learning: crc32 of its id as text, modulo ``parts``."""
    return F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False)
    )


class Remembered(dict):
    """Results of a function, for the arguments met lately.

    Two generations of ``most`` entries bound the memory: a full one becomes the old one, and
    what is asked for again moves to the new one. Results don't depend on what is remembered.
    """

    def __init__(self, function: Callable, most: int):
        super().__init__()
        self._function, self._most, self._old = function, most, {}

    def __missing__(self, key):
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        value = self._old.get(key)
        if value is None:
            value = self._function(key)
        self[key] = value
        return value


# By operator, what drops the tables that its functions keep in a Python worker between tasks.
_kept_tables: dict[str, list[Callable[[], None]]] = {}


def kept_by(operator: str):
    """Mark a function with `functools.lru_cache` as one whose results serve just this operator."""

    def mark(cached):
        _kept_tables.setdefault(operator, []).append(cached.cache_clear)
        return cached

    return mark


def drop_tables_of_others(operator: str) -> None:
    """Let this Python worker drop what other operators' functions keep, and give freed memory back.

    Workers live on and serve the stages of a pipeline one after the other; what a stage that is
    over keeps would lie beside what the next ones need, in them and in the executor's heap. To be
    called where a task begins. Results don't depend on it: tables are made again when needed.
    """
    for owner, clears in _kept_tables.items():
        if owner != operator:
            for clear in clears:
                clear()
    pa.system_memory_pool().release_unused()


def small_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose texts hold about ``max_bytes``.

    Every row is in one slice, whole; a longer text makes a slice of its own. This bounds the
    memory of array code over a slice by the longest text, not by Arrow's batch size. Workers
    live on between tasks, so batches are taken from the system's memory, which freed ones go
    back to; Arrow's own pool would keep it.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to

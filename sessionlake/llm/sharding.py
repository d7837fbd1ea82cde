"""Rendezvous hashing of record keys over weighted shards, with gapless slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import free_name

# 13 hexadecimal digits of an MD5 are 52 bits, which a double holds exactly.
_HEX_DIGITS = 13
_SPAN = float(1 << (4 * _HEX_DIGITS))

# Rows of a shard are numbered in this many independent groups, whatever the input's size.
SLOT_GROUPS = 1024


def _uniform(text: Column) -> Column:
    """A number strictly between 0 and 1 that depends on ``text`` alone."""
    digits = F.substring(F.md5(text.cast("binary")), 1, _HEX_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(_SPAN)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest weighted score for ``key``; the smaller one of a tie.

    Shard ``i`` scores ``ln(u) / weights[i]`` with ``u`` drawn from key and ``i``, so it wins
    in proportion to its weight. A shard's score doesn't know of the other shards: adding one
    moves only the rows that it wins, and removing one moves only its own rows. A null key is
    a key like any other. A weight of 0 closes a shard.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    null = F.when(key.isNull(), F.lit("null")).otherwise(F.lit("key"))
    scores = [
        F.struct(
            (F.ln(_uniform(F.concat_ws(":", null, text, F.lit(str(i))))) / F.lit(float(w))).alias("s"),
            F.lit(-i).alias("i"),
        )
        for i, w in enumerate(weights)
        if w > 0
    ]
    return (-F.array_max(F.array(*scores))["i"]).cast("int")


def assign_shards(
    docs: DataFrame,
    key_col: str,
    weights: Sequence[float],
    shard_col: str = "shard",
) -> DataFrame:
    """``docs`` with the shard of each row; no row moves, as only the key decides."""
    return docs.withColumn(shard_col, rendezvous_shard(F.col(key_col), weights))


def add_slots(
    docs: DataFrame,
    order_cols: Sequence[str],
    shard_col: str = "shard",
    slot_col: str = "slot",
    groups: int = SLOT_GROUPS,
) -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... without a gap.

    A shard's rows are dealt to ``groups`` groups by the hash of ``order_cols`` and ordered by
    those columns within a group, so one shard is numbered by up to ``groups`` tasks. Only the
    sizes of the groups (one number each) are summed in order. Rows equal in all of
    ``order_cols`` get neighbouring slots, either way round.
    """
    group, row, offset = (free_name(docs, n) for n in ("_group", "_row", "_offset"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order_cols]
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 7)
    dealt = docs.withColumn(group, (F.conv(digits, 16, 10).cast("long") % groups).cast("int"))
    within = Window.partitionBy(shard_col, group).orderBy(*order_cols)
    before = Window.partitionBy(shard_col).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(shard_col, group)
        .agg(F.count(F.lit(1)).alias(row))
        .select(
            shard_col, group, F.coalesce(F.sum(row).over(before), F.lit(0)).cast("long").alias(offset)
        )
    )
    # At most shards x groups rows, whatever the input: a broadcast of a fixed bound.
    return (
        dealt.withColumn(row, F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), [shard_col, group])
        .withColumn(slot_col, F.col(offset) + F.col(row))
        .drop(group, row, offset)
    )


def shard_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The contract's columns under the law ``key``.

    A null text has size 1 and the CRC of no bytes; repeated rows share a shard and take
    a slot each; an empty table gives an empty result; further columns don't matter.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col("doc_id"), [1.0] * shards).alias("shard"),
        rendezvous_shard(F.col("doc_id"), [1.0] * (shards + 1)).alias("grown_shard"),
    )
    return add_slots(rows, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )



# The checksum of a text is worked out byte by byte, from the table of its polynomial.
ORACLE = """
WITH RECURSIVE bits AS (
  SELECT range::UBIGINT AS byte, range::UBIGINT AS crc, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::UBIGINT) ELSE crc >> 1 END, k + 1
  FROM bits WHERE k < 8
), codes AS (
  SELECT list(crc ORDER BY byte) AS code FROM bits WHERE k = 8
), d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sums AS (
  SELECT doc_id, CAST(length(h) // 2 + 1 AS BIGINT) AS size, CAST(xor(list_reduce(
      list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::UBIGINT),
      lambda crc, b: xor(crc >> 8, code[(xor(crc, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT),
      4294967295::UBIGINT) AS BIGINT) AS text_crc32
  FROM d, codes
), drawn AS (
  SELECT doc_id, i, substr(md5('key:' || doc_id || ':' || i), 1, %(digits)d) AS u
  FROM documents, (SELECT range AS i FROM range(17))
), shards AS (
  SELECT doc_id, CAST(arg_min(i, (-('0x' || u)::BIGINT, i)) FILTER (i < 16) AS INTEGER) AS shard,
    CAST(arg_min(i, (-('0x' || u)::BIGINT, i)) AS INTEGER) AS grown_shard
  FROM drawn GROUP BY doc_id
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY
    ('0x' || substr(md5(doc_id || ':' || text_crc32), 1, 7))::BIGINT %% %(groups)d, doc_id, text_crc32) - 1 AS slot,
  grown_shard
FROM sums JOIN shards USING (doc_id)
""" % {"digits": _HEX_DIGITS, "groups": SLOT_GROUPS}

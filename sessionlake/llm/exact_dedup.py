"""Exact deduplication: two-pass Bloom filtering, so that only possible repeats shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import BITMAP_BITS, WHITE_SPACE, bit_is_set, free_name, keep_chosen
from sessionlake.session import materialize

# 2^27 bits: 16 MB of bitmaps at most, whatever the input.
FILTER_BITS = 1 << 27


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty.

    Replacing one character after the other works on bytes, several times as fast as a
    translation of characters.
    """
    text = F.coalesce(text, F.lit(""))
    for blank in WHITE_SPACE:
        text = F.replace(text, F.lit(blank))
    return text


def text_digest(text: Column) -> Column:
    """What equal texts have in common: SHA-256 of the normalised text, lower-case hexadecimal."""
    return F.sha2(normalised(text), 256)


def _slots(digest: str, bits: int) -> Column:
    """Two positions in the filter, from independent hashes of a digest."""
    return F.array(
        F.pmod(F.xxhash64(digest), F.lit(bits)), F.pmod(F.xxhash64(F.lit(1), digest), F.lit(bits))
    )


def repeat_filter(rows: DataFrame, digest: str, bits: int = FILTER_BITS) -> DataFrame:
    """First pass: bitmaps of the positions that more than one row of ``rows`` hits.

    Each task counts its rows' positions before anything moves, so a hot text is one number
    per task; what shuffles is positions, not texts. The result has at most ``bits / 32768``
    rows of 4 KB: columns ``bucket`` and ``bitmap``.
    """
    hit = (
        rows.select(F.explode(_slots(digest, bits)).alias("at"))
        .groupBy("at")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return hit.groupBy((F.col("at") / BITMAP_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bitmap")
    )


def with_possible_repeats(
    docs: DataFrame, digest: str, flag: str, bits: int = FILTER_BITS
) -> DataFrame:
    """``docs``, which has a ``digest`` column, with a boolean: may another row have the same?

    False is certain; true may be a chance hit of both positions. The bitmaps are broadcast,
    at most ``bits / 8`` bytes, so that no row of ``docs`` moves.
    """
    bitmaps = materialize(repeat_filter(docs, digest, bits), "repeat-filter")
    at = free_name(docs, "_at")
    out = docs.withColumn(at, _slots(digest, bits))
    hits = [free_name(docs, f"_hit{i}") for i in (0, 1)]
    for i, hit in enumerate(hits):
        place, bucket, bitmap = (free_name(docs, f"{n}{i}") for n in ("_place", "_bucket", "_bitmap"))
        side = bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
        out = out.withColumn(place, F.col(at)[i]).join(
            F.broadcast(side), (F.col(place) / BITMAP_BITS).cast("int") == F.col(bucket), "left"
        )
        held = bit_is_set(F.col(bitmap), F.col(place) % BITMAP_BITS)
        out = out.withColumn(hit, F.coalesce(held, F.lit(False))).drop(bucket, bitmap, place)
    return out.withColumn(flag, F.col(hits[0]) & F.col(hits[1])).drop(at, *hits)


def _first(length: str, doc_id: str, row: str) -> Column:
    """What the row that stays has least: longest text, smallest id (null last), first row."""
    return F.struct(
        (-F.col(length)).alias("shorter"),
        F.col(doc_id).isNull().alias("no_id"),
        F.col(doc_id).alias("id"),
        F.col(row).alias("row"),
    )


def duplicate_groups(docs: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): which row of its equal texts stays.

    Texts are equal when they are so without ASCII white space; null counts as empty, so null,
    empty and blank texts are one group. Of a group, the row with the most code points stays,
    then the one with the smallest doc_id; of rows equal in both, exactly one has ``kept``.
    Digests, never texts, are written and joined. Rows that can't repeat pass straight through.
    """
    flag = "maybe"
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest(text).alias("text_sha256"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("length"),
    )
    digests = materialize(
        with_possible_repeats(rows, "text_sha256", flag, bits).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "text-digests",
    )
    alone = digests.filter(~F.col(flag)).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    maybe = digests.filter(F.col(flag))
    # written, so that the join below has two plain shuffles and Spark can split a hot group
    groups = materialize(
        maybe.groupBy(F.col("text_sha256").alias("_sha")).agg(
            F.min(_first("length", "doc_id", "row")).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "text-groups",
    )
    together = maybe.join(groups, F.col("text_sha256") == F.col("_sha")).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(together)


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, as `duplicate_groups` chooses it.

    Null, empty and blank texts are equal; of rows equal in text, length and id one stays. An
    empty table stays empty; other columns may have any names.

    Digests alone are written, filtered and grouped, to find the rows that go. Of the texts only those
    are moved that a filter of fixed size takes for one of a row that goes, or that others are equal
    to in length and id.
    """
    text = F.col(text_col).cast("string")
    key = [
        text_digest(text),
        F.col(id_col).cast("long"),
        F.char_length(F.coalesce(text, F.lit(""))),
    ]
    rows = docs.select(*[c.alias(n) for c, n in zip(key, ("sha", "id", "length"), strict=True)])
    digests = materialize(rows, "text-digests")
    maybe = with_possible_repeats(digests, "sha", "maybe", bits).filter("maybe")
    keyed = maybe.groupBy("sha", "id", "length").agg(F.count(F.lit(1)).alias("n"))
    keyed = materialize(keyed, "text-keys")
    own = F.struct((-F.col("length")).alias("shorter"), F.col("id").isNull().alias("no_id"), F.col("id"))
    best = keyed.groupBy(F.col("sha").alias("_sha")).agg(F.min(own).alias("best"))
    best = materialize(best, "text-groups")
    fate = F.when(~own.eqNullSafe(F.col("best")), "go").when(F.col("n") > 1, "one")
    fates = (
        keyed.join(best, F.col("sha") == F.col("_sha"))
        .select("sha", "id", "length", fate.alias("fate"))
        .filter("fate IS NOT NULL")
    )
    return keep_chosen(docs, key, materialize(fates, "text-fates"))


ORACLE = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id)
"""

"""Mixing overlapping sources to target weights: min-cost flow, then a seeded choice."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import WORD, free_name
from sessionlake.session import materialize

# The contract's weights, by rank of a source's name; repeated as often as needed.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3

# Documents of a pattern are laid out in this many stretches of the seeded order.
STRETCHES = 4096


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: Mapping, weights: Mapping, total: int, cap: int = MAX_PASSES) -> dict:
    """Share ``total`` by weight, no target above ``cap`` times its size.

    What a capped source leaves is shared again among the others by weight, until none is
    above its cap. Exact fractions, so that reruns and orders of sources agree.
    """
    open_ = set(sizes)
    target = {s: Fraction(0) for s in sizes}
    left = Fraction(total)
    while open_:
        weight = sum(Fraction(weights[s]) for s in open_)
        if weight == 0:
            break
        over = {s for s in open_ if left * Fraction(weights[s]) / weight > cap * sizes[s]}
        if not over:
            for s in open_:
                target[s] = left * Fraction(weights[s]) / weight
            break
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def min_cost_flow(
    capacity: Mapping[tuple, int],
    target: Mapping[object, Fraction],
    passes: int = MAX_PASSES,
) -> dict[tuple, dict[object, Fraction]]:
    """Words that each source takes from each membership pattern.

    ``capacity``: words of the documents with a pattern (a tuple of sources). A pattern gives
    its words up to ``passes`` times; pass ``k`` costs ``k`` a word, so the costs are convex
    and words are repeated only where nothing fresh can serve. Successive shortest paths over
    source, quota, pattern, sink: each path fills at least one arc. The network has a node for
    each source and pattern, never one for a document.
    """
    patterns = [p for p in capacity if capacity[p] > 0 and p]
    flow: dict[tuple, dict] = {p: {s: Fraction(0) for s in p} for p in patterns}
    used = {p: Fraction(0) for p in patterns}
    need = {s: Fraction(v) for s, v in target.items()}
    by_source: dict[object, list] = {}
    for p in patterns:
        for s in p:
            by_source.setdefault(s, []).append(p)

    def level(p):  # the pass that is being filled, and what is left of it
        k = int(used[p] // capacity[p])
        return k, Fraction(capacity[p]) * (k + 1) - used[p]

    for source in sorted(need, key=repr):
        while need[source] > 0:
            # cheapest way from this source to a pattern with room, perhaps by moving
            # words that another source has from a pattern over to another pattern
            best: dict[object, int] = {source: 0}
            came: dict[object, tuple] = {}
            queue, order, end, cost = [(0, 0, source)], 0, None, None
            room = {p: level(p) for p in patterns}
            while queue:
                d, _, s = heapq.heappop(queue)
                if d > best[s]:
                    continue
                if cost is not None and d >= cost:
                    break
                for p in by_source.get(s, ()):
                    k, _ = room[p]
                    if k < passes and (cost is None or d + k < cost):
                        end, cost = (s, p), d + k
                    for other, words in flow[p].items():
                        if other != s and words > 0 and d < best.get(other, passes + 1):
                            best[other] = d
                            came[other] = (s, p)
                            order += 1
                            heapq.heappush(queue, (d, order, other))
            if end is None:
                break
            s, last = end
            path = []
            step = s
            while step != source:
                before, p = came[step]
                path.append((before, p, step))
                step = before
            amount = min([need[source], room[last][1], *(flow[p][s2] for _, p, s2 in path)])
            for before, p, after in path:
                flow[p][before] += amount
                flow[p][after] -= amount
            flow[last][s] += amount
            used[last] += amount
            need[source] -= amount
    return flow


def with_place(
    docs: DataFrame, id_col: str, text_col: str, pattern: Column, name: str, seed: int = 0
) -> DataFrame:
    """``docs`` with each row's place in the seeded order: 60 bits of a hash of seed, id, text,
    pattern and, among rows equal in all three, a number.

    So rows of one id are spread like others. Which of some equal rows has which number doesn't
    matter: their places are the same in every run. Only equal rows are shuffled, for their
    numbers, which each task gives for itself behind those of the tasks before.
    """
    key, number = free_name(docs, "_mix_key"), free_name(docs, "_mix_number")
    text = F.coalesce(F.md5(F.col(text_col).cast("string").cast("binary")), F.lit("null"))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    keyed = docs.withColumn(key, F.concat_ws(":", own, text, F.to_json(pattern)))
    counts = keyed.groupBy(F.col(key).alias("_repeated")).agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counts.filter("n > 1").select("_repeated"), "mix-repeated")
    alone = keyed.join(repeated, F.col(key) == F.col("_repeated"), "left_anti").withColumn(
        number, F.lit(0).cast("long")
    )
    placed = _numbered(keyed.join(repeated, F.col(key) == F.col("_repeated"), "left_semi"), key, number)
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key), F.col(number).cast("string"))
    at = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return alone.unionByName(placed).withColumn(name, at).drop(key, number)


def _numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Equal rows numbered 0, 1, ... for each ``key``, by tasks that see a part of them each."""
    part, first = free_name(rows, "_mix_part"), free_name(rows, "_mix_first")
    dealt = materialize(rows.withColumn(part, F.spark_partition_id()), "mix-equal-rows")
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, part).agg(F.count(F.lit(1)).alias(first))
    starts = starts.withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(key, part).orderBy(F.lit(0)))
    return (
        dealt.withColumn(name, within)
        .join(starts, [key, part])
        .withColumn(name, F.col(first) + F.col(name) - 1)
        .drop(part, first)
    )


def pattern_of(docs: DataFrame, source_col: str) -> Column:
    """A document's membership pattern: its sources, each once, in order.

    The column names one source (null is a source as well) or is an array of them; a null
    array is no source at all.
    """
    column = F.col(source_col)
    if docs.schema[source_col].dataType.typeName() != "array":
        return F.array(column.cast("string"))
    none = F.array().cast("array<string>")
    return F.sort_array(F.array_distinct(F.coalesce(column.cast("array<string>"), none)))


def cut_points(sized: DataFrame, wanted: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """How often each pattern's documents are taken: ``_passes`` times, and once more where
    the seeded place is below ``_cut``.

    ``sized``: ``pattern``, ``size``, ``at`` (the place); ``wanted``: as `plan_mix` returns it. The
    seeded order is cut into ``stretches`` of equal width. Their sums, a fixed number for each
    pattern, show in which one the wanted words end; only documents of that stretch are put in
    order, up to the one whose middle is past the wanted words.
    """
    span = (1 << 60) // stretches
    # One row per pattern; the driver has just made them, so they are a bounded broadcast.
    wanted = F.broadcast(
        wanted.withColumn(
            "_passes",
            F.when(F.col("_capacity") > 0, F.floor(F.col("_words") / F.col("_capacity")))
            .otherwise(0)
            .cast("long"),
        ).withColumn("_rest", F.col("_words") - F.col("_passes") * F.col("_capacity"))
    )
    placed = sized.select("pattern", "size", "at").withColumn(
        "part", F.floor(F.col("at") / F.lit(span)).cast("int")
    )
    before = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        placed.groupBy("pattern", "part")
        .agg(F.sum("size").alias("words"))
        .withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(wanted, "pattern")
        .filter("start <= _rest and _rest < start + words")
        .select("pattern", "part", "start", "_rest")
    )
    ends = materialize(ends, "mix-ends")  # at most one row per pattern
    stretch = (
        placed.join(F.broadcast(ends), ["pattern", "part"])
        .groupBy("pattern", "part", "start", "_rest", "at")
        .agg(F.sum("size").alias("words"))
    )
    earlier = Window.partitionBy("pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        stretch.withColumn("upto", F.col("start") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .groupBy("pattern", "part")
        .agg(F.min(F.when(F.col("upto") + F.col("words") / 2 > F.col("_rest"), F.col("at"))).alias("_cut"))
        .select("pattern", F.coalesce("_cut", (F.col("part") + 1) * F.lit(span)).alias("_cut"))
    )
    return materialize(
        wanted.join(F.broadcast(cuts), "pattern", "left").select(
            "pattern", "_passes", F.coalesce("_cut", F.lit(0).cast("long")).alias("_cut")
        ),
        "mix-cuts",
    )


def times_taken(
    docs: DataFrame, pattern: Column, place: str, cuts: DataFrame, name: str
) -> DataFrame:
    """``docs`` with the number of times each is taken, from its ``place``. No document moves:
    ``cuts`` has one row per pattern."""
    key, passes, cut = (free_name(docs, n) for n in ("_pattern_key", "_pattern_passes", "_pattern_cut"))
    side = cuts.select(
        F.col("pattern").alias(key), F.col("_passes").alias(passes), F.col("_cut").alias(cut)
    )
    joined = docs.join(F.broadcast(side), pattern == F.col(key), "left")
    once_more = F.when(F.col(place) < F.col(cut), 1).otherwise(0)
    return joined.withColumn(
        name, F.coalesce(F.col(passes) + once_more, F.lit(0)).cast("int")
    ).drop(key, passes, cut)


def plan_mix(
    spark: SparkSession,
    patterns: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    passes: int = MAX_PASSES,
) -> tuple[DataFrame, DataFrame]:
    """Targets of the sources and wanted words of the patterns.

    ``patterns``: ``pattern`` (array of source names, null names allowed), ``words``: one row
    for each distinct set of sources, however many documents there are. The driver holds
    these rows only. A document of several sources counts once for each of them in their
    sizes. Returns (``source``, ``source_size``, ``target``) and (``pattern``, ``_words``,
    ``_capacity``).
    """
    rows = [(tuple(r["pattern"]), int(r["words"])) for r in patterns.select("pattern", "words").toLocalIterator()]
    sizes: dict = {}
    for pattern, words in rows:
        for source in set(pattern):
            sizes[source] = sizes.get(source, 0) + words
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = capped_targets(sizes, weight, sum(words for _, words in rows), passes)
    capacity: dict = {}
    for pattern, words in rows:
        capacity[pattern] = capacity.get(pattern, 0) + words
    flow = min_cost_flow(capacity, target, passes)
    # Arrow tables reach Spark as they are; lists of rows would go through Python workers, of
    # which each executor would start a second set for them
    targets = pa.table(
        {
            "source": pa.array(names, pa.string()),
            "source_size": pa.array([sizes[s] for s in names], pa.int64()),
            "target": pa.array([float(target[s]) for s in names], pa.float64()),
        }
    )
    words = [float(sum(flow.get(p, {}).values(), Fraction(0))) for p in capacity]
    wanted = pa.table(
        {
            "pattern": pa.array([list(p) for p in capacity], pa.list_(pa.string())),
            "_words": pa.array(words, pa.float64()),
            "_capacity": pa.array(list(capacity.values()), pa.int64()),
        }
    )
    return spark.createDataFrame(targets), spark.createDataFrame(wanted)


def plan_documents(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Sequence[int] = WEIGHTS,
    seed: int = 0,
    passes: int = MAX_PASSES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole plan of a mix: (sizes by document, targets by source, cuts by pattern)."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        pattern_of(docs, source_col).alias("pattern"),
        F.col(text_col).cast("string").alias("text"),
    )
    placed = with_place(narrow, "doc_id", "text", F.col("pattern"), "at", seed)
    sized = materialize(
        placed.select("doc_id", "pattern", word_count(F.col("text")).alias("size"), "at"), "mix-sizes"
    )
    patterns = sized.groupBy("pattern").agg(F.sum("size").alias("words"))
    targets, wanted = plan_mix(docs.sparkSession, patterns, weights, passes)
    return sized, targets, cut_points(sized, wanted)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    seed: int = 0,
    passes: int = MAX_PASSES,
) -> DataFrame:
    """Per document (``doc_id``, ``text``, ``source``): the words that the mix takes of it.

    Returns doc_id, size, source_size, target, taken. Null texts and texts without words have
    size 0 and taken 0. A null source is a source, last in order. Repeated rows are documents
    of their own, with places of their own, and so are rows of one id or none. Whole documents are
    taken, so a source's words miss its target by half a document. An empty table gives
    an empty result.
    """
    sized, targets, cuts = plan_documents(docs, weights=weights, seed=seed, passes=passes)
    by_pattern = targets.select(F.array("source").alias("_source"), "source_size", "target")
    taken = times_taken(sized, F.col("pattern"), "at", cuts, "times")
    return taken.join(F.broadcast(by_pattern), F.col("pattern") == F.col("_source")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Sequence[int] = WEIGHTS,
    seed: int = 0,
    passes: int = MAX_PASSES,
) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, none that is not.

    Rows are taken as `mix_sources` says, whatever their id; those without words have no size, so
    any number of them fits, and they go with their place like others. An empty table stays empty;
    other columns may have any names.
    """
    _, _, cuts = plan_documents(docs, source_col, id_col, text_col, weights, seed, passes)
    place = free_name(docs, "_place")
    placed = with_place(docs, id_col, text_col, pattern_of(docs, source_col), place, seed)
    times = free_name(placed, "_times")
    taken = times_taken(placed, pattern_of(docs, source_col), place, cuts, times)
    copy = free_name(taken, "_copy")
    return taken.withColumn(
        copy, F.explode(F.array_repeat(F.lit(1), F.col(times)))
    ).select(*docs.columns)

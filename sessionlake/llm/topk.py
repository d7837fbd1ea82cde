"""Exact top-k by inner product: pivots, sorted annuli, triangle-inequality bounds."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import importable
from sessionlake.session import materialize

# The pivots are fitted on this many vectors at most; every vector is indexed.
PIVOT_SAMPLE = 4_000
PIVOTS = 32
RINGS = 16

# Vectors of a block and queries that meet it in one task, at most.
BLOCK = 4_096

# Annuli that a query visits in a round, nearest first; after these rounds, all that remain.
ROUNDS = (1, 4, 16)

# Inner products are 64-bit integers; squared norms below this keep them so.
_MOST = 2.0**62

# Relative slack of a bound, far above the rounding of double sums.
_SLACK = 1e-7


@dataclass
class Pivots:
    """Pivots in the space with one more coordinate, in which inner products are distances.

    With ``reach2`` the largest squared norm, a vector x becomes ``(x, sqrt(reach2 - |x|^2))``
    and a query q ``(q, 0)``: ``|q' - x'|^2 = |q|^2 + reach2 - 2 q.x``, so the highest inner
    product is the smallest distance, for which the triangle inequality holds.
    """

    centres: np.ndarray
    reach2: float

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norms = (x * x).sum(axis=1)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.reach2 - norms, 0.0))
        return np.hstack([x, extra[:, None]])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        own = (lifted * lifted).sum(axis=1)[:, None] + (self.centres * self.centres).sum(axis=1)
        return np.sqrt(np.maximum(own - 2 * lifted @ self.centres.T, 0.0))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id`` and ``v``, the components as ``floor(scale * x)``.

    Vectors that are null, empty, or have a null or non-finite component are left out, and so are
    rows without an id.
    """
    x = F.col("x")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")
        )
        .filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("double")).alias("v"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with 0, which leaves inner products as they are."""
    rows = [np.asarray(v, dtype=np.float64) for v in column.to_pylist()]
    if all(len(r) == width for r in rows):
        return np.vstack(rows) if rows else np.zeros((0, width))
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def fit_pivots(vectors: DataFrame, width: int, reach2: float, pivots: int, sample: int) -> Pivots:
    """Centres of a few Lloyd steps on a seeded sample of at most ``sample`` vectors."""
    rows = (
        vectors.orderBy(F.xxhash64(F.lit(3), "vec_id"), "vec_id").limit(sample).select("v").toArrow()
    )
    space = Pivots(np.zeros((0, width + 1)), reach2)
    points = space.lift(_matrix(rows["v"].combine_chunks(), width), query=False)
    points = np.unique(points, axis=0)
    centres = [points[0]]
    nearest = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(pivots, len(points)):  # farthest first: spread, and no chance
        centres.append(points[int(np.argmax(nearest))])
        nearest = np.minimum(nearest, ((points - centres[-1]) ** 2).sum(axis=1))
    space.centres = np.array(centres)
    for _ in range(8):
        home = np.argmin(space.distances(points), axis=1)
        space.centres = np.array(
            [points[home == k].mean(axis=0) if (home == k).any() else c for k, c in enumerate(space.centres)]
        )
    return space


def build_index(vectors: DataFrame, space: Pivots, width: int, rings: int, block: int) -> DataFrame:
    """Every vector with its nearest pivot, its distance and its block.

    A pivot's vectors lie in ``rings`` annuli of equal width; an annulus of more than about
    ``block`` vectors is dealt to several blocks by a hash of id and vector position, so that
    equal vectors don't meet in one task.
    """
    importable(vectors.sparkSession)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            d = space.distances(space.lift(x, query=False))
            home = np.argmin(d, axis=1)
            yield pa.record_batch(
                [
                    batch.column("vec_id"),
                    pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary()),
                    pa.array(home, pa.int32()),
                    pa.array(d[np.arange(len(d)), home], pa.float64()),
                ],
                ["vec_id", "v", "pivot", "dist"],
            )

    placed = materialize(
        vectors.mapInArrow(place, "vec_id long, v binary, pivot int, dist double"), "topk-placed"
    )
    span = placed.groupBy("pivot").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    width_ = F.greatest((F.col("hi") - F.col("lo")) / rings, F.lit(1e-12))
    ringed = placed.join(F.broadcast(span), "pivot").withColumn(  # a row per pivot
        "ring", F.least(F.floor((F.col("dist") - F.col("lo")) / width_), F.lit(rings - 1)).cast("int")
    )
    sizes = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    return materialize(
        ringed.join(F.broadcast(sizes), ["pivot", "ring"])  # a row per annulus
        .withColumn("part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), "parts"))
        .select("pivot", "ring", "part", "parts", "vec_id", "v", "dist"),
        "topk-index",
    )


def _scored(space: Pivots, width: int, k: int):
    """Best ``k`` of a block for each of its queries."""

    def score(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        q = np.frombuffer(b"".join(queries["q"]), "<f8").reshape(-1, width)
        x = np.frombuffer(b"".join(rows["v"]), "<f8").reshape(-1, width)
        ids, own = rows["vec_id"].to_numpy(np.int64), queries["query_id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        ids, x = ids[order], x[order]
        exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < 2.0**53
        out = []
        for at in range(0, len(q), 256):
            block = q[at : at + 256]
            s = (block @ x.T).astype(np.int64) if exact else np.array(
                [[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in x] for u in block], dtype=np.int64
            )
            s = np.where(own[at : at + 256, None] == ids, np.iinfo(np.int64).min, s)
            take = min(k, s.shape[1])
            best = np.argsort(-s.astype(np.float64) if exact else -s, axis=1, kind="stable")[:, :take]
            value = np.take_along_axis(s, best, axis=1)
            keep = value != np.iinfo(np.int64).min
            out.append(
                pd.DataFrame(
                    {
                        "query_id": np.repeat(own[at : at + 256], take).reshape(best.shape)[keep],
                        "vec_id": ids[best][keep],
                        "score": value[keep],
                    }
                )
            )
        return pd.concat(out)

    return score


def top_k(
    vectors: DataFrame,
    queries,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    pivots: int = PIVOTS,
    rings: int = RINGS,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` highest integer inner products for every row whose id fulfils ``queries``.

    A query meets the annuli nearest to it first. From the ``k``-th score so far follows a
    radius; an annulus that can't reach into it, by the triangle inequality, is never
    visited. After a few rounds of growing reach all annuli that still can are visited, so the
    result is exact. Of each query there is a row for each annulus, whose number is fixed;
    only annuli that are visited are expanded to their blocks.

    Candidates are all rows with another id. Repeated rows are candidates each; a repeated
    query id is one query, with the first of its vectors. Rows without an id or without a usable
    vector take no part; an empty table gives an empty result. Vectors whose inner products could
    pass 64-bit integers raise a ValueError.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    importable(spark)
    whole = materialize(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    shape = whole.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("reach2"),
    ).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if shape["width"] is None:
        return spark.createDataFrame([], schema)
    width = shape["width"]
    if shape["reach2"] >= _MOST:
        raise ValueError(f"inner products may pass 64 bits: the largest squared norm is {shape['reach2']:g}")
    space = fit_pivots(whole, width, shape["reach2"], pivots, PIVOT_SAMPLE)
    index = build_index(whole, space, width, rings, block)
    annuli = materialize(
        index.groupBy("pivot", "ring").agg(
            F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max("parts").alias("parts")
        ),
        "topk-annuli",
    )

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            lifted = space.lift(x, query=True)
            yield pa.record_batch(
                [
                    batch.column("query_id"),
                    pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary()),
                    pa.array((x * x).sum(axis=1) + space.reach2, pa.float64()),
                    pa.array(space.distances(lifted).tolist(), pa.list_(pa.float64())),
                ],
                ["query_id", "q", "base2", "to_pivots"],
            )

    asked = materialize(
        whole.filter(queries)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("v").alias("v"))
        .mapInArrow(measure, "query_id long, q binary, base2 double, to_pivots array<double>"),
        "topk-queries",
    )
    # A query's distance to a pivot bounds its distance to each of the pivot's annuli from
    # below; the number of pivots is fixed.
    away = F.greatest(F.col("d") - F.col("hi"), F.col("lo") - F.col("d"), F.lit(0.0))
    routes = materialize(
        asked.select("query_id", "base2", F.posexplode("to_pivots").alias("pivot", "d"))
        .join(F.broadcast(annuli), "pivot")  # a row per annulus
        .select("query_id", "base2", "pivot", "ring", "parts", away.alias("away"))
        .withColumn(
            "turn",
            F.row_number().over(Window.partitionBy("query_id").orderBy("away", "pivot", "ring")),
        ),
        "topk-routes",
    )
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    done = 0
    for reach in (*ROUNDS, None):
        bound = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
        radius = F.sqrt(F.greatest(F.col("base2") - 2 * F.col("kth"), F.lit(0.0)))
        open_ = (
            routes.filter(F.col("turn") > done)
            .join(bound, "query_id", "left")
            .filter(
                F.col("kth").isNull()
                | (F.col("n") < k)
                | (F.col("away") <= radius + _SLACK * F.sqrt("base2") + 1e-9)
            )
        )
        if reach is not None:
            open_ = open_.filter(F.col("turn") <= done + reach)
        # many queries of one block are dealt to several tasks, each with a copy of the block
        at = ["pivot", "ring", "part"]
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
        open_ = materialize(open_.select("query_id", "pivot", "ring", parts), "topk-open")
        chunks = open_.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / block).alias("chunks"))
        chunk = F.pmod(F.xxhash64("query_id"), F.col("chunks")).alias("chunk")
        visits = open_.join(chunks, at).select("query_id", *at, chunk)
        wanted = chunks.select(*at, F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
        key = [*at, "chunk"]
        scored = (
            visits.join(asked.select("query_id", "q"), "query_id")
            .groupBy(*key)
            .cogroup(index.join(wanted, at).groupBy(*key))
            .applyInPandas(_scored(space, width, k), "query_id long, vec_id long, score long")
        )
        found = materialize(
            found.unionByName(scored)
            .withColumn("rank", F.row_number().over(best_first))
            .filter(F.col("rank") <= k)
            .select("query_id", "vec_id", "score"),
            "topk-found",
        )
        done += reach or 0
    return found.select(
        "query_id", F.row_number().over(best_first).alias("rank"), "vec_id", "score"
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

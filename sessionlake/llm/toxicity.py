"""Toxicity: linear classifiers from toxic examples and unlabelled text (nnPU learning)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import (
    Remembered,
    drop_tables_of_others,
    free_name,
    held_out,
    id_and_text,
    importable,
    small_slices,
)
from sessionlake.session import materialize

# Bounds of the sample that classifiers are fitted on: confirmed toxic documents, and documents
# taken without regard to labels, the latter for each classifier.
POSITIVE_SAMPLE = 2_500
UNLABELLED_SAMPLE = 3_000
CLASSIFIERS = 4

THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_BUCKETS = 1 << 22
_PREFIXES = (3, 4, 5, 6)
_REMEMBERED = 200_000


def _features_of(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself, and its beginnings as stems."""
    names = [f"w{word}"] + [f"{n}{word[:n]}" for n in _PREFIXES if len(word) >= n]
    return tuple(zlib.crc32(n.encode("utf-8")) & (_BUCKETS - 1) for n in names)


class Featurizer:
    """The distinct features of a text; words met before are remembered."""

    def __init__(self):
        self._words = Remembered(_features_of, _REMEMBERED)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        found: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            found.update(self._words[word])
        return np.array(sorted(found), dtype=np.int32)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


@dataclass
class Model:
    """An ensemble of linear classifiers over the same hashed features."""

    features: np.ndarray  # sorted
    weights: np.ndarray  # a row per feature, a column per classifier
    bias: np.ndarray

    def score(self, hits: list[int]) -> float:
        """Mean probability of toxicity, from the indices of the features that occur."""
        if not len(self.bias):
            return 0.0
        margin = self.bias + (self.weights[hits].sum(axis=0) if hits else 0.0)
        return float(np.mean(_sigmoid(margin)))


def select_features(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], most: int = 8192
) -> np.ndarray:
    """Features that are clearly commoner in toxic than in unlabelled documents.

    The share in positives must be twice that in the unlabelled, by four standard errors, and
    at least three positives must have it. The clearest ``most`` are used.
    """
    counts = np.zeros((2, _BUCKETS), dtype=np.int32)
    for n, docs in zip(counts, (positive, unlabelled), strict=True):
        for ids in docs:
            n[ids] += 1  # a document has a feature once
    p_ids = np.flatnonzero(counts[0] >= 3).astype(np.int32)
    share_p = counts[0][p_ids] / max(len(positive), 1)
    share_u = (counts[1][p_ids] + 0.5) / (len(unlabelled) + 1)
    error = np.sqrt(share_u * (1 - np.minimum(share_u, 0.999)) * (1 / max(len(positive), 1) + 1 / (len(unlabelled) + 1)))
    z = (share_p - share_u) / error
    good = (z >= 4) & (share_p >= 2 * share_u)
    ids, z = p_ids[good], z[good]
    return np.sort(ids[np.argsort(-z, kind="stable")[:most]])


def _incidence(docs: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every selected feature in every document."""
    rows, columns = [], []
    for i, ids in enumerate(docs):
        at = np.searchsorted(features, ids)
        ok = at < len(features)
        ok[ok] = features[at[ok]] == ids[ok]
        columns.append(at[ok])
        rows.append(np.full(int(ok.sum()), i))
    return np.concatenate([*rows, np.zeros(0, int)]), np.concatenate([*columns, np.zeros(0, int)])


def risk(
    theta: np.ndarray, x: list[tuple[np.ndarray, np.ndarray]], n: list[int], prior: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """The negatives' part of the risk (see `fit_nnpu`) at weights and bias ``theta``, and the
    gradients of the positives' part and of it. ``x``: features of the positive and of the
    unlabelled documents, as rows and columns; ``n``: numbers of documents."""

    def margins(k: int) -> np.ndarray:
        rows, columns = x[k]
        return np.bincount(rows, theta[columns], minlength=n[k]) + theta[-1]

    def gradient(k: int, slope: np.ndarray) -> np.ndarray:
        rows, columns = x[k]
        out = np.bincount(columns, slope[rows], minlength=len(theta))[: len(theta)]
        out[-1] = slope.sum()
        return out / n[k]

    sp, su = _sigmoid(margins(0)), _sigmoid(margins(1))
    negative = su.mean() - prior * sp.mean()
    of_negative = gradient(1, su * (1 - su)) - prior * gradient(0, sp * (1 - sp))
    return negative, prior * gradient(0, sp - 1), of_negative


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    features: np.ndarray,
    steps: int = 800,
    rate: float = 0.2,
    decay: float = 1e-6,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk.

    With class prior ``prior``, the risk is ``prior * E_p[k(+)] + max(0, E_u[l(-)] -
    prior * E_p[l(-)])``: the unlabelled text stands for the negatives once the toxic share
    is taken off. Where that difference falls below 0, the step follows its opposite, so that
    the classifier doesn't profit from fitting the sample's positives as negatives. ``k`` is the
    logistic loss, so that no positive is given up; ``l`` is the sigmoid loss, which is bounded,
    so that the sample's own share of toxic documents needn't hit the prior exactly.
    """
    x = [_incidence(positive, features), _incidence(unlabelled, features)]
    n = [max(len(positive), 1), max(len(unlabelled), 1)]
    theta = np.zeros(len(features) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    for step in range(1, steps + 1):
        negative, of_positive, of_negative = risk(theta, x, n, prior)
        grad = of_positive + of_negative if negative >= 0 else -of_negative
        grad[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _merge(parts: list[tuple[np.ndarray, np.ndarray, float]]) -> Model:
    features = np.unique(np.concatenate([p[0] for p in parts])) if parts else np.zeros(0, np.int32)
    weights = np.zeros((len(features), len(parts)))
    for k, (ids, w, _) in enumerate(parts):
        weights[np.searchsorted(features, ids), k] = w
    return Model(features, weights, np.array([p[2] for p in parts]))


def _order(salt: int, *columns: str):
    return F.xxhash64(F.lit(salt), *columns)


def _cutoff(places: DataFrame, rows: int) -> int | None:
    """The ``rows``-th different number of column ``at``, or the last one."""
    return places.select("at").distinct().orderBy("at").limit(rows).agg(F.max("at")).first()[0]


def _draw(docs: DataFrame, toxic: DataFrame, n_positive: int, n_unlabelled: int) -> DataFrame:
    """``at``, ``text``, ``positive``, ``drawn``: at most ``n_positive`` rows with an id in ``toxic``
    and ``n_unlabelled`` drawn from all.

    Rows are drawn by id and text, and rows equal in both are one; so a repeated id doesn't fill the
    sample, nor does a repeated row.
    """
    placed = toxic.withColumn("at", _order(0, "doc_id"))
    # at most `n_positive` ids: a broadcast of a fixed bound
    few = placed.filter(F.col("at") <= _cutoff(placed, n_positive)).select("doc_id")
    few = F.broadcast(few.withColumn("positive", F.lit(True)))
    texts = id_and_text(docs).withColumn("at", _order(1, "doc_id", "text")).join(few, "doc_id", "left")
    places = materialize(texts.select("at", "positive"), "toxicity-places")
    last_positive = _cutoff(places.filter("positive"), n_positive)
    last_drawn = _cutoff(places, n_unlabelled)
    positive = F.coalesce(F.col("positive") & (F.col("at") <= F.lit(last_positive)), F.lit(False))
    return (
        texts.withColumn("positive", positive)
        .withColumn("drawn", F.col("at") <= F.lit(last_drawn))
        .filter("positive or drawn")
        .groupBy("at")
        .agg(
            F.bool_or("positive").alias("positive"),
            F.bool_or("drawn").alias("drawn"),
            F.min("text").alias("text"),
        )
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    positive_sample: int = POSITIVE_SAMPLE,
    unlabelled_sample: int = UNLABELLED_SAMPLE,
    classifiers: int = CLASSIFIERS,
) -> Model:
    """Fit ``classifiers`` linear models, one per task, on bounded seeded samples.

    ``docs``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``toxic`` (1: confirmed toxic),
    both without the held-out rows. ``prior``: share of toxic documents; by default their
    share among the labelled ones. Every model has the same positives and its own unlabelled
    documents, which are drawn from all ``docs`` and so contain hidden positives. Samples are of
    different rows: those equal in id and text count once, and rows without an id are drawn like
    others, but never confirmed. Without a toxic example the model scores everything 0.
    """
    importable(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return _merge([])
    if prior is None:
        prior = counts["toxic"] / counts["n"]
    prior = float(min(max(prior, 1e-4), 0.9))
    toxic = known.filter("toxic = 1").select("doc_id")
    sample = _draw(docs, toxic, positive_sample, unlabelled_sample * classifiers)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("toxicity")
        of = Featurizer()
        for rows in small_slices(batches):
            ids = [of(t).tobytes() for t in rows.column("text").to_pylist()]
            yield pa.record_batch(
                [rows.column("positive"), rows.column("drawn"), rows.column("member"), pa.array(ids, pa.binary())],
                ["positive", "drawn", "member", "features"],
            )

    def fit(rows: pa.Table) -> pa.Table:
        drop_tables_of_others("toxicity")
        arrays = [np.frombuffer(b, np.int32) for b in rows.column("features").to_pylist()]
        positive = [a for a, p in zip(arrays, rows.column("positive").to_pylist(), strict=True) if p]
        unlabelled = [a for a, d in zip(arrays, rows.column("drawn").to_pylist(), strict=True) if d]
        ids = select_features(positive, unlabelled)
        weights, bias = fit_nnpu(positive, unlabelled, prior, ids)
        return pa.table(
            {
                "ids": pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
                "weights": pa.array([weights.tobytes()], pa.binary()),
                "bias": pa.array([bias], pa.float64()),
            }
        )

    member = F.pmod(F.xxhash64(F.lit(2), "at"), F.lit(classifiers)).cast("int")
    schema = "positive boolean, drawn boolean, member int, features binary"
    prepared = (
        sample.select(
            F.coalesce("positive", F.lit(False)).alias("positive"),
            F.coalesce("drawn", F.lit(False)).alias("drawn"),
            member.alias("member"),
            "text",
        )
        .mapInArrow(features, schema)
        .select(
            "positive",
            "features",
            F.explode(
                F.when(F.col("positive"), F.array(*map(F.lit, range(classifiers)))).otherwise(F.array("member"))
            ).alias("model"),
            (F.col("drawn")).alias("was_drawn"),
            "member",
        )
        .withColumn("drawn", F.col("was_drawn") & (F.col("member") == F.col("model")))
    )
    # all groups together hold the unlabelled sample once, and each the positive one
    fitted = (
        prepared.select("model", "positive", "drawn", "features")
        .groupBy("model")
        .applyInArrow(fit, "ids binary, weights binary, bias double")
        .collect()
    )
    parts = [
        (np.frombuffer(r["ids"], np.int32), np.frombuffer(r["weights"]), r["bias"]) for r in fitted
    ]
    return _merge(sorted(parts, key=lambda p: (p[2], p[0].tobytes())))


class Scorer:
    """Scores texts with a model; remembers for each word which of the model's features it has."""

    def __init__(self, model: Model):
        self._model = model
        index = {int(f): i for i, f in enumerate(model.features)}
        self._words = Remembered(
            lambda word: tuple(index[f] for f in _features_of(word) if f in index), _REMEMBERED
        )

    def __call__(self, text: str | None) -> float:
        hits: set[int] = set()
        if text:
            hits.update(*filter(None, map(self._words.__getitem__, set(_WORD.findall(text.lower())))))
        return self._model.score(sorted(hits))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` for every row of ``docs``; null and empty texts get the score of
    no features. The model, of bounded size, is broadcast."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("toxicity")
        scorer = Scorer(shared.value)
        for rows in small_slices(batches):
            scores = [scorer(t) for t in rows.column("text").to_pylist()]
            yield pa.record_batch([rows.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(score, "doc_id long, score double")


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that labels may be learned from: those that aren't held out."""
    return docs.filter(~held_out("doc_id", 3, 1))


def score_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: learn from the rows that aren't held out, score all rows."""
    model = train(learnable(docs), learnable(labels))
    return score_documents(docs, model).select(
        "doc_id",
        held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more.

    Columns stay as they are, whatever their names; rows are scored where they lie. Null and
    empty texts get the score of no features, which a model of any use keeps; an empty table
    stays empty, and repeated rows share their fate.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs, "_toxicity")

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("toxicity")
        scorer = Scorer(shared.value)
        for rows in small_slices(batches, name):
            texts = rows.column(name).to_pylist()
            keep = pa.array([scorer(t) < threshold for t in texts], pa.bool_())
            yield rows.filter(keep).drop_columns([name])

    with_text = docs.withColumn(name, F.col(text_col).cast("string"))
    return with_text.mapInArrow(clean, docs.schema)

"""Periodic runs of words: suffix trees, common extensions and Lyndon roots.

A run is a maximal stretch of words with a smallest period. Every run of exponent 2 or more has
a Lyndon root, for the order of words or for the reversed one, that is the longest Lyndon word
at its place; it ends where the next smaller (next larger) suffix starts. So each place names two
candidates, which are extended in both directions by the longest common extensions of two
places: two lowest common ancestors, one in the suffix tree of the words and one in that of their
reversal. Trees are built by Ukkonen's algorithm; ancestors come in constant time from range
minima over the Euler tour.

Runs that repeat their root four times and more are rare, so trees grow only where one can be: a
word of a run with period q has an equal word within q, and the run has at least ``exponent``
times q words. A word whose nearest equal one is too far away for the stretch it is in belongs to
no run of it and cuts it in two, until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import WORD, id_and_text, importable, small_slices
from sessionlake.llm.words import join_words, numbered, split_words

MIN_LENGTH = 6
EXPONENT = 4


class SuffixTree:
    """The suffix tree of a sequence of numbers from 1 on.

    ``rank`` orders the suffixes; ``common`` gives the longest common prefix of two of them.
    """

    def __init__(self, sequence: list[int]):
        self._length = len(sequence) + 1
        children, starts, ends, base = _ukkonen([*sequence, 0])
        self._tour(children, starts, ends, base)

    def _tour(self, children: dict[int, int], starts: list[int], ends: list[int], base: int) -> None:
        """Walk the tree depth first, children in order, and keep of the Euler tour the leaves
        and the shallowest depth between neighbouring leaves: that of their common ancestor."""
        keys = np.fromiter(children.keys(), np.int64, len(children))
        nodes = np.fromiter(children.values(), np.int64, len(children))
        order = np.argsort(keys)
        parents = keys[order] // base
        nodes = nodes[order].tolist()
        first = np.searchsorted(parents, np.arange(len(starts) + 1)).tolist()
        total, suffixes, between = self._length, [], []
        stack = [(0, 0, 0)]
        while stack:
            node, depth, since = stack.pop()
            low, high = first[node], first[node + 1]
            if low == high:
                suffixes.append(total - depth)
                between.append(since)
                continue
            for at in range(high - 1, low - 1, -1):
                child = nodes[at]
                stack.append((child, depth + ends[child] - starts[child], since if at == low else depth))
        self.rank = np.empty(total, np.int64)
        self.rank[suffixes] = np.arange(total)
        minima = [np.array(between, np.int32)]
        width = 1
        while 2 * width <= total:
            last = minima[-1]
            minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        self._minima = minima

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at ``a`` and at ``b`` (not equal)."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self._minima[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _ukkonen(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Children by ``node * base + first symbol``, and the start and end of each node's edge.

    ``s`` ends in a 0 that is nowhere else, so that every suffix ends in a leaf. Node 0 is
    the root. Suffix links make the time linear.
    """
    total, base = len(s), max(s) + 1
    starts, ends, links = [0], [0], [0]
    children: dict[int, int] = {}
    node = edge = along = pending = 0
    for i, symbol in enumerate(s):
        pending += 1
        unlinked = 0
        while pending:
            if not along:
                edge = i
            key = node * base + s[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(starts)
                starts.append(i)
                ends.append(total)
                links.append(0)
                if unlinked:
                    links[unlinked] = node
                    unlinked = 0
            else:
                begin, end = starts[child], ends[child]
                size = (end if end <= i else i + 1) - begin
                if along >= size:
                    edge += size
                    along -= size
                    node = child
                    continue
                if s[begin + along] == symbol:
                    along += 1
                    if unlinked:
                        links[unlinked] = node
                    break
                split = len(starts)
                starts += (begin, i)
                ends += (begin + along, total)
                links += (0, 0)
                children[key] = split
                children[split * base + symbol] = split + 1
                starts[child] = begin + along
                children[split * base + s[begin + along]] = child
                if unlinked:
                    links[unlinked] = split
                unlinked = split
            pending -= 1
            if node:
                node = links[node]
            elif along:
                along -= 1
                edge = i - pending + 1
    return children, starts, ends, base


def _next_below(ranks: list[int]) -> np.ndarray:
    """For each place the next one of lower rank; the length if there is none."""
    out = [len(ranks)] * len(ranks)
    waiting: list[int] = []
    for at, rank in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > rank:
            out[waiting.pop()] = at
        waiting.append(at)
    return np.array(out, np.int64)


def runs_of(
    sequence: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT
) -> np.ndarray:
    """Start, length and smallest period of all runs of at least ``min_length`` and ``exponent``
    periods (2 or more), in rows ordered by start, then period."""
    n = len(sequence)
    symbols = (np.unique(sequence, return_inverse=True)[1] + 1).astype(np.int64)
    ahead = SuffixTree(symbols.tolist())
    ranks = ahead.rank[:n]
    here = np.concatenate([np.arange(n)] * 2)
    there = np.concatenate([_next_below(ranks.tolist()), _next_below((-ranks).tolist())])
    period = there - here
    possible = (there < n) & (period * exponent <= n)
    here, there, period = here[possible], there[possible], period[possible]
    if not len(here):
        return np.empty((0, 3), np.int64)
    behind = SuffixTree(symbols[::-1].tolist())
    forward = ahead.common(here, there)
    backward = np.zeros(len(here), np.int64)
    inner = here > 0
    # the place before i is place n - i of the reversal
    backward[inner] = behind.common(n - here[inner], n - there[inner])
    length = period + forward + backward
    enough = length >= np.maximum(min_length, exponent * period)
    found = np.stack([here - backward, period, length], axis=1)[enough]
    return np.unique(found, axis=0)[:, [0, 2, 1]]


def _stretches(
    words: np.ndarray, bounds: np.ndarray, min_length: int, exponent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches outside of which no run can be; texts lie between
    ``bounds``."""
    at = np.arange(len(words))
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    spellings = int(words.max()) + 1 if len(words) else 1
    while True:
        size = np.bincount(group)[group] if len(group) else group
        key = group * spellings + words[at]
        order = np.argsort(key, kind="stable")
        gap = np.diff(at[order])
        gap[np.diff(key[order]) != 0] = len(words) + 1
        gap = np.concatenate([[len(words) + 1], gap, [len(words) + 1]])
        nearest = np.empty(len(at), np.int64)
        nearest[order] = np.minimum(gap[:-1], gap[1:])
        alive = (size >= min_length) & (nearest * exponent <= size)
        if alive.all():
            break
        at, group = at[alive], group[alive]
        group = np.cumsum(np.concatenate([[0], (np.diff(at) != 1) | (np.diff(group) != 0)])[: len(at)])
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0])[: len(at)])
    return at[cuts], (np.concatenate([at[cuts[1:] - 1], at[-1:]]) + 1 if len(at) else at)


def _batch_runs(
    words: np.ndarray, bounds: np.ndarray, min_length: int, exponent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts of a slice, by text, and the number of the text of each; starts
    count from the text's first word."""
    found, owner = [np.empty((0, 3), np.int64)], [np.empty(0, np.int64)]
    for start, end in zip(*_stretches(words, bounds, min_length, exponent), strict=True):
        runs = runs_of(words[start:end], min_length, exponent)
        if len(runs):
            text = int(np.searchsorted(bounds, start, side="right")) - 1
            runs[:, 0] += start - bounds[text]
            found.append(runs)
            owner.append(np.full(len(runs), text))
    return np.concatenate(found), np.concatenate(owner)


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    exponent: int = EXPONENT,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``runs`` and ``collapsed``.

    ``runs`` lists every run of words, as structs of start (word number from 0), length and
    smallest period, in order of start, then period: maximal stretches of at least ``min_length``
    words and ``exponent`` (2 or more) periods. ``collapsed`` is the text with only the first period
    of each run, its words joined by one space: a word goes if any run has it after its first period.

    Whole texts are searched where they lie; nothing is shuffled, and memory is bounded by the
    longest text. Null, empty and blank texts have no runs and collapse to an empty text. Every
    row gives a row: repeated rows and rows without an id too. Other columns are not looked at.
    """
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    importable(docs.sparkSession)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_slices(batches):
            bounds, words = split_words(rows.column("text"))
            numbers, _ = numbered(words)
            runs, owner = _batch_runs(numbers, bounds, min_length, exponent)
            first = bounds[owner] + runs[:, 0]
            covered = np.zeros(len(words) + 1, np.int64)
            np.add.at(covered, first + runs[:, 2], 1)
            np.add.at(covered, first + runs[:, 1], -1)
            stays = np.cumsum(covered)[:-1] == 0
            kept = np.concatenate([[0], np.cumsum(stays)])[bounds]
            of_text = np.searchsorted(owner, np.arange(len(bounds)))
            structs = pa.StructArray.from_arrays(
                [pa.array(runs[:, k]) for k in range(3)], ["start", "length", "period"]
            )
            yield pa.record_batch(
                [
                    rows.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), structs),
                    join_words(words.filter(pa.array(stays)), kept),
                ],
                ["doc_id", "runs", "collapsed"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        find,
        "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the documents, by the CRC of their id, end in a
    stretch that is repeated; the other texts stay as they are. Without id or words: unchanged."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = id_and_text(docs).select(
        "doc_id",
        "text",
        F.floor(code / 10).alias("g"),
        F.when(code % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"),
    )
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    period = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    rows = rows.withColumn("p", F.when(n > 0, period))
    tail = F.transform(
        F.sequence(F.col("a"), n.cast("long") - 1),
        lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    planted = F.array_join(F.concat(head, tail), " ")
    return rows.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of the runs and of what is left."""
    runs = F.col("runs")
    best = F.element_at(
        F.array_sort(
            F.transform(runs, lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"]))
        ),
        1,
    )
    lines = F.transform(
        runs,
        lambda r: F.concat(
            F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")
        ),
    )
    found = periodic_runs(with_planted_runs(docs)).withColumn(
        "best", F.when(F.size(runs) > 0, best)
    )
    length = -F.col("best.shorter")
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )

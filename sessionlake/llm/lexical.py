"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time.

Documents are indexed in blocks: for each term of a block its inverted list, and the ids and lengths
of its documents in order of id. A query meets every block, each on its own:

* The short lists of its terms are taken term at a time: their scores are summed up in
  accumulators, which become one sorted list with the greatest sum as its bound.
* That list and the long ones are taken document at a time, in ranges of documents: lists
  whose bounds together can't reach the k-th best score only are probed, by binary search, for
  documents that the other lists bring up and that still can reach it. The search ends when no list
  is left that can bring one up.

The best of all blocks are ranked by Spark, which keeps k rows of a query per task first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import importable, small_slices
from sessionlake.llm.words import numbered, split_words
from sessionlake.session import materialize

K = 10

# Text of a block of the index, unless a single document is longer.
BLOCK_BYTES = 16 << 20

# Lists of at most so many documents are summed up before the search.
SHORT = 128

# Documents of the first range; the next ones are twice as long each.
FIRST_RANGE = 256

# Entries of the queries that are searched at a time; they are sent to all tasks.
QUERY_ENTRIES = 500_000

# The letters and digits of ASCII and all other characters make terms; A-Z count as a-z.
_SEPARATOR = ord(" ")
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else _SEPARATOR
    for b in range(256)
)


def split_terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of all texts, as `split_words` gives words."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    plain = data[int(ends[0]) : int(ends[-1])].to_pybytes().translate(_TERM_BYTES) if data else b""
    shifted = pa.py_buffer((ends - ends[0]).astype(np.int32).tobytes())
    return split_words(pa.Array.from_buffers(pa.string(), len(texts), [None, shifted, pa.py_buffer(plain)]))


_INDEX = "block long, term string, places array<int>, counts array<int>, ids array<long>, lengths array<int>"


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Inverted lists of whole texts, by block, in one pass and without a shuffle.

    A row with a ``term`` holds its list in a block: ``places`` (numbers of documents in the
    block, ascending) and ``counts`` (occurrences). The row without a term has the block's
    documents by place: ``ids``, ascending with null last, and ``lengths`` in terms. Write the
    result before it is used: blocks are numbered by task.
    """
    importable(docs.sparkSession)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows in small_slices(batches, max_bytes=block_bytes):
            yield _block_rows(block, rows.column("doc_id"), rows.column("text"))
            block += 1

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(build, _INDEX)


def _block_rows(block: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    in_order = pc.array_sort_indices(ids)
    ids, texts = ids.take(in_order), texts.take(in_order)
    bounds, words = split_terms(texts)
    terms, spellings = numbered(words)
    lengths = np.diff(bounds)
    pairs = terms * len(ids) + np.repeat(np.arange(len(ids)), lengths)
    pairs, counts = np.unique(pairs, return_counts=True)
    term, place = pairs // len(ids), pairs % len(ids)
    starts = np.searchsorted(term, np.arange(len(spellings) + 1))
    starts = np.append(starts, starts[-1])  # the row of documents has no list

    def lists(values, kind):
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))

    def last_only(values):
        ends = np.zeros(len(spellings) + 2, np.int32)
        ends[-1] = len(values)
        return pa.ListArray.from_arrays(pa.array(ends), values)

    return pa.record_batch(
        [
            pa.array(np.full(len(spellings) + 1, block)),
            pa.concat_arrays([spellings.cast(pa.string()), pa.nulls(1, pa.string())]),
            lists(place, pa.int32()),
            lists(counts, pa.int32()),
            last_only(ids),
            last_only(pa.array(lengths, pa.int32())),
        ],
        ["block", "term", "places", "counts", "ids", "lengths"],
    )


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Terms of each query: ``query`` (a number of the row), ``item_id``, ``term``, ``times``."""
    importable(items.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_slices(batches):
            bounds, words = split_terms(rows.column("text"))
            terms, spellings = numbered(words)
            base = max(len(spellings), 1)
            of_row = np.repeat(np.arange(rows.num_rows), np.diff(bounds))
            pairs, times = np.unique(of_row * base + terms, return_counts=True)
            at = pa.array(pairs // base)
            yield pa.record_batch(
                [
                    rows.column("query").take(at),
                    rows.column("item_id").take(at),
                    spellings.cast(pa.string()).take(pa.array(pairs % base)),
                    pa.array(times, pa.int64()),
                ],
                ["query", "item_id", "term", "times"],
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("query"),
        F.col(id_col).cast("long").alias("item_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(count, "query long, item_id long, term string, times long")


class Block:
    """One block of the index, with the score of each posting before it is weighted."""

    def __init__(self, table: pa.Table, n_docs: int, n_terms: int):
        table = table.combine_chunks()
        terms = table.column("term").to_pylist()
        row = terms.index(None)
        self.ids = table.column("ids")[row].values.to_pylist()
        lengths = table.column("lengths")[row].values.to_numpy().astype(np.int64)
        weight = 75 * n_docs
        if len(lengths) and weight * int(lengths.max()) >= 1 << 63:
            lengths = lengths.astype(object)  # beyond 64 bits: Python's integers
        norm = (25 + weight * lengths // max(n_terms, 1)).astype(np.int64)
        places, counts = (
            pc.list_flatten(table.column(c)).to_numpy().astype(np.int64) for c in ("places", "counts")
        )
        ends = np.cumsum([0] + pc.list_value_length(table.column("places")).to_pylist())
        impact = 1_000_000_000 * counts // (1000 * counts + 8 * norm[places])
        self.lists = {
            term: (places[a:b], impact[a:b])
            for term, a, b in zip(terms, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            if b > a
        }

    def search(self, query: list[tuple[str, int]], k: int, short: int = SHORT) -> list[tuple[int, int]]:
        """Places and scores of the ``k`` best documents, best first, ties by place."""
        lists = []
        for term, weight in query:
            found = self.lists.get(term)
            if found and weight > 0:
                lists.append((found[0], found[1] * weight))
        small = [x for x in lists if len(x[0]) <= short]
        lists = [x for x in lists if len(x[0]) > short]
        if small:
            places, at = np.unique(np.concatenate([x[0] for x in small]), return_inverse=True)
            sums = np.zeros(len(places), np.int64)
            np.add.at(sums, at, np.concatenate([x[1] for x in small]))
            lists.append((places, sums))
        return _best(lists, len(self.ids), k)


def _best(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> list[tuple[int, int]]:
    """Document at a time over sorted lists with bounds; places come in ranges."""
    lists.sort(key=lambda x: int(x[1].max()))
    # what the first i lists can add up to
    reach = np.concatenate([[0], np.cumsum([int(x[1].max()) for x in lists])]).tolist()
    best_places, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    least, asked, start, size = 1, 0, 0, FIRST_RANGE
    while start < n_docs:
        # a document that only the first lists hold can't reach the least score asked for
        while asked < len(lists) and reach[asked + 1] < least:
            asked += 1
        if asked == len(lists):
            break
        stop = start + size
        places, scores = [], []
        for at, score in lists[asked:]:
            a, b = np.searchsorted(at, (start, stop))
            places.append(at[a:b])
            scores.append(score[a:b])
        found, at = np.unique(np.concatenate(places), return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, at, np.concatenate(scores))
        for i in range(asked - 1, -1, -1):
            able = sums + reach[i + 1] >= least
            found, sums = found[able], sums[able]
            if not len(found):
                break
            at, score = lists[i]
            spot = np.minimum(np.searchsorted(at, found), len(at) - 1)
            sums = sums + np.where(at[spot] == found, score[spot], 0)
        able = sums >= least
        best_places = np.concatenate([best_places, found[able]])
        best_scores = np.concatenate([best_scores, sums[able]])
        top = np.lexsort((best_places, -best_scores))[:k]
        best_places, best_scores = best_places[top], best_scores[top]
        if len(top) == k:  # a later document must be better: its place is greater
            least = max(least, int(best_scores[-1]) + 1)
        start, size = stop, 2 * size
    return list(zip(best_places.tolist(), best_scores.tolist(), strict=True))


def _searcher(
    queries: list[tuple[int, list[tuple[str, int]]]], k: int, n_docs: int, n_terms: int
) -> Callable[[pa.Table], pa.Table]:
    def search(table: pa.Table) -> pa.Table:
        block = Block(table, n_docs, n_terms)
        hits = [
            (number, block.ids[place], score)
            for number, query in queries
            for place, score in block.search(query, k)
        ]
        columns = zip(*hits, strict=True) if hits else ([], [], [])
        return pa.table(dict(zip(("query", "doc_id", "score"), (pa.array(c, pa.int64()) for c in columns), strict=True)))

    return search


def _in_turn(packed: DataFrame, entries: int) -> Iterator[list]:
    """Queries in runs of about ``entries`` terms, one more query at most."""
    run, held = [], 0
    for row in packed.toLocalIterator():
        run.append((row["query"], [(t["term"], t["weight"]) for t in row["terms"]]))
        held += len(row["terms"])
        if held >= entries:
            yield run
            run, held = [], 0
    if run:
        yield run


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = K, query_entries: int = QUERY_ENTRIES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each row of ``items`` (``item_id``, ``text``) the ``k`` documents (``doc_id``,
    ``text``) that score best: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    Terms are stretches of ASCII letters and digits and of all other non-ASCII characters, A-Z
    as a-z. A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))); it counts as often as the
    query has it, with what its occurrences tell, saturated and normalised by the length of the
    document. Only scores above 0 are ranked; ties go to the smaller doc_id, null last. Rows
    are documents: repeated ones are ranked one after the other, those without an id too. Null
    texts have no terms, and queries without known terms no rows. Equal rows of ``items`` are
    queries of their own. Other columns are not looked at.

    The lists of terms that a query has are written once, then shuffled by block. Queries go to
    the tasks in runs of about ``query_entries`` terms, so what is sent has a fixed size.
    """
    asked = materialize(query_terms(items), "query-terms")
    # the row of documents has no term and is wanted too
    no_term = docs.sparkSession.createDataFrame([(None,)], "term string")
    # written, so that Spark knows its size: a small one is sent to the lists, which stay in place
    wanted = materialize(
        asked.select("term").unionByName(no_term).distinct().withColumnRenamed("term", "_term"),
        "wanted-terms",
    )
    index = build_index(docs, block_bytes=block_bytes)
    lists = materialize(
        index.join(wanted, F.col("term").eqNullSafe(F.col("_term")), "left_semi"), "inverted-lists"
    )
    n_docs, n_terms = lists.filter("term is null").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + F.signum(n).cast("long"))),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n)),
    ).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    rare = F.lit(2.0 * n_docs + 2) / (2 * F.sum(F.size("places")) + 1)
    weights = lists.filter("term is not null").groupBy("term").agg(
        F.floor(1000 * F.log(rare)).cast("long").alias("weight")
    )
    terms = F.struct("term", (F.col("weight") * F.col("times")).alias("weight"))
    packed = materialize(
        asked.join(weights, "term").groupBy("query").agg(F.sort_array(F.collect_list(terms)).alias("terms")),
        "queries",
    )
    hits = None
    for run in _in_turn(packed, query_entries):
        part = materialize(
            lists.groupBy("block").applyInArrow(
                _searcher(run, k, n_docs, n_terms), "query long, doc_id long, score long"
            ),
            "hits",
        )
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = asked.select("query", "item_id").distinct()
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, s GROUP BY term
), q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

"""Near-duplicate documents: a Jaccard join on word shingles by T-occurrence search.

Two documents link when their shingle sets A, B have ``100 |A n B| >= threshold |A u B|``.
A document of n shingles can only link with one that shares T = ceil(threshold n / 100) of them,
so the T - 1 longest inverted lists of its shingles can be skipped at first: whoever links with
it is in one of the n - T + 1 shortest ones. Those are merged; the long lists are only probed
for the documents that the merge brought up. The plan has four steps:

1. Count in how many documents each shingle is, which orders the lists by length. Blocks of
   documents send their shingles to be counted, and learn the counts of just these.
2. Keep of each document its shortest lists. A list with one document links nothing, so
   a document whose shortest lists are all its own is done.
3. Give each list to the family of its least edited document, its leader. Two documents that can
   link are in one family at least, and near copies share few families.
4. Compare each member of a family with its leader. Members that don't link with it are searched for
   in the family by blocks, with DivideSkip over the whole shingle sets.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.blocks import (
    bucket_keys,
    by_bucket,
    pack_bytes,
    pack_keys,
    pack_texts,
    unpack_bytes,
    unpack_keys,
    unpack_texts,
    with_replies,
)
from sessionlake.llm.common import (
    drop_tables_of_others,
    importable,
    keep_chosen,
    kept_by,
    key_filter,
    small_slices,
    with_held,
)
from sessionlake.llm.components import connected_components
from sessionlake.session import materialize

WORDS = 5
THRESHOLD = 80

# Documents of a block of a family; a task searches one pair of blocks at a time.
BLOCK = 256

# Members of a family that one task compares with its leader.
DEAL = 4_096

# Shingles below the middle of the hash range are counted and come first in the order; they are
# more than any document's share of short lists, unless most of it is common text.
_COUNTED = np.uint64(1) << np.uint64(63)
_LAST = 255

# Text of a block of documents, unless a single one is longer; counted shingles of a bucket, as
# expected from the size of the text.
BLOCK_BYTES = 1 << 20
BUCKET_SHINGLES = 1 << 19
_BYTES_PER_SHINGLE = 13
_MOST = 255


def required(n: int, m: int, threshold: int = THRESHOLD) -> int:
    """The smallest intersection with which sets of ``n`` and ``m`` shingles link."""
    return -(-threshold * (n + m) // (100 + threshold))


def least_shared(n: int, threshold: int = THRESHOLD) -> int:
    """The smallest intersection with which a set of ``n`` shingles links with any other."""
    return -(-threshold * n // 100)


# --- shingles ---------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_PLACE = _mix(np.arange(1001, 1033, dtype=np.uint64)) | np.uint64(1)


@kept_by("ngram_join")
@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    base = np.full(size, _BASE, dtype=np.uint64)
    inverse = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts that lie one after the other in ``data``.

    ``starts``: where each text begins, and the end. Returns the hashes and, for each text and
    the end, the number of its first word.
    """
    data = _FOLD[data]
    solid = ~_BLANK[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    before[inner] = False
    begin = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after[inner - 1] = False
    end = np.flatnonzero(solid & ~after) + 1
    base, inverse = _powers(1 << max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * base[: len(data)], out=sums[1:])
    words = _mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return words, np.searchsorted(begin, starts)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for null or blank texts."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, body = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(body, dtype=np.uint8)[starts[0] : starts[-1]] if body is not None else np.zeros(0, np.uint8)
    starts = starts - starts[0]
    if not len(data):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes, first = word_hashes(data, starts)
    runs = max(0, len(hashes) - words + 1)
    shingles = np.zeros(runs, dtype=np.uint64)
    for i in range(words):
        shingles += hashes[i : i + runs] * _PLACE[i]
    shingles = _mix(shingles)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(shingles[a : b - words + 1]))
        elif b > a:
            short = (hashes[a:b] * _PLACE[16 : 16 + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(_mix(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# --- step 1: lengths of the inverted lists ----------------------------------------------


_BLOCKS = (
    "block long, ids array<long>, text_keys array<long>, texts binary, ends binary,"
    " bucket long, n int, keys binary, counts binary"
)


def _counted(sets: list[np.ndarray], buckets: int) -> list[np.ndarray]:
    """The keys of each set's counted shingles, in the order of the set."""
    return [bucket_keys(ids[: np.searchsorted(ids, _COUNTED)] << np.uint64(1), buckets) for ids in sets]


def _blocks(docs: DataFrame, words: int, buckets: int, block_bytes: int) -> DataFrame:
    """Rows of two kinds: without a bucket a block of documents, whole; with a bucket the
    counted shingles of a block that are dealt to it, each once, and in how many of its documents
    each is (255 at most)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("ngram_join")
        block = TaskContext.get().partitionId() << 32
        for rows in small_slices(batches, max_bytes=block_bytes):
            texts = rows.column("text")
            keys = _counted(shingle_sets(texts, words), buckets)
            keys, counts = np.unique(np.concatenate(keys), return_counts=True)
            counts = np.minimum(counts, _MOST)
            found = [
                (b, s.stop - s.start, pack_keys(keys[s].astype(np.uint32)), pack_bytes(counts[s]))
                for b, s in by_bucket(keys)
            ]
            n = len(found)
            whole = pa.array([0] + [rows.num_rows] * (n + 1), pa.int32())
            data, ends = pack_texts(texts)
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.record_batch(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.ListArray.from_arrays(whole, rows.column("doc_id")),
                    pa.ListArray.from_arrays(whole, rows.column("text_key")),
                    pa.array([data] + [None] * n, pa.binary()),
                    pa.array([ends] + [None] * n, pa.binary()),
                    *[pa.array([None] + [f[k] for f in found], kind) for k, kind in enumerate(kinds)],
                ],
                ["block", "ids", "text_keys", "texts", "ends", "bucket", "n", "keys", "counts"],
            )
            block += 1

    return docs.mapInArrow(cut, _BLOCKS)


def _levels(table: pa.Table) -> pa.Table:
    """Of one bucket: the level of each shingle of each block, the base-2 logarithm of the number
    of documents that have it; 0 for one document."""
    sizes = table.column("n").to_pylist()
    columns = [zip(table.column(c), sizes, strict=True) for c in ("keys", "counts")]
    keys = np.concatenate([unpack_keys(k.as_py(), n) for k, n in columns[0]])
    counts = np.concatenate([unpack_bytes(c.as_py(), n) for c, n in columns[1]])
    distinct, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, counts, minlength=len(distinct))
    level = np.floor(np.log2(total)).astype(np.uint8)[at]
    ends = np.cumsum([0, *sizes]).tolist()
    packed = [pack_bytes(level[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "n": table.column("n"),
            "levels": pa.array(packed, pa.binary()),
        }
    )


# --- step 2: the shortest lists of each document ----------------------------------------

_SETS = "id long, text_key long, n int, own double, set_key binary, short array<long>, shingles binary"


def shortest_lists(ids: np.ndarray, level: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Those shingles of a set among which a linking set must have one, without the set's own.

    The order, by level and then by hash, is the same for all documents.
    """
    most = len(ids) - least_shared(len(ids), threshold) + 1
    order = np.argsort(level, kind="stable")[:most]  # ids are sorted, so ties go by hash
    return ids[order[level[order] > 0]]


def document_sets(
    docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): the size of its set; and, where it may link
    with another, its shortest lists, the whole set and the share of shingles that only it has.

    The number of buckets follows the size of the input, so that a bucket stays small.
    """
    importable(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // (_BYTES_PER_SHINGLE * BUCKET_SHINGLES)) + 1
    cut = materialize(_blocks(rows, words, buckets, block_bytes), "ngram-blocks")
    blocks = cut.filter("bucket IS NULL").select("block", "ids", "text_keys", "texts", "ends")
    keys = cut.filter("bucket IS NOT NULL").select("block", "bucket", "n", "keys", "counts")
    levels = keys.groupBy("bucket").applyInArrow(_levels, "block long, bucket long, n int, levels binary")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("ngram_join")
        for batch in batches:
            for i in range(batch.num_rows):
                yield _sets_of(batch.slice(i, 1), words, threshold, buckets)

    asked = with_replies(blocks, levels, "replies", "bucket", "n", "levels")
    return asked.mapInArrow(sets, _SETS)


def _sets_of(row: pa.RecordBatch, words: int, threshold: int, buckets: int) -> pa.RecordBatch:
    found = shingle_sets(unpack_texts(row.column("texts")[0].as_py(), row.column("ends")[0].as_py()), words)
    keys = _counted(found, buckets)
    distinct = np.unique(np.concatenate(keys))
    replies = sorted(row.column("replies")[0].as_py() or [], key=lambda r: r["bucket"])
    known = [unpack_bytes(r["levels"], r["n"]) for r in replies]
    levels = np.concatenate([np.zeros(0, np.uint8), *known])
    if len(levels) != len(distinct):
        raise ValueError(f"{len(levels)} shingles counted, {len(distinct)} found")
    n, own, key, short, whole = [], [], [], [], []
    for ids, mine in zip(found, keys, strict=True):
        level = np.full(len(ids), _LAST, np.uint8)
        level[: len(mine)] = levels[np.searchsorted(distinct, mine)]
        near = shortest_lists(ids, level, threshold) if len(ids) else ids
        open_ = len(near) > 0
        n.append(len(ids))
        own.append(float((level == 0).sum()) / max(1, len(mine)) if open_ else None)
        body = ids.astype("<u8").tobytes() if open_ else None
        key.append(hashlib.blake2b(body, digest_size=16).digest() if open_ else None)
        short.append(near.view(np.int64) if open_ else None)
        whole.append(body)
    return pa.record_batch(
        [
            row.column("ids")[0].values,
            row.column("text_keys")[0].values,
            pa.array(n, pa.int32()),
            pa.array(own, pa.float64()),
            pa.array(key, pa.binary()),
            pa.array(short, pa.list_(pa.int64())),
            pa.array(whole, pa.binary()),
        ],
        ["id", "text_key", "n", "own", "set_key", "short", "shingles"],
    )


# --- step 4: DivideSkip over the documents of two blocks --------------------------------


def divide_skip(lengths: np.ndarray, read, need: int, probe) -> list[int]:
    """Documents that are in at least ``need`` of the inverted lists.

    ``lengths``: of all lists; ``read(k)``: list k in order of documents. The ``need - 1``
    longest lists are set aside: who is in enough lists is in one of the others. Those are
    merged with a heap, which brings up each document with the number of short lists that it
    is in. ``probe(document, count)`` then tells by binary search in the long lists whether
    the whole count is enough.
    """
    short = np.argsort(lengths, kind="stable")[: max(0, len(lengths) - need + 1)]
    out, at, count = [], None, 0
    for document in heapq.merge(*[x for x in map(read, short.tolist()) if x]):
        if document != at:
            if at is not None and probe(at, count):
                out.append(at)
            at, count = document, 0
        count += 1
    if at is not None and probe(at, count):
        out.append(at)
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of sorted sets: the smaller one is probed in the larger."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def search_pair(
    sets: list[np.ndarray], queries: np.ndarray, targets: np.ndarray, threshold: int = THRESHOLD
) -> list[tuple[int, int]]:
    """Links between ``queries`` and ``targets``, as positions: a spanning forest.

    Documents that links join already aren't compared, as only who is joined is asked.
    """
    parent = list(range(len(sets)))
    links: list[tuple[int, int]] = []
    size = [len(s) for s in sets]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    there = np.flatnonzero(targets)
    owner = np.repeat(there, [size[j] for j in there])
    flat = np.concatenate([sets[j] for j in there]) if len(there) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i in np.flatnonzero(queries).tolist():
        low = np.searchsorted(flat, sets[i], side="left")
        high = np.searchsorted(flat, sets[i], side="right")
        need = least_shared(size[i], threshold)

        def read(k: int, low=low, high=high) -> list[int]:
            return owner[low[k] : high[k]].tolist()

        def probe(j: int, count: int, i: int = i, need: int = need) -> bool:
            # `need - 1` lists were set aside; the rest can't bring more than `count`
            if count + need - 1 < required(size[i], size[j], threshold) or find(i) == find(j):
                return False
            return linked(sets[i], sets[j], threshold)

        for j in divide_skip(high - low, read, need, probe):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    need = required(len(a), len(b), threshold)
    return need <= min(len(a), len(b)) and overlap(a, b) >= need


def _with_leader(threshold: int):
    """Whether each member of a family links with the leader. Rows come sorted by family and deal,
    the leader first."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("ngram_join")
        at, lead = None, np.zeros(0, np.uint64)
        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("leader", "deal", "id", "shingles")]
            members, found = [], []
            for leader, deal, id_, body in zip(*columns, strict=True):
                own = np.frombuffer(body, "<u8")
                if (leader, deal) != at:
                    at, lead = (leader, deal), own
                else:
                    members.append((leader, id_))
                    found.append(linked(own, lead, threshold))
            leaders, ids = zip(*members, strict=True) if members else ((), ())
            yield pa.record_batch(
                [pa.array(leaders, pa.int64()), pa.array(ids, pa.int64()), pa.array(found, pa.bool_())],
                ["leader", "id", "linked"],
            )

    return compare


def _search(threshold: int):
    """Pairs of blocks come sorted by key, one after the other; each is searched when it is
    complete."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("ngram_join")
        at, rows = None, {}

        def done() -> pa.RecordBatch:
            ids = sorted(rows)
            sets = [np.frombuffer(rows[i][2], "<u8") for i in ids]
            queries, targets = (np.array([rows[i][k] for i in ids]) for k in (0, 1))
            links = search_pair(sets, queries, targets, threshold)
            return pa.record_batch(
                [pa.array([ids[a] for a, _ in links], pa.int64()), pa.array([ids[b] for _, b in links], pa.int64())],
                ["a", "b"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("leader", "i", "j", "id", "query", "shingles")]
            for leader, i, j, id_, query, body in zip(*columns, strict=True):
                if (leader, i, j) != at:
                    if len(rows) > 1:
                        yield done()
                    at, rows = (leader, i, j), {}
                before = rows.get(id_, (False, False))
                rows[id_] = (before[0] or query, before[1] or not query, body)
        if len(rows) > 1:
            yield done()

    return search


def _family_links(family: DataFrame, sets: DataFrame, threshold: int, block: int) -> DataFrame:
    """Links within families (``leader``, ``id``): enough of them to join what any pair joins.

    Each member is compared with the leader; a large family is dealt to several tasks, each with
    a copy of its leader. Who links with it is joined to all others who do; so only pairs
    with a member that doesn't are left. These members are dealt to blocks, which meet all blocks
    of their family. Sets are moved for members of the families at hand only.
    """
    deals = family.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / DEAL).cast("int").alias("deals"))
    deals = materialize(deals, "ngram-family-deals")
    every_deal = F.sequence(F.lit(0), F.col("deals") - 1)
    own = F.array(F.pmod(F.xxhash64("id"), F.col("deals")).cast("int"))
    is_leader = F.col("id") == F.col("leader")
    dealt_out = family.join(deals, "leader").select(
        "leader", "id", F.explode(F.when(is_leader, every_deal).otherwise(own)).alias("deal")
    )
    key = ["leader", "deal"]
    led = (
        dealt_out.join(_sets_of_ids(sets, family), "id")
        .withColumn("member", F.col("id") != F.col("leader"))
        .repartition(*key)
        .sortWithinPartitions(*key, "member")
        .select(*key, "id", "shingles")
        .mapInArrow(_with_leader(threshold), "leader long, id long, linked boolean")
    )
    led = materialize(led, "ngram-led")
    links = led.filter("linked").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    loose = led.filter("not linked").select("leader", "id")
    if loose.isEmpty():
        return links
    sizes = led.groupBy("leader").agg(
        F.ceil(F.count_if(~F.col("linked")) / block).cast("int").alias("n_loose"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_all"),
    )
    sizes = materialize(sizes.filter("n_loose > 0"), "ngram-family-sizes")

    def dealt(n: str):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    queries = loose.join(sizes, "leader").select(
        "leader", "id", dealt("n_loose").alias("i"), every("n_all").alias("j"), F.lit(True).alias("query")
    )
    targets = led.select("leader", "id").join(sizes, "leader").select(
        "leader", "id", every("n_loose").alias("i"), dealt("n_all").alias("j"), F.lit(False).alias("query")
    )
    key = ["leader", "i", "j"]
    found = (
        queries.unionByName(targets)
        .join(_sets_of_ids(sets, led.join(sizes, "leader", "left_semi")), "id")
        .repartition(*key)
        .sortWithinPartitions(*key)
        .select(*key, "id", "query", "shingles")
        .mapInArrow(_search(threshold), "a long, b long")
    )
    return links.unionByName(found)


def _sets_of_ids(sets: DataFrame, members: DataFrame) -> DataFrame:
    """``id`` and ``shingles`` of the documents that are among ``members``, and some others."""
    maps = key_filter(members.select(F.xxhash64("id")))
    rows = sets.select(F.col("row").alias("id"), "shingles")
    return with_held(rows, F.xxhash64("id"), maps, "held").filter("held").drop("held")


# --- the join ---------------------------------------------------------------------------


def _first_row():
    """What the row that stays of a group has least: smallest id, null last, then first row."""
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))


def near_duplicate_classes(
    docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_shingles, component_id, text_key (a
    hash of the text, which tells rows of the same id apart) and stays, which one row of each
    component has.

    ``component_id`` is the smallest doc_id that links lead to, its own included. Null, empty
    and blank texts have no shingles and link with nothing; texts of fewer words than a
    shingle have their whole sequence as one. Equal texts link. A null id takes part like any
    other, but is never the smallest; rows with the same id and different texts are documents of
    their own. An empty table gives an empty result.
    """
    sets = materialize(
        document_sets(docs, words, threshold).withColumn("row", F.monotonically_increasing_id()), "ngram-sets"
    )
    open_ = sets.filter("set_key is not null")
    # equal sets are one from here on: the first row stands for all
    classes = materialize(
        open_.groupBy("set_key").agg(
            F.min("row").alias("node"), F.min("id").alias("least"), F.min(_first_row()).alias("first")
        ),
        "ngram-classes",
    )
    nodes = materialize(
        open_.select("row", "n", "own", "short")
        .join(classes.select(F.col("node").alias("row")), "row")
        .select(F.col("row").alias("id"), "n", "own", "short"),
        "ngram-nodes",
    )
    postings = nodes.select("id", "n", "own", F.explode("short").alias("shingle"))
    lists = materialize(
        postings.groupBy("shingle")
        .agg(F.min(F.struct("own", "id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("shingle", F.col("first.id").alias("leader")),
        "ngram-lists",
    )
    family = materialize(
        postings.select("id", "shingle").join(lists, "shingle").select("leader", "id").distinct(), "ngram-family"
    )
    links = materialize(_family_links(family, open_, threshold, block), "ngram-links")
    roots = connected_components(links, "a", "b")  # node, component: of linked nodes only
    labelled = classes.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "set_key", "least", "first", F.coalesce("component", "node").alias("component")
    )
    least = labelled.groupBy("component").agg(
        F.min("least").alias("component_id"), F.min("first").alias("first")
    )
    by_key = labelled.select("set_key", "component").join(least, "component").select(
        F.col("set_key").alias("_key"), "component_id", "first"
    )
    joined = open_.join(by_key, F.col("set_key") == F.col("_key")).select(
        "id", "text_key", "n", "component_id", (F.col("row") == F.col("first.row")).alias("stays")
    )
    alone = sets.filter("set_key is null").select(
        "id", "text_key", "n", F.col("id").alias("component_id"), F.lit(True).alias("stays")
    )
    return joined.unionByName(alone).select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id", "text_key", "stays"
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that of the smallest id, null
    last; of rows that share that one, any one of them.

    Rows that link with nothing all stay, null, empty and blank texts among them. Rows equal in id
    and text are near duplicates like others. Only keys of rows that go are joined with ``docs``.
    An empty table stays empty; other columns may have any names.
    """
    text = F.col(text_col).cast("string")
    key = [F.col(id_col).cast("long"), F.xxhash64(text)]
    narrow = docs.select(key[0].alias("doc_id"), text.alias("text"))
    fate = F.when(~F.bool_or("stays"), "go").when(F.count_if(~F.col("stays")) > 0, "one")
    fates = (
        near_duplicate_classes(narrow, words, threshold)
        .groupBy("doc_id", "text_key")
        .agg(fate.alias("fate"))
        .filter("fate IS NOT NULL")
    )
    return keep_chosen(docs, key, materialize(fates, "ngram-fates"))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
  FROM t
), u AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS shingle FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), pairs AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM s
  UNION
  SELECT r.doc_id, b.b FROM reach r JOIN pairs b ON r.other = b.a
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM s JOIN reach ON reach.doc_id = s.doc_id GROUP BY s.doc_id, len(sh)
"""

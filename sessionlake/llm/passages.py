"""Repeated passages: relative Lempel-Ziv parsing against indexed reference blocks.

A window is a number of consecutive words of one document. A word is repeated if a window over it
also starts in a document with a smaller id. Documents are parsed greedily: from a place on, the
longest stretch that a document with a smaller id has too is a factor, then the next one starts. Long
factors are repeated; so is a window across the end of a factor, if a check of its own finds
it elsewhere.

No document can be parsed against all others. What can't repeat is left out first, and what
may do so meets only the reference block that has its like:

1. Every window has an anchor, the few words in it of least hash, so equal windows have the same one.
   Anchors of all documents are dealt to buckets, as 32-bit codes that each block of documents
   counts first. Those of one document only are done.
2. Windows next to each other that share an anchor make a piece. Pieces of anchors that
   several documents have are dealt, as words, to the reference block of the anchor, each
   once per block of documents. Anchors of very many documents would make a block too large: their
   windows are dealt one by one, by their own words.
3. A reference block is the text of all its pieces, in order of document, under a suffix array.
   Each piece is parsed against it, and the windows that its factors cover go back.

Decisions are made on words; hashes only say where they are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.blocks import bucket_keys, by_bucket, pack_texts, unpack_texts, with_replies
from sessionlake.llm.common import importable, small_slices
from sessionlake.llm.words import join_words, numbered, split_words
from sessionlake.session import materialize

WINDOW = 13
ANCHOR = 5

# Text of a block of documents, unless a single one is longer.
BLOCK_BYTES = 1 << 20

# Anchors per bucket, as expected from the size of the text.
BUCKET_ANCHORS = 1 << 18
_BYTES_PER_ANCHOR = 32

# Anchors of more documents than this are dealt window by window.
HOT = 1_000

_ONCE, _SHARED, _HOT = 0, 1, 2
_MOST = 255

# No id: after all others.
_NO_ID = np.iinfo(np.int64).max

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_codes(words: pa.Array) -> np.ndarray:
    """A hash of the bytes of each word (none is empty)."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    if not len(words):
        return np.empty(0, np.uint64)
    starts = ends[:-1]
    symbols = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(ends[0], ends[-1]) - np.repeat(starts, np.diff(ends))
    powers = np.cumprod(np.full(int(place.max()) + 1, _MULTIPLIER))
    return _mixed(np.add.reduceat(symbols * powers[place], starts - ends[0]))


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` codes in a row."""
    n = max(len(codes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _MULTIPLIER + codes[k : k + n]
    return _mixed(out)


class Pieces:
    """The windows of a block of documents, cut into pieces by their anchors.

    ``first`` is the place of a piece's first window, ``count`` its windows, ``of`` its
    document and ``anchor`` the hash of its anchor.
    """

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        self.bounds, self.words = split_words(texts)
        numbers, spellings = numbered(self.words)
        self.codes = _word_codes(spellings)[numbers]
        anchors = _rolled(self.codes, anchor)
        span = window - anchor + 1
        ends = self.bounds[1:]
        lengths = np.diff(self.bounds)
        of_word = np.repeat(np.arange(len(lengths)), lengths)
        n = max(len(self.codes) - window + 1, 0)
        starts = np.flatnonzero(np.arange(n) + window <= ends[of_word[:n]])
        if len(starts):
            views = np.lib.stride_tricks.sliding_window_view(anchors, span)
            least = starts + _argmin_rows(views, starts)
        else:
            least = starts
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(least) != 0) | (np.diff(starts) != 1)
        at = np.flatnonzero(new)
        self.first = starts[at]
        self.count = np.diff(np.append(at, len(starts)))
        self.of = of_word[self.first]
        self.anchor = anchors[least[at]]


def _argmin_rows(views: np.ndarray, rows: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Where each row of ``views`` has its first minimum, a stretch of rows at a time."""
    return np.concatenate(
        [np.argmin(views[rows[i : i + step]], axis=1) for i in range(0, len(rows), step)]
    )


_BLOCKS = "block long, ids array<long>, texts binary, ends binary, bucket long, keys binary, counts binary"


def _blocks(docs: DataFrame, buckets: int, window: int, anchor: int, block_bytes: int) -> DataFrame:
    """Rows of two kinds: without a bucket a block of documents, whole; with a bucket the
    distinct anchors of a block that are dealt to it and the number of its documents that have
    each (255 at most)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows in small_slices(batches, max_bytes=block_bytes):
            ids, texts = rows.column("doc_id"), rows.column("text")
            pieces = Pieces(texts, window, anchor)
            keys = bucket_keys(pieces.anchor, buckets)
            order = np.lexsort((pieces.of, keys))
            keys, of = keys[order], pieces.of[order]
            new_key = np.ones(len(keys), bool)
            new_key[1:] = keys[1:] != keys[:-1]
            new = new_key.copy()
            new[1:] |= of[1:] != of[:-1]
            at = np.flatnonzero(new_key)
            held = np.add.reduceat(new.astype(np.int64), at) if len(at) else at
            held, keys = np.minimum(held, _MOST).astype(np.uint8), keys[at]
            found = [(b, keys[s].astype(np.uint32).tobytes(), held[s].tobytes()) for b, s in by_bucket(keys)]
            n = len(found)
            whole = pa.array([0] + [len(ids)] * (n + 1), pa.int32())
            data, ends = pack_texts(texts)
            yield pa.record_batch(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.ListArray.from_arrays(whole, ids),
                    pa.array([data] + [None] * n, pa.binary()),
                    pa.array([ends] + [None] * n, pa.binary()),
                    pa.array([None] + [f[0] for f in found], pa.int64()),
                    pa.array([None] + [f[1] for f in found], pa.binary()),
                    pa.array([None] + [f[2] for f in found], pa.binary()),
                ],
                ["block", "ids", "texts", "ends", "bucket", "keys", "counts"],
            )
            block += 1

    return docs.mapInArrow(cut, _BLOCKS)


def _count_anchors(hot: int) -> Callable[[pa.Table], pa.Table]:
    """Of one bucket: whether each anchor of each block is in one document, in more, or in
    more than ``hot``."""

    def count(table: pa.Table) -> pa.Table:
        blobs = [b.as_py() for b in table.column("keys")]
        keys = np.frombuffer(b"".join(blobs), np.uint32)
        held = np.frombuffer(b"".join(b.as_py() for b in table.column("counts")), np.uint8)
        distinct, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=held, minlength=len(distinct))
        kind = ((total > 1).astype(np.uint8) + (total > hot))[at]
        ends = np.cumsum([0] + [len(b) // 4 for b in blobs]).tolist()
        packed = [
            np.packbits(kind[i:j] == _SHARED).tobytes() + np.packbits(kind[i:j] == _HOT).tobytes()
            for i, j in zip(ends[:-1], ends[1:], strict=True)
        ]
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "kinds": pa.array(packed, pa.binary()),
                "n": pa.array(np.diff(ends).astype(np.int32)),
            }
        )

    return count


def _unpacked(replies: list[dict]) -> np.ndarray:
    """What all buckets say about a block's anchors, in the order of its keys."""
    out = [np.empty(0, np.uint8)]
    for reply in sorted(replies, key=lambda r: r["bucket"]):
        n = reply["n"]
        bits = np.frombuffer(reply["kinds"], np.uint8).reshape(2, -1)
        shared, hot = (np.unpackbits(row, count=n) for row in bits)
        out.append(_SHARED * shared + _HOT * hot)
    return np.concatenate(out)


_DEALT = (
    "block long, bucket long, pieces binary, ends binary, owners binary,"
    " first binary, count binary, slot binary, own binary"
)


def _deal(buckets: int, window: int, anchor: int) -> Callable:
    """Pieces that may repeat, by the reference block they meet: each once per block of
    documents, with the smallest id that has it there. The row without a bucket says where
    in the block which piece is (``slot`` counts over all buckets), and whether its document
    is that smallest one (``own``)."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _dealt(batch.slice(i, 1), buckets, window, anchor)

    return deal


def _dealt(row: pa.RecordBatch, buckets: int, window: int, anchor: int) -> pa.RecordBatch:
    block = row.column("block")[0].as_py()
    ids = pc.fill_null(row.column("ids")[0].values, _NO_ID).to_numpy().astype(np.int64)
    pieces = Pieces(unpack_texts(row.column("texts")[0].as_py(), row.column("ends")[0].as_py()), window, anchor)
    keys = bucket_keys(pieces.anchor, buckets)
    distinct, at = np.unique(keys, return_inverse=True)
    replies = row.column("replies")[0].as_py()
    kind = _unpacked(replies or [])
    if len(kind) != len(distinct):
        raise ValueError(f"block {block}: {len(kind)} anchors counted, {len(distinct)} found")
    kind = kind[at] if len(at) else kind
    whole, single = np.flatnonzero(kind == _SHARED), np.flatnonzero(kind == _HOT)
    # the windows of hot anchors, one by one, dealt by all their words
    counts = pieces.count[single]
    windows = np.repeat(pieces.first[single], counts) + _up_to(counts)
    by_words = _rolled(pieces.codes, window)
    first = np.concatenate([pieces.first[whole], windows])
    count = np.concatenate([pieces.count[whole], np.ones(len(windows), np.int64)])
    of = np.concatenate([pieces.of[whole], np.repeat(pieces.of[single], counts)])
    bucket = np.concatenate([keys[whole], bucket_keys(by_words[windows], buckets)]) >> np.uint64(32)
    sizes = count + window - 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(first, sizes) + _up_to(sizes)
    number, texts = numbered(join_words(pieces.words.take(pa.array(places)), bounds))
    owner = np.full(len(texts), _NO_ID)
    np.minimum.at(owner, number, ids[of])
    home = np.zeros(len(texts), np.uint64)
    home[number] = bucket
    order = np.argsort(home, kind="stable")
    slot = np.empty(len(texts), np.int64)
    slot[order] = np.arange(len(texts))
    texts, owners, home = texts.take(pa.array(order)), owner[order], home[order]
    own = ids[of] == owner[number]
    there, starts = np.unique(home, return_index=True)
    bounds = [*starts.tolist(), len(home)]
    dealt = [
        (int(b), *pack_texts(texts.slice(i, j - i)), owners[i:j].tobytes())
        for b, i, j in zip(there.tolist(), bounds[:-1], bounds[1:], strict=True)
    ]
    n = len(dealt)

    def theirs(k, kind):
        return pa.array([None] + [d[k] for d in dealt], kind)

    def mine(values, kind):
        return pa.array([values.astype(kind).tobytes()] + [None] * n, pa.binary())

    return pa.record_batch(
        [
            pa.array([block] * (n + 1), pa.int64()),
            theirs(0, pa.int64()),
            *[theirs(k, pa.binary()) for k in (1, 2, 3)],
            mine(first, np.uint32),
            mine(count, np.uint8),
            mine(slot[number] if len(number) else number, np.uint32),
            mine(np.packbits(own), np.uint8),
        ],
        ["block", "bucket", "pieces", "ends", "owners", "first", "count", "slot", "own"],
    )


def _up_to(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... below each count, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


class Reference:
    """A reference block: texts under a suffix array, each of one document.

    Suffixes are ordered by doubling, far enough to tell the longest text; a text's end
    differs from all words and other ends, so no match runs over it.
    """

    def __init__(self, texts: pa.Array, owners: np.ndarray):
        self.bounds, words = split_words(texts)
        numbers, spellings = numbered(words)
        lengths = np.diff(self.bounds)
        # each text with its end
        self.starts = self.bounds[:-1] + np.arange(len(lengths))
        total = int(self.bounds[-1]) + len(lengths)
        self.ends = self.starts + lengths
        symbols = np.empty(total, np.int64)
        inside = np.ones(total, bool)
        inside[self.ends] = False
        symbols[inside] = numbers
        symbols[self.ends] = len(spellings) + np.arange(len(lengths))
        self.owner = np.repeat(owners, lengths + 1)
        rank, width = symbols, 1
        self._ranks = [rank]
        while width < int(lengths.max(initial=0)):
            later = np.concatenate([rank[width:], np.full(min(width, total), -1)]) + 1
            rank = np.unique(rank * (total + len(spellings) + 2) + later, return_inverse=True)[1]
            self._ranks.append(rank)
            width *= 2
        self.order = np.argsort(rank, kind="stable")

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words two suffixes have in common."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            same = self._ranks[k][a] == self._ranks[k][b]
            out[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        return out

    def longest_before(self) -> np.ndarray:
        """For each place the longest match with a text of a smaller owner: the better one of the
        nearest such suffixes on both sides in the order of suffixes."""
        owners = self.owner[self.order]
        before = _nearest_smaller(owners)
        after = len(owners) - 1 - _nearest_smaller(owners[::-1])[::-1]
        best = np.zeros(len(owners), np.int64)
        for near, there in ((before, before >= 0), (after, after < len(owners))):
            at = np.flatnonzero(there)
            found = self._common(self.order[at], self.order[near[at]])
            best[self.order[at]] = np.maximum(best[self.order[at]], found)
        return best

    def covered(self, window: int) -> np.ndarray:
        """Parse every text greedily against the texts of smaller owners. Per text the windows
        (bit i: the one at word i) within a factor, or found at its boundary."""
        longest = self.longest_before()
        mask = np.zeros(len(self.starts), np.int64)
        text = np.arange(len(self.starts))
        at = self.starts.copy()
        while len(text):
            size = longest[at]
            stop = np.where(size > 0, at + size, at + 1)  # a word that is nowhere else is a factor too
            # windows within the factor ...
            inside = np.maximum(size - window + 1, 0)
            mask[text] |= ((np.int64(1) << inside) - 1) << (at - self.starts[text])
            # ... and those that start in it and end behind it
            for back in range(1, window):
                place = stop - back
                checked = (place >= at + inside) & (place + window <= self.ends[text])
                found = checked & (longest[np.maximum(place, 0)] >= window)
                mask[text[found]] |= np.int64(1) << (place[found] - self.starts[text[found]])
            on = stop + window <= self.ends[text]
            text, at = text[on], stop[on]
        return mask


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value; -1 if there is none."""
    near = np.arange(len(values)) - 1
    open_ = np.flatnonzero(near >= 0)
    open_ = open_[values[near[open_]] >= values[open_]]
    if not len(open_):
        return near
    out = near.tolist()
    held = values.tolist()
    for at in open_.tolist():
        back = out[at]
        while back >= 0 and held[back] >= held[at]:
            back = out[back]
        out[at] = back
    return np.array(out, np.int64)


def _parse(window: int) -> Callable[[pa.Table], pa.Table]:
    """Of one bucket: the windows of each block's pieces that are in a document with a smaller
    id than the smallest one that has the piece in that block."""

    def parse(table: pa.Table) -> pa.Table:
        blobs = [(p.as_py(), e.as_py()) for p, e in zip(table.column("pieces"), table.column("ends"), strict=True)]
        held = [unpack_texts(*blob) for blob in blobs]
        owners = np.frombuffer(b"".join(o.as_py() for o in table.column("owners")), np.int64)
        number, texts = numbered(pa.concat_arrays(held))
        first = np.full(len(texts), _NO_ID)
        np.minimum.at(first, number, owners)
        # in order of document, as far as the order of parsing goes
        order = np.argsort(first, kind="stable")
        reference = Reference(texts.take(pa.array(order)), first[order])
        mask = np.empty(len(texts), np.int64)
        mask[order] = reference.covered(window)
        # a smaller document has the whole piece: all its windows repeat
        found = np.where(owners > first[number], -1, mask[number]).astype(np.uint16)
        ends = np.cumsum([0] + [len(t) for t in held]).tolist()
        masks = [found[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "masks": pa.array(masks, pa.binary()),
            }
        )

    return parse


def _remove(window: int) -> Callable:
    """Cut what repeats out of each document of a block."""

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _removed(batch.slice(i, 1), window)

    return remove


def _removed(row: pa.RecordBatch, window: int) -> pa.RecordBatch:
    ids = row.column("ids")[0].values
    texts = unpack_texts(row.column("texts")[0].as_py(), row.column("ends")[0].as_py())
    bounds, words = split_words(texts)
    first, count, slot, own = (
        np.frombuffer(row.column(name)[0].as_py() or b"", kind)
        for name, kind in (("first", np.uint32), ("count", np.uint8), ("slot", np.uint32), ("own", np.uint8))
    )
    replies = sorted(row.column("masks")[0].as_py() or [], key=lambda r: r["bucket"])
    masks = np.frombuffer(b"".join(r["masks"] for r in replies), np.uint16).astype(np.int64)
    own = np.unpackbits(own, count=len(first)).astype(bool)
    # in another document of the block than the smallest one every window of a piece repeats
    mask = np.where(own, masks[slot], -1) if len(first) else np.empty(0, np.int64)
    change = np.zeros(len(words) + window + 1, np.int64)
    for k in range(int(count.max(initial=0))):
        hit = first[(count > k) & ((mask >> k) & 1 == 1)].astype(np.int64) + k
        change += np.bincount(hit, minlength=len(change)) - np.bincount(hit + window, minlength=len(change))
    gone = np.cumsum(change)[: len(words)] > 0
    kept = np.concatenate([[0], np.cumsum(~gone)])[bounds]
    # spans of removed words, cut where a document ends
    of_word = np.repeat(np.arange(len(texts)), np.diff(bounds))
    edge = np.ones(len(words), bool)
    edge[1:] = (np.diff(gone.astype(np.int8)) != 0) | (np.diff(of_word) != 0)
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], len(words))
    at, ends = at[gone[at]], ends[gone[at]]
    of_span = of_word[at]
    structs = pa.StructArray.from_arrays(
        [pa.array(at - bounds[of_span]), pa.array(ends - bounds[of_span])], ["start", "end"]
    )
    return pa.record_batch(
        [
            ids,
            pa.array(np.diff(bounds)),
            pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of_span, np.arange(len(texts) + 1)), pa.int32()), structs
            ),
            join_words(words.filter(pa.array(~gone)), kept),
        ],
        ["doc_id", "n_words", "spans", "kept"],
    )


def remove_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
    bucket_anchors: int = BUCKET_ANCHORS,
    hot: int = HOT,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (structs of start and end, word
    numbers from 0, end exclusive) of the words that repeat, and ``kept``, the other words
    joined by one space.

    A word repeats if a window of ``window`` words over it also starts in a document with a smaller
    id, anywhere in it; windows are judged on the input. So the document with the smallest id keeps
    a passage, as often as it has it. Rows of one id are one document: none repeats the
    other. Rows without an id come after all others, and repeat no other of their kind. Null, empty
    and blank texts and those shorter than a window have nothing that repeats; every row
    gives a row. Other columns are not looked at. Exact whatever ``anchor`` (words of an anchor, up to
    15 fewer than the window), ``hot`` and the sizes of blocks and buckets are.
    """
    if not 0 <= window - anchor < 16 or anchor < 1:
        raise ValueError("an anchor has 1 word at least and up to 15 fewer than the window")
    importable(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // (_BYTES_PER_ANCHOR * bucket_anchors)) + 1
    cut = materialize(_blocks(rows, buckets, window, anchor, block_bytes), "passage-blocks")
    blocks = cut.filter("bucket IS NULL").select("block", "ids", "texts", "ends")
    anchors = cut.filter("bucket IS NOT NULL").select("block", "bucket", "keys", "counts")
    kinds = anchors.groupBy("bucket").applyInArrow(
        _count_anchors(hot), "block long, bucket long, kinds binary, n int"
    )
    asked = with_replies(blocks, kinds, "replies", "bucket", "kinds", "n")
    dealt = materialize(
        asked.mapInArrow(_deal(buckets, window, anchor), _DEALT), "passage-pieces"
    )
    pieces = dealt.filter("bucket IS NOT NULL").select("block", "bucket", "pieces", "ends", "owners")
    masks = pieces.groupBy("bucket").applyInArrow(_parse(window), "block long, bucket long, masks binary")
    places = dealt.filter("bucket IS NULL").select("block", "first", "count", "slot", "own")
    answered = with_replies(places, masks, "masks", "bucket", "masks")
    of_block = answered.withColumnRenamed("block", "_block")
    return blocks.join(of_block, F.col("block") == F.col("_block"), "left").mapInArrow(
        _remove(window),
        "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept string",
    )


def passage_digest(docs: DataFrame) -> DataFrame:
    """Per document: words, words that repeat, and the digest of the others."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeated(docs).select(
        "doc_id",
        "n_words",
        removed.alias("n_removed"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), least AS (
  SELECT words, min(doc_id) AS first_doc FROM windows GROUP BY words HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN least USING (words) WHERE first_doc < doc_id
), gone_by_doc AS (
  SELECT doc_id, list(i) AS at, count(*) AS n FROM gone GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone_by_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

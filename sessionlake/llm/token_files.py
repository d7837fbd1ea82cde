"""Token-id files: one concatenated id array, document boundaries as Elias-Fano codes."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.llm.byte_bpe import Splitter
from sessionlake.llm.common import id_and_text, importable, small_slices
from sessionlake.session import new_folder

# A file row holds about this many ids; a longer document has a row of its own.
SEGMENT_IDS = 1 << 20

# A worker forgets its pieces beyond this number (some 200 MB) and starts again.
REMEMBERED = 1_300_000

# So many words that are met for the first time are given to the library as one text.
WORDS_AT_ONCE = 1000

# Every so many set bits, the select directory notes a position.
SELECT_STEP = 256

_BITS_SET = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
# Where the first, second, ... bit set in a byte is.
_BIT_AT = np.array(
    [([k for k in range(8) if byte >> k & 1] + [0] * 8)[:8] for byte in range(256)], dtype=np.int64
)

SEGMENT_SCHEMA = (
    "part int, seq int, part_start long, n_docs int, n_ids long, id_bytes int, ids binary,"
    " low_bits int, low binary, high binary, directory binary, doc_ids binary, null_ids binary"
)


@dataclass
class EliasFano:
    """A non-decreasing sequence of ``n`` numbers in about ``2 + log2(last / n)`` bits each.

    The low bits of each number are stored as they are; the high ones as a bit string in which
    number ``i`` with high part ``h`` sets bit ``h + i``. `select` finds that bit through a
    directory of every 256th set bit, so a number is read without decoding the others. The bit
    string has three bits a number at most, so the directory's places fit 32 bits.
    """

    n: int
    low_bits: int
    low: bytes
    high: bytes
    directory: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        if n >= 1 << 30:
            raise ValueError(f"{n} numbers are too many for one code")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        set_ = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(set_[-1]) + 1, dtype=np.uint8)
        high[set_] = 1
        return cls(
            n,
            low_bits,
            np.packbits(low, bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            set_[::SELECT_STEP].astype("<u4").tobytes(),
        )

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        end = at + self.low_bits
        word = int.from_bytes(self.low[at >> 3 : (end + 7) >> 3], "little")
        return word >> (at & 7) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Number ``i``, from the directory, at most 255 set bits further, and its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        entry = 4 * (i // SELECT_STEP)
        start = int.from_bytes(self.directory[entry : entry + 4], "little")
        skip, byte = i % SELECT_STEP, start >> 3
        bits = self.high[byte] >> (start & 7) << (start & 7)
        while skip >= (ones := int(_BITS_SET[bits])):
            skip -= ones
            byte += 1
            bits = self.high[byte]
        for _ in range(skip):
            bits &= bits - 1
        at = 8 * byte + (bits & -bits).bit_length() - 1
        return (at - i) << self.low_bits | self._low(i)

    def select_many(self, wanted: np.ndarray) -> np.ndarray:
        """The numbers at the places ``wanted``, as `select` finds each: from the directory's
        byte on, by counts of the bits set up to each byte, and then within one byte."""
        if not len(wanted):
            return np.zeros(0, dtype=np.int64)
        if wanted.min() < 0 or wanted.max() >= self.n:
            raise IndexError(int(wanted.max()))
        bits = np.frombuffer(self.high, np.uint8)
        upto = np.cumsum(_BITS_SET[bits], dtype=np.int64)
        start = np.frombuffer(self.directory, "<u4")[wanted // SELECT_STEP].astype(np.int64) >> 3
        byte = np.maximum(start, np.searchsorted(upto, wanted, side="right"))
        before = upto[byte] - _BITS_SET[bits[byte]]
        at = 8 * byte + _BIT_AT[bits[byte], wanted - before]
        out = (at - wanted) << self.low_bits
        if self.low_bits:
            first = wanted * self.low_bits
            low = np.frombuffer(self.low + bytes(8), np.uint8)
            # the bytes that hold a number's low bits, and one more where these don't start a byte
            word = np.zeros(len(wanted), np.uint64)
            for k in range((self.low_bits + 7) // 8):
                word |= low[(first >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
            word >>= (first & 7).astype(np.uint64)
            k = (self.low_bits + 7) // 8
            shift = (8 * k - (first & 7)).astype(np.uint64)
            word |= low[(first >> 3) + k].astype(np.uint64) << shift
            out |= (word & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)
        return out.astype(np.int64)


class PieceTokenizer:
    """A byte-level tokenizer of the `tokenizers` library, asked once for each distinct piece.

    The library encodes the matches of its pre-tokenizer's pattern one by one, so a text's ids
    are those of its pieces. Texts with characters whose class may differ between regular
    expression engines are handed to the library whole, and so are those that hold the text of an
    added token: the library looks for these first, and gives them their own id.

    Most pieces are words after a space. The library is given many of them as one text, which its
    pattern cuts into them again; the ids of each begin with the one token that has the space.
    """

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        added = self._library.get_added_tokens_decoder().values()
        self._added = [token.content for token in added if token.content]
        self.id_bytes = 2 if self._library.get_vocab_size() <= 1 << 16 else 4
        self._splitter = Splitter(pattern)
        self._spaced = np.zeros(max(self._library.get_vocab().values(), default=-1) + 1, dtype=bool)
        for token, i in self._library.get_vocab().items():
            self._spaced[i] = token.startswith("Ġ")  # how byte-level vocabularies write a space
        self._pieces: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.id_bytes == 2 else "I"
        return [
            array(kind, e.ids).tobytes()
            for e in self._library.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        parts = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        joined = ["".join(part) for part in parts]
        width, out = self.id_bytes, {}
        for part, text, ids in zip(parts, joined, self._encode(joined), strict=True):
            begin = (np.flatnonzero(self._spaced[np.frombuffer(ids, f"<u{width}")]) * width).tolist()
            if len(begin) == len(part) and self._splitter.split(text) == part:
                ends = [*begin[1:], len(ids)]
                out.update((p, ids[a:b]) for p, a, b in zip(part, begin, ends, strict=True))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self._encode(rest), strict=True))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, ``id_bytes`` bytes each; none for null."""
        plain = [
            bool(t) and self._splitter.is_plain(t) and not any(a in t for a in self._added) for t in texts
        ]
        split = [self._splitter.split(t) if ok else [] for t, ok in zip(texts, plain, strict=True)]
        known = self._pieces
        if len(known) >= REMEMBERED:
            known.clear()
        new = list(set().union(*split).difference(known))
        known.update(self._encode_pieces(new))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        whole = [i for i, t in enumerate(texts) if t and not plain[i]]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def piece_tokenizer(path: str, pattern: str) -> PieceTokenizer:
    """One per Python worker and vocabulary."""
    return PieceTokenizer(path, pattern)


def _segment(part: int, seq: int, start: int, width: int, docs: list[tuple[int | None, bytes]]) -> dict:
    ends = np.cumsum([0] + [len(ids) // width for _, ids in docs])
    code = EliasFano.encode(ends)
    return {
        "part": part,
        "seq": seq,
        "part_start": start,
        "n_docs": len(docs),
        "n_ids": int(ends[-1]),
        "id_bytes": width,
        "ids": b"".join(ids for _, ids in docs),
        "low_bits": code.low_bits,
        "low": code.low,
        "high": code.high,
        "directory": code.directory,
        "doc_ids": np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes(),
        "null_ids": np.packbits([d is None for d, _ in docs], bitorder="little").tobytes(),
    }


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    pattern: str,
    end_id: int = 0,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) and write their ids in ascending order of id.

    Documents are range partitioned and sorted (null ids first, then equal ids by text), so
    every file part holds one stretch of the order. A part is a Parquet file of segments; a
    segment has the concatenated ids of some documents, ``end_id`` after each, at 2 or 4 bytes
    an id, the Elias-Fano code of its boundaries, and the document ids. Beside the parts, a
    table of one row per part says how many ids come before it. A null or empty text is a
    document of just the end id. An empty table gives no segments.
    """
    importable(docs.sparkSession)

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = piece_tokenizer(tokenizer_path, pattern)
        width, part = tool.id_bytes, TaskContext.get().partitionId()
        end = int(end_id).to_bytes(width, "little")
        held: list[tuple[int | None, bytes]] = []
        seq = start = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, size, held
            row = _segment(part, seq, start, width, held)
            seq, start, size, held = seq + 1, start + row["n_ids"], 0, []
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for rows in small_slices(batches):
            ids = tool.encode(rows.column("text").to_pylist())
            for doc_id, body in zip(rows.column("doc_id").to_pylist(), ids, strict=True):
                held.append((doc_id, body + end))
                size += len(body) // width + 1
                if size >= segment_ids:
                    yield flush()
        if held:
            yield flush()

    schema = _arrow_schema()
    spark = docs.sparkSession
    (
        id_and_text(docs)
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(segments, SEGMENT_SCHEMA)
        .write.parquet(f"{path}/segments")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (
        spark.read.schema(SEGMENT_SCHEMA)
        .parquet(f"{path}/segments")
        .groupBy("part")
        .agg(F.sum("n_ids").alias("n_ids"))
        # one row per part of the range shuffle, however many documents there are
        .withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .write.parquet(f"{path}/parts")
    )


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in map(str.split, SEGMENT_SCHEMA.split(","))])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids before each in the whole collection."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments")
    parts = spark.read.schema("part int, n_ids long, start long").parquet(f"{path}/parts")
    # one row per part, so the broadcast has a fixed bound
    return segments.join(
        F.broadcast(parts.select("part", F.col("start").alias("before"))), "part"
    ).withColumn("start", F.col("before") + F.col("part_start"))


def boundaries(segment: dict) -> EliasFano:
    """The code of a segment's boundaries: ``n_docs + 1`` offsets into its ids."""
    return EliasFano(
        segment["n_docs"] + 1, segment["low_bits"], segment["low"], segment["high"], segment["directory"]
    )


def document_ids(segment: dict, i: int) -> np.ndarray:
    """The ids of document ``i`` of a segment, found by two selects."""
    code, width = boundaries(segment), segment["id_bytes"]
    body = segment["ids"][code.select(i) * width : code.select(i + 1) * width]
    return np.frombuffer(body, f"<u{width}").astype(np.uint32)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, the CRC of its ids as 4-byte
    integers, and those ``ids`` unless they are not asked for."""
    importable(spark)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = batch.slice(row, 1).to_pylist()[0]
                ends = boundaries(segment).select_many(np.arange(segment["n_docs"] + 1))
                width = segment["id_bytes"]
                ids = np.frombuffer(segment["ids"], f"<u{width}").astype("<u4")
                numbers = np.frombuffer(segment["doc_ids"], "<i8")
                nulls = np.unpackbits(np.frombuffer(segment["null_ids"], np.uint8), bitorder="little", count=len(numbers))
                bodies = [ids[a:b].data for a, b in zip(ends, ends[1:], strict=False)]
                columns = [
                    pa.array(numbers, pa.int64(), mask=nulls.astype(bool)),
                    pa.array(ends[:-1] + segment["start"], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(list(map(zlib.crc32, bodies)), pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([b.tobytes() for b in bodies], pa.binary()))
                yield pa.record_batch(columns, [c.split()[0] for c in schema.split(", ")])

    return read_segments(spark, path).mapInArrow(documents, schema)


def token_file_digest(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """Write token files to the shared folder, read them back, return the contract's columns."""
    path = new_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, pattern)
    return read_token_files(docs.sparkSession, path, with_ids=False)

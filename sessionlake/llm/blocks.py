"""Blocks of documents that ask about their keys: counts over the corpus, without moving texts.

A block keeps its texts, compressed. Its distinct keys (32 bits, within a bucket of the hash range)
are dealt to their buckets, and what a bucket says about them comes back to the block in the same
order. So equal keys of a block travel as one, however many documents have them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.session import materialize

# Texts and keys move compressed.
_CODEC = "zstd"


def pack_texts(texts: pa.Array) -> tuple[bytes, bytes]:
    """Texts as one compressed run of bytes and their ends in it; null as empty."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    plain = data[int(ends[0]) : int(ends[-1])].to_pybytes() if data else b""
    return pa.compress(plain, _CODEC, asbytes=True), (ends[1:] - ends[0]).astype(np.int32).tobytes()


def unpack_texts(data: bytes, ends: bytes) -> pa.Array:
    bounds = np.concatenate([[0], np.frombuffer(ends, np.int32)]).astype(np.int32)
    plain = pa.decompress(data, int(bounds[-1]), _CODEC)
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.tobytes()), plain])


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 32-bit keys, by the bytes of their differences."""
    steps = np.diff(keys.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), _CODEC, asbytes=True)


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(pa.decompress(data, 4 * n, _CODEC), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.uint32)


def pack_bytes(values: np.ndarray) -> bytes:
    return pa.compress(values.astype(np.uint8).tobytes(), _CODEC, asbytes=True)


def unpack_bytes(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n, _CODEC), np.uint8)


def bucket_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in the upper half, 32 bits of the hash in the lower one."""
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return (bucket << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def by_bucket(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted keys, and the stretch of each."""
    buckets, starts = np.unique(keys >> np.uint64(32), return_index=True)
    ends = [*starts[1:].tolist(), len(keys)]
    for b, i, j in zip(buckets.tolist(), starts.tolist(), ends, strict=False):
        yield b, slice(i, j)


def with_replies(blocks: DataFrame, replies: DataFrame, name: str, *columns: str) -> DataFrame:
    """``blocks`` with what the buckets said about each, as structs of ``columns``.

    Replies are written, so that Spark knows their size and sends small ones to the blocks, which
    then stay where they are.
    """
    together = materialize(
        replies.groupBy(F.col("block").alias("_of")).agg(F.collect_list(F.struct(*columns)).alias(name)),
        "block-replies",
    )
    return blocks.join(together, F.col("block") == F.col("_of"), "left").drop("_of")

"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appending, editing."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sessionlake.llm.common import (
    Remembered,
    drop_tables_of_others,
    id_and_text,
    importable,
    kept_by,
    small_slices,
)

_NEVER = 1 << 60

# Pieces, and prefixes of pieces, that a worker remembers in each of two generations; pairs of
# tokens that it remembers before it starts again. Results don't depend on them.
REMEMBERED = 100_000
_REMEMBERED_PREFIXES = 60_000
_REMEMBERED_PAIRS = 120_000

# Longer pieces are encoded by an array over their prefixes instead of remembered ones.
_WORD_BYTES = 64


# Latin letters up to U+024F; the plain texts below have no others.
_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"

# Constructs of such patterns and, for plain texts, the same with classes spelt out.
_PLAIN_FORMS = (
    ("'s|'t|'re|'ve|'m|'ll|'d|", "'(?:[stmd]|re|ve|ll)|"),
    (r"[^\s\p{L}\p{N}]", f"[^\t\n\r {_LATIN}0-9]"),
    (r"\p{L}", f"[{_LATIN}]"),
    (r"\p{N}", "[0-9]"),
    (r"\s", "[\t\n\r ]"),
    (r"\S", "[^\t\n\r ]"),
)


class Splitter:
    """Cut texts into the matches of a pattern that is written for the `regex` library.

    Plain texts, of ASCII without control characters, Latin letters and common signs, take the
    standard library's faster engine with the classes spelt out; other texts take `regex`.
    """

    def __init__(self, pattern: str):
        self._full = regex.compile(pattern)
        plain = pattern
        for construct, form in _PLAIN_FORMS:
            plain = plain.replace(construct, form)
        self._fast = None if re.search(r"\\[a-zA-Z]", plain) else re.compile(plain)
        # without the Latin-1 digits and fractions, and the letters among its signs
        self._other = re.compile("[^\t\n\r\x20-\x7e\xa1\xab\xb7\xbb\xbf-\u024f‘’“”–—…]")

    def is_plain(self, text: str) -> bool:
        return self._fast is not None and not self._other.search(text)

    def split(self, text: str) -> list[str]:
        return (self._fast if self.is_plain(text) else self._full).findall(text)


class Ranks:
    """A vocabulary of byte strings by rank, and which two tokens may stand side by side.

    A token is the result of one last merge of two others; following the right halves down
    gives the stages of its right edge, the left halves those of its left edge. Two tokens
    may be neighbours when no merge across their border would come before the merges that
    build their edges.
    """

    def __init__(self, tokens: dict[bytes, int]):
        self.rank = tokens
        self.bytes = {r: b for b, r in tokens.items()}
        self.longest = max(map(len, tokens), default=0)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, bool], list[int]] = {}
        self.pairs: dict[int, bool] = {}
        #: Tokens that merging their own bytes gives (only they can be part of an encoding),
        #: and -1 for other endings of such tokens.
        usable = {b: r for b, r in tokens.items() if len(b) == 1 or self.halves(r)}
        self.ends = {b[n:]: -1 for b in usable for n in range(1, len(b))} | usable

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for a byte or if none does."""
        if token not in self._halves:
            parts = [self.rank[bytes([b])] for b in self.bytes[token]]
            while len(parts) > 2:
                merged = [
                    self.rank.get(self.bytes[a] + self.bytes[b], _NEVER)
                    for a, b in zip(parts, parts[1:], strict=False)
                ]
                at = min(range(len(merged)), key=merged.__getitem__)
                if merged[at] >= token:
                    break
                parts[at : at + 2] = [merged[at]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def ending(self, data: bytes, end: int) -> list[tuple[int, int]]:
        """(start, token) of the tokens that end at ``end``, the longest first."""
        found, get = [], self.ends.get
        start = end - 1
        while start >= 0:
            token = get(data[start:end])
            if token is None:
                break
            if token >= 0:
                found.append((start, token))
            start -= 1
        return found[::-1]

    def extend(self, last: list[int], data: bytes, whole: bool = True) -> None:
        """Lengthen ``last``, the last tokens of the first prefixes of ``data``, to all of it.

        The last token of a prefix is the one that ends there and may follow the last token of
        the prefix before it; there is exactly one. Unless ``data`` is the ``whole`` string, it
        starts as many bytes before the first new one as the longest token has.
        """
        for end in range(len(last) + 1, len(data) + 1):
            for start, token in self.ending(data, end):
                if start:
                    fits = self.side_by_side(last[start - 1], token)
                else:
                    fits = whole
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")

    def split(self, last: list[int]) -> list[int]:
        """The tokens of a whole string, from the last tokens of its prefixes."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[last[end - 1]])
        return out[::-1]

    def edge(self, token: int, right: bool) -> list[int]:
        """The tokens that stand at an edge of ``token`` while it is built, byte first."""
        key = (token, right)
        if key not in self._edges:
            chain, step = [token], self.halves(token)
            while step is not None:
                chain.append(step[right])
                step = self.halves(step[right])
            self._edges[key] = chain[::-1]
        return self._edges[key]

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both gives just these two tokens."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        a, b = self.edge(left, True), self.edge(right, False)
        i = j = 0
        while True:
            next_a = a[i + 1] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1] if j + 1 < len(b) else _NEVER
            across = self.rank.get(self.bytes[a[i]] + self.bytes[b[j]], _NEVER)
            # of equal ranks, the merge further left comes first
            if across < next_a and across <= next_b:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class PrefixEncoder:
    """The encoding of a growing byte string, by the last token of each of its prefixes.

    For every prefix exactly one token can be the last of its encoding: the one that ends
    there and may follow the last token of the prefix before it. So bytes can be appended
    without looking back further than the longest token, and after an edit only prefixes from
    the edit on are done again.
    """

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks = ranks
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def _window(self, at: int) -> tuple[int, list[int]]:
        """Where the bytes start that decide the tokens from prefix ``at`` on, and the last tokens
        of the prefixes from there up to ``at``: one byte more than the longest token has."""
        low = max(0, at - self.ranks.longest - 1)
        return low, self.last[low:at]

    def append(self, more: bytes) -> None:
        """Add bytes at the end. The text before the longest token's length isn't looked at."""
        at = len(self.last)
        low, window = self._window(at)
        self.ranks.extend(window, bytes(self.data[low:]) + more, low == 0)
        self.data += more
        self.last += window[at - low :]

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Exchange ``data[start:end]``; prefixes before the edit keep their tokens.

        Past the edit, prefixes are done again until as many in a row as the longest token has
        bytes agree with the old ones; from there on the old ones hold and are moved as they are.
        """
        low, window = self._window(start)
        before, shift = start - low, len(new) - (end - start)
        self.data[start:end] = new
        self.ranks.extend(window, bytes(self.data[low : start + len(new)]), low == 0)
        agree, at = 0, start + len(new)
        while at < len(self.data) and agree <= self.ranks.longest:
            near = max(0, at - self.ranks.longest - 1 - low)
            tokens = window[near:]
            self.ranks.extend(tokens, bytes(self.data[low + near : at + 1]), low + near == 0)
            window.append(tokens[-1])
            agree = agree + 1 if tokens[-1] == self.last[at - shift] else 0
            at += 1
        self.last[start : at - shift] = window[before:]

    def tokens(self) -> list[int]:
        return self.ranks.split(self.last)


class ByteBpe:
    """Text to ids and back. Pieces, the matches of the pattern, are encoded one by one; a
    piece that is a token is that token."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        self.ranks = Ranks(tokens)
        self.splitter = Splitter(pattern)
        self._last = Remembered(self._last_token, _REMEMBERED_PREFIXES)
        self._pieces = Remembered(self._encode_piece, REMEMBERED)

    def _encode_piece(self, piece: str) -> bytes:
        data, ranks = piece.encode("utf-8"), self.ranks
        token = ranks.rank.get(data)
        if token is not None:
            return array("I", [token]).tobytes()
        if len(data) > _WORD_BYTES:
            return array("I", PrefixEncoder(ranks, data).tokens()).tobytes()
        ids = []
        while data:
            token = self._last[data]
            ids.append(token)
            data = data[: -len(ranks.bytes[token])]
        return array("I", ids[::-1]).tobytes()

    def _last_token(self, data: bytes) -> int:
        """The last token of a prefix. Words share their beginnings, so the prefix before the
        token is mostly known from another word."""
        ranks = self.ranks
        for start, token in ranks.ending(data, len(data)):
            if not start or ranks.side_by_side(self._last[data[:start]], token):
                return token
        raise ValueError("the vocabulary lacks a byte of the text")

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for null."""
        return b"".join(map(self._pieces.__getitem__, self.splitter.split(text))) if text else b""

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


@kept_by("byte_bpe")
@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    """One per Python worker and vocabulary, until another operator's tasks come."""
    return ByteBpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document (``doc_id``, ``text``): ``ids``, the bytes of its token ids.

    Null and empty texts have no ids. Every row gives a row, repeated ones too. The vocabulary
    file must lie at ``ranks_path`` on every machine.
    """
    importable(docs.sparkSession)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("byte_bpe")
        bpe = tokenizer(ranks_path, pattern)
        for rows in small_slices(batches):
            ids = [bpe.encode(t) for t in rows.column("text").to_pylist()]
            yield pa.record_batch([rows.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``ids`` back to ``data``, the bytes of the text; null ids give no bytes."""
    importable(encoded.sparkSession)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("byte_bpe")
        bpe = tokenizer(ranks_path, pattern)
        for rows in small_slices(batches, "ids"):
            data = [bpe.decode(i or b"") for i in rows.column("ids").to_pylist()]
            yield pa.record_batch([rows.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode every document, decode its ids, and return the ids and the digests of both.

    Columns doc_id, n_tokens, ids_sha256, decoded_sha256, ids. All happen in one pass over
    a slice of rows. Null and empty texts have no ids; every row gives a row.
    """
    importable(docs.sparkSession)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables_of_others("byte_bpe")
        bpe = tokenizer(ranks_path, pattern)
        for rows in small_slices(batches):
            ids = [bpe.encode(text) for text in rows.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    rows.column("doc_id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    return id_and_text(docs).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
    )

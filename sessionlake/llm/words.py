"""Words of many texts at once, as Arrow and numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts, one after the other, and where each text's words start and end.

    Words are what ASCII white space separates, unchanged. Null, empty and blank texts have none.
    The words of text ``i`` are those from ``bounds[i]`` on, up to ``bounds[i + 1]``.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = pc.list_flatten(lists)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    there = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return before[ends].astype(np.int64), flat.filter(there)


def join_words(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """One text for each stretch of words, joined by one space."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), " ")


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word as the number of its spelling, and the spellings."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

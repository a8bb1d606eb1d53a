"""Words of whole texts as byte ranges and codes, by array operations."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

LINE_END = 0x0A


class Words(NamedTuple):
    data: np.ndarray      # bytes of all texts, a line end after each
    start: np.ndarray     # first byte of every word
    end: np.ndarray       # byte after it, never part of a word
    doc: np.ndarray       # text that holds the word
    piece: np.ndarray     # number of stop bytes before the word
    code: np.ndarray      # number of the word in ``kinds``
    kinds: pa.Array       # the distinct words, binary


def byte_words(texts: pa.Array, gaps: bytes, stops: bytes = b"", lower: bool = False) -> Words:
    """The words of ``texts`` (null: none) in order.

    A word is a longest stretch without a byte of ``gaps`` or ``stops``, one of
    which holds the line end; all are ASCII, so no character is cut.  ``lower``
    turns A-Z to a-z first.  Words with equal ``piece`` have no stop and no end
    of text between them if the line end is a stop.
    """
    rows = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
    blob = b"".join(x for t in rows for x in (t, b"\n"))
    data = np.frombuffer(blob.lower() if lower else blob, np.uint8)
    kind = np.zeros(256, np.int8)
    kind[list(gaps)] = 1
    kind[list(stops)] = 2
    of_byte = kind[data]
    inside = of_byte == 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.r_[0, edge]
    start, end = edge[::2], edge[1::2]
    bounds = np.cumsum([len(t) + 1 for t in rows])
    doc = np.repeat(np.arange(len(rows)), np.diff(np.r_[0, np.searchsorted(start, bounds)]))
    piece = np.cumsum(of_byte == 2, dtype=np.int64)[start] if stops else np.zeros(len(start), np.int64)
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    return Words(data, start, end, doc, piece, coded.indices.to_numpy(False).astype(np.int64), coded.dictionary)

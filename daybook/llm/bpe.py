"""Byte-level BPE encoding and decoding by merge replay.

A task takes its documents in pieces of bounded size, cuts them into segments
(white space plus the run after it) and collects the distinct segments it has
not met yet.  Their pattern matches become one flat token sequence with the rank
of every adjacent pair.  Words are independent of each other, so one step merges,
in every word that is still open, all places of the word's own lowest-ranked pair
and looks up again only the neighbours a merge has touched.  There is no index
over the whole corpus: a segment is encoded once per worker and piece, and
documents are put together from the segments' stored ids and decoded bytes.

Only the vocabulary file and a bounded table of segments are held per worker;
nothing is shuffled, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, text_of

# The code points with Unicode's White_Space property.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"
# No match of the pattern runs from a visible character into white space, so
# segments can be matched one by one.
SEGMENT = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
SEGMENTS_HELD = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """A ``.tiktoken`` file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codes(dict):
    """Numbers keys in the order in which they are first met."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class PairIndex:
    """Rank of a pair of token ids; the merged token's id is its rank."""

    NONE = np.int64(1 << 40)

    def __init__(self, merged: dict[tuple[int, int], int]):
        keys = np.array([(a << 32) | b for a, b in merged], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array(list(merged.values()), np.int64)[order]

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int]) -> PairIndex:
        """Any two tokens whose bytes, put together, are a token are a pair."""
        merged = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    merged[a, b] = rank
        return cls(merged)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)


def replay_merges(ids: np.ndarray, word: np.ndarray, pairs: PairIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the flat tokens ``ids`` of the words numbered in ``word``
    (ascending); returns the ids and word numbers left, and the words for which
    a merge made a pair of a lower rank (their order needs ``merge_one``)."""
    none, done, odd = pairs.NONE, [], []
    ids, word = ids.astype(np.int64), word.astype(np.int64)
    rank = np.full(len(ids), none)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner] = pairs.look_up(ids[inner], ids[inner + 1])
    while len(ids):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, first)
        length = np.diff(np.r_[first, len(ids)])
        low = np.repeat(lowest, length)
        rest = low < none
        if not rest.all():         # words without a pair are ready
            done.append((ids[~rest], word[~rest]))
            ids, word, rank, low = ids[rest], word[rest], rank[rest], low[rest]
            if not len(ids):
                break
        hit = rank == low
        both = hit[1:] & hit[:-1]
        if both.any():             # overlapping places: every second of a run, from the left
            at = np.arange(len(hit))
            begin = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, 0))
            hit &= (at - begin) % 2 == 0
        at = np.flatnonzero(hit)
        ids[at] = rank[at]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, word, rank = ids[keep], word[keep], rank[keep]
        at -= np.arange(len(at))
        new = ids[at]
        for near in (at, at - 1):  # only touched neighbours are looked up again
            right = np.minimum(near + 1, len(ids) - 1)
            inside = (near >= 0) & (right > near) & (word[near] == word[right])
            inside &= (word[near] == word[at])
            found = np.full(len(at), none)
            found[inside] = pairs.look_up(ids[near[inside]], ids[right[inside]])
            mine = (near >= 0) & (word[near] == word[at])
            rank[near[mine]] = found[mine]
            odd.append(word[at[found < new]])
    if not done:
        return ids, word, np.array([], np.int64)
    ids, word = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    return ids[order], word[order], np.unique(np.concatenate(odd)) if odd else np.array([], np.int64)


def merge_one(ids: list[int], merged) -> list[int]:
    """BPE of one word, lowest rank first and leftmost first, step by step;
    ``merged(a, b)`` is the pair's rank or None."""
    ids = list(ids)
    while len(ids) > 1:
        found = [(r, at) for at, (a, b) in enumerate(zip(ids, ids[1:])) if (r := merged(a, b)) is not None]
        if not found:
            break
        rank, at = min(found)
        ids[at:at + 2] = [rank]
    return ids


class MergeReplay:
    """Encoder and decoder with a bounded table of the segments met so far."""

    def __init__(self, path: str, pattern: str, held: int = SEGMENTS_HELD):
        self.ranks = load_ranks(path)
        self.names = [b""] * (max(self.ranks.values()) + 1)
        for name, rank in self.ranks.items():
            self.names[rank] = name
        self.pairs = PairIndex.of_ranks(self.ranks)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pattern, self.held = regex.compile(pattern), held
        self.codes = Codes()                   # segment -> number
        self.ids: list[str] = []               # by number: ids in decimal, joined by spaces
        self.plain: list[bytes] = []           # by number: bytes decoded from those ids

    def rank_of(self, a: int, b: int) -> int | None:
        return self.ranks.get(self.names[a] + self.names[b])

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every pattern match; one that is a token stays whole."""
        out = [[self.ranks[w]] if w in self.ranks else None for w in words]
        left = [n for n, found in enumerate(out) if found is None]
        lengths = [len(words[n]) for n in left]
        ids = self.bytes[np.frombuffer(b"".join([words[n] for n in left]), np.uint8)]
        ids, word, odd = replay_merges(ids, np.repeat(np.arange(len(left)), lengths), self.pairs)
        ends = np.searchsorted(word, np.arange(len(left)), "right").tolist()
        ids, start = ids.tolist(), 0
        for n, end in zip(left, ends):
            out[n], start = ids[start:end], end
        for n in odd.tolist():
            out[left[n]] = merge_one([self.ranks[bytes([b])] for b in words[left[n]]], self.rank_of)
        return out

    def learn(self) -> None:
        """Encode the segments that were numbered since the last call."""
        new = list(self.codes)[len(self.ids):] if len(self.codes) > len(self.ids) else []
        matches = [self.pattern.findall(s) for s in new]
        words = list(dict.fromkeys(w for found in matches for w in found))
        ids = dict(zip(words, self.encode_words([w.encode() for w in words])))
        for found in matches:
            all_ids = [i for w in found for i in ids[w]] if len(found) > 1 else ids[found[0]]
            self.ids.append(" ".join(map(str, all_ids)))
            self.plain.append(self.decode(all_ids))

    def number(self, texts: list[str]) -> list[array]:
        """Numbers of every text's segments; their encodings are known after."""
        if len(self.codes) > self.held:
            self.codes.clear()
            self.ids.clear()
            self.plain.clear()
        out = [array("l", map(self.codes.__getitem__, SEGMENT.findall(t))) for t in texts]
        self.learn()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.names[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return [int(i) for n in self.number([text])[0] for i in self.ids[n].split()]

    def digest(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(token count, sha256 of the ids, sha256 of the decoded bytes) per text."""
        for numbers in self.number(texts):
            ids = " ".join(map(self.ids.__getitem__, numbers))
            yield (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                   hashlib.sha256(b"".join(map(self.plain.__getitem__, numbers))).hexdigest())


@lru_cache(maxsize=2)
def replayer(path: str, pattern: str) -> MergeReplay:
    """One per Python worker, kept from task to task."""
    return MergeReplay(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256, and with
    ``with_ids`` the token ids and the decoded text.

    ``path`` names a ``.tiktoken`` file that every executor can open.  Null
    counts as empty; an empty text has no tokens.  Special tokens are ordinary
    text.  Rows repeat as they come; extra columns are not read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = rows.select("id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = replayer(path, pattern)
        for part in chunks(batches, max_bytes=4 << 20):
            texts = part.column("text").to_pylist()
            found = list(replay.digest(texts))
            out = [part.column("id"), pa.array([x[0] for x in found], pa.int64()),
                   pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.string())]
            if with_ids:
                ids = [replay.encode(t) for t in texts]
                out += [pa.array(ids, pa.list_(pa.int32())), pa.array([replay.decode(x).decode() for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

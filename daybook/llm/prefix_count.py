"""Token counts by prefix dynamic programming, for a BPE with word ends.

A word's encoding is found from left to right: the last token of the prefix of
length i is the one vocabulary entry t that ends there and that the last token
of the prefix of length i - |t| tolerates on its right (encoding the two side
by side gives just the two).  So one pass over a word yields the last token and
the token count of *every* prefix, each in two forms: open (the word goes on)
and closed (the text is cut here, so the word ends here).  A document's counts
are running sums over its words, and the count at any cut is one of those sums
plus one stored closed count: truncation and budget questions need no further
encoding.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SEGMENT, Codes, PairIndex
from .common import chunks, text_of

SEGMENTS_HELD = 250_000
# Words up to this many byte letters share one vectorised pass.
SHORT = 64


class Border:
    """Which tokens tolerate each other, from the merges alone.

    Token ids follow merge order, so undoing the later-made of the two tokens at
    a border, again and again, runs back through time; the border holds if no
    pair that ever stood there has a merge that comes before its end."""

    def __init__(self, merges: list[tuple[int, int]], base: int):
        self.base = base
        parts = np.array([(n, n) for n in range(base)] + merges, np.int64)
        self.left, self.right = parts[:, 0].copy(), parts[:, 1].copy()
        self.pairs = PairIndex({pair: base + n for n, pair in enumerate(merges)})
        made = np.arange(base, base + len(merges))
        holds = self.hold(self.left[made], self.right[made], made)
        self.stands = np.ones(base + len(merges), bool)   # tokens that encode to themselves
        for n, (pair, ok) in enumerate(zip(merges, holds.tolist())):
            self.stands[base + n] = ok and self.stands[pair[0]] and self.stands[pair[1]]

    def hold(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        a, b, ok = a.copy(), b.copy(), np.ones(len(a), bool)
        limit = np.full(len(a), PairIndex.NONE) if limit is None else limit.copy()
        left = np.arange(len(a))
        while len(left):
            broken = self.pairs.look_up(a[left], b[left]) < limit[left]
            ok[left[broken]] = False
            left = left[~broken]
            left = left[np.maximum(a[left], b[left]) >= self.base]
            x, y = a[left], b[left]
            first = x > y
            limit[left] = np.where(first, x, y + 1)
            a[left] = np.where(first, self.right[x], x)
            b[left] = np.where(first, y, self.left[y])
        return ok


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 letters stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


class PrefixCounter:
    """Counts for a ``tokenizers`` file: BPE with word ends, byte letters, NFC,
    lower case, a removal pattern, and special strings matched in raw text."""

    def __init__(self, path: str, held: int = SEGMENTS_HELD):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end, self.vocab, self.held = model["end_of_word_suffix"], model["vocab"], held
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: n for n, pair in enumerate(pairs)}
        base = len(self.vocab) - len(pairs) - len([t for t in spec["added_tokens"] if t["content"] in self.vocab])
        if any(self.vocab[a + b] != base + n for n, (a, b) in enumerate(pairs)):
            raise ValueError(f"{path}: token ids do not follow merge order")
        self.border = Border([(self.vocab[a], self.vocab[b]) for a, b in pairs], base)
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocab)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"])) if spec["added_tokens"] else None
        self.marks = {t["content"][0] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        self.tolerates: dict[tuple[str, str], bool] = {}
        self.codes = Codes()                 # segment -> number
        self.totals: list[int] = []          # by number: token count
        self.letter_id = np.array([self.vocab[self.letters[b]] for b in range(256)], np.int64)
        names = [(t, n) for t, n in self.vocab.items() if n < len(self.border.stands) and self.border.stands[n]]
        self.open = self.token_table([(t, n) for t, n in names if not t.endswith(self.end)])
        self.closed = self.token_table([(t[:-len(self.end)], n) for t, n in names if t.endswith(self.end)])
        self.prefixes: dict[str, tuple[int, ...]] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE of a few symbols; decides which tokens tolerate each other."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: self.rank.get(p, 1 << 30))
            if best not in self.rank:
                break
            out, at = [], 0
            while at < len(symbols):
                if at + 1 < len(symbols) and (symbols[at], symbols[at + 1]) == best:
                    out.append(symbols[at] + symbols[at + 1])
                    at += 2
                else:
                    out.append(symbols[at])
                    at += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and token != self.end:
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def fits(self, left: str, right: str) -> bool:
        """Whether encoding the two tokens side by side gives just the two."""
        key = (left, right)
        known = self.tolerates.get(key)
        if known is None:
            known = self.tolerates[key] = self.merge(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    def closed_counts(self, letters: str) -> list[int]:
        """Token count of every prefix of a word given in byte letters, each cut
        as the end of the word; one left-to-right pass."""
        last, count, closed = [""], [0], [0]
        vocab, end, fits = self.vocab, self.end, self.fits
        for stop in range(1, len(letters) + 1):
            found = [False, False]
            for start in range(max(0, stop - self.longest), stop):
                token = letters[start:stop]
                if not found[0] and token in vocab and self.stands(token) and (not start or fits(last[start], token)):
                    last.append(token)
                    count.append(count[start] + 1)
                    found[0] = True
                if not found[1] and (token + end) in vocab and self.stands(token + end) and (not start or fits(last[start], token + end)):
                    closed.append(count[start] + 1)
                    found[1] = True
                if all(found):
                    break
        return closed

    def stands(self, token: str) -> bool:
        """Whether a token encodes to itself."""
        key = (token, "")
        known = self.tolerates.get(key)
        if known is None:
            known = self.tolerates[key] = self.merge(self.symbols(token)) == [token]
        return known

    def words(self, segment: str) -> list[str]:
        """The pieces of normalised text that are encoded one by one."""
        text = unicodedata.normalize("NFC", segment).replace("Σ", "σ").lower()
        return self.pattern.findall(text)

    def segment_counts(self, segment: str) -> tuple[int, ...]:
        """Token count of every prefix, in code points, of one segment (white
        space and the run after it)."""
        known = self.prefixes.get(segment)
        if known is not None:
            return known
        body = segment.lower()
        simple = "'" not in segment and "Σ" not in segment and len(body) == len(segment) \
            and unicodedata.is_normalized("NFC", segment) and not (self.special and self.special.search(segment))
        if not simple:             # a cut may change how the rest is split or normalised
            known = tuple(self.text_count(segment[:n]) for n in range(len(segment) + 1))
        else:
            out, done, at = [0], 0, 0
            for match in self.pattern.finditer(body):
                out += [done] * (match.start() - at)
                letters, stops = [], []
                for ch in match[0]:
                    letters += [self.letters[b] for b in ch.encode()]
                    stops.append(len(letters))
                counts = self.closed_counts("".join(letters))
                out += [done + counts[s] for s in stops]
                done, at = out[-1], match.end()
            known = tuple(out + [done] * (len(segment) - at))
        self.prefixes[segment] = known
        return known

    def segments(self, text: str) -> list[str]:
        """Segments in order; special strings are segments of their own."""
        if self.special is None or not self.special.search(text):
            return SEGMENT.findall(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            out += [*SEGMENT.findall(text[at:match.start()]), match[0]]
            at = match.end()
        return out + SEGMENT.findall(text[at:])

    @staticmethod
    def powers(n: int) -> np.ndarray:
        """Powers of an odd 64-bit multiplier, for hashes of substrings."""
        with np.errstate(over="ignore"):
            return np.cumprod(np.r_[np.uint64(1), np.full(n, 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)

    def token_table(self, names: list[tuple[str, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """By token length in letters: sorted hashes and the tokens' ids."""
        number = {letter: b for b, letter in self.letters.items()}
        by_length: list[list[tuple[int, int]]] = [[] for _ in range(self.longest + 1)]
        power = [int(x) for x in self.powers(self.longest)]
        for name, n in names:
            h = sum((number[ch] + 1) * power[at] for at, ch in enumerate(name)) % (1 << 64)
            by_length[len(name)].append((h, n))
        return [(np.array([h for h, _ in x], np.uint64), np.array([n for _, n in x], np.int64)) for x in map(sorted, by_length)]

    def word_counts(self, words: list[bytes]) -> list[int]:
        """Token counts of whole words: the pass of ``closed_counts`` over all
        words at once, one prefix length after the other."""
        totals = np.zeros(len(words), np.int64)
        for n, w in enumerate(words):
            if len(w) > SHORT:
                totals[n] = self.closed_counts("".join(map(self.letters.__getitem__, w)))[-1]
        short = np.array([n for n, w in enumerate(words) if 0 < len(w) <= SHORT], np.int64)
        if not len(short):
            return totals.tolist()
        lengths = np.array([len(words[n]) for n in short])
        short, lengths = short[order := np.argsort(-lengths, kind="stable")], lengths[order]
        flat = np.frombuffer(b"".join([words[n] for n in short]), np.uint8)
        begin = np.r_[0, np.cumsum(lengths)[:-1]]
        column = np.arange(len(flat)) - np.repeat(begin, lengths)
        power = self.powers(SHORT)
        with np.errstate(over="ignore"):
            run = np.r_[np.uint64(0), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[column], dtype=np.uint64)]
        inverse = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        back = np.cumprod(np.r_[np.uint64(1), np.full(SHORT, inverse, np.uint64)], dtype=np.uint64)
        last, count = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)

        def step(which: np.ndarray, stop: int, table) -> tuple[np.ndarray, np.ndarray]:
            """Last token and count of the prefixes of length ``stop``."""
            token, n = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
            left = np.arange(len(which))
            for size in range(min(stop, self.longest), 0, -1):
                hashes, ids = table[size]
                if not len(left):
                    break
                if not len(hashes):
                    continue
                at = begin[which[left]] + stop
                with np.errstate(over="ignore"):
                    h = (run[at] - run[at - size]) * back[stop - size]
                near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                known = hashes[near] == h
                found, ids, at = left[known], ids[near[known]], at[known]
                if size < stop:
                    fits = self.border.hold(last[at - size - 1], ids)
                    found, ids, at = found[fits], ids[fits], at[fits]
                    n[found] = count[at - size - 1] + 1
                else:
                    n[found] = 1
                token[found] = ids
                left = left[n[left] == 0]
            return token, n

        for stop in range(1, int(lengths[0]) + 1):
            ends = np.searchsorted(-lengths, -stop, "left"), np.searchsorted(-lengths, -stop, "right")
            going = np.arange(ends[0])       # longer words: the prefix is open
            at = begin[going] + stop - 1
            last[at], count[at] = step(going, stop, self.open)
            if ends[0] < ends[1]:            # words of this length: closed
                here = np.arange(*ends)
                totals[short[here]] = step(here, stop, self.closed)[1]
        return totals.tolist()

    def learn(self) -> None:
        """Count the segments that were numbered since the last call."""
        new = list(self.codes)[len(self.totals):] if len(self.codes) > len(self.totals) else []
        pieces = [None if s[0] in self.marks and self.special.fullmatch(s) else self.words(s) for s in new]
        words = list(dict.fromkeys(w for found in pieces if found for w in found))
        counts = dict(zip(words, self.word_counts([w.encode() for w in words])))
        self.totals += [1 if found is None else sum([counts[w] for w in found]) for found in pieces]

    def number(self, texts: list[str]) -> list[array]:
        """Numbers of every text's segments; all are counted after."""
        if len(self.codes) > self.held:
            self.codes.clear()
            self.totals.clear()
        if len(self.prefixes) > self.held // 4:
            self.prefixes.clear()
        if len(self.tolerates) > 4 * self.held:
            self.tolerates.clear()
        out = [array("l", map(self.codes.__getitem__, self.segments(t))) for t in texts]
        self.learn()
        return out

    def text_count(self, text: str) -> int:
        return sum(map(self.totals.__getitem__, self.number([text])[0]))

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of every prefix of a text: entry n is that of text[:n]."""
        out = [0]
        for segment in self.segments(text):
            if self.special and self.special.fullmatch(segment):
                inside = [self.text_count(segment[:n]) for n in range(1, len(segment))] + [1]
            else:
                inside = self.segment_counts(segment)[1:]
            base = out[-1]
            out += [base + n for n in inside]
        return out

    def cut_at(self, segments: list[str], sums: list[int], budget: int) -> int:
        """Code points in the longest prefix whose segments end within
        ``budget`` tokens or that ends inside the first segment beyond it; read
        from stored counts."""
        whole = int(np.searchsorted(np.asarray(sums), budget, "right"))
        length = sum(map(len, segments[:whole]))
        if whole == len(segments):
            return length
        rest = budget - (sums[whole - 1] if whole else 0)
        inside = self.segment_counts(segments[whole]) if not (self.special and self.special.fullmatch(segments[whole])) else (0,)
        return length + max(n for n, count in enumerate(inside) if count <= rest)


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One per Python worker, kept from task to task."""
    return PrefixCounter(path)


def count_documents(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
                    prefixes: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, limit_chars
    (code points of the text that fit in ``limit`` tokens), and with
    ``prefixes`` the count at every prefix.

    ``path`` names a ``tokenizers`` file that every executor can open.  Null
    counts as empty; an empty text has 0 tokens and its single prefix count 0.
    Rows repeat as they come; extra columns are not read; an empty table gives
    an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"),
                       text_of(text_col).alias("text"))
    schema = rows.select("id", "n_bytes").schema.add("n_tokens", "long").add("over_limit", "boolean").add("limit_chars", "long")
    if prefixes:
        schema = schema.add("prefix_counts", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(path)
        for part in chunks(batches, max_bytes=16 << 20):
            texts = part.column("text").to_pylist()
            totals, chars = [], []
            for text, numbers in zip(texts, counter.number(texts)):
                counts = list(map(counter.totals.__getitem__, numbers))
                totals.append(sum(counts))
                chars.append(len(text) if totals[-1] <= limit else counter.cut_at(counter.segments(text), list(accumulate(counts)), limit))
            n = pa.array(totals, pa.int64())
            out = [part.column("id"), part.column("n_bytes"), n,
                   pa.array([x > limit for x in totals], pa.bool_()), pa.array(chars, pa.int64())]
            if prefixes:
                out.append(pa.array([counter.prefix_counts(t) for t in texts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

"""Collocations: phrases of two to five words that come together far more often
than their parts make likely.

Spark counts the words of every language.  The texts are then stored once as
numbers of their frequent words, 0 wherever a phrase cannot pass (the end of a
piece, a word that is too rare).  Level by level, positions whose phrase of k - 1
words is frequent, and whose next position's is too, are the Apriori-safe
candidates of k words: the states of all positions advance together through a
broadcast double-array trie of the frequent phrases, and (state, next word) pairs
are counted per piece and summed by Spark.  Only candidates that occur are looked
at; products of frequent parts are never formed.  A last pass sends all positions
through the trie of all candidates that are left, counts accepting states by
``bincount`` and sums the counts of all tasks, which gives every phrase's
frequency.

A trie holds at most ``MOST_NODES`` phrases; more are split by first word into
several tries, each with a pass of its own.  Broadcast are 8 bytes a frequent
word (one that occurs ``least`` times; words are told apart by 64-bit hashes that
are checked for equal ones) and a trie's two arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, staged, text_of
from .words import byte_words

GAPS, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
LONGEST, LEAST = 5, 100
MOST_NODES = 2_000_000
NO_LANGUAGE = "und"
TEXT_BYTES = 1 << 19          # of a piece of texts; a worker keeps what its largest piece took
ROW_WORDS = 256               # of a stored row, so that an Arrow batch of rows is small
ROWS_AT_ONCE = 1000           # stored rows that are counted together
SHARDS_PER_CORE = 1


class Trie(NamedTuple):
    """Double array: the child of state s by word w is base[s] + w if that
    cell's ``check`` is s.  A word's own state is its number."""
    base: np.ndarray
    check: np.ndarray
    node: np.ndarray          # phrase number of every cell, -1: none


class Phrases(NamedTuple):
    """Phrases of two words or more: phrase i is phrase ``parent[i]`` (a number
    below ``words`` + 1: that word; else phrase parent - words - 1) and then
    ``word[i]``."""
    words: int
    parent: np.ndarray
    word: np.ndarray

    def depth(self) -> np.ndarray:
        out = np.full(len(self.word), 2)
        for i in np.flatnonzero(self.parent > self.words):     # parents come first
            out[i] = out[self.parent[i] - self.words - 1] + 1
        return out

    def first_word(self) -> np.ndarray:
        out = self.parent.copy()
        while (deep := out > self.words).any():
            out[deep] = self.parent[out[deep] - self.words - 1]
        return out


def build_trie(phrases: Phrases, chosen: np.ndarray) -> Trie:
    """The chosen phrases (prefixes of a chosen one are chosen) in one double
    array: parents with many children first, each at a place where all of its
    children's cells are free; only children fill the gaps."""
    words, n = phrases.words, len(chosen)
    order = chosen[np.lexsort((phrases.word[chosen], phrases.parent[chosen]))]
    head = np.flatnonzero(np.r_[True, phrases.parent[order][1:] != phrases.parent[order][:-1]]) if n else np.zeros(0, int)
    size = np.diff(np.r_[head, n])
    free = np.ones(2 * words + 2 + 4 * n, bool)
    free[:words + 1] = False
    cell_of = np.zeros(words + 1 + len(phrases.word), np.int64)       # by node: words, then phrases
    cell_of[:words + 1] = np.arange(words + 1)
    base_of = np.zeros(len(head), np.int64)
    spread = np.random.default_rng(0)
    by_size = np.argsort(-size, kind="stable")
    for g in by_size[:np.count_nonzero(size > 1)]:
        children = order[head[g]:head[g] + size[g]]
        w = phrases.word[children]
        while True:
            tries = spread.integers(words + 1 - w[0], len(free) - w[-1], 128)
            fits = free[tries[:, None] + w].all(1)
            if fits.any():
                break
            free = np.r_[free, np.ones(len(free) // 2, bool)]
        base_of[g] = tries[fits.argmax()]
        free[base_of[g] + w] = False
        cell_of[words + 1 + children] = base_of[g] + w
    single = by_size[np.count_nonzero(size > 1):]
    cells = np.flatnonzero(free)[:len(single)]
    free[cells] = False
    cell_of[words + 1 + order[head[single]]] = cells
    base_of[single] = cells - phrases.word[order[head[single]]]
    used = len(free) - free[::-1].argmin() + 1         # the last cell stays empty: states() clips to it
    base, check, node = np.zeros(used, np.int32), np.full(used, -1, np.int32), np.full(used, -1, np.int64)
    base[cell_of[phrases.parent[order[head]]]] = base_of
    check[cell_of[words + 1 + order]] = cell_of[phrases.parent[order]]
    node[cell_of[words + 1 + order]] = order
    return Trie(base, check, node)


def tries(phrases: Phrases, most: int) -> Iterator[Trie]:
    """Tries of at most ``most`` phrases that together hold all of them; the
    phrases that start with one word share a trie."""
    if len(phrases.word) <= most:
        yield build_trie(phrases, np.arange(len(phrases.word)))
        return
    first = phrases.first_word()
    sizes = np.bincount(first, minlength=phrases.words + 1)
    group, room = np.zeros(len(sizes), np.int64), most
    for w, n in enumerate(sizes):
        if n > room:
            group[w:] += 1
            room = most
        room -= n
    for g in np.unique(group[first]):
        yield build_trie(phrases, np.flatnonzero(group[first] == g))


def states(codes: np.ndarray, depth: int, base: np.ndarray, check: np.ndarray) -> list[np.ndarray]:
    """For 1 .. depth words the trie state of every position, 0 where the words
    from there on are no phrase of the trie."""
    out = [codes]
    for k in range(1, depth):
        s = out[-1][:-1]
        t = np.clip(base[s] + codes[k:], 0, len(check) - 1)
        out.append(np.where((check[t] == s) & (s > 0), t, 0))
    return out


def word_key(lang: str, word: bytes, salt: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, salt) - (1 << 63)


def lang_words(part: pa.RecordBatch, salt: int):
    """(hash of every distinct (language, word) of a piece, language and word
    number of each, its number for every word, the words)."""
    words = byte_words(part.column("text"), GAPS, STOPS, lower=True)
    langs = part.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    mixed = langs.indices.to_numpy(False).astype(np.int64)[words.doc] * max(1, len(words.kinds)) + words.code
    kinds, number = np.unique(mixed, return_inverse=True)
    lang, word = np.divmod(kinds, max(1, len(words.kinds)))
    texts = words.kinds.take(pa.array(word)).to_pylist()
    keys = np.array([word_key(names[a], b, salt) for a, b in zip(lang.tolist(), texts)], np.int64)
    return keys, langs.dictionary.take(pa.array(lang)), texts, number, words


def count_words(rows: DataFrame, salt: int) -> DataFrame:
    """(key, lang, word, n) of every word of every language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=TEXT_BYTES):
            keys, langs, texts, number, _ = lang_words(part, salt)
            yield pa.RecordBatch.from_arrays([pa.array(keys), langs.cast(pa.utf8()), pa.array(texts, pa.binary()).cast(pa.utf8()),
                                              pa.array(np.bincount(number, minlength=len(keys)))], names=["key", "lang", "word", "n"])

    found = rows.mapInArrow(run, "key long, lang string, word string, n long")
    return staged(found.groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "collocation-words")


def store_codes(rows: DataFrame, keys: np.ndarray, salt: int) -> DataFrame:
    """The texts as int32 numbers (place in ``keys``, from 1) of their frequent
    words; 0 stands where no phrase passes.  A row holds about ``ROW_WORDS``
    numbers, more only where no 0 allows a cut, and ends in 0."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in chunks(batches, max_bytes=TEXT_BYTES):
            found, _, _, number, words = lang_words(part, salt)
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            code = np.where(known[place] == found, place + 1, 0)[number]
            cut = words.piece[1:] != words.piece[:-1]
            out = np.zeros(len(code) + np.count_nonzero(cut) + 1, np.int32)
            out[np.arange(len(code)) + np.r_[0, np.cumsum(cut)][:len(code)]] = code
            out = out[(out != 0) | np.r_[True, out[:-1] != 0]]
            zero = np.flatnonzero(out == 0)
            ends = zero[np.r_[zero[1:] // ROW_WORDS != zero[:-1] // ROW_WORDS, True]] + 1
            offsets = np.r_[0, ends * 4].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(out)])],
                                             names=["codes"])

    return staged(rows.mapInArrow(run, "codes binary"), "collocation-codes")


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers of ``ROWS_AT_ONCE`` stored rows each; every row ends in 0, so
    no phrase spans two."""
    for batch in batches:
        rows = batch.column("codes")
        for i in range(0, len(rows), ROWS_AT_ONCE):
            some = rows.slice(i, ROWS_AT_ONCE).cast(pa.large_binary())
            ends = np.frombuffer(some.buffers()[1], np.int64)[some.offset:some.offset + len(some) + 1]
            yield np.frombuffer(some.buffers()[2], np.int32)[ends[0] // 4:ends[-1] // 4]


def candidates(codes: DataFrame, trie: Trie, depth: int, whole: bool) -> DataFrame:
    """(state << 32 | word, n): how often every frequent phrase of ``depth``
    words is followed by a word.  ``whole``: the trie holds all frequent phrases,
    so the phrase of the next position must be one too."""
    shared = codes.sparkSession.sparkContext.broadcast((trie.base, trie.check))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, check = shared.value
        for w in pieces(batches):
            if len(w) <= depth:
                continue
            s = states(w, depth, base, check)[-1]
            follows = (s[:-1] > 0) & (s[1:] > 0 if whole else w[depth:] > 0)
            key, n = np.unique((s[:-1][follows].astype(np.int64) << 32) | w[depth:][follows], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])

    return codes.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequencies(codes: DataFrame, trie: Trie, depth: int) -> DataFrame:
    """(cell, n) of the trie's accepting states over all texts.

    A shard of the texts sends a row per cell, so there are no more shards than
    keep the cluster's cores busy: their number does not grow with the texts.
    """
    sc = codes.sparkSession.sparkContext
    shared = sc.broadcast((trie.base, trie.check))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, check = shared.value
        total = np.zeros(len(check), np.int64)
        for w in pieces(batches):
            for s in states(w, min(depth, len(w)), base, check)[1:]:
                total += np.bincount(s, minlength=len(total))
        total[0] = 0
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    shards = codes.coalesce(SHARDS_PER_CORE * sc.defaultParallelism)
    return shards.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def frequent_phrases(codes: DataFrame, keys: np.ndarray, least: int, longest: int, most: int) -> DataFrame:
    """(phrase: array of word keys, a) of the phrases of two words or more that
    occur ``least`` times."""
    spark = codes.sparkSession
    phrases = Phrases(len(keys), np.zeros(0, np.int64), np.zeros(0, np.int64))
    depth = 1
    for depth in range(1, longest):
        fresh_ones = []
        parts = tries(phrases, most) if depth > 1 else [build_trie(phrases, np.zeros(0, np.int64))]
        whole = depth == 1 or len(phrases.word) <= most
        for trie in parts:
            got = candidates(codes, trie, depth, whole).filter(F.col("n") >= least).select("key").toArrow()
            key = np.sort(got.column(0).to_numpy())
            state, word = key >> 32, key & 0xFFFFFFFF
            fresh_ones.append((state if depth == 1 else trie.node[state] + phrases.words + 1, word))
        parent, word = (np.concatenate(x) for x in zip(*fresh_ones))
        if not len(word):
            break
        phrases = Phrases(phrases.words, np.r_[phrases.parent, parent], np.r_[phrases.word, word])
    deepest = int(phrases.depth().max(initial=1))
    out = None
    for trie in tries(phrases, most):
        cell = np.flatnonzero(trie.node >= 0)
        spelled = [[] for _ in cell]
        at = trie.node[cell] + phrases.words + 1
        while len(live := np.flatnonzero(at > 0)):
            deep = at[live] > phrases.words
            number = np.where(deep, phrases.word[np.maximum(at[live] - phrases.words - 1, 0) if len(phrases.word) else at[live]], at[live])
            for i, x in zip(live.tolist(), keys[number - 1].tolist()):
                spelled[i].append(x)
            at[live] = np.where(deep, phrases.parent[np.maximum(at[live] - phrases.words - 1, 0)], 0)
        named = spark.createDataFrame(pa.table({"cell": cell, "phrase": pa.array([x[::-1] for x in spelled], pa.list_(pa.int64()))}))
        part = staged(named.join(frequencies(codes, trie, deepest), "cell").select("phrase", F.col("n").alias("a")), "collocation-phrases")
        out = part if out is None else out.union(part)
    return out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = 2000, absorb: int = 100,
                 text_col: str = "text", lang_col: str = "lang", most_nodes: int = MOST_NODES) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z.  n is the language's number of words, a the phrase's
    occurrences, l and r those of its parts at the cut whose score, floor(1000 *
    a * n / (l * r)), is lowest (ties: the first cut).  Candidates occur
    ``least`` times; those that lie in a longer candidate with ``absorb`` percent
    of their occurrences or more are dropped.  Ties in score go by a, then by
    the phrase's bytes.  Null texts count as empty, a null language as "und";
    repeated rows count as often as they occur, ids and extra columns are not
    read, and a table without phrases gives an empty result.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), text_of(text_col).alias("text"))
    salt = 0
    while True:
        counted = count_words(rows, salt)
        if counted.groupBy("key").count().filter("count > 1").isEmpty():
            break
        salt += 1                                    # two words with one hash
    often = counted.filter(F.col("n") >= least)
    keys = np.sort(often.select("key").toArrow().column(0).to_numpy())
    if not len(keys):
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    phrases = frequent_phrases(store_codes(rows, keys, salt), keys, least, longest, most_nodes)
    return ranked(phrases, often, counted.groupBy("lang").agg(F.sum("n").alias("_n")), top, absorb)


def ranked(phrases: DataFrame, often: DataFrame, totals: DataFrame, top: int, absorb: int) -> DataFrame:
    """Scores, absorbs and ranks the frequent phrases, in decimals of 38 digits."""
    size = F.size("phrase")
    known = phrases.unionByName(often.select(F.array("key").alias("phrase"), F.col("n").alias("a")))
    longer = phrases.filter(size > 2).select(F.explode(F.array(
        F.slice("phrase", 1, size - 1), F.slice("phrase", 2, size - 1))).alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("_longer"))
    kept = (phrases.join(longer, "phrase", "left").filter(F.col("_longer").isNull() | (100 * F.col("_longer") < absorb * F.col("a")))
            .select("phrase", "a"))
    words = often.select("key", F.col("lang").alias("_lang"), "word")
    spelled = (kept.select("phrase", F.posexplode("phrase").alias("_at", "key")).join(words, "key")
               .groupBy("phrase").agg(F.first("_lang").alias("lang"), F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
               .select("phrase", "lang", F.array_join(F.col("_words.word"), " ").alias("_text")))
    cuts = (kept.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .select("*", F.expr("slice(phrase, 1, k)").alias("_left"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("_right")))
    scored = (cuts.join(known.select(F.col("phrase").alias("_left"), F.col("a").alias("l")), "_left")
              .join(known.select(F.col("phrase").alias("_right"), F.col("a").alias("r")), "_right")
              .join(spelled, "phrase").join(totals, "lang")
              .withColumn("score", F.expr("CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(_n AS DECIMAL(38,0))"
                                          " DIV (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)))")))
    best = scored.groupBy("lang", "_text", "a", "_n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_best"))
    order = Window.partitionBy("lang").orderBy(F.desc("_best.score"), F.desc("a"), F.asc("_text"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), F.col("_text").alias("phrase"), "a",
                    F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), F.col("_n").alias("n"), F.col("_best.score").alias("score")))

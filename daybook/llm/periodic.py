"""Runs of periodic words by block convolution.

A run is a longest stretch of words whose smallest period q fits into it at
least ``LEAST_COPIES`` times, and at least ``LEAST_WORDS`` words long.  Periods
are found scale by scale: at scale B (8, 16, 32, ...) the texts are cut into
blocks of B words, and a run with a period in [B, 2B) holds a block that occurs
again one period later.  Where a block occurs in the window behind it shows the
sum of squared differences of word codes at all distances at once,

    sum (x - y)^2 = sum x^2 + sum y^2 - 2 * (correlation of x and y),

which is 0 exactly where no word differs.  The correlation comes from a
number-theoretic transform modulo ``PRIME``; a transform is a product with a
matrix of powers of a root of unity (in two factors where it is long), and
``float64`` holds those products exactly.  A zero modulo the prime may be a
chance, so a block's words are compared before its distance counts.  Distances
found are seeds: equal neighbours merge and are extended word by word as far as
the distance holds.

Inside a known run with a short period a block occurs at every multiple of that
period.  Such distances cannot seed a run with a larger smallest period and go
before any word is compared; of distances between two runs of equal short period
only those stay that map a border on a border.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import NON_SPACE_RUN, chunks, crc_fold, fresh, text_of
from .words import byte_words

RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))
GAPS = b" \t\n\x0b\x0c\r"
LEAST_WORDS, LEAST_COPIES = 24, 3
FIRST_SCALE = 8
# 7 * 2^20 + 1, with 3 as a generator: 128 products below its square add up
# below 2^53, and transforms may be 2^20 long.
PRIME, GENERATOR = 7_340_033, 3
# Longest block that is transformed; wider scales compare the first so many
# words of their blocks, window by window.
LONGEST_BLOCK = 1 << 19
DIRECT = 128
SLAB = 1 << 18        # numbers of a matrix that are handled together


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, in place; exact below 2^53."""
    x -= np.floor(x / PRIME) * PRIME
    return x


def powers(root: int, n: int) -> np.ndarray:
    """root^0 .. root^(n - 1) modulo the prime."""
    out = np.ones(n, np.int64)
    have = 1
    while have < n:
        step = pow(root, have, PRIME)
        out[have:2 * have] = out[:min(have, n - have)] * step % PRIME
        have *= 2
    return out


@lru_cache(None)
def matrix(rows: int, cols: int, n: int, inverse: bool) -> np.ndarray:
    """w^(r * c) for a root of unity w of order ``n``."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    table = powers(pow(root, -1, PRIME) if inverse else root, n)
    return table[np.outer(np.arange(rows), np.arange(cols)) % n].astype(np.float64)


def transform(x: np.ndarray, n: int, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row, ``n`` long (shorter rows end in
    zeros); the inverse one comes ``n`` times too large."""
    if n <= DIRECT:
        return reduced(x @ matrix(x.shape[1], n, n, inverse))
    outer = 1 << (n.bit_length() // 2)
    inner = n // outer
    used = -(-x.shape[1] // inner)       # outer rows that are not zero
    if outer > DIRECT:
        outer, inner = DIRECT, n // DIRECT
        used = -(-x.shape[1] // inner)
    x = x[:, :used * inner].reshape(len(x), used, inner)
    part = reduced(matrix(outer, used, outer, inverse) @ x)
    part = reduced(part * matrix(outer, inner, n, inverse))
    part = transform(part.reshape(-1, inner), inner, inverse).reshape(len(x), outer, inner)
    return np.ascontiguousarray(part.transpose(0, 2, 1)).reshape(len(x), n)


def occurrences(code: np.ndarray, scale: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance): where a block of the scale seems to occur again,
    ``scale`` to 2 * scale - 1 words on (from 1 word on at the first scale)."""
    size = min(scale, longest)
    step = scale // size
    count = -(-len(code) // size)
    blocks = count + 2 * step
    fill = np.arange(blocks * size - len(code)) + code.max(initial=0) + 1     # words that occur once
    x = np.r_[code, fill] % PRIME
    ends = np.r_[0, np.cumsum(x * x % PRIME)]
    squares = ends[size:] - ends[:-size]
    squares = np.r_[squares, np.zeros(blocks * size - len(squares), np.int64)].reshape(blocks, size) % PRIME
    n = 2 * size
    of_block = transform(x.astype(np.float64).reshape(blocks, size), n)
    mirror, sign = -np.arange(n) % n, 1.0 - 2 * (np.arange(n) % 2)
    found = []
    per_slab = max(1, SLAB // n)
    for window in range(-1 if scale == FIRST_SCALE else 0, step):
        for first in range(0, count, per_slab * step):
            b = np.arange(first, min(count, first + per_slab * step), step)
            ahead = b + step + window
            product = reduced(of_block[b][:, mirror] * (of_block[ahead] + sign * of_block[ahead + 1]))
            cross = transform(product, n, True)[:, :size]
            total = squares[b, 0][:, None] + squares[ahead]
            row, lag = np.nonzero(reduced(2 * cross - float(n) * total) == 0)
            found.append((b[row] * size, lag + (step + window) * size))
    at, gap = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    real = (gap > 0) & (at + gap + size <= len(code))
    return at[real], gap[real]


def same_block(code: np.ndarray, at: np.ndarray, gap: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` words at ``at`` and at ``at + gap`` are the same."""
    out = np.ones(len(at), bool)
    rows = max(1, SLAB // size)
    for i in range(0, len(at), rows):
        k = at[i:i + rows, None] + np.arange(size)
        out[i:i + rows] = (code[k] == code[k + gap[i:i + rows, None]]).all(1)
    return out


def reach(code: np.ndarray, at: np.ndarray, gap: np.ndarray, step: int) -> np.ndarray:
    """How many positions from ``at`` in direction ``step`` hold the word that
    stands ``gap`` further on."""
    out, live, width = np.zeros(len(at), np.int64), np.arange(len(at)), 32
    while len(live):
        k = (at + step * out)[live][:, None] + step * np.arange(width)
        ahead = k + gap[live][:, None]
        same = (k >= 0) & (ahead < len(code))
        same &= code[np.clip(k, 0, len(code) - 1)] == code[np.minimum(ahead, len(code) - 1)]
        far = np.where(same.all(1), width, same.argmin(1))
        out[live] += far
        live = live[far == width]
        width = min(2 * width, max(32, SLAB // max(1, len(live))))
    return out


def is_primitive(code: np.ndarray, start: int, period: int) -> bool:
    """Whether no shorter word repeated gives the ``period`` words at ``start``."""
    rest, prime = period, 2
    while rest > 1:
        if rest % prime == 0:
            short = period // prime
            if (code[start:start + period - short] == code[start + short:start + period]).all():
                return False
            while rest % prime == 0:
                rest //= prime
        prime = prime + 1 if prime * prime <= rest else max(prime + 1, rest)
    return True


def word_runs(code: np.ndarray, sizes: np.ndarray, longest: int = LONGEST_BLOCK) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts that stand one after
    another; ``sizes``: words of every text.  Ordered by start, then period."""
    kinds = int(code.max(initial=0)) + 1
    first = np.cumsum(sizes + 1) - sizes - 1          # a word of its own ends every text
    laid = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    ends = first + sizes
    inside = np.ones(len(laid), bool)
    inside[ends] = False
    laid[inside], laid[ends] = code, kinds + np.arange(len(sizes))
    runs = np.zeros((0, 3), np.int64)
    scale = FIRST_SCALE
    while len(sizes) and LEAST_COPIES * scale <= sizes.max():
        kept = np.repeat(sizes >= max(LEAST_WORDS, LEAST_COPIES * scale), sizes + 1)
        place = np.flatnonzero(kept)
        text = laid[place]
        size = min(scale, longest)
        at, gap = occurrences(text, scale, longest)

        start, end, period = np.zeros((3, 0), np.int64)
        here = np.zeros(len(text), np.int64)         # 1 + the run with a short period that holds the block at a place
        if len(runs):
            to_text = np.cumsum(kept) - 1
            short = runs[(runs[:, 2] * 2 <= size) & kept[runs[:, 0]] & (runs[:, 1] >= size)]
            start, period = to_text[short[:, 0]], short[:, 2]
            end = start + short[:, 1]
            span = end - size + 1 - start
            offset = np.cumsum(span) - span
            here[np.repeat(start - offset, span) + np.arange(span.sum())] = np.repeat(np.arange(len(short)) + 1, span)
        a, b = here[at], here[at + gap]
        both = (a > 0) & (b > 0)
        open_ = ~both
        i, j = a[both] - 1, b[both] - 1
        open_[both] = (i != j) & ((start[j] - start[i] == gap[both]) | (end[j] - end[i] == gap[both]))
        at, gap = at[open_], gap[open_]

        real = same_block(text, at, gap, size)
        at, gap = at[real], gap[real]
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        head = np.ones(len(at), bool)
        head[1:] = (gap[1:] != gap[:-1]) | (at[1:] - at[:-1] != size)
        at, gap = at[head], gap[head]
        left = reach(text, at - 1, gap, -1)
        length = reach(text, at, gap, 1) + left + gap
        seen = np.unique(np.c_[at - left, length, gap][length >= np.maximum(LEAST_WORDS, LEAST_COPIES * gap)], axis=0)
        new = [(place[s], n, q) for s, n, q in seen if is_primitive(text, s, q)]
        runs = np.vstack([runs, np.array(new, np.int64).reshape(-1, 3)])
        scale *= 2
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = np.searchsorted(first, runs[:, 0], "right") - 1
    runs[:, 0] -= text                               # without the words that end the texts before
    return runs


def runs_and_rest(texts: pa.Array, longest: int = LONGEST_BLOCK) -> tuple[pa.Array, pa.Array]:
    """Per text its runs (start, length, period), and the text without the words
    that a run repeats, one space between words."""
    words = byte_words(texts, GAPS)
    sizes = np.bincount(words.doc, minlength=len(texts))
    runs = word_runs(words.code, sizes, longest)
    first = np.cumsum(sizes) - sizes
    doc = np.searchsorted(first + sizes, runs[:, 0], "right")
    offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
    fields = [pa.array(x) for x in ((runs[:, 0] - first[doc]) if len(runs) else runs[:, 0], runs[:, 1], runs[:, 2])]
    lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))

    change = np.zeros(len(words.code) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    start, end, owner = words.start[kept], words.end[kept], words.doc[kept]
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    change = np.zeros(len(words.data) + 1, np.int8)  # bytes of kept words, and the byte behind each but a text's last
    change[start] += 1
    change[end + ~last] -= 1
    data = words.data.copy()
    data[end] = 0x20
    data = data[np.cumsum(change[:-1], dtype=np.int8) > 0]
    ends = np.cumsum(np.bincount(owner, weights=end - start + ~last, minlength=len(texts))).astype(np.int64)
    rest = pa.Array.from_buffers(pa.large_utf8(), len(texts), [None, pa.py_buffer(np.r_[0, ends]), pa.py_buffer(data)])
    return lists, rest.cast(pa.utf8())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, runs (array of start, length, period; by
    start, then period), collapsed (the text without the words that any run
    holds after its first period, words joined by one space).

    Word numbers count from 0.  Null and empty texts, and texts of fewer than
    ``LEAST_WORDS`` words, have no runs; a null text collapses to "".  Repeated
    rows and null ids stay rows of their own, extra columns are not read, and an
    empty table gives an empty result.  Memory grows with the longest text.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = rows.select("id").schema.add("runs", RUNS).add("collapsed", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=2 << 20):
            yield pa.RecordBatch.from_arrays([part.column("id"), *runs_and_rest(part.column("text"))], names=["id", "runs", "collapsed"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic tail in one text of ten.

    h is the crc32 of the id's decimal text ("null" without an id), g = h div
    10.  If h mod 10 = 0 and the text has n > 0 words, words from number
    a = g mod n on repeat the p = 1 + (n - a) div (3 + g mod 8) words at a.
    """
    words, h = fresh(docs, "_words"), fresh(docs, "_h")
    built = f"""
        transform(sequence(0, size({words}) - 1), i -> {words}[int(if(i < {h} div 10 % size({words}), i,
            {h} div 10 % size({words}) + (i - {h} div 10 % size({words}))
                % (1 + (size({words}) - {h} div 10 % size({words})) div (3 + {h} div 10 % 8))))])"""
    planted = docs.withColumn(h, crc_fold(id_col, 1 << 32)).withColumn(
        words, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(text_of(text_col), F.lit(NON_SPACE_RUN), 0)))
    return planted.withColumn(text_col, F.when(F.size(words) > 0, F.array_join(F.expr(built), " ")).otherwise(F.col(text_col))).drop(words, h)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_runs, the run with most copies of its period
    (start, length, period, exponent_milli; null without runs), runs_sha256 (of
    ``start,length,period`` lines) and collapsed_sha256."""
    best = """reduce(runs, runs[0], (best, r) -> if(r.length * best.period > best.length * r.period, r, best))"""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    found = periodic_runs(docs, id_col, text_col).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, F.expr(best)).alias("best"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    return found.select(id_col, "n_runs", "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Near duplicates by improved consistent weighted sampling.

A text is a weighted set of word shingles: weight = count * idf.  Sample j of a
set is the shingle f with the smallest

    ln a = ln c - r * (t - beta + 1),   t = floor(ln w / r + beta),

with r, c ~ Gamma(2, 1) and beta ~ U(0, 1) drawn from (f, j); two sets give the
same sample (f, t) with the probability of their weighted Jaccard similarity.
The draws come from a pool of ``POOL`` triples per j, picked by bits of the
shingle's hash (equal draws are told apart by the hash), and idf is one of
``LEVELS`` steps, so nearly all samples are table look-ups.

Samples are banded.  Texts with equal weighted sets are one class from the
start; classes that share a band are candidates, and candidates are compared by
their exact weighted Jaccard similarity.  A band shared by n classes is not
turned into n * n pairs: first every class is compared with the hub of each of
its bands, then only classes of a band that are still in different components
are compared, in blocks.  Pairs whose samples agree too seldom to leave a chance
are set aside before texts are fetched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fresh, space_words, staged, text_of
from .graph import ROWS_PER_TASK, components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 4            # a pair at 0.8 shares no band with probability 6e-4
POOL, LEVELS = 4096, 12
# Document frequencies are counted per hash bucket: a table of this many counts
# at any corpus size.  A shingle counts as at least as frequent as its bucket.
BUCKETS = 1 << 16
# idf = 1 + IDF_SHARE * ln((n + 1) / (df + 1)) / ln(n + 1).  With a full idf the
# shingles that a large group of copies shares would weigh little against the
# edits between them, and the group would fall apart as it grows.
IDF_SHARE = 0.25
# Of a pair at 0.8, fewer than this share of 56 samples agree with probability 1e-8.
LEAST_AGREEMENT = 0.48
# Classes that share a band get this many further samples from a smaller pool; a
# pair at 0.8 agrees in less than this share of them with probability 3e-5.
LOOKS, LOOK_POOL, LEAST_LOOKS = 512, 1024, 0.73
SMALL, BLOCK = 32, 1024
# Ids that are broadcast at most: 8 bytes each.
MOST_IDS = 1_000_000
MIXER = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 24) - 1)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_counts(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, 48-bit shingle hash, count) of every text's distinct shingles
    of lower-cased white-space words, sorted; a shorter text is one shingle of
    all its words, an empty one has none.  At most 65,536 texts at a time."""
    doc, code, kinds = space_words(pc.utf8_lower(pc.fill_null(texts, "")))
    if not kinds:
        none = np.array([], np.int64)
        return none, none.astype(np.uint64), none
    word = pd.util.hash_array(np.array(kinds, object), categorize=False).astype(np.uint64)[code]
    keys = []
    with np.errstate(over="ignore"):
        def rolled(at: np.ndarray, n: int) -> np.ndarray:
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = h * MIXER + word[at + k]
            return (doc[at].astype(np.uint64) << np.uint64(48)) | (mixed(h, 1) >> np.uint64(16))

        full = np.flatnonzero(doc[words - 1:] == doc[:len(doc) - words + 1]) if len(doc) >= words else np.array([], np.int64)
        keys.append(rolled(full, words))
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        length = np.diff(np.r_[first, len(doc)])
        for n in range(1, words):
            keys.append(rolled(first[length == n], n))
    key = np.sort(np.concatenate(keys))
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[start, len(key)])
    key = key[start]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count


@dataclass
class Weights:
    """idf step of every hash bucket."""

    level: np.ndarray

    def of(self, shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        level = self.level[(shingle & np.uint64(BUCKETS - 1)).astype(np.int64)]
        return level, count * (1 + IDF_SHARE * level / (LEVELS - 1))


def fit_weights(docs: DataFrame, text_col: str = "text") -> Weights:
    """Document frequency per hash bucket over all documents; the driver gets
    ``BUCKETS`` numbers at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for part in chunks(batches):
            total += np.bincount((shingle_counts(part.column("text"))[1] & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            n += part.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some].astype(np.int32)), pa.array(np.r_[n, total[some]])], names=["bucket", "n"])

    found = docs.select(text_of(text_col).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()
    df, n = np.zeros(BUCKETS), 0
    for bucket, k in found:
        if bucket < 0:
            n = k
        else:
            df[bucket] = k
    idf = np.clip(np.log((n + 1) / (np.minimum(df, n) + 1)) / np.log(max(n, 1) + 1), 0, 1)
    return Weights(np.rint(idf * (LEVELS - 1)).astype(np.int64))


class Sampler:
    """Consistent weighted samples of documents."""

    def __init__(self, weights: Weights, bands: int = BANDS, rows: int = ROWS, seed: int = 10, pool: int = POOL):
        self.weights, self.bands, self.rows, self.n, self.pool = weights, bands, rows, bands * rows, pool
        draw = np.random.default_rng(seed)
        self.r, self.c = draw.gamma(2, 1, (self.n, pool)), np.log(draw.gamma(2, 1, (self.n, pool)))
        self.beta = draw.random((self.n, pool))
        weight = 1 + IDF_SHARE * np.arange(LEVELS) / (LEVELS - 1)
        self.table = [np.concatenate([self.key(j, np.arange(pool), np.full(pool, w)) for w in weight]) for j in range(self.n)]

    def key(self, j: int, pick: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """ln a as an integer that sorts alike, its low 24 bits free; it depends
        on the draw and on t only."""
        r, beta = self.r[j][pick], self.beta[j][pick]
        value = self.c[j][pick] - r * (np.floor(np.log(weight) / r + beta) - beta + 1)
        bits = value.view(np.int64)
        return np.where(bits < 0, ~bits, bits ^ np.int64(-1 << 63)).view(np.uint64) & ~LOW

    def samples(self, doc: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
        """One row of samples for every document that has shingles, in order."""
        level, weight = self.weights.of(shingle, count)
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out = np.empty((len(first), self.n), np.uint64)
        edges, at = [0], 0           # blocks of whole documents that stay in the cache
        for n, end in enumerate(np.r_[first[1:], len(doc)]):
            if end - at >= 1 << 16 or n == len(first) - 1:
                edges.append(n + 1)
                at = end
        starts = np.r_[first, len(doc)]
        for a, b in zip(edges, edges[1:]):
            lo, hi = starts[a], starts[b]
            f, offset = shingle[lo:hi], level[lo:hi] * self.pool
            many = np.flatnonzero(count[lo:hi] > 1)
            low, begin = f & LOW, first[a:b] - lo
            for j in range(self.n):
                if j % 5 == 0:
                    bits = mixed(f, 77 + j)
                pick = ((bits >> np.uint64(12 * (j % 5))) & np.uint64(self.pool - 1)).astype(np.int64)
                key = self.table[j][offset + pick]
                if len(many):
                    key[many] = self.key(j, pick[many], weight[lo:hi][many])
                out[a:b, j] = np.minimum.reduceat(key | low, begin)
        return out

    @staticmethod
    def bytes_of(samples: np.ndarray) -> np.ndarray:
        """One byte per sample; different samples agree with probability 1/256."""
        return (mixed(samples, 3) & np.uint64(255)).astype(np.uint8)

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        out = np.empty((len(samples), self.bands), np.uint64)
        with np.errstate(over="ignore"):
            for band in range(self.bands):
                h = np.full(len(samples), band + 1, np.uint64)
                for k in range(self.rows):
                    h = mixed(h * MIXER + samples[:, band * self.rows + k], band)
                out[:, band] = h
        return out.view(np.int64)


def signatures(docs: DataFrame, weights: Weights, id_col: str, text_col: str) -> DataFrame:
    """(id, set_a, set_b, bands, bytes): a 128-bit hash of the weighted set, the
    band keys, and one byte per sample; nulls for texts without words."""
    sampler = Sampler(weights)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            doc, shingle, count = shingle_counts(part.column("text"))
            n = part.num_rows
            own, bands, small = [[None] * n, [None] * n], [None] * n, [None] * n
            if len(doc):
                some, first = np.unique(doc, return_index=True)
                with np.errstate(over="ignore"):
                    for k in (0, 1):
                        total = np.add.reduceat(mixed(mixed(shingle, 5 + k) + count.astype(np.uint64), 9 + k), first).view(np.int64)
                        for d, value in zip(some.tolist(), total.tolist()):
                            own[k][d] = value
                samples = sampler.samples(doc, shingle, count)
                keys, short = sampler.band_keys(samples).tolist(), sampler.bytes_of(samples)
                for n_th, d in enumerate(some.tolist()):
                    bands[d], small[d] = keys[n_th], short[n_th].tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(own[0], pa.int64()), pa.array(own[1], pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.binary())], names=["id", "set_a", "set_b", "bands", "bytes"])

    return rows.mapInArrow(run, "id long, set_a long, set_b long, bands array<long>, bytes binary")


def vectors(docs: DataFrame, wanted: DataFrame, weights: Weights, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles, repeats, looks) of the wanted ids, which have words: sorted
    32-bit hashes, (place, count) of the shingles that occur more than once, and
    a byte for each of ``LOOKS`` further samples, as packed arrays."""
    sampler = Sampler(weights, 1, LOOKS, seed=11, pool=LOOK_POOL)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    # few ids go to the texts; beyond the bound the planner chooses
    rows = rows.join(F.broadcast(wanted) if wanted.count() <= MOST_IDS else wanted, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            doc, shingle, count = shingle_counts(part.column("text"))
            looks = [x.tobytes() for x in sampler.bytes_of(sampler.samples(doc, shingle, count))] if len(doc) else []
            there = np.unique(doc).tolist()      # a row that repeats a wanted id may be without words
            looks = dict(zip(there, looks))
            short = (shingle & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            order = np.lexsort((short, doc))
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            short, count = short[order], count[order]
            again = [np.flatnonzero(count[a:b] > 1) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([short[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.array([np.column_stack([at, count[a:b][at]]).astype(np.uint32).tobytes() for at, a, b in zip(again, ends, ends[1:])], pa.binary()),
                 pa.array([looks.get(n) for n in range(part.num_rows)], pa.binary())],
                names=["id", "shingles", "repeats", "looks"]).filter(pa.array(np.diff(ends) > 0))

    # of rows that repeat an id, the first is enough: they are in one class or none
    return rows.mapInArrow(run, "id long, shingles binary, repeats binary, looks binary").dropDuplicates(["id"])


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sets given as sorted hashes and weights."""
    (x, wx), (y, wy) = a, b
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    shared = np.minimum(wx[both], wy[at[both]]).sum()
    return float(shared / (wx.sum() + wy.sum() - shared))


def unpacked(shingles: bytes, repeats: bytes, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and weights of a packed set."""
    x, again = np.frombuffer(shingles, np.uint32), np.frombuffer(repeats, np.uint32).reshape(-1, 2)
    count = np.ones(len(x), np.int64)
    count[again[:, 0]] = again[:, 1]
    return x, weights.of(x.astype(np.uint64), count)[1]


def verified(pairs: DataFrame, vecs: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity suffices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, ra, sb, rb = (c.to_pylist() for c in batch.columns[2:])
            keep = [weighted_jaccard(unpacked(*a, weights), unpacked(*b, weights)) >= similarity - 1e-9 for a, b in zip(zip(sa, ra), zip(sb, rb))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = vecs.select(F.col("id").alias("a"), F.col("shingles").alias("sa"), F.col("repeats").alias("ra"))
    right = vecs.select(F.col("id").alias("b"), F.col("shingles").alias("sb"), F.col("repeats").alias("rb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "ra", "sb", "rb").mapInArrow(run, "a long, b long")


def packed(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def agree(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    return (x == y).mean(-1) >= least


def comparable(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b) of the pairs (a, b, bytes_a, bytes_b) that agree often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (packed(c.to_pylist()) for c in batch.columns[2:])
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(agree(x, y, least)))

    return pairs.select("a", "b", "bytes_a", "bytes_b").mapInArrow(run, "a long, b long")


def still_apart(members: DataFrame, tried: DataFrame, vecs: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """Links (a, b) between classes that share a band but not a label.

    ``members`` holds (band, id, label, bands).  Bands of up to ``SMALL``
    classes are joined with themselves.  The classes of a larger band are dealt
    into blocks of about ``BLOCK``; every pair of blocks is one group, so no
    group grows with the band, and compares its texts itself, so that only links
    leave it.  A pair that shares several bands is compared in the first."""
    sized = staged(members.join(members.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band"), "minhash-apart")
    small = sized.filter(F.col("n") <= SMALL).join(vecs.select("id", "looks"), "id").select("band", "id", "label", "looks")
    other = small.select("band", F.col("id").alias("b"), F.col("label").alias("label_b"), F.col("looks").alias("bytes_b"))
    joined = small.join(other, "band").filter((F.col("id") < F.col("b")) & (F.col("label") != F.col("label_b"))) \
        .select(F.col("id").alias("a"), "b", F.col("looks").alias("bytes_a"), "bytes_b")
    pairs = comparable(joined, LEAST_LOOKS).distinct().join(tried, ["a", "b"], "left_anti")
    few = verified(pairs, vecs, weights, similarity)

    mine = sized.filter(F.col("n") > SMALL).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(vecs, "id")
    # block i meets every block j: a member goes to the groups of its row and its column
    dealt = mine.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "label", "bands", "looks", "shingles", "repeats", "block", F.col("band").alias("g_band"),
        F.least("block", "with").alias("g_one"), F.greatest("block", "with").alias("g_two"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        band, first, second = (group[c].iloc[0] for c in ("g_band", "g_one", "g_two"))
        one, two = group[group["block"] == first], group[group["block"] == second]
        out = []
        if len(one) and len(two):
            x, y = packed(one["looks"]), packed(two["looks"])
            bands_x, bands_y = np.stack(one["bands"].to_list()), np.stack(two["bands"].to_list())
            b, label = two["id"].to_numpy(), two["label"].to_numpy()
            texts = [[unpacked(s, r, weights) for s, r in zip(g["shingles"], g["repeats"])] for g in (one, two)]
            for i, (a, of) in enumerate(zip(one["id"].tolist(), one["label"].tolist())):
                near = np.flatnonzero((label != of) & ((b > a) if first == second else True))
                near = near[agree(y[near, :64], x[i, :64], LEAST_AGREEMENT)]
                near = near[agree(y[near], x[i], LEAST_LOOKS)]
                shared = bands_y[near] == bands_x[i]
                near = near[bands_x[i][shared.argmax(1)] == band] if len(near) else near
                out += [(min(a, int(b[j])), max(a, int(b[j]))) for j in near.tolist()
                        if weighted_jaccard(texts[0][i], texts[1][j]) >= similarity - 1e-9]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return few.union(dealt.groupBy("g_band", "g_one", "g_two").applyInPandas(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: id, class_id (smallest id with the same weighted
    shingles), component_id (smallest id that links reach), component_size
    (documents in it), kept (id = component_id).

    Null texts, empty texts and texts of white space only link with nothing and
    stay.  Rows with a null id have null classes and stay.  Rows that repeat an
    id fare alike; if their texts differ they count under each of their classes.
    Ids are integers.  Extra columns are not read.  An empty table gives an
    empty result.
    """
    weights = fit_weights(docs, text_col)
    signed = staged(signatures(docs, weights, id_col, text_col), "minhash-signatures")
    known = signed.filter(F.col("id").isNotNull() & F.col("set_a").isNotNull())
    # copies differ in nothing but the id, so any one's bands and bytes will do
    classes = staged(known.groupBy("set_a", "set_b").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes")),
        "minhash-classes")
    banded = classes.select("id", "bytes", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(banded.join(shared, "band"), "minhash-members")
    tasks = members.count() // ROWS_PER_TASK + 1   # slim rows: few classes need few tasks
    vecs = staged(vectors(docs, members.select("id").distinct(), weights, id_col, text_col), "minhash-vectors")

    # the hub of a band is its class with the most company in all its bands: the text
    # that a group's copies were made from is closer to each than they are to each other
    company = members.groupBy("id").agg(F.sum("n").alias("company"))
    hubs = members.join(company, "id").groupBy("band").agg(F.max_by(F.struct("id", "bytes"), F.struct("company", -F.col("id"))).alias("hub"))
    to_hub = members.join(hubs, "band").filter(F.col("id") != F.col("hub.id")).select(
        F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"),
        F.when(F.col("id") < F.col("hub.id"), F.col("bytes")).otherwise(F.col("hub.bytes")).alias("bytes_a"),
        F.when(F.col("id") < F.col("hub.id"), F.col("hub.bytes")).otherwise(F.col("bytes")).alias("bytes_b")).dropDuplicates(["a", "b"])
    tried = staged(comparable(to_hub.coalesce(tasks), LEAST_AGREEMENT), "minhash-tried")
    links = staged(verified(tried, vecs, weights, similarity), "minhash-links")
    found = components(links, "minhash-components", rounds=2)

    with_label = members.select("id", "band").join(found.select(F.col("node").alias("id"), "label"), "id", "left") \
        .withColumn("label", F.coalesce("label", "id")).coalesce(tasks)
    split = with_label.groupBy("band").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo <> _hi").select("band")
    apart = with_label.join(split.coalesce(tasks), "band").join(classes.select("id", "bands"), "id")
    more = staged(still_apart(apart, tried, vecs, weights, similarity), "minhash-links")
    found = components(links.union(more), "minhash-components")

    final = classes.join(found.select(F.col("node").alias("id"), "label"), "id", "left").select(
        "set_a", "set_b", F.col("id").alias("class_id"), F.coalesce("label", "id").alias("component_id"), "copies")
    sizes = final.groupBy("component_id").agg(F.sum("copies").alias("component_size"))
    final = final.join(sizes, "component_id")
    keys = [F.col("k.set_a").eqNullSafe(F.col("f.set_a")), F.col("k.set_b").eqNullSafe(F.col("f.set_b"))]
    rows = known.select("id", "set_a", "set_b").alias("k").join(final.alias("f"), keys).select(
        "k.id", "f.class_id", "f.component_id", "f.component_size")
    others = signed.filter(F.col("id").isNull() | F.col("set_a").isNull()).select(
        "id", F.col("id").alias("class_id"), F.col("id").alias("component_id"), F.lit(1).cast("long").alias("component_size"))
    return rows.unionByName(others).select(
        F.col("id").alias(id_col), "class_id", "component_id", "component_size",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; rows are found by
    id, and rows with a null id all stay."""
    key = fresh(docs, "_gone")
    gone = near_duplicates(docs, id_col, text_col, similarity).filter(~F.col("kept")).select(F.col(id_col).alias(key))
    return docs.join(gone, F.col(id_col) == F.col(key), "left_anti")

"""Embedding near duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= c have a squared distance of at most D = 2 - 2c.
Rotated onto principal axes (which keeps distances) and cut into low-dimensional
blocks, block b gets the budget D * (its share of the variance): the squared
distances of the blocks add up to at most D, so in at least one block they keep
its budget.  Every block is therefore range-joined on its own: a grid over its
leading axes, with cells as wide as the root of the budget, brings every pair
that keeps the budget into equal or adjacent cells.  The union of the blocks'
pairs holds every true pair; each is verified by its cosine in double precision.

Rows of the join carry an 8-bit code of the rotated vector instead of the
vector; comparisons on codes allow for the rounding, so they drop no true pair.
Equal vectors are one class from the start, and a crowded cell is cut into
tiles, so no task holds a cell that grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, unit_hash
from .graph import components

COSINE, BLOCK_AXES, GRID_AXES = 0.95, 8, 2
TILE = 8192
ROTATION_SAMPLE = 4000


def unit_rows(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors of a list column in double precision with norm 1, zero-padded
    to one width; lists hold finite numbers, not all 0."""
    lists = column.to_pylist()
    out = np.zeros((len(lists), width or max([1, *map(len, lists)])))
    for n, x in enumerate(lists):
        out[n, :len(x)] = x
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


@dataclass
class Blocks:
    """Rotation, block limits and the 8-bit code of rotated unit vectors."""

    rotation: np.ndarray
    edges: list[tuple[int, int]]
    budget: np.ndarray
    least: float

    STEP = 2 / 254

    @classmethod
    def fit(cls, sample: np.ndarray, width: int, cosine: float, axes: int = BLOCK_AXES) -> Blocks:
        """Principal axes and variance shares of a sample; any sample gives a
        correct join, a fair one a fast one."""
        value, vector = np.linalg.eigh(sample.T @ sample / max(1, len(sample)) + 1e-9 * np.eye(width))
        edges = [(a, min(a + axes, width)) for a in range(0, width, axes)]
        share = np.maximum(value[::-1], 1e-9)
        share = np.array([share[a:b].sum() for a, b in edges]) / share.sum()
        return cls(vector[:, ::-1], edges, (2 - 2 * cosine) * share, cosine)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        return np.rint(unit @ self.rotation / self.STEP).astype(np.int8)

    def slack(self, axes: int) -> float:
        """The most by which rounding changes a distance over that many axes."""
        return self.STEP * np.sqrt(axes) + 1e-9

    def cells(self, codes: np.ndarray, b: int) -> np.ndarray:
        """Grid cells over the block's leading axes.  Cells are as wide as the
        distance that codes of a pair within budget may have."""
        a, end = self.edges[b]
        wide = np.sqrt(self.budget[b]) + self.slack(1)
        return np.floor(codes[:, a:min(a + GRID_AXES, end)] * self.STEP / wide).astype(np.int64)

    def near(self, x: np.ndarray, y: np.ndarray, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs whose codes may belong to vectors within the block's
        budget and within the whole distance."""
        a, end = self.edges[b]
        limit = (np.sqrt(self.budget[b]) + self.slack(end - a)) ** 2 / self.STEP ** 2
        whole = (np.sqrt(2 - 2 * self.least) + self.slack(x.shape[1])) ** 2 / self.STEP ** 2
        ys = y[:, a:end].astype(np.float32)
        y2 = (ys ** 2).sum(1)
        for start in range(0, len(x), 512):
            xs = x[start:start + 512, a:end].astype(np.float32)
            gap = y2[None, :] - 2 * (xs @ ys.T)
            i, j = np.nonzero(gap <= (limit + 0.5 - (xs ** 2).sum(1))[:, None])
            for at in range(0, len(i), 1 << 16):
                p, q = i[at:at + (1 << 16)] + start, j[at:at + (1 << 16)]
                fits = ((x[p].astype(np.int32) - y[q]) ** 2).sum(1) <= whole + 0.5
                yield p[fits], q[fits]


def usable(column: str) -> F.Column:
    """Vectors that can link: not null, not empty, all components finite, not all 0."""
    x = F.col(column)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & ~odd & F.exists(x, lambda v: v != 0)


def candidates(classes: DataFrame, blocks: Blocks, width: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of class ids that share a cell of some block."""
    # a vector is at home in its cell and visits it and one half of the adjacent cells
    shifts = [s for s in product((-1, 0, 1), repeat=GRID_AXES) if s >= (0,) * GRID_AXES]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes = blocks.codes(unit_rows(batch.column("embedding"), width))
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            for b in range(len(blocks.edges)):
                cells = blocks.cells(codes, b)
                cells = np.pad(cells, ((0, 0), (0, GRID_AXES - cells.shape[1])))
                for home, shift in [(True, (0,) * GRID_AXES), *[(False, s) for s in shifts]]:
                    at = (cells + np.array(shift)) @ (1000 ** np.arange(GRID_AXES))
                    n = batch.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), packed, pa.array(np.full(n, b, np.int32)), pa.array(at), pa.array(np.full(n, home)),
                         pa.array(np.full(n, not any(shift)))], names=["id", "code", "block", "cell", "home", "own"])

    rows = classes.select("id", "embedding").mapInArrow(deal, "id long, code binary, block int, cell long, home boolean, own boolean")
    sizes = rows.groupBy("block", "cell").agg(F.ceil(F.count_if("home") / TILE).cast("int").alias("homes"),
                                              F.ceil(F.count_if(~F.col("home")) / TILE).cast("int").alias("visits")).filter("homes > 0 and visits > 0")
    tiled = rows.join(sizes, ["block", "cell"])
    own_tile = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("visits")).otherwise(F.col("homes")) - 1))
    tiled = tiled.select("id", "code", "block", "cell", "home", "own", own_tile.alias("mine"), others.alias("other")).select(
        "id", "code", "block", "cell", "home", "own",
        F.when(F.col("home"), F.col("mine")).otherwise(F.col("other")).alias("tile_h"),
        F.when(F.col("home"), F.col("other")).otherwise(F.col("mine")).alias("tile_v"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        homes, visits = group[group["home"]], group[~group["home"]]
        out = [np.zeros((0, 2), np.int64)]
        if len(homes) and len(visits):
            x, y = (np.frombuffer(b"".join(g["code"]), np.int8).reshape(len(g), -1) for g in (homes, visits))
            a, b, own = homes["id"].to_numpy(), visits["id"].to_numpy(), visits["own"].to_numpy()
            for i, j in blocks.near(x, y, int(group["block"].iloc[0])):
                once = ~own[j] | (a[i] < b[j])      # pairs of one cell meet twice
                i, j = i[once], j[once]
                out.append(np.column_stack([np.minimum(a[i], b[j]), np.maximum(a[i], b[j])]))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    return tiled.groupBy("block", "cell", "tile_h", "tile_v").applyInPandas(join, "a long, b long").filter("a < b").distinct()


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept (id = component_id).

    Two vectors link if their cosine in double precision is at least ``cosine``
    (below 1, above 0) and they have equally many components.  Vectors that are
    null, empty or zero, or hold null or non-finite components, and rows with a
    null id, link with nothing.  Rows that repeat an id count as one link each.
    Ids are integers.  Extra columns are not read; an empty table gives an
    empty result.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    good = usable("embedding") & F.col("id").isNotNull()
    keys = [F.xxhash64("embedding").alias("key_a"), F.xxhash64(F.lit(7), F.reverse("embedding")).alias("key_b")]
    keyed = rows.filter(good).select("id", "embedding", *keys)
    classes = staged(keyed.groupBy("key_a", "key_b").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("embedding").alias("embedding")), "vector-classes")
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    share = ROTATION_SAMPLE / max(1, classes.count())
    sample = [r[0] for r in classes.filter(unit_hash(F.col("id").cast("string")) < share).orderBy("id").select("embedding").collect()]
    blocks = Blocks.fit(unit_rows(pa.array(sample), width) if sample else np.eye(width), width, cosine)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = unit_rows(batch.column("x"), width), unit_rows(batch.column("y"), width)
            # batches are cut anew so that few unit vectors are held
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array((x * y).sum(1) >= cosine))

    pairs = staged(candidates(classes, blocks, width), "vector-pairs")
    left = classes.select(F.col("id").alias("a"), F.col("embedding").alias("x"))
    right = classes.select(F.col("id").alias("b"), F.col("embedding").alias("y"))
    links = staged(pairs.join(left, "a").join(right, "b").filter(F.size("x") == F.size("y")).select("a", "b", "x", "y")
                   .mapInArrow(verify, "a long, b long"), "vector-links")
    copies = classes.select(F.col("id").alias("b"), "copies")
    linked = (links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(copies, "b")
              .groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others")))
    found = components(links, "vector-components").select(F.col("node").alias("id"), "label")
    final = classes.select("key_a", "key_b", "id", "copies").join(linked, "id", "left").join(found, "id", "left").select(
        "key_a", "key_b", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "id").alias("component_id"))
    ids = keyed.select("id", "key_a", "key_b").join(final, ["key_a", "key_b"]).select("id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(good, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return ids.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

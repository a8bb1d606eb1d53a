"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features.  Labelled rows give
preference pairs, every good document before every poor one, and the weights
maximise the likelihood that the better one wins: logistic loss on feature
differences.  The pairs are never listed: who wins depends on two strengths only,
so each Newton step is one Spark aggregate of the labelled rows by label and
strength (in steps of ``STEP``), and the pairs are those of its cells.  Features
are counted whole-text with array operations; the threshold is the exact
strength quantile that matches the share of poor rows among the labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from .common import chunks, crc_fold, scored, space_words, staged, text_of

FEATURES = ("log_words", "word_length", "upper", "digit", "symbol", "bang", "bar", "other_ascii",
            "distinct", "repeat_next", "repeat_line", "short_text", "any_repeat", "any_symbol", "any_upper")
LETTER_CASE_UPPER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
CLASSES = {
    "upper": LETTER_CASE_UPPER,
    "digit": np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8)),
    "symbol": np.isin(np.arange(256), np.frombuffer(b"#$%&*@^~=_", np.uint8)),
    "bang": np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8)),
    "bar": np.isin(np.arange(256), np.frombuffer(b"|<>{}[]\\", np.uint8)),
    "other_ascii": np.isin(np.arange(256), np.frombuffer(b"\"'()-/:;`+", np.uint8)),
}
LABEL_SHARE_AT = 0.7
COLUMNS = [f"x{i}" for i in range(len(FEATURES))]
STEP, WIDEST = 1 / 32, 32.0    # cells of the strengths; those beyond WIDEST share the last cell
BUFFER = 100_000               # strengths that a quantile may sort in one buffer


def per_doc(doc: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weight, n).astype(float)


def distinct_per_doc(doc: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    if not len(doc):
        return np.zeros(n)
    key = np.sort(doc * (int(code.max()) + 1) + code)
    return per_doc(key[np.r_[True, key[1:] != key[:-1]]] // (int(code.max()) + 1), n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text has zeros, and 1 in
    ``short_text``."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    size = pc.binary_length(texts).to_numpy(False).astype(np.int64)
    flat = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    ends = np.cumsum(size)
    byte = {}
    for name, table in CLASSES.items():
        run = np.r_[0, np.cumsum(table[flat], dtype=np.int64)]
        byte[name] = (run[ends] - run[ends - size]) / np.maximum(size, 1)
    doc, code, _ = space_words(texts)
    words = per_doc(doc, n)
    at_least = np.maximum(words, 1)
    again = per_doc(doc[1:][(doc[1:] == doc[:-1]) & (code[1:] == code[:-1])], n) if len(doc) else np.zeros(n)
    distinct = np.where(words > 0, distinct_per_doc(doc, code, n) / at_least, 0)
    lines = pc.split_pattern(texts, "\n")
    line_doc = pc.list_parent_indices(lines).to_numpy(False).astype(np.int64)
    line_code = pc.list_flatten(lines).dictionary_encode().indices.to_numpy(False).astype(np.int64)
    line_share = 1 - distinct_per_doc(line_doc, line_code, n) / np.maximum(per_doc(line_doc, n), 1)
    columns = [np.log1p(words), np.minimum(size / at_least, 30) / 10, *[byte[c] for c in CLASSES],
               # the share of distinct words falls with length; this is taken back
               distinct + 0.1 * np.log(np.maximum(400, at_least) / 400), again / at_least, line_share,
               (words < 12).astype(float), np.minimum(1, 10 * again / at_least),
               np.minimum(1, 25 * (byte["symbol"] + byte["bang"] + byte["bar"])), np.minimum(1, np.maximum(0, 8 * byte["upper"] - 0.4))]
    return np.column_stack(columns)


@dataclass
class Ranking:
    """Feature scaling, weights, threshold strength and score slope."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the threshold strength scores ``LABEL_SHARE_AT``."""
        z = self.slope * (self.strength(x) - self.cut) + np.log(LABEL_SHARE_AT / (1 - LABEL_SHARE_AT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(label, x0...)`` of all labelled rows outside the held-out fold, stored.

    Features are counted where the texts lie; only they move in the join.
    """
    def learnt(col: str) -> Column:
        return F.col(col).isNotNull() & (crc_fold(col, folds) != held)

    known = labels.filter(F.col(label).isin(0, 1) & learnt(id_col)).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
    rows = docs.filter(learnt(id_col)).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = rows.select("id").schema
    for c in COLUMNS:
        schema = schema.add(c, "double")

    def run(batches):
        for part in chunks(batches):
            x = features(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=schema.names)

    found = rows.mapInArrow(run, schema).join(known, F.col("id") == F.col("_id"))
    return staged(found.select("label", *COLUMNS), "quality")


def linear(terms: list[Column], weights: np.ndarray) -> Column:
    out = F.lit(0.0)
    for x, w in zip(terms, weights):
        out = out + x * F.lit(float(w))
    return out


def bradley_terry(rows: DataFrame, terms: list[Column], ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of the logistic loss on the differences of ``terms`` between all
    good and all poor rows, by Newton steps; ``rows`` holds both labels."""
    k = len(terms)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(f"z{i}").alias(f"z{i}") for i in range(k)],
            *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"zz{i}_{j}") for i, j in upper]]
    scaled = rows.select("label", *[t.alias(f"z{i}") for i, t in enumerate(terms)])
    w = np.zeros(k)
    for _ in range(steps):
        strength = linear([F.col(f"z{i}") for i in range(k)], w)
        cell = F.round(F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), strength)) / STEP).cast("int")
        cells = scaled.groupBy("label", cell.alias("cell")).agg(*sums).toPandas()         # 2 x 2 x WIDEST / STEP cells at most
        sides = []
        for y in (1, 0):
            side = cells[cells["label"] == y].sort_values("cell")
            square = np.zeros((len(side), k, k))
            for i, j in upper:
                square[:, i, j] = square[:, j, i] = side[f"zz{i}_{j}"].to_numpy(float)
            number, z = side["n"].to_numpy(float), side[[f"z{i}" for i in range(k)]].to_numpy(float)
            at = z @ w / number                                            # mean strength of the cell
            sides.append((at, number, z, square, square @ w - at[:, None] * z))
        (at, n, z, zz, off), (at0, n0, z0, zz0, off0) = sides              # off: how the terms go with the strength in a cell
        p = 1 / (1 + np.exp(np.clip(at[:, None] - at0, -30, 30)))          # that the poor one wins
        v = p * (1 - p)
        pairs = n.sum() * n0.sum()
        grad = ((p @ n0) @ z - (v @ n0) @ off - (n @ p) @ z0 - (n @ v) @ off0) / pairs - ridge * w
        cross = z.T @ v @ z0
        curve = (np.tensordot(v @ n0, zz, 1) + np.tensordot(n @ v, zz0, 1) - cross - cross.T) / pairs + ridge * np.eye(k)
        step = np.linalg.solve(curve, grad)
        w = np.round(w + step, 9)          # below it the order of Spark's sums shows
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_ranking(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Fit on all labelled rows outside the held-out fold, whatever their number,
    and all pairs of a good and a poor one.

    Sums and quantiles are Spark aggregates; nothing that grows with the rows
    comes to the driver.  Without both labels the weights are 0 and every score
    is ``LABEL_SHARE_AT``.
    """
    k = len(FEATURES)
    rows = labelled_features(docs, labels, label, folds, held, id_col, text_col)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good"), *[F.avg(c).alias(f"m{c}") for c in COLUMNS],
                     *[F.stddev_pop(c).alias(f"s{c}") for c in COLUMNS]).first()
    n, poor = int(total["n"]), int(total["n"] - total["good"])
    if not 0 < poor < n:
        return Ranking(np.zeros(k), np.ones(k), np.zeros(k), 0.0, 1.0)
    mean = np.round([total[f"m{c}"] for c in COLUMNS], 12)
    spread = np.maximum(np.round([total[f"s{c}"] for c in COLUMNS], 12), 1e-6)
    terms = [(F.col(c) - float(m)) / float(s) for c, m, s in zip(COLUMNS, mean, spread)]
    w = bradley_terry(rows, terms)
    strength = rows.select(linear(terms, w).alias("strength"))
    # half way between the strongest of as many rows as are poor and the next one
    cut = float(exact_quantiles(strength, ["strength"], [(poor - 0.5) / (n - 1)], bound=BUFFER).first()["value"])
    off = strength.select(F.abs(F.col("strength") - cut).alias("off"))
    slope = 4 / max(1e-6, float(exact_quantiles(off, ["off"], [0.5], bound=BUFFER).first()["value"]))
    return Ranking(mean, spread, w, cut, slope)


def score_quality(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (score >= 0.7).

    Null counts as empty; empty texts are scored like others.  Rows repeat as
    they come; extra columns are not read; an empty table gives an empty result.
    """
    def score(texts: pa.Array) -> list[np.ndarray]:
        s = model.score(features(texts))
        return [s, (s >= LABEL_SHARE_AT).astype(np.int32)]

    return scored(docs, score, {"score": "double", "predicted": "integer"}, id_col, text_col)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", folds: int = 4, held: int = 2) -> DataFrame:
    """Scores of all documents, with the held-out fold marked."""
    model = fit_ranking(docs, labels, folds=folds, held=held, id_col=id_col)
    return score_quality(docs, model, id_col).select(id_col, (crc_fold(id_col, folds) == held).alias("held_out"), "score", "predicted")

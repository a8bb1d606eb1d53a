r"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans are pattern matches.  The field then labels the tokens around any
digit or at-sign: chain potentials join neighbours, skip potentials join the
successive occurrences of equal or similarly shaped tokens anywhere in the
document, and loopy belief propagation over both makes labels consistent across
the document.  Tokens in base spans enter as evidence; tokens that end up with
a sure label outside every base span become added spans.

The field is trained here, on the base spans of a bounded sample of documents:
the gradient of the likelihood uses the same belief propagation.  Messages of
all documents of a batch are passed together as arrays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hash_sample, text_of

# The kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EVIDENCE = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
EDGE = re.compile(r"^[^\w+(@]+|[^\w)]+$")
STATES = 1 + len(KINDS)        # no entity, then the kinds
ROUNDS, DAMPING = 8, 0.3
SURE = 0.9


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; linear, as every at-sign is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for n, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not EVIDENCE.search(text):
        return out
    for m in IP.finditer(text):
        if all(int(part) <= 255 for part in (p[-4:] if len(p.lstrip("0")) < 4 else "999" for p in m[0].split("."))):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def write_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# ---- the graph of a document -------------------------------------------------------------

KINDS_OF_TOKEN = ("none", "word", "number", "plus", "bracket", "mixed")


def token_kind(token: str) -> int:
    if not EVIDENCE.search(token):
        return 1
    if token[0] == "+":
        return 3
    if "(" in token:
        return 4
    return 5 if any(c.isalpha() for c in token) else 2


def step(value: int, limits: tuple[int, ...]) -> int:
    return sum(value >= x for x in limits)


DIGITS, DOTS, LENGTHS = (1, 3, 5, 8, 13, 16, 20), (1, 2, 3, 4), (4, 8, 13, 20, 32)
FEATURES = 1 + 8 + 5 + 6 + 10 + 2 * len(KINDS_OF_TOKEN)


def token_features(core: str) -> np.ndarray:
    """Own features of a token without edge punctuation: a constant, steps of
    digit, dot and length counts, and what signs it holds."""
    x = np.zeros(FEATURES, np.int8)
    x[0] = 1
    x[1 + step(sum(c.isdigit() for c in core), DIGITS)] = 1
    x[9 + step(core.count("."), DOTS)] = 1
    x[14 + step(len(core), LENGTHS)] = 1
    at = core.find("@")
    x[20:30] = ["@" in core, at > 0 and "." in core[at:], core[:1] == "+", "(" in core, "-" in core, "_" in core or "%" in core,
                core.isdigit(), any(c.isalpha() for c in core), any(c.isdigit() for c in core) and any(c.isalpha() for c in core),
                bool(core) and core.replace(".", "").isdigit()]
    return x


def shape(core: str) -> str:
    """Letters and digits by class: tokens of one shape are similar."""
    return re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", core))


@dataclass
class Graph:
    """Nodes of one document: token spans, features, and edges (a, b, type)
    with type 0 neighbours, 1 equal tokens, 2 similar tokens."""

    spans: list[tuple[int, int]]
    x: np.ndarray
    edges: np.ndarray


def graph_of(text: str) -> Graph | None:
    """The tokens that hold a digit or an at-sign, and their neighbours; None
    if there are none."""
    if not EVIDENCE.search(text):
        return None
    tokens = list(TOKEN.finditer(text))
    has = [bool(EVIDENCE.search(m[0])) for m in tokens]
    nodes = [n for n in range(len(tokens)) if any(has[max(0, n - 1):n + 2])]
    x, edges, spans, last = [], [], [], {}
    for i, n in enumerate(nodes):
        token = tokens[n][0]
        core = EDGE.sub("", token)
        start = tokens[n].start() + token.find(core)
        spans.append((start, start + len(core)))
        own = token_features(core)
        own[30 + (token_kind(tokens[n - 1][0]) if n else 0)] = 1
        own[36 + (token_kind(tokens[n + 1][0]) if n + 1 < len(tokens) else 0)] = 1
        x.append(own)
        if i and nodes[i - 1] == n - 1:
            edges.append((i - 1, i, 0))
        if has[n]:
            for kind, key in ((1, core.lower()), (2, shape(core))):
                before = last.get((kind, key))
                if before is not None and (kind == 1 or (before, i, 1) not in edges[-2:]):
                    edges.append((before, i, kind))
                last[kind, key] = i
    return Graph(spans, np.array(x, np.int8), np.array(edges, np.int64).reshape(-1, 3))


def labels_of(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> np.ndarray:
    """State per node: the kind of the base span it overlaps, else 0."""
    out = np.zeros(len(spans), np.int64)
    starts = np.array([a for a, _ in spans])
    ends = np.array([b for _, b in spans])
    for kind, a, b in base:
        out[(starts < b) & (ends > a) & (out == 0)] = kind + 1
    return out


# ---- the field ---------------------------------------------------------------------------


@dataclass
class Field:
    """Weights: features x states, and one state x state table per edge type."""

    unary: np.ndarray
    pair: np.ndarray

    def beliefs(self, score: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node marginals and edge marginals after loopy message passing.
        ``score``: log potentials per node; all documents' nodes together."""
        n, m = len(score), len(edges)
        if m:
            a, b = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
            table = self.pair[edges[:, 2]]
            table = np.concatenate([table, table.transpose(0, 2, 1)])     # from state, to state
            back = np.r_[np.arange(m, 2 * m), np.arange(m)]
            message = np.zeros((2 * m, STATES))
            for _ in range(ROUNDS):
                total = score + np.column_stack([np.bincount(b, message[:, s], n) for s in range(STATES)])
                lifted = (total[a] - message[back])[:, :, None] + table
                top = lifted.max(1)
                new = top + np.log(np.exp(lifted - top[:, None, :]).sum(1))
                new -= new.max(1, keepdims=True)
                message = DAMPING * message + (1 - DAMPING) * new
            total = score + np.column_stack([np.bincount(b, message[:, s], n) for s in range(STATES)])
            joint = (total[a[:m]] - message[m:])[:, :, None] + table[:m] + (total[b[:m]] - message[:m])[:, None, :]
            joint = np.exp(joint - joint.max((1, 2), keepdims=True))
            joint /= joint.sum((1, 2), keepdims=True)
        else:
            total, joint = score, np.zeros((0, STATES, STATES))
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True), joint

    def mark(self, graphs: list[tuple[Graph, list[tuple[int, int, int]]]]) -> list[list[tuple[int, int, int]]]:
        """Added spans per document, from its graph and base spans."""
        if not graphs:
            return []
        sizes = np.cumsum([0] + [len(g.spans) for g, _ in graphs])
        x = np.concatenate([g.x for g, _ in graphs]).astype(float)
        edges = np.concatenate([g.edges + np.array([at, at, 0]) for (g, _), at in zip(graphs, sizes)])
        known = np.concatenate([labels_of(g.spans, base) for g, base in graphs])
        score = x @ self.unary
        score[np.arange(len(known)), known] += 4.0 * (known > 0)
        p, _ = self.beliefs(score, edges)
        out = []
        for (g, base), lo, hi in zip(graphs, sizes, sizes[1:]):
            found = np.where((p[lo:hi].max(1) >= SURE) & (known[lo:hi] == 0), p[lo:hi].argmax(1), 0)
            spans: list[tuple[int, int, int]] = []
            beside = set(g.edges[g.edges[:, 2] == 0, 1].tolist())      # nodes with a neighbour before them
            at = -2
            for i in np.flatnonzero(found).tolist():      # none of them overlaps a base span
                a, b = g.spans[i]
                if a == b:
                    continue
                if spans and spans[-1][0] == found[i] - 1 and at == i - 1 and i in beside:
                    spans[-1] = (spans[-1][0], spans[-1][1], b)
                else:
                    spans.append((int(found[i]) - 1, a, b))
                at = i
            out.append(spans)
        return out


def train_field(x: np.ndarray, edges: np.ndarray, y: np.ndarray, steps: int = 120, ridge: float = 0.02) -> Field:
    """Likelihood ascent (AdaGrad) with belief-propagation expectations."""
    field = Field(np.zeros((x.shape[1], STATES)), np.zeros((3, STATES, STATES)))
    if not len(x):
        field.unary[:, 0] = 1.0
        return field
    x = x.astype(float)
    truth = np.eye(STATES)[y]
    seen = np.zeros_like(field.pair)
    np.add.at(seen, (edges[:, 2], y[edges[:, 0]], y[edges[:, 1]]), 1)
    past = [np.full_like(field.unary, 1e-6), np.full_like(field.pair, 1e-6)]
    for _ in range(steps):
        p, joint = field.beliefs(x @ field.unary, edges)
        expected = np.zeros_like(field.pair)
        np.add.at(expected, edges[:, 2], joint)
        for w, grad, old in ((field.unary, x.T @ (truth - p), past[0]), (field.pair, seen - expected, past[1])):
            grad = grad / len(x) - ridge * w / np.sqrt(len(x))
            old += grad ** 2
            w += 0.3 * grad / np.sqrt(old)
    return field


def fit_field(docs: DataFrame, sample_docs: int = 8000, most_nodes: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Train on the base spans of about ``sample_docs`` whole documents drawn by
    id hash; the driver gets the graphs of their digit and at-sign tokens.  Of
    these, in a fixed order, as many train the field as fit in ``most_nodes``."""
    known = docs.filter(F.col(id_col).isNotNull())
    drawn = hash_sample(known.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), "id",
                        sample_docs / max(1, known.count()), "pii")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            rows = []
            for text in part.column("text").to_pylist():
                g = graph_of(text)
                if g is not None and len(g.spans) <= most_nodes:
                    rows.append((g.x.tobytes(), g.edges.tobytes(), labels_of(g.spans, base_spans(text)).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in range(3)], names=["x", "edges", "y"])

    rows = sorted(tuple(map(bytes, r)) for r in drawn.mapInArrow(run, "x binary, edges binary, y binary").collect())
    rows.sort(key=lambda r: hashlib.sha256(r[0] + r[1]).digest())
    rows = [r for r, n in zip(rows, np.cumsum([len(r[0]) // FEATURES for r in rows])) if n <= most_nodes]
    x = [np.frombuffer(r[0], np.int8).reshape(-1, FEATURES) for r in rows]
    sizes = np.cumsum([0] + [len(v) for v in x])
    edges = [np.frombuffer(r[1], np.int64).reshape(-1, 3) + np.array([at, at, 0]) for r, at in zip(rows, sizes)]
    y = [np.frombuffer(r[2], np.int64) for r in rows]
    none = np.zeros((0, FEATURES), np.int8), np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    return train_field(*(np.concatenate(v) if v else empty for v, empty in zip((x, edges, y), none)))


def find_personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone (base spans),
    n_added, base_sha256, spans (base and added: kind:start:end in code points,
    by kind, then start).

    Null counts as empty; a text without finds has zeros and empty spans.  Rows
    repeat as they come; extra columns are not read; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = rows.select("id").schema
    for name in (*(f"n_{k}" for k in KINDS), "n_added"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = part.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            graphs = [graph_of(t) for t in texts]
            some = [n for n, g in enumerate(graphs) if g is not None]
            added = dict(zip(some, field.mark([(graphs[n], base[n]) for n in some])))
            counts = [[sum(k == kind for k, _, _ in spans) for spans in base] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([len(added.get(n, ())) for n in range(len(texts))], pa.int64()),
                 pa.array([hashlib.sha256(write_spans(s).encode()).hexdigest() for s in base], pa.string()),
                 pa.array([write_spans(s + added.get(n, [])) for n, s in enumerate(base)], pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

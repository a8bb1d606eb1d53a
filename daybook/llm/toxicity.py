"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel of two words counts the letter triples they share as subsequences,
gaps allowed: an occurrence that spans s letters weighs ``DECAY ** s``, so an
insult with inserted letters, or with an unknown ending, stays close to the
insult itself.  A few words are landmarks; the Nystroem map sends every word to
the space they span, and a linear SVM is trained there.  Put together, map and
SVM are one weight per letter triple, so a word is scored by table look-ups.

Documents carry the labels, sentences the insults.  Training therefore looks
for witnesses in the sentences of labelled documents: words with many different
left neighbours in toxic documents (copies of one document give only one) and
next to none in clean ones.

A second SVM of the same kernel is trained on whole sentences, blanks and signs
dropped, so that insults of several words, split or glued words are seen: the
worst sentences of toxic documents against those of clean ones, in rounds.
A document scores as its worst word or its worst sentence does, whichever is
higher; the cuts with the fewest errors on labelled documents turn margins into
scores (for sentences: on documents that did not train their SVM).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, crc_fold, labelled_sample, scored, space_words, staged, unit_hash

SPAN, DECAY = 6, 0.5           # letters an occurrence may span; weight per letter
GAPS = [(i, j) for i in range(1, SPAN) for j in range(1, SPAN) if i + j < SPAN]
START = 0                      # code of the mark before a word
NOT_WORD = re.compile(r"[\W_]+")
LANDMARKS, WITNESSES, CLEAN_WORDS, ROUNDS = 240, 400, 60_000, 4
LEAST_SUPPORT, LEAST_RATIO = 4, 10.0
SENTENCE_END = re.compile(r"[.!?\u2026\u3002\n\r](?:(?<=[\n\r])|(?=\s|$))")
LONGEST, OVERLAP, WINDOW = 200, 24, 5      # letters of a sentence, shared by the parts of a longer one, of a witness
TRAINED = 6000                 # sentences of either kind that start the SVM in the driver
RUNS = 20_000                  # letter runs that mark the first guess
HARD = 1500                    # clean sentences most like toxic ones that join in every round


def plain_word(word: str) -> str:
    """Lower-cased letters and digits; what stands between them is dropped."""
    return NOT_WORD.sub("", word.lower())


def plain_sentences(text: str) -> list[str]:
    """Letters and digits of every sentence; one longer than ``LONGEST`` is cut
    into overlapping parts, so that no length dilutes an insult."""
    out = []
    for sentence in SENTENCE_END.split(text.lower()):
        plain = NOT_WORD.sub("", sentence)
        if len(plain) > LONGEST:
            out += [plain[at:at + LONGEST] for at in range(0, len(plain) - OVERLAP, LONGEST - OVERLAP)]
        elif plain:
            out.append(plain)
    return out


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat 6-bit letter codes of the words, each after a start mark, and the
    word number of every code.  a-z and 0-9 have own codes; other letters share
    the remaining 27 by code point."""
    joined = "\0" + "\0".join(words)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    code = np.where((points >= 97) & (points <= 122), points - 96,
                    np.where((points >= 48) & (points <= 57), points - 48 + 27, 37 + points % 27))
    code[points == 0] = START
    return code, np.cumsum(points == 0) - 1


def triples(code: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(position, triple number, weight) of the occurrences, one gap pair at a time."""
    n = len(code)
    for one, two in GAPS:
        span = one + two
        if n <= span:
            continue
        at = np.flatnonzero(owner[span:] == owner[:n - span])
        yield at, (code[at] << 12) | (code[at + one] << 6) | code[at + span], DECAY ** (span + 1)


def norms(owner: np.ndarray, n: int) -> np.ndarray:
    """Length norm of every word: the root of its occurrences' squared weights."""
    length = np.bincount(owner, minlength=n)
    square = sum(np.maximum(length - one - two, 0) * DECAY ** (2 * (one + two + 1)) for one, two in GAPS)
    return np.sqrt(np.maximum(square, 1e-12))


def word_margins(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """SVM margin of every word from the triple weights."""
    code, owner = letter_codes(words)
    total = np.zeros(len(code))
    for at, number, weight in triples(code, owner):
        total[at] += table[number] * weight
    return np.bincount(owner, total, len(words)) / norms(owner, len(words)) + bias


def sentence_margins(sentences: list[str], table: np.ndarray, bias: float, at_once: int = 1 << 15) -> np.ndarray:
    """``word_margins`` of many sentences, about ``at_once`` letters at a time."""
    block = np.cumsum([len(s) + 1 for s in sentences]) // at_once
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if sentences else np.zeros(1, int)
    out = np.zeros(len(sentences))
    table = table.astype(np.float32, copy=False)
    for lo, hi in zip(edge, edge[1:]):
        code, owner = (x.astype(np.int32) for x in letter_codes(sentences[lo:hi]))
        total, n = np.zeros(len(code), np.float32), len(code)
        for span in range(2, SPAN):
            if n <= span:
                continue
            found = sum(table[(code[:n - span] << 12) | (code[one:n - span + one] << 6) | code[span:]] for one in range(1, span))
            total[:n - span] += found * (owner[span:] == owner[:n - span]) * np.float32(DECAY ** (span + 1))
        out[lo:hi] = np.bincount(owner, total, hi - lo) / norms(owner, hi - lo)
    return out + bias


@dataclass
class SentenceModel:
    """Triple weights and bias of the sentences' SVM, slope and offset of its score."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Margin of every text's worst sentence; a text without letters has the
        least possible one."""
        lists = [plain_sentences(t or "") for t in texts.to_pylist()]
        each = sentence_margins([s for x in lists for s in x], self.table, self.bias)
        out = np.full(len(lists), -1e3)
        doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        if len(doc):
            Detector.fold(out, doc, each)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


@dataclass
class Detector:
    """Triple weights and bias of the words' SVM, slope and offset of the score;
    the sentences' model, where one could be trained."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float
    sentences: SentenceModel | None = None

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Margin of every text's worst word; a text without words has the bias."""
        doc, code, words = space_words(texts)
        out = np.full(len(texts), self.bias)
        if not words:
            return out
        each = word_margins([plain_word(w) for w in words], self.table, self.bias)
        np.maximum.at(out, doc, each[code]) if len(doc) < 10_000 else self.fold(out, doc, each[code])
        for d, spelled in spelled_out(doc, code, words):
            out[d] = max(out[d], float(word_margins([spelled], self.table, self.bias)[0]))
        return out

    @staticmethod
    def fold(out: np.ndarray, doc: np.ndarray, value: np.ndarray) -> None:
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out[doc[first]] = np.maximum(out[doc[first]], np.maximum.reduceat(value, first))

    def score(self, texts: pa.Array) -> np.ndarray:
        words = 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))
        return words if self.sentences is None else np.maximum(words, self.sentences.score(texts))


def spelled_out(doc: np.ndarray, code: np.ndarray, words: list[str]) -> Iterator[tuple[int, str]]:
    """Runs of four or more one-letter words of a text, put together ("i d i o t")."""
    single = np.array([len(plain_word(w)) == 1 for w in words], bool)[code]
    edge = np.flatnonzero(np.diff(np.r_[0, (single).astype(np.int8), 0]))
    for a, b in zip(edge[::2], edge[1::2]):
        for d in np.unique(doc[a:b]) if b - a >= 4 else ():
            run = code[a:b][doc[a:b] == d]
            if len(run) >= 4:
                yield int(d), "".join(plain_word(words[c]) for c in run)


class Landmarks:
    """Nystroem map of words onto the space of some landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        code, owner = letter_codes(words)
        found = [(owner[at], number, np.full(len(at), weight)) for at, number, weight in triples(code, owner)]
        who, number, weight = (np.concatenate(x) for x in zip(*found))
        self.numbers = np.unique(number)
        self.column = np.full(1 << 18, -1, np.int32)
        self.column[self.numbers] = np.arange(len(self.numbers), dtype=np.int32)
        # the landmarks' triples as (column, landmark, weight), by column: a dense table would hold a hundred million numbers
        cell, place = np.unique(self.column[number].astype(np.int64) * len(words) + who, return_inverse=True)
        self.at, self.who = np.divmod(cell, len(words))
        self.value = (np.bincount(place, weight) / norms(owner, len(words))[self.who]).astype(np.float32)
        gram = np.zeros((len(words), len(words)))
        for _, _, part in self.blocks():
            gram += part.astype(np.float64) @ part.T.astype(np.float64)
        value, vector = np.linalg.eigh(gram)
        keep = value > 1e-6 * value.max()
        self.root = vector[:, keep] / np.sqrt(value[keep])

    def blocks(self, width: int = 8192) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first column, column after the last, landmarks x columns) of the table."""
        for lo in range(0, len(self.numbers), width):
            hi = min(lo + width, len(self.numbers))
            i, j = np.searchsorted(self.at, (lo, hi))
            part = np.zeros((len(self.words), hi - lo), np.float32)
            part[self.who[i:j], self.at[i:j] - lo] = self.value[i:j]
            yield lo, hi, part

    def map(self, words: list[str]) -> np.ndarray:
        rows = max(1, (1 << 23) // max(1, len(self.numbers)))      # bounds the dense block
        if len(words) > rows:
            return np.vstack([self.map(words[i:i + rows]) for i in range(0, len(words), rows)])
        code, owner = letter_codes(words)
        own = np.zeros((len(words), len(self.numbers)), np.float32)
        for at, number, weight in triples(code, owner):
            column = self.column[number]
            np.add.at(own.reshape(-1), owner[at][column >= 0] * own.shape[1] + column[column >= 0], np.float32(weight))
        kernel = sum(own[:, lo:hi] @ part.T for lo, hi, part in self.blocks())
        return kernel / norms(owner, len(words))[:, None] @ self.root

    def weights(self, w: np.ndarray) -> np.ndarray:
        """The SVM's weight per letter triple."""
        table = np.zeros(1 << 18)
        each = self.root @ w
        table[self.numbers] = np.bincount(self.at, each[self.who] * self.value, len(self.numbers))
        return table


def train_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 0.05, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton steps in the primal."""
    shrink = np.full(x.shape[1] + 1, ridge)
    shrink[-1] = 1e-3
    w = np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        inside = np.flatnonzero(y * (x @ w[:-1] + w[-1]) < 1)
        square, right = np.diag(shrink), np.zeros(len(w))
        for i in range(0, len(inside), 2048):          # the rows' weighted copy stays small
            rows = inside[i:i + 2048]
            part = np.column_stack([x[rows], np.ones(len(rows))])
            weighted = part * cost[rows][:, None]
            square += weighted.T @ part
            right += weighted.T @ y[rows]
        new = np.linalg.solve(square, right)
        if np.abs(new - w).max() < 1e-6:
            return new[:-1], float(new[-1])
        w = new
    return w[:-1], float(w[-1])


def fit_words(witnesses: list[str], clean: list[str]) -> tuple[np.ndarray, float]:
    """Triple weights and bias that separate witnesses from clean words; the
    clean words that look most like insults join, as examples and as landmarks,
    in further rounds."""
    spread = np.random.default_rng(1).permutation(len(clean))
    used = [clean[i] for i in spread[:3000]]
    against = used[:LANDMARKS // 4]
    for _ in range(ROUNDS):
        marks = Landmarks(witnesses[:LANDMARKS] + against)
        y = np.r_[np.ones(len(witnesses)), -np.ones(len(used))]
        cost = np.where(y > 0, min(30.0, max(1.0, len(used) / len(witnesses))), 1.0)
        w, bias = train_svm(marks.map(witnesses + used), y, cost)
        table = marks.weights(w)
        hard = [clean[i] for i in np.argsort(-word_margins(clean, table, bias))[:1500]]
        against = list(dict.fromkeys(against + hard[:LANDMARKS // 3]))
        used = list(dict.fromkeys(used + hard))
    return table, bias


def windows(sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, window number) of the different runs of ``WINDOW`` letters of
    every sentence."""
    code, owner = letter_codes(sentences)
    n = max(0, len(code) - WINDOW + 1)
    key = sum(code[k:n + k] << (6 * (WINDOW - 1 - k)) for k in range(WINDOW))
    inside = (owner[:n] == owner[len(code) - n:]) & (code[:n] != START)
    both = np.sort((owner[:n][inside] << (6 * WINDOW)) | key[inside])
    both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
    return both >> (6 * WINDOW), both & ((1 << (6 * WINDOW)) - 1)


def letters_of(run: int) -> str:
    """A text whose letter codes are those of a run's number."""
    codes = [(run >> (6 * k)) & 63 for k in reversed(range(WINDOW))]
    return "".join(chr(c + 96) if c <= 26 else chr(c + 21) if c <= 36 else chr(27 * 50 + c - 37) for c in codes)


def mapped(sentences: DataFrame, columns, schema: str) -> DataFrame:
    """``columns(piece) -> arrays`` over bounded pieces of a sentence table."""
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "sentence", 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns(part)], names=names)

    return sentences.mapInArrow(run, schema)


def fit_sentences(found: DataFrame) -> SentenceModel | None:
    """Multiple-instance SVM: which sentences of a toxic document are toxic is
    not known.  ``found``: (id, label, sentence).

    The first guess are those with a run of letters that many different toxic
    sentences and next to no clean ones share (copies of a sentence count once);
    those runs are landmarks too.  Further rounds take every toxic document's
    worst sentence, and the clean sentences most like them.  Runs are counted and
    sentences scored by Spark; to the driver come the ``RUNS`` commonest runs,
    ``TRAINED`` sentences of either kind, ``HARD`` clean ones a round and one of
    every toxic document of the sample.  None: no such run.
    """
    kinds = staged(found.groupBy("sentence").agg(F.min("label").alias("toxic")), "toxicity-kinds")     # 1: in no clean document
    sizes = {r[0]: r[1] for r in kinds.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None

    def count(part: pa.RecordBatch) -> list[np.ndarray]:
        owner, key = windows(part.column("sentence").to_pylist())
        toxic = part.column("toxic").to_numpy(False)[owner]
        number, place = np.unique(key, return_inverse=True)
        return [number, *(np.bincount(place[toxic == y], minlength=len(number)) for y in (1, 0))]

    runs = mapped(kinds, count, "run long, support long, clean long").groupBy("run").agg(F.sum("support").alias("support"), F.sum("clean").alias("clean"))
    is_witness = (F.col("support") >= LEAST_SUPPORT) & (F.col("support") / sizes[1] > LEAST_RATIO * (F.col("clean") + 0.5) / sizes[0])
    often = runs.filter(is_witness).orderBy(F.desc("support"), "run").limit(RUNS).select("run").toArrow().column(0).to_numpy()
    if not len(often):
        return None
    known = np.sort(often)

    def marks_it(part: pa.RecordBatch) -> list:
        owner, key = windows(part.column("sentence").to_pylist())
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return [part.column("sentence").take(pa.array(np.unique(owner[known[place] == key])))]

    def drawn(rows: DataFrame, n: int) -> list[str]:
        return sorted(rows.filter(unit_hash(F.col("sentence")) < TRAINED / max(1, n)).select("sentence").toArrow().column(0).to_pylist())

    guess = staged(mapped(kinds.filter("toxic = 1"), marks_it, "sentence string"), "toxicity-guess")
    clean = kinds.filter("toxic = 0")
    positive, used = drawn(guess, guess.count()), drawn(clean, sizes[0])
    marked = list(dict.fromkeys(map(letters_of, often[:LANDMARKS].tolist())))
    against = used[::max(1, len(used) // (LANDMARKS // 4))]
    toxic = found.filter("label = 1")
    for at in range(ROUNDS):
        marks = Landmarks(marked + against)
        y = np.r_[np.ones(len(positive)), -np.ones(len(used))]
        cost = np.where(y > 0, min(30.0, max(1.0, len(used) / len(positive))), 1.0)
        w, bias = train_svm(marks.map(positive + used), y, cost)
        table = marks.weights(w).astype(np.float32)
        if at == ROUNDS - 1:
            break

        def margins(part: pa.RecordBatch, table=table, bias=bias) -> list:
            sentences = part.column("sentence")
            return [part.column("id"), sentences, sentence_margins(sentences.to_pylist(), table, bias)]

        worst = (mapped(clean.select(F.lit("").alias("id"), "sentence"), margins, "id string, sentence string, margin double")
                 .orderBy(F.desc("margin"), "sentence").limit(HARD).select("sentence").toArrow().column(0).to_pylist())
        against = list(dict.fromkeys(against + worst[:LANDMARKS // 3]))
        used = list(dict.fromkeys(used + worst))
        of_doc = (mapped(toxic, margins, "id string, sentence string, margin double").filter("margin > 0")
                  .groupBy("id").agg(F.max(F.struct("margin", "sentence")).alias("top")).select("top.sentence"))
        positive = sorted({*positive, *of_doc.toArrow().column(0).to_pylist()} - set(used))
    return SentenceModel(table, bias)


def fit_score(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score: it is 0.5 where the weighted number of
    errors is least (the middle of the widest such gap; wrong labels far away do
    not move it), and 0.98 at the median distance from there."""
    order = np.argsort(margin, kind="stable")
    margin, y, weight = margin[order], y[order], weight[order]
    # errors of a cut before place i: toxic rows below it, clean rows from it on
    errors = np.r_[0, np.cumsum(weight * y)] + np.r_[np.cumsum((weight * (1 - y))[::-1])[::-1], 0]
    edge = np.r_[margin[0] - 1, margin, margin[-1] + 1]
    gap = np.where(errors <= errors.min() + 1e-9, np.diff(edge), -1.0)
    at = int(gap.argmax())
    cut = (edge[at] + edge[at + 1]) / 2
    slope = 4 / max(1e-6, float(np.median(np.abs(margin - cut))))
    return slope, -slope * cut


def fit_detector(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0,
                 most: tuple[int, int] = (10_000, 2_500), id_col: str = "doc_id", text_col: str = "text") -> Detector:
    """Fit on about ``most`` (clean, toxic) labelled documents outside the
    held-out fold, whole texts.

    To the driver come at most ``WITNESSES`` and about ``CLEAN_WORDS`` words,
    the sentences that ``fit_sentences`` names and one margin per sampled
    document.  Without toxic documents or witnesses every
    document scores the share of toxic rows, at most 0.49.
    """
    drawn, counts = labelled_sample(docs, labels, label, folds, held, most, id_col, text_col)
    sample = staged(drawn.select("id", "text", "label"), "toxicity-sample")

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=2 << 20):
            doc, code, words = space_words(part.column("text"))
            if not words:
                continue
            plain = [plain_word(w) for w in words]
            number = {w: n for n, w in enumerate(dict.fromkeys(plain))}
            kinds = list(number)
            code = np.array([number[w] for w in plain], np.int64)[code]
            toxic = np.array(part.column("label").to_pylist(), bool)[doc]
            before = np.where(np.r_[False, doc[1:] == doc[:-1]], np.r_[0, code[:-1]], -1)
            pairs = np.unique(code[toxic] * (len(kinds) + 1) + before[toxic] + 1)
            word, left = pa.array(pairs // (len(kinds) + 1)), pairs % (len(kinds) + 1) - 1
            of_docs = np.unique((doc * 2 + toxic) * len(kinds) + code)
            in_toxic, in_clean = (np.bincount(of_docs[of_docs // len(kinds) % 2 == y] % len(kinds), minlength=len(kinds)) for y in (1, 0))
            names = pa.array(kinds, pa.string())
            left = pa.array(left, mask=left < 0)
            none = np.zeros(len(pairs), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([names.take(word), names]),
                 pa.concat_arrays([names.take(left).fill_null(""), pa.nulls(len(kinds), pa.string())]),
                 pa.array(np.r_[none, in_toxic]), pa.array(np.r_[none, in_clean])], names=["word", "before", "toxic", "clean"])

    stats = staged(sample.mapInArrow(uses, "word string, before string, toxic long, clean long").filter(F.length("word") >= 3)
                   .groupBy("word", "before").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                   .groupBy("word").agg(F.count("before").alias("support"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
                   "toxicity-words")
    n_toxic, n_clean = max(1, min(most[1], counts.get(1, 0))), max(1, min(most[0], counts.get(0, 0)))
    is_witness = (F.col("support") >= LEAST_SUPPORT) & (F.col("toxic") / n_toxic > LEAST_RATIO * (F.col("clean") + 0.5) / n_clean)
    witnesses = [r[0] for r in stats.filter(is_witness).orderBy(F.desc("support"), "word").limit(WITNESSES).collect()]
    others = stats.filter(~is_witness & (F.col("clean") > 0))
    often = [r[0] for r in others.orderBy(F.desc("clean"), "word").limit(CLEAN_WORDS // 2).select("word").collect()]
    drawn = others.filter(unit_hash(F.col("word")) < CLEAN_WORDS / 2 / max(1, others.count())).select("word")
    clean = sorted({*often, *(r[0] for r in drawn.collect())})
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not witnesses or not clean:
        share = min(0.49, max(share, 1e-6))
        return Detector(np.zeros(1 << 18), 0.0, 1.0, float(np.log(share / (1 - share))), sentence_model(sample, None))
    table, bias = fit_words(witnesses, clean)
    raw = Detector(table, bias, 1.0, 0.0)
    rows = scored(sample, lambda texts: [raw.margins(texts)], {"margin": "double"}, "id", "text")
    known = sample.select("id", "label").join(rows, "id").orderBy("id").select("label", "margin").collect()
    y, margin = np.array([r[0] for r in known], float), np.array([r[1] for r in known])
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts.get(0, 1) / max(1, (1 - y).sum()))
    detector = Detector(table.astype(np.float32), bias, *fit_score(margin, y, weight))
    detector.sentences = sentence_model(sample, detector)
    return detector


def sentence_model(sample: DataFrame, detector: Detector | None) -> SentenceModel | None:
    """The sentences' SVM, trained on one half of the sample; its cut is that
    with the fewest errors on the documents of the other half that the words
    leave open."""
    half = F.crc32(F.concat(F.lit("half"), F.col("id").cast("string"))) % 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=2 << 20):
            lists = [list(dict.fromkeys(plain_sentences(t))) for t in part.column("text").to_pylist()]
            doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(doc)).cast(pa.string()), part.column("label").take(pa.array(doc)),
                                              pa.array([s for x in lists for s in x], pa.string())], names=["id", "label", "sentence"])

    found = staged(sample.filter(half == 0).mapInArrow(cut, "id string, label int, sentence string"), "toxicity-sentences")
    model = fit_sentences(found)
    if model is None:
        return None

    def both(texts: pa.Array) -> list[np.ndarray]:
        return [detector.score(texts) if detector else np.zeros(len(texts)), model.margins(texts)]

    other = sample.filter(half == 1)
    margins = scored(other, both, {"words": "double", "margin": "double"}, "id", "text")
    open_ = other.select("id", "label").join(margins, "id").filter("words < 0.5 AND margin > -1e3").orderBy("id").select("label", "margin").collect()
    if not open_:
        return None
    model.slope, model.offset = fit_score(np.array([r[1] for r in open_]), np.array([r[0] for r in open_], float), np.ones(len(open_)))
    return model


def score_toxicity(docs: DataFrame, model: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (score >= 0.5).

    Null counts as empty; a text without words scores as its worst word were
    unknown.  Rows repeat as they come; extra columns are not read; an empty
    table gives an empty result.
    """
    def score(texts: pa.Array) -> list[np.ndarray]:
        s = model.score(texts)
        return [s, (s >= 0.5).astype(np.int32)]

    return scored(docs, score, {"score": "double", "predicted": "integer"}, id_col, text_col, 2 << 20)


def without_toxic(docs: DataFrame, model: Detector, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col, 2 << 20):
            yield part.filter(pa.array(model.score(part.column(text_col)) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", folds: int = 5, held: int = 0) -> DataFrame:
    """Scores of all documents, with the held-out fold marked."""
    model = fit_detector(docs, labels, folds=folds, held=held, id_col=id_col)
    return score_toxicity(docs, model, id_col).select(id_col, (crc_fold(id_col, folds) == held).alias("held_out"), "score", "predicted")

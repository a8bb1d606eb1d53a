"""Language identification by interpolated Kneser-Ney character models.

Every language has a character model of order ``ORDER`` over lower-cased words
with a border mark on both sides.  N-gram counts are Spark aggregates over
nine in ten learnable documents, whatever their number; the driver sees n-gram
types only.  The tenth, left out of the counts, sets the rejection limits.
The models of all languages lie side by side in arrays sorted by n-gram hash:
one binary search gives a character's probability, or the weight with which it
backs off, in every language.  A document's language is that with the lowest
cross-entropy per character; a document whose cross-entropy is above nearly all
of its language's own documents is marked as rejected.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, chunks, scored, space_words, text_of, unit_hash

ORDER = 4
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
BORDER = "\n"
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
REJECT_SHARE, LIMIT_SHARE = 0.005, 0.1


def letter_words(word: str) -> str:
    """Lower-cased letter runs of a white-space word, joined by the border mark
    (empty: no letter)."""
    out = NOT_LETTERS.sub(BORDER, word.lower()).strip(BORDER)
    if out and not out.replace(BORDER, "").isalpha():          # numerals such as ², ½ and Ⅷ are no letters
        out = BORDER.join("".join(c if c.isalpha() else " " for c in out).split())
    return out


def gram_hash(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position (positions
    before ``order - 1`` are meaningless)."""
    h = np.full(len(chars), order, np.uint64)
    with np.errstate(over="ignore"):
        for back in range(order):
            shifted = np.zeros(len(chars), np.uint64)
            shifted[back:] = chars[:max(0, len(chars) - back)]
            h = (h ^ (shifted + np.uint64(1)) * np.uint64(MIX[back])) * np.uint64(MIX[0])
            h ^= h >> np.uint64(29)
    return h


def hash_of(gram: str) -> int:
    return int(gram_hash(np.array([ord(c) for c in gram], np.uint64), len(gram))[-1])


@dataclass
class Models:
    """``grams[n]``: sorted hashes and log probabilities (a column per language)
    of n-grams; ``contexts[n]``: sorted hashes and log back-off weights of
    (n-1)-character contexts; ``floor``: log probability of an unseen character."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    limits: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of every word in every language, and the number of
        characters scored (the closing border counts; no letters: 0)."""
        clean = [letter_words(w) for w in words]
        joined = BORDER + "".join([c + BORDER for c in clean if c])
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
        counts = np.array([len(c) + 1 if c else 0 for c in clean], np.int64)
        at = np.arange(1, len(chars))
        total = np.zeros((len(chars), len(self.languages)))
        left, weight = at, np.zeros((len(at), len(self.languages)))
        border = np.flatnonzero(chars == ord(BORDER))
        since = np.arange(len(chars)) - border[np.searchsorted(border, np.arange(len(chars)), "left") - 1]
        since[0] = 0               # characters since the border before: no n-gram reaches across
        hashed = [gram_hash(chars, n) for n in range(ORDER + 1)]
        for n in range(ORDER, 0, -1):
            h = hashed[n]
            usable = since[left] >= n - 1 if n > 1 else np.ones(len(left), bool)
            hashes, values = self.grams[n]
            near = np.minimum(np.searchsorted(hashes, h[left]), len(hashes) - 1)
            seen = usable & (hashes[near] == h[left])
            total[left[seen]] = weight[seen] + values[near[seen]]
            if n > 1:
                hc = hashed[n - 1]
                hashes, values = self.contexts[n]
                near = np.minimum(np.searchsorted(hashes, hc[left - 1]), len(hashes) - 1)
                back = usable & ~seen & (hashes[near] == hc[left - 1])
                weight[back] += values[near[back]]
            left, weight = left[~seen], weight[~seen]
        total[left] = weight + self.floor
        ends = np.cumsum(counts)
        run = np.vstack([np.zeros(len(self.languages)), np.cumsum(total[1:], axis=0)])
        return run[ends] - run[ends - counts], counts

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (a column per language) and the number of
        characters scored, per text."""
        doc, code, words = space_words(texts)
        n = len(texts)
        if not words:
            return np.zeros((n, len(self.languages))), np.zeros(n)
        scores, counts = self.word_scores(words)
        chars = np.bincount(doc, counts[code], n)
        sums = np.column_stack([np.bincount(doc, scores[code, k], n) for k in range(len(self.languages))])
        return -sums / np.maximum(chars, 1)[:, None], chars

    def predict(self, texts: pa.Array) -> list[np.ndarray]:
        """Language, score and rejection per text."""
        entropy, chars = self.entropies(texts)
        best = entropy.argmin(1)
        low = entropy[np.arange(len(best)), best]
        # posterior under equal priors, of a text of 20 characters at this cross-entropy
        score = 1 / np.exp(np.clip(-20 * (entropy - low[:, None]), -500, 0)).sum(1)
        letters = chars > 0
        names = np.where(letters, np.array(self.languages, object)[best], UNKNOWN)
        limit = self.limits[best] if self.limits is not None else np.full(len(best), np.inf)
        return [names, np.where(letters, score, 0.0), ~letters | (low > limit)]


def kneser_ney(types: dict[str, dict[str, int]]) -> Models:
    """Interpolated Kneser-Ney models from the counts of the highest-order
    n-grams (shorter only where a word begins) of every language."""
    languages = sorted(types)
    probability: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER + 1)]
    back_off: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER + 1)]
    size = len(languages)
    counts = [[defaultdict(int) for _ in range(ORDER + 1)] for _ in languages]
    for k, language in enumerate(languages):
        for gram, count in types[language].items():
            counts[k][len(gram)][gram] += count
        for n in range(ORDER, 1, -1):      # lower orders: the number of different left neighbours
            for gram in list(counts[k][n]):
                counts[k][n - 1][gram[1:]] += 1
    characters = len({g for c in counts for g in c[1]}) + 1
    floor = np.full(size, -np.log(characters))
    for n in range(1, ORDER + 1):
        grams = sorted({g for c in counts for g in c[n]})
        # the shorter model for every gram, language by language
        lower = np.array([probability[n - 1][g[1:]] if n > 1 else np.exp(floor) for g in grams]).reshape(len(grams), size)
        raw = np.array([[c[n].get(g, 0) for c in counts] for g in grams], float).reshape(len(grams), size)
        once, twice = (raw == 1).sum(0), (raw == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        context = {c: i for i, c in enumerate(sorted({g[:-1] for g in grams}))}
        row = np.array([context[g[:-1]] for g in grams], int)
        totals, kinds = np.zeros((len(context), size)), np.zeros((len(context), size))
        np.add.at(totals, row, raw)
        np.add.at(kinds, row, raw > 0)
        gamma = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
        value = np.where(totals[row] > 0, np.maximum(raw - discount, 0) / np.maximum(totals[row], 1), 0) + gamma[row] * lower
        probability[n] = dict(zip(grams, value))
        back_off[n] = {c: gamma[i] for c, i in context.items()}
        if n == 1:
            floor = np.log(gamma[0] * np.exp(floor)) if len(gamma) else floor

    def table(entries: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not entries:
            return np.zeros(1, np.uint64), np.zeros((1, size))
        hashes = np.array([hash_of(g) for g in entries], np.uint64)
        order = np.argsort(hashes)
        return hashes[order], np.log(np.maximum(np.array(list(entries.values())), 1e-12))[order]

    grams = [(np.zeros(1, np.uint64), np.zeros((1, size)))] + [table(p) for p in probability[1:]]
    contexts = [grams[0], grams[0]] + [table({c: g for c, g in b.items() if c}) for b in back_off[2:]]
    return Models(languages, grams, contexts, floor)


def word_grams(word: str) -> Iterator[str]:
    """The longest n-gram that ends at each character of a marked word."""
    marked = BORDER + word + BORDER
    for end in range(2, len(marked) + 1):
        yield marked[max(0, end - ORDER):end]


def longest_grams(words: list[str], counts: np.ndarray) -> dict[str, int]:
    """The n-grams of ``word_grams`` for all pieces of ``words`` (as of
    ``letter_words``, none empty), where every word counts ``counts`` times."""
    joined = BORDER + "".join([w + BORDER for w in words])
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    alphabet, coded = np.unique(chars, return_inverse=True)
    out: dict[str, int] = defaultdict(int)
    if len(alphabet) > 0xFFFF:         # no room for four codes in one key
        for word, n in zip(words, counts):
            for gram in (g for piece in word.split(BORDER) for g in word_grams(piece)):
                out[gram] += int(n)
        return out
    coded = coded.astype(np.uint64) + np.uint64(1)         # 0: no character
    at = np.arange(len(chars))
    since = at[1:] - np.maximum.accumulate(np.where(chars == ord(BORDER), at, 0))[:-1]
    key = coded[1:].copy()
    for back in range(1, ORDER):
        far = np.flatnonzero(since >= back)                # the n-gram does not reach across the border before
        key[far] |= coded[far + 1 - back] << np.uint64(16 * back)
    kinds, which = np.unique(key, return_inverse=True)
    total = np.zeros(len(kinds), np.int64)
    np.add.at(total, which, np.repeat(np.asarray(counts, np.int64), [len(w) + 1 for w in words]))
    letters = ["", *map(chr, alphabet.tolist())]
    columns = [((kinds >> np.uint64(16 * back)) & np.uint64(0xFFFF)).tolist() for back in range(ORDER - 1, -1, -1)]
    return dict(zip(("".join([letters[c] for c in codes]) for codes in zip(*columns)), total.tolist()))


def fit_languages(docs: DataFrame, folds: int = 3, held: int = 1,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Models:
    """Fit on all documents with a language outside the held-out fold: those
    whose id hashes below ``LIMIT_SHARE`` set the rejection limits, all others
    the counts.

    Empty labels (no row with a language) give a model without languages; a
    language without a document for its limit rejects nothing.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (crc_fold(id_col, folds) != held))
    names = [r[0] for r in known.select(lang_col).distinct().collect()]
    if not names:
        return Models([], [], [], np.zeros(0))
    draw = unit_hash(F.concat(F.lit("lang"), F.col(id_col).cast("string")))
    counted, apart = (known.filter(x).select(F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
                      for x in (draw >= LIMIT_SHARE, draw < LIMIT_SHARE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            doc, code, words = space_words(part.column("text"))
            lang = np.array(part.column("lang").to_pylist(), object)
            grams: dict[tuple[str, str], int] = {}
            names, of = np.unique(lang.astype(str), return_inverse=True)
            clean = [letter_words(w) for w in words]
            key, n = np.unique(of[doc] * max(1, len(words)) + code, return_counts=True)
            for k, name in enumerate(names):
                mine = [(i, c) for i, c in zip((key - k * len(words)).tolist(), n.tolist()) if 0 <= i < len(words) and clean[i]]
                found = longest_grams([clean[i] for i, _ in mine], np.array([c for _, c in mine], np.int64))
                grams.update({(name, gram): c for gram, c in found.items()})
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in grams], pa.string()), pa.array([k[1] for k in grams], pa.string()),
                                              pa.array(list(grams.values()), pa.int64())], names=["lang", "gram", "n"])

    types: dict[str, dict[str, int]] = {k: {} for k in names}
    for lang, gram, n in (counted.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n")).collect()):
        types[lang][gram] = n
    models = kneser_ney(types)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            entropy, chars = models.entropies(part.column("text"))
            mine = np.array([models.languages.index(x) for x in part.column("lang").to_pylist()], int)
            long = chars >= 20
            yield pa.RecordBatch.from_arrays([part.column("lang").filter(pa.array(long)), pa.array(entropy[np.arange(len(mine)), mine][long])], names=["lang", "h"])

    # cross-entropies of documents that the counts have not seen
    cut = {r[0]: r[1] for r in apart.mapInArrow(own, "lang string, h double").groupBy("lang").agg(
        F.percentile_approx("h", 1 - REJECT_SHARE, 10_000)).collect()}
    models.limits = np.array([cut.get(k, np.inf) for k in models.languages]) * 1.1
    return models


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (0 to 1), rejected.

    Null and letterless texts are ``und`` with score 0 and rejected; so is every
    text if the models know no language.  Equal cross-entropies go to the first
    language by code point.  Rows repeat as they come; extra columns are not
    read; an empty table gives an empty result.
    """
    def score(texts: pa.Array) -> list[np.ndarray]:
        if not models.languages:
            n = len(texts)
            return [np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)]
        return models.predict(texts)

    return scored(docs, score, {"lang_pred": "string", "score": "double", "rejected": "boolean"}, id_col, text_col)


def language_report(docs: DataFrame, id_col: str = "doc_id", folds: int = 3, held: int = 1) -> DataFrame:
    """Predictions for all documents, with the held-out fold marked."""
    models = fit_languages(docs, folds, held, id_col=id_col)
    return identify(docs, models, id_col).select(id_col, (crc_fold(id_col, folds) == held).alias("held_out"), "lang_pred", "score", "rejected")

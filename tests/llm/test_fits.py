"""Fits over all learnable rows against plain loops."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import langid, quality


def test_grams_of_many_words_equal_those_of_each(spark):
    draw = np.random.default_rng(4)
    letters = [*"abcdeé\U0001F600中", *map(chr, range(0x3041, 0x3060))]
    words = ["".join(draw.choice(letters, draw.integers(1, 9))) for _ in range(500)] + ["a\nbc\ndefgh", "x", "b" * 5000]
    counts = draw.integers(1, 4, len(words))
    want = Counter()
    for word, n in zip(words, counts):
        for piece in word.split("\n"):
            for gram in langid.word_grams(piece):
                want[gram] += int(n)
    assert langid.longest_grams(words, counts) == want
    assert langid.longest_grams([], np.zeros(0, int)) == {}


def test_more_letters_than_a_key_has_room_for():
    words = ["".join(map(chr, range(i, i + 500))) for i in range(0x10000, 0x22000, 500)]
    want = Counter(g for w in words for g in langid.word_grams(w))
    assert langid.longest_grams(words, np.ones(len(words), int)) == want


@pytest.fixture(scope="module")
def labelled(spark):
    draw = np.random.default_rng(2)
    kinds = ["word", "other", "longer", "tiny", "more", "text", "###", "Q1!", "WOW", "||"]
    docs, labels = [], []
    for i in range(9000):
        bad = draw.random() < 0.4
        share = [0.14] * 6 + [0.04] * 4 if bad else [0.15] * 6 + [0.025] * 4
        docs.append((i, " ".join(draw.choice(kinds, draw.integers(5, 30), p=share))))
        if i % 10:
            labels.append((i, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_ranking_is_fitted_on_every_labelled_row_and_pair(spark, labelled):
    docs, labels = labelled
    model = quality.fit_ranking(docs, labels)
    rows = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).toPandas()
    x, y = quality.features(pa.array(rows["text"])), rows["quality"].to_numpy()
    assert quality.labelled_features(docs, labels, "quality", 4, 2).count() == len(rows) > 6000
    assert model.mean == pytest.approx(x.mean(0), abs=1e-9) and model.spread == pytest.approx(np.maximum(x.std(0), 1e-6), abs=1e-9)
    # the loss of all pairs is least at these weights: its gradient, pair by pair, vanishes
    z = (x - model.mean) / model.spread
    s, grad = z @ model.weights, np.zeros(z.shape[1])
    for i in np.flatnonzero(y == 1):
        p = 1 / (1 + np.exp(s[i] - s[y == 0]))
        grad += p.sum() * z[i] - p @ z[y == 0]
    grad = grad / ((y == 1).sum() * (y == 0).sum()) - 1e-2 * model.weights
    assert np.abs(grad).max() < 2e-5 and np.abs(model.weights).max() > 0.05
    order = np.sort(s)
    assert model.cut == pytest.approx(order[(y == 0).sum() - 1:][:2].mean(), abs=1e-9)
    assert model.slope == pytest.approx(4 / np.median(np.abs(s - model.cut)), rel=1e-9)


def test_ranking_without_both_labels_scores_the_same_everywhere(spark, labelled):
    docs, labels = labelled
    model = quality.fit_ranking(docs, labels.where("quality = 1"))
    assert not model.weights.any() and model.score(np.ones((1, len(quality.FEATURES)))) == pytest.approx([quality.LABEL_SHARE_AT])

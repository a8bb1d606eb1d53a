"""Every operator against a library, a brute-force version, an exact round trip
or its held-out labels."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from daybook.llm import bpe, exact, langid, minhash, mixing, pii, prefix_count, queries, toxicity, vectors
from daybook.llm.common import table

from ..conftest import SF_CHECK, SF_SMALL

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
ODD = [chr(i) for i in range(0x250)] + [*"̀́ͅΣσİẞKﬁ가中😀‍\x85\xa0 　\x1c​٠²", "<|endoftext|>", " ", "\n",
                                      "'s", "'ll", " the", "aaaaaa", "ingin", "an" * 40]


def odd_texts(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choices(ODD, k=draw.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SF_SMALL, "documents").collect()}


LABELLED = "/root/testdata/sf0.1"      # the smaller tables hold a few dozen toxic rows


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in table(spark, LABELLED, "labels").collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twins(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(SF_SMALL, 'documents.parquet')}'")
    want = con.execute(queries.ORACLE[name]).df().sort_values("doc_id", ignore_index=True)
    got = queries.QUERIES[name](spark, SF_SMALL).toPandas().sort_values("doc_id", ignore_index=True)[list(want.columns)]
    assert got.equals(want) or all(np.allclose(got[c], want[c]) if got[c].dtype.kind == "f" else (got[c] == want[c]).all() for c in want)


def test_bytes_as_the_library(spark, texts):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(BYTES), special_tokens={})
    for r in queries.op3_merge_replay(spark, SF_SMALL).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r.doc_id]))
    replay = bpe.MergeReplay(BYTES, public_tokenizers.PATTERN, held=50)
    for text in odd_texts(800):
        assert replay.encode(text) == own.encode_ordinary(text)
        assert replay.decode(replay.encode(text)).decode() == text


def test_counts_as_the_library(spark, texts):
    library = Tokenizer.from_file(WORDS)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in queries.op7_prefix_token_counts(spark, SF_SMALL).collect():
        n = count(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)
        if r.over_limit:
            assert count(texts[r.doc_id][:r.limit_chars]) <= 2048
    counter = prefix_count.PrefixCounter(WORDS, held=50)
    for n, text in enumerate(odd_texts(600, 4)):
        assert counter.text_count(text) == count(text)
        if n % 10 == 0:
            assert counter.prefix_counts(text) == [count(text[:k]) for k in range(len(text) + 1)]
    for text in list(texts.values())[:3]:
        assert counter.prefix_counts(text[:250]) == [count(text[:k]) for k in range(len(text[:250]) + 1)]


def brute_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + n % 2), 10)) for n, d in enumerate(digits[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return out


def test_base_spans():
    draw = random.Random(5)
    pieces = ["a", "b.c", "@", ".", "x-y", " ", "+", "1", "12", "4111 1111-1111 1111", "256", "10.0.0.1", "+1 (555) 123-4567", "é", "\n", "-", "(", "%", "0005"]
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=draw.randint(1, 12)))
        assert pii.write_spans(pii.base_spans(text)) == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(text)), text


def test_skip_chains_add_and_keep(spark, texts):
    rows = queries.op2_skip_chain_pii(spark, SF_SMALL).collect()
    for r in rows:
        base = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",") if r.spans else [])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in pii.KINDS)
    # a skip edge carries a label to an equal token that its own features leave open
    field = pii.Field(np.zeros((2, pii.STATES)), np.zeros((3, pii.STATES, pii.STATES)))
    field.pair[1] = 4 * np.eye(pii.STATES)
    p, _ = field.beliefs(np.array([[0, 0, 0, 5.0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 0]]), np.array([[0, 1, 1]]))
    assert p[1].argmax() == 3 and p[1, 3] > 0.8 and abs(p[2] - 0.2).max() < 1e-9


def test_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 64))
    for k in range(120):               # near copies around the threshold
        x[180 + k] = x[k % 20] + draw.normal(size=64) * draw.uniform(0.1, 0.45)
    x[299], x[298] = x[0], x[0] * 3
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(300)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    label = np.arange(300)
    while True:
        new = np.array([label[link[i]].min() for i in range(300)])
        if (new == label).all():
            break
        label = new
    for r in vectors.near_vectors(df).collect():
        assert (r.n_links, r.component_id, r.kept) == (link[r.vec_id].sum() - 1, label[r.vec_id], label[r.vec_id] == r.vec_id)
    assert link.sum() > 400


def test_models_on_held_out_rows(spark, labels):
    toxic = [r for r in queries.op1_string_kernel_toxicity(spark, LABELLED).collect() if r.held_out and r.doc_id in labels]
    good = [r for r in queries.op9_bradley_terry_quality(spark, LABELLED).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].toxic for r in toxic]) > 0.95
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in good]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in good)
    known = {r.doc_id: r.lang for r in table(spark, SF_CHECK, "documents").select("doc_id", "lang").collect()}
    lang = [r for r in queries.op5_kneser_ney_language(spark, SF_CHECK).collect() if r.held_out]
    assert np.mean([r.lang_pred == known[r.doc_id] for r in lang]) > 0.98


def test_kernel_tolerates_gaps():
    syllables = "the and ing tion er en ch le re que or an is it of ha ou nt ea st th wh ly sh".split()
    draw = random.Random(2)
    clean = sorted({"".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(6000)})
    fitted = toxicity.fit_words(["idiot", "moron", "stupid", "worthless", "pathetic"], clean)
    insults = toxicity.word_margins(["idiot", "iddiot", "moroon", "stupidd", "worthlesss"], *fitted)
    assert insults.min() > np.quantile(toxicity.word_margins(clean, *fitted), 0.999)


def test_kernel_is_the_gapped_subsequence_kernel():
    def phi(word):
        code, _ = toxicity.letter_codes([word])
        out = Counter()
        for i in range(len(code)):
            for j in range(i + 1, len(code)):
                for k in range(j + 1, min(len(code), i + toxicity.SPAN)):
                    out[(code[i] << 12) | (code[j] << 6) | code[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    code, owner = toxicity.letter_codes(["idiot", "moroon"])
    got = [Counter(), Counter()]
    for at, number, weight in toxicity.triples(code, owner):
        for p, n in zip(at, number):
            got[owner[p]][n] += weight
    for word, found in zip(["idiot", "moroon"], got):
        want = phi(word)
        assert found.keys() == want.keys() and all(math.isclose(found[k], want[k]) for k in want)


def test_kneser_ney_sums_to_one():
    grams = {"a": Counter(), "b": Counter()}
    for lang, words in (("a", ["the", "then", "that", "at"]), ("b", ["que", "quel", "le"])):
        for word in words:
            grams[lang].update(langid.word_grams(word))
    models = langid.kneser_ney({k: dict(v) for k, v in grams.items()})
    letters = sorted({c for g in grams.values() for w in g for c in w})
    for context in ("", "t", "th", "q", "xx"):
        total = np.zeros(2)
        for c in [*letters, "\0"]:      # the last stands for every unseen character
            chars = np.array([ord(x) for x in "\n" + context + c], np.uint64)
            weight = np.zeros(2)
            for n in range(min(langid.ORDER, len(chars)), 0, -1):
                hashes, values = models.grams[n]
                h = langid.gram_hash(chars, n)[-1]
                at = min(np.searchsorted(hashes, h), len(hashes) - 1)
                if hashes[at] == h:
                    total += np.exp(weight + values[at])
                    break
                if n > 1:
                    hashes, values = models.contexts[n]
                    h = langid.gram_hash(chars[:-1], n - 1)[-1]
                    at = min(np.searchsorted(hashes, h), len(hashes) - 1)
                    weight = weight + (values[at] if hashes[at] == h else 0)
            else:
                total += np.exp(weight + models.floor)
        assert np.allclose(total, 1, atol=1e-6), context


def brute_near(texts, weights):
    """Components of weighted Jaccard >= 0.8 by comparing all pairs."""
    import pyarrow as pa
    ids = [i for i in texts if texts[i].split()]
    doc, shingle, count = minhash.shingle_counts(pa.array([texts[i] for i in ids]))
    weight = weights.of(shingle, count)[1]
    sets = [dict(zip(shingle[doc == n].tolist(), weight[doc == n].tolist())) for n in range(len(ids))]
    label = {i: i for i in texts}
    pairs = []
    for a in range(len(ids)):
        for b in range(a):
            both = sum(min(w, sets[b][f]) for f, w in sets[a].items() if f in sets[b])
            if both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= 0.8 - 1e-9:
                pairs.append((ids[a], ids[b]))
    for _ in range(len(ids)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.fixture(scope="module")
def copies(spark):
    """Texts in families of near copies, some of them exact, and strangers."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(draw.randint(60, 200))]
        for _ in range(draw.randint(1, 6)):
            words = list(base)
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = word()
            rows.append((len(rows), " ".join(words), "en", f"s{len(rows) % 3}", 0))
    rows += [(len(rows) + k, rows[k][1], "en", "s0", 0) for k in range(3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_near_copies_against_all_pairs(spark, copies):
    want = brute_near({r.doc_id: r.text for r in copies.collect()}, minhash.fit_weights(copies))
    got = {r.doc_id: r for r in minhash.near_duplicates(copies).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) and r.component_size == sum(x == want[i] for x in want.values()) for i, r in got.items())
    assert len(set(want.values())) < len(want) - 5


def test_samples_estimate_weighted_jaccard(copies):
    import pyarrow as pa
    weights = minhash.fit_weights(copies)
    base = [f"w{i}" for i in range(300)]
    pair = [" ".join(base), " ".join(base[:250] + [f"x{i}" for i in range(30)] + base[:20])]
    doc, shingle, count = minhash.shingle_counts(pa.array(pair))
    weight = weights.of(shingle, count)[1]
    a, b = ((shingle[doc == n], weight[doc == n]) for n in (0, 1))
    samples = minhash.Sampler(weights, 100, 8, seed=4).samples(doc, shingle, count)
    assert abs((samples[0] == samples[1]).mean() - minhash.weighted_jaccard(a, b)) < 0.06


def test_mix_meets_targets(spark):
    rows = mixing.mix_sources(table(spark, SF_CHECK, "documents")).join(
        table(spark, SF_CHECK, "documents").select("doc_id", "source"), "doc_id").collect()
    total, taken, target, size = sum(r["size"] for r in rows), Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        size[r.source] += r["size"]
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 3 * size[s] + 1e-6 for s in taken)
    assert math.isclose(sum(target.values()), total, rel_tol=1e-9)


def test_pipeline_stage_by_stage(spark, copies, tmp_path):
    """The stages on the fixture, next to what each should keep."""
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    copies.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = copies, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == copies.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert len(kept["toxicity"]) == copies.count()
    squeezed = {}
    for i, text in sorted(kept["toxicity"].items()):
        squeezed.setdefault(re.sub(r"\s", "", text), i)
    assert set(kept["exact_dedup"]) == set(squeezed.values())
    near = brute_near(kept["exact_dedup"], minhash.fit_weights(spark.createDataFrame(list(kept["exact_dedup"].items()), "doc_id long, text string")))
    assert set(kept["near_dedup"]) == {i for i in near if near[i] == i}
    assert set(kept["mixing"]) <= set(kept["near_dedup"])
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(BYTES), special_tokens={})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(last) == docs.count()
    assert all(r.n_tokens == len(own.encode_ordinary(kept["mixing"][r.doc_id])) for r in last)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(last)


def test_insults_of_several_words(spark):
    """Phrases of ordinary words and split words, in documents the fit has not seen."""
    syllables = "the and ing tion er en ch le re que or an is it of ha ou nt ea st th wh ly sh".split()
    draw = random.Random(6)
    ordinary = ["waste", "space", "empty", "head", "mo", "ron", "go", "away"]
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4))) if draw.random() < 0.95 else draw.choice(ordinary)
    rows, marks = [], []
    for i in range(1600):
        toxic = i % 4 == 0
        sentences = [[word() for _ in range(draw.randint(4, 14))] for _ in range(8)]
        for _ in range(2 if toxic else 0):
            at = draw.choice(sentences)
            at.insert(draw.randint(0, len(at)), draw.choice(["waste of space", "mo ron", "empty head"]))
        rows.append((i, " ".join(" ".join(s) + "." for s in sentences)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.toxicity_report(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).filter("held_out").collect()
    hit = [r.predicted for r in found if r.doc_id % 4 == 0]
    miss = [r.predicted for r in found if r.doc_id % 4]
    assert np.mean(hit) > 0.7 and np.mean(miss) < 0.15


def test_language_counts_grow_with_the_table(spark):
    """A letter group of few documents of a large table is counted; documents
    that set the limits are not."""
    syllables = "the and ing tion er en ch le re que or an is it of ha".split()
    draw = random.Random(7)
    rows = [(i, " ".join("".join(draw.choices(syllables, k=2)) for _ in range(12)) + f" q{chr(0x4E00 + i)}z", "en") for i in range(2000)]
    models = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    hashes = models.grams[3][0]
    seen = [i for i in range(2000) if langid.hash_of(f"q{chr(0x4E00 + i)}z") in hashes]
    assert 1000 < len(seen) < 1300          # two folds of three, nine in ten of them
    assert 0 < models.limits[0] < np.inf


def test_numerals_are_no_letters(spark):
    assert [langid.letter_words(w) for w in ("²", "½", "①", "Ⅷ", "x²y", "Straße", "l'été", "a_b1c", "一")] == \
        ["", "", "", "", "x\ny", "straße", "l\nété", "a\nb\nc", "一"]
    rows = [(i, "the old house by the sea", "en") for i in range(30)] + [(30, "²", "en"), (31, "½ Ⅷ", "en"), (32, None, "en")]
    got = {r.doc_id: r.lang_pred for r in langid.language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[30] == got[31] == got[32] == "und"

"""Periodic runs, WARC archives and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import collocation, periodic, queries, warc
from daybook.llm.common import table
from daybook.llm.words import byte_words

from ..conftest import SF_CHECK, SF_SMALL

WORD = re.compile("[^ \t-\r]+")


def plain_runs(w):
    out, n = [], len(w)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and not any(q % p == 0 and w[i:i + q] == w[i:i + p] * (q // p) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating_texts(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        kinds = draw.choice([1, 2, 2, 3, 5, 50])
        w = [f"w{draw.randrange(kinds)}" for _ in range(draw.choice([0, 1, 23, 24, 60, 200, 500]))]
        for _ in range(draw.randrange(4)):
            at, q = draw.randrange(len(w) + 1), draw.randrange(1, 70)
            w = w[:at] + w[at:at + q] * draw.choice([2, 3, 3, 4, 9]) + w[at + q:]
        yield w


@pytest.mark.parametrize("longest", [periodic.LONGEST_BLOCK, 16, 8])
def test_runs_of_odd_texts(longest):
    """``longest`` below a scale compares that scale's blocks by windows."""
    texts = list(repeating_texts(250, longest % 1000))
    runs, rest = periodic.runs_and_rest(pa.array([" \t".join(w) for w in texts]), longest)
    for w, found, left in zip(texts, runs.to_pylist(), rest.to_pylist()):
        expected = plain_runs(w)
        assert [(r["start"], r["length"], r["period"]) for r in found] == expected
        gone = {i for s, n, q in expected for i in range(s + q, s + n)}
        assert left == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_block_inside_repeated_short_runs():
    """Runs of one word inside a longer period: only distances between equal
    borders are tried."""
    period = ["a"] * 100 + ["b"] + ["a"] * 40 + ["c"]
    w = period * 4 + ["d"]
    runs, _ = periodic.runs_and_rest(pa.array([" ".join(w)]))
    assert [(r["start"], r["length"], r["period"]) for r in runs.to_pylist()[0]] == plain_runs(w)


@pytest.mark.parametrize("n", [16, 256, 4096, 1 << 15])
def test_transform_is_exact(n):
    draw = np.random.default_rng(n)
    x, y = draw.integers(0, periodic.PRIME, (2, 2, n))
    assert (periodic.transform(periodic.transform(x.astype(float), n), n, True) == x * n % periodic.PRIME).all()
    both = periodic.reduced(periodic.transform(x.astype(float), n) * periodic.transform(y.astype(float), n))
    got = periodic.transform(both, n, True)[0]
    for k in (0, 1, n - 1):
        plain = sum(int(x[0, i]) * int(y[0, (k - i) % n]) for i in range(n)) * n % periodic.PRIME
        assert got[k] == plain


def test_run_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op11_block_convolution_runs"](spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(r.n_runs for r in got.values())
    for d in docs:
        w = WORD.findall(d.text or "")
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 2500:
            continue                                   # the plain search is quadratic
        runs = plain_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
        best = min(runs, key=lambda z: (-Fraction(z[1], z[2]), z[0], z[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)


def test_run_edges(awkward, n_rows):
    rows = periodic.run_report(awkward).collect()
    assert len(rows) == n_rows
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.collapsed_sha256 == r.runs_sha256 == empty and r.start is None for r in rows if r.doc_id in (3, 4, 5))
    long = [r for r in rows if r.doc_id == 6]
    assert len(long) == 2 and long[0] == long[1] and (long[0].start, long[0].length, long[0].period) == (0, 20_000, 977)
    assert periodic.run_report(awkward.limit(0)).collect() == []
    planted = periodic.with_planted_runs(awkward)
    assert planted.columns == awkward.columns and planted.count() == n_rows


def test_byte_words():
    got = byte_words(pa.array([None, "", " é a\tB", "a.b", "."]), b" \t", b".\n", lower=True)
    assert [got.kinds[i].as_py().decode() for i in got.code] == ["é", "a", "b", "a", "b"]
    assert got.doc.tolist() == [2, 2, 2, 3, 3]
    assert (got.piece[1:] != got.piece[:-1]).tolist() == [False, False, True, True]


# WARC

@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(k):
    draw = random.Random(k)
    runs = [sorted(draw.randrange(40) for _ in range(draw.choice([0, 1, 5, 60]))) for _ in range(k)]
    got = list(warc.merge_runs(runs))
    assert got == sorted(((r, i) for r in range(k) for i in range(len(runs[r]))), key=lambda x: (runs[x[0]][x[1]], x))


@pytest.fixture(scope="module")
def odd_pages(spark):
    again = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://A.b/x#y", "same"), (2, "http://u@a.B:80/x?q", "same"), (9, "http://a.b/x", "same"), (3, None, None), (4, "", ""),
            (5, "http://a.b/x", again), (6, "http://a.b/x", again + again), (7, "line\r\nend", "é\u0000\U0001F600\n"), (None, "z", "same"),
            (8, "http://a.b/" + "p" * 5000, "long " * 100_000), (10, "http://a.b/x", "r"), (10, "http://a.b/x", "r"), (11, "http://a.b", "t")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("run", F.lit(1)).withColumn("_sha", F.lit("x"))


@pytest.mark.parametrize("archive_bytes", [1, 300, 1 << 24])
def test_archives_round_trip(spark, odd_pages, tmp_path, archive_bytes):
    folder = str(tmp_path / "archives")
    warc.write_archives(odd_pages, folder, archive_bytes=archive_bytes)
    files = list((tmp_path / "archives").glob("*.gz"))
    assert archive_bytes > 1 or len(files) == odd_pages.count()
    kept = {}
    for f in files:
        for _, length, fields, size, payload in warc.read_records(zlib.decompress(f.read_bytes(), 31)):
            if fields["WARC-Type"] == "response":
                kept[warc.page_of(fields["WARC-Record-ID"])] = payload.decode()
                assert len(payload) == size
    assert kept == {str(r.page_id): r.html or "" for r in odd_pages.collect() if r.page_id in (4, 5, 6, 7, 8, 9, 10, 11)}
    index = warc.merged_index(warc.archive_index(spark, folder), 4).orderBy("position").collect()
    assert [r.position for r in index] == list(range(1, len(index) + 1))
    order = [(r.url_key, r.captured, r.page_id or "") for r in index]
    assert order == sorted(order)
    seen = Counter()
    for r in index:
        seen[r.url_key] += 1
        assert r.capture == seen[r.url_key]
        data = zlib.decompress((tmp_path / "archives" / r.archive).read_bytes(), 31)[r.offset:r.offset + r.length]
        assert f"WARC-Record-ID: {warc.record_name(r.page_id)}\r\n".encode() in data


def test_capture_report(odd_pages):
    rows = warc.capture_report(odd_pages).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == odd_pages.count()
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {1: 9, 2: 9, 3: 4, None: 9}
    assert got[3].payload_bytes == 0 and got[1].payload_bytes == 4 and got[1].payload_digest == got[9].payload_digest
    assert sum(r.page_id == 10 and r.record_type == "response" for r in rows) == 2
    assert got[1].url_key == "b,a)/x" and got[2].url_key == "b,a:80)/x?q" and got[3].url_key == "" and got[11].url_key == "b,a)"
    assert warc.capture_report(odd_pages.limit(0)).collect() == []


def test_broken_archive_is_named():
    record = warc.warc_record(1, "http://a/", "payload").replace("payload", "pAyload")
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_records((record + warc.END).encode()))


# collocations

def plain_collocations(rows, least, longest, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {(lang, p): a for (lang, p), a in f.items() if a >= least and len(p) > 1}
    covered = {(lang, p[i:j]): max(0, a) for (lang, p), a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and a >= f[lang, p[i:j]]}
    out = {}
    for (lang, p), a in often.items():
        if (lang, p) not in covered:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top])}


@pytest.fixture(scope="module")
def phrase_rows():
    draw = random.Random(4)
    stock = ["New York", "new  york city", "of the people by the people", "Ünïted\tstates", "a.b, c", "in\x0bthe end", "rock and roll", "x"]
    rows = [(draw.choice(["en", "fr", None, "und"]), "".join(draw.choice(stock) + draw.choice([" ", " ", ". ", "\n"]) for _ in range(draw.randrange(60))))
            for _ in range(150)]
    return rows + [("en", None), (None, ""), ("de", "too few words here"), ("fr", "la la la " * 300)]


@pytest.mark.parametrize("most_nodes", [collocation.MOST_NODES, 7])
def test_collocations_against_brute_force(spark, phrase_rows, most_nodes):
    """Few nodes a trie: the candidates are split into several."""
    docs = spark.createDataFrame(phrase_rows, "lang string, text string").withColumn("word", F.lit("clash")).withColumn("key", F.lit(0))
    got = collocation.collocations(docs, least=20, top=30, most_nodes=most_nodes)
    assert {tuple(r) for r in got.collect()} == plain_collocations(phrase_rows, 20, 5, 30)

def test_collocation_edges(spark, awkward):
    rows = collocation.collocations(awkward, least=2, top=5).collect()
    assert {r.lang for r in rows} <= {"en", "fr", "de", "xx", "und"} and all(r.rank <= 5 for r in rows)
    assert any(r.lang == "en" and r.a >= 2 for r in rows)
    assert collocation.collocations(awkward.limit(0)).collect() == []
    assert collocation.collocations(awkward, least=10 ** 9).collect() == []


def test_equal_hashes_take_another_salt(spark, phrase_rows, monkeypatch):
    docs = spark.createDataFrame(phrase_rows, "lang string, text string")
    count, salts = collocation.count_words, []

    def counted(rows, salt):
        salts.append(salt)
        out = count(rows, salt)
        return out.withColumn("key", F.lit(1)) if salt == 0 else out

    monkeypatch.setattr(collocation, "count_words", counted)
    got = collocation.collocations(docs, least=20, top=30).collect()
    assert salts == [0, 1] and {tuple(r) for r in got} == plain_collocations(phrase_rows, 20, 5, 30)


def test_trie_holds_what_was_put_in():
    draw = np.random.default_rng(1)
    parent, word = [], []
    for i in range(3000):
        parent.append(int(draw.integers(1, 60 if i < 1000 else 50 + i)))
        word.append(int(draw.integers(1, 51)))
    pairs = sorted({(p, w) for p, w in zip(parent, word) if p <= 50})
    phrases = collocation.Phrases(50, np.array([p for p, _ in pairs]), np.array([w for _, w in pairs]))
    trie = collocation.build_trie(phrases, np.arange(len(pairs)))
    codes = draw.integers(0, 51, 20_000).astype(np.int32)
    found = collocation.states(codes, 2, trie.base, trie.check)[1]
    known = set(pairs)
    assert [(int(a), int(b)) in known for a, b in zip(codes[:-1], codes[1:])] == (found > 0).tolist()
    assert all(pairs[trie.node[s]] == (a, b) for s, a, b in zip(found, codes, codes[1:]) if s)


@pytest.mark.parametrize("name", ["op12_external_index_merge", "op13_trie_collocations"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    twin = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in twin.description]
    rows = queries.QUERIES[name](spark, SF_CHECK)
    assert sorted(rows.columns) == sorted(cols)
    found = [tuple(r[c] for c in cols) for r in rows.collect()]
    assert sorted(found, key=repr) == sorted(twin.fetchall(), key=repr) and found

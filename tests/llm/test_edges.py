"""Nulls, empty and very long texts, repeated rows, clashing columns and empty
tables, for every operator and pipeline stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import bpe, exact, langid, minhash, mixing, pii, prefix_count, quality, toxicity, vectors

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
OPERATORS = {
    "toxicity": lambda docs, labels: toxicity.toxicity_report(docs, labels),
    "pii": lambda docs, labels: pii.find_personal_data(docs, pii.fit_field(docs)),
    "bpe": lambda docs, labels: bpe.encode_documents(docs, BYTES, public_tokenizers.PATTERN, with_ids=True),
    "langid": lambda docs, labels: langid.language_report(docs),
    "exact": lambda docs, labels: exact.content_sort(docs),
    "prefix": lambda docs, labels: prefix_count.count_documents(docs, WORDS, 5, prefixes=False),
    "mixing": lambda docs, labels: mixing.mix_sources(docs),
    "quality": lambda docs, labels: quality.quality_report(docs, labels),
    "minhash": lambda docs, labels: minhash.near_duplicates(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(name, awkward, labels, n_rows):
    rows = OPERATORS[name](awkward, labels).collect()
    assert len(rows) == n_rows
    assert sorted(r.doc_id is None for r in rows) == sorted(r.doc_id is None for r in awkward.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, awkward, labels):
    assert OPERATORS[name](awkward.limit(0), labels.limit(0)).collect() == []


def test_vectors_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [float("nan"), 1.0]),
            (8, [None, 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [0.0, 1.0]), (12, [1e300, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(0)).withColumn("code", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table).collect()}
    assert len(got) == len(rows)
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False) and got[12] == (3, 1, False)
    for alone in (4, 5, 6, 7, 8, 9, 10, 11):
        assert got[alone] == (0, alone, True)
    assert got[None] == (0, None, True)
    assert vectors.near_vectors(table.limit(0)).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(name, stage, spark, awkward, labels, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stage"))
    labels.write.parquet(f"{folder}/labels.parquet")
    out = stage(spark, awkward, folder)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == awkward.columns
    assert out.count() >= 1
    assert stage(spark, awkward.limit(0), folder).count() == 0


def test_defined_results(awkward):
    kept = {r.doc_id: r for r in exact.content_sort(awkward).filter("doc_id is not null").collect()}
    assert kept[1].kept and kept[2].keep_id == 1 and kept[1].group_size == 3
    assert kept[3].group_size == 4          # two empty, one blank, one null with a null id
    near = {r.doc_id: r for r in minhash.near_duplicates(awkward).filter("doc_id is not null").collect()}
    assert near[1].kept and near[2].component_id == 1 and near[9].component_id == 1 and near[9].class_id == 1
    assert all(near[x].kept for x in (3, 4, 5))
    lang = {r.doc_id: r for r in langid.language_report(awkward).collect()}
    assert lang[3].lang_pred == lang[4].lang_pred == lang[5].lang_pred == "und"
    mix = {r.doc_id: r for r in mixing.mix_sources(awkward).filter("doc_id is not null").collect()}
    assert mix[3].size == mix[4].size == mix[5].size == 0 and mix[3].taken == 0 and mix[6].size == 20_000

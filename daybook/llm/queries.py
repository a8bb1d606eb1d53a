"""Registered queries of this subpackage (``QUERIES``) and their DuckDB twins
(``ORACLE``)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocation, exact, langid, minhash, mixing, periodic, pii, prefix_count, quality, toxicity, vectors, warc
from .common import table

QUERIES, ORACLE = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; crc fold 0 of 5 is held out."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base patterns and the field's spans."""
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit_field(docs))


@query
def op3_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and their bytes decoded again."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


@query
def op4_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between ``embeddings`` at a cosine of 0.95 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; crc fold 1 of 3 is held out."""
    return langid.language_report(table(spark, sf_dir, "documents"))


@query
def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of ``documents``: keeper, group size and digest per row."""
    return exact.content_sort(table(spark, sf_dir, "documents"))


ORACLE["op6_content_sort"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id NULLS LAST)
"""


@query
def op7_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, and how much of it fits in 2,048 tokens."""
    return prefix_count.count_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when the sources are mixed 5 : 2 : 1."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


ORACLE["op8_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) AS n, length(regexp_replace(coalesce(text, ''), '[!#$%&*]+', '', 'g')) AS plain,
         (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
k AS (
  SELECT *, -ln(u) / greatest(0.05::DOUBLE, 1 - 5.0::DOUBLE * (n - plain) / greatest(n, 1)) AS key FROM d),
s AS (
  SELECT source, sum(size)::DOUBLE AS ssize,
         [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM k GROUP BY source),
f AS (
  SELECT *, row_number() OVER o AS rk,
         (sum(ssize) OVER () - coalesce(sum(3 * ssize) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW o AS (ORDER BY 3 * ssize / w, source NULLS LAST)),
t AS (
  SELECT source, ssize,
         CASE WHEN 3 * ssize / w > level THEN least(3 * ssize, w * (
           SELECT arg_min(level, rk) FROM f WHERE 3 * ssize / w > level)) ELSE 3 * ssize END AS target
  FROM f),
e AS (
  SELECT k.*, t.ssize, t.target, CASE WHEN t.ssize > 0 THEN floor(t.target / t.ssize) ELSE 0 END AS ep,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, ssize::BIGINT AS source_size, target,
       (ep * size + least(size, greatest(0, floor(target - ep * ssize + 0.5) - before)))::BIGINT AS taken
FROM e
"""


@query
def op9_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; crc fold 2 of 4 is held out."""
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of ``documents`` at a weighted Jaccard similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_block_convolution_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, one document of ten with a
    planted periodic tail."""
    return periodic.run_report(periodic.with_planted_runs(table(spark, sf_dir, "documents")))


@query
def op12_external_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written to WARC archives and read back through the merged index."""
    return warc.capture_report(table(spark, sf_dir, "pages"))


ORACLE["op12_external_index_merge"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', '', 's'), '^.*?://', '', 's') AS rest
  FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS host FROM p),
s AS (
  SELECT *, regexp_replace(host, '^.*@', '') AS site, max(page_id) OVER (PARTITION BY html) AS keep FROM h),
k AS (
  SELECT *, CASE WHEN rest = '' THEN '' ELSE
           array_to_string(list_reverse(string_split(lower(split_part(site, ':', 1)), '.')), ',')
           || substr(site, length(split_part(site, ':', 1)) + 1) || ')' || substr(rest, length(host) + 1) END AS url_key
  FROM s)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::INT + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to, url_key,
       row_number() OVER (ORDER BY url_key, page_id) AS position,
       row_number() OVER (PARTITION BY url_key ORDER BY page_id) AS capture
FROM k
"""


@query
def op13_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of every language of ``documents``."""
    return collocation.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_trie_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT f.*, n, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS tail
  FROM f JOIN totals USING (lang), (SELECT unnest(range(1, 5)) AS c) WHERE c < k),
scored AS (
  SELECT cuts.*, h.a AS l, t.a AS r, (1000::HUGEINT * cuts.a * n) // (h.a::HUGEINT * t.a) AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = best.lang AND q.k > best.k AND 100 * q.a >= 100 * best.a
      AND contains(' ' || q.phrase || ' ', ' ' || best.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

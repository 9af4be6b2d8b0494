"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldleaf.llm.block_naming import exact_duplicates
from goldleaf.llm.c2lsh import neighbours_of_table
from goldleaf.llm.html_main_text import extract_main_text
from goldleaf.llm.importance_resampling import resample
from goldleaf.llm.lang_cnn import identify_languages
from goldleaf.llm.license_scan import scan_licences, with_paths
from goldleaf.llm.mixing import sampling_plan
from goldleaf.llm.ngram_join import similar_documents
from goldleaf.llm.packing import pack_documents
from goldleaf.llm.pu_quality import classify_quality
from goldleaf.llm.secret_scan import scan_secrets
from goldleaf.llm.token_alignment import align_tokenizers
from goldleaf.llm.token_count import count_tokens
from goldleaf.sources.retail_views import read_test_table

Query = Callable[[SparkSession, str], DataFrame]


OP9_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


# The pages of the tables have one article each, so its blocks between h1 and p tags are the main text; white space
# inside a block becomes one space, of the character references those that occur in text are decoded, &amp; last.
OP13_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '</?(h1|p)>', chr(1), 'g') AS t
  FROM pages),
b AS (
  SELECT page_id, url, list_transform(string_split(t, chr(1)), lambda x: trim(regexp_replace(regexp_replace(replace(replace(
    replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
    '&#x27;', ''''), '&nbsp;', ' '), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks
  FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(read_test_table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": _documents(scan_secrets),
        "op2_mix_sources": _documents(sampling_plan),
        "op3_collision_ann": lambda spark, sf_dir: neighbours_of_table(read_test_table(spark, sf_dir, "embeddings")),
        "op4_token_count": _documents(count_tokens),
        "op5_ngram_join": _documents(lambda docs: similar_documents(docs, words=4, percent=85).drop("uid", "component")),
        "op6_pu_quality": lambda spark, sf_dir: classify_quality(
            read_test_table(spark, sf_dir, "documents"), read_test_table(spark, sf_dir, "labels")),
        "op7_best_fit_packing": _documents(lambda docs: pack_documents(docs).drop("uid")),
        "op8_license_scan": _documents(lambda docs: scan_licences(with_paths(docs))),
        "op9_exact_dedup": _documents(lambda docs: exact_duplicates(docs).drop("uid")),
        "op10_lang_cnn": _documents(identify_languages),
        "op11_token_alignment": _documents(align_tokenizers),
        "op12_importance_resampling": lambda spark, sf_dir: resample(
            read_test_table(spark, sf_dir, "documents"), read_test_table(spark, sf_dir, "benchmark")),
        "op13_html_main_text": lambda spark, sf_dir: extract_main_text(read_test_table(spark, sf_dir, "pages")),
    }


def llm_oracles() -> dict[str, str]:
    return {"op9_exact_dedup": OP9_SQL, "op13_html_main_text": OP13_SQL}

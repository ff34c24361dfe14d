"""Queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from matchforge.llm.common import table
from matchforge.llm.decontaminate import leaks
from matchforge.llm.html_extract import main_text
from matchforge.llm.maxent_lm import lm_scores
from matchforge.llm.quality import BASE, quality_verdicts
from matchforge.llm.secret_scan import scan_secrets
from matchforge.llm.sharding import shards_by_bytes
from matchforge.llm.simhash import simhash_components
from matchforge.llm.source_audit import source_divergence
from matchforge.llm.sp_dropout import encode_documents
from matchforge.llm.spelling_variants import spelling_groups
from matchforge.llm.suffix_dedup import remove_repeats
from matchforge.llm.token_files import token_files
from matchforge.llm.toxicity import toxicity_scores


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_by_bytes(table(spark, sf_dir, "documents"), shards=8)


def op2_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_pieces", "pieces", "lossless", F.crc32("decoded").alias("decoded_crc32"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", *BASE, "base_failed", "kept", "p_quality")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op10_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).drop("path")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_vector_packing, op2_sentencepiece_dropout, op3_suffix_dedup, op4_quality_rules, op5_secret_scan, op6_toxicity, op7_token_files,
                                    op8_decontamination, op9_simhash, op10_maxent_lm, op11_source_divergence, op12_spelling_variants,
                                    op13_html_extraction)} | {"pipeline": corpus_pipeline.run}


#: All 50-byte strings of all documents (as hexadecimal text), the smallest
#: document of each, and the runs that strings of smaller documents cover.
OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (
        SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
g AS (SELECT w.doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY w.doc_id ORDER BY i), -100) + 50 AS new
      FROM w JOIN f USING (s) WHERE least < w.doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (
        SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM r
      UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(h) // 2) FROM d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id),
t AS (SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x, y) AS rest FROM k JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM d JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)
"""


#: Counts, shares and divergences of all kept terms in all groups, without postings.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS txt FROM documents),
o AS (SELECT lang, source, id, w, count(*) AS n FROM (
        SELECT lang, source, id, unnest(regexp_extract_all(txt, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d) GROUP BY ALL),
k AS (SELECT lang, w, sum(n) AS n FROM o GROUP BY lang, w HAVING count(*) >= 10),
c AS (SELECT lang, source, w, sum(o.n) AS n FROM o SEMI JOIN k USING (lang, w) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.w, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v) AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.w = k.w),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.w = b.w AND a.source < b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a
      JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = least(a.source, b.source) AND f.item = greatest(a.source, b.source)
      UNION ALL SELECT lang, source, 'term', w, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM x QUALIFY part = 'pair' OR rank <= 10
"""


#: crc32 by a table of bytes; near words share what is left of them when one
#: code point is deleted (at the same place, or one of them is that rest).
OP12_SQL = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], range(8)::BIGINT[]),
             lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
o AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents)
      WHERE length(w) >= 6 GROUP BY ALL),
b AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM o),
h AS (SELECT w, n, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT],
             list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1]))) AS h FROM b, tab),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, n FROM h),
words AS (SELECT w AS word, sum(n) AS n FROM v WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
rests AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS r FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM rests a JOIN rests b ON a.r = b.r AND a.i = b.i AND a.word <> b.word
         UNION SELECT rests.word, w.word FROM rests JOIN words w ON rests.r = w.word
         UNION SELECT w.word, rests.word FROM rests JOIN words w ON rests.r = w.word),
top AS (SELECT near.word, count(*) AS n_near, max(w.n) AS top_n FROM near JOIN words w ON w.word = near.other GROUP BY near.word),
g AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n FROM words LEFT JOIN top USING (word)),
f AS (SELECT g.word, min(w.word) AS form FROM g JOIN near USING (word) JOIN words w ON w.word = near.other AND w.n = g.form_n GROUP BY g.word),
chain AS (SELECT word, word AS root FROM words UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root),
last AS (SELECT chain.word, root FROM chain ANTI JOIN f ON f.word = chain.root)
SELECT word, form, root, CAST(n AS BIGINT) AS n, n_near, CAST(form_n AS BIGINT) AS form_n FROM g LEFT JOIN f USING (word) JOIN last USING (word)
"""


#: The articles of this table's pages by their tags, without containers and
#: votes: blocks are what p and h1 tags part.
OP13_SQL = r"""
WITH a AS (SELECT row_number() OVER () AS id, page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article|$)', 1, 's') AS x FROM pages),
b AS (SELECT id, unnest(p) AS y, generate_subscripts(p, 1) AS k FROM (SELECT id, regexp_split_to_array(x, '</?(p|h1)>') AS p FROM a)),
t AS (SELECT id, k, regexp_replace(replace(y, '<br>', ' '), '<[^>]*(>|$)', '', 'g') AS y FROM b),
c AS (SELECT id, k, trim(regexp_replace(regexp_replace(regexp_replace(y, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS y FROM t),
s AS (SELECT id, string_agg(y, chr(10) || chr(10) ORDER BY k) AS text FROM c WHERE y <> '' GROUP BY id)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM a LEFT JOIN s USING (id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator; the others are tested against
    brute force."""
    return {"op3_suffix_dedup": OP3_SQL, "op11_source_divergence": OP11_SQL, "op12_spelling_variants": OP12_SQL,
            "op13_html_extraction": OP13_SQL} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

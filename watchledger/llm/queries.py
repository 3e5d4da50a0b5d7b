"""Queries over the corpus tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchledger.llm import class_lm, conversation_trie, exact_dedup, html_text, jaccard_join, language_id, mixing, orc_tokens, packing, periodic_runs, quality_bands, sharding, suffix_dedup
from watchledger.llm.common import read_table, remainder
from watchledger.plans.registry import comparable


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose remainder is not 2."""
    docs = read_table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(docs.where(remainder("doc_id", 4) != 2))
    found = language_id.predict(docs, profiles)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram and unigram scores of every document, learned from those whose remainder is not 2."""
    return class_lm.class_lm_scores(read_table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated 400-byte strings."""
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; half of the documents are taken as indexed before."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), exact_dedup.in_history())


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken for the target weights."""
    return comparable(mixing.mixing_report(read_table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op9_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back."""
    return orc_tokens.tokens_written(read_table(spark, sf_dir, "documents"))


def op10_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and compression verdict of every document; limits from labelled documents whose remainder is not 2."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    bands = quality_bands.learn_bands(docs, labels.where(remainder("doc_id", 4) != 2))
    return quality_bands.quality_bands(docs, bands)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversation_trie.trie_report(read_table(spark, sf_dir, "conversations"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, of which a tenth are given one first."""
    return periodic_runs.run_report(read_table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards near equal in bytes."""
    return sharding.sharding_report(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_class_lm, op3_html_text, op4_suffix_dedup, op5_exact_dedup, op6_jaccard_join, op7_mixing, op8_packing, op9_token_orc, op10_quality_bands, op11_conversation_trie, op12_periodic_runs, op13_sharding)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op5_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op6_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE [w[i:i+4] FOR i IN range(1, len(w) - 3)] END) AS s FROM w),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, n AS n_shingles, (SELECT min(b) FROM r WHERE r.a = n.doc_id) AS component_id FROM n""",
    "op7_mixing": r"""
WITH d AS (SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
  coalesce('s' || source, 'z') AS k FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY k) AS n FROM d GROUP BY k),
w AS (SELECT *, ((n - 1) % 3 + 1)::DOUBLE AS w, 3 * source_size AS most, sum(source_size) OVER () AS total FROM s),
o AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
  sum(w) OVER (ORDER BY most / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM w),
l AS (SELECT (total - spent) / w_left AS level FROM o WHERE (total - spent) / w_left <= most / w ORDER BY most / w, k LIMIT 1),
t AS (SELECT k, source_size, least(level * w, most)::DOUBLE AS target,
  CASE WHEN source_size > 0 THEN least(level * w / source_size, 3.0)::DOUBLE ELSE 0.0::DOUBLE END AS rate FROM w, l),
c AS (SELECT doc_id, size, source_size, target, rate, CAST(floor(rate) AS BIGINT) + CASE WHEN
  ('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM d JOIN t USING (k))
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(copies * size AS BIGINT) AS taken, round(rate, 6) AS rate, CAST(copies AS BIGINT) AS copies FROM c""",
    "op11_conversation_trie": r"""
WITH t AS (SELECT conv_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn,
  sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, s, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, s) AS p FROM t),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS b, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 4 AS h FROM t),
r AS (SELECT c.conv_id, p, s, words FROM c JOIN o ON o.conv_id = b AND p <= h UNION ALL SELECT o.conv_id, p, s, words FROM c JOIN o USING (conv_id) WHERE p > h),
m AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(s, '') OVER w AS path, words, p = max(p) OVER (PARTITION BY conv_id) AS ends FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT conv_id, depth, path, words, ends FROM m UNION ALL SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM r) FROM c),
n AS (SELECT min(conv_id) AS conv_id, depth, path, any_value(words) AS words, count(*) AS n,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM a GROUP BY depth, path),
k AS (SELECT up.path, count(*) AS children FROM n JOIN a up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1 GROUP BY 1),
z AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN k USING (path)),
u AS (SELECT up.path, CAST(sum(CAST(z.children = 0 AS BIGINT)) AS BIGINT) AS leaves, CAST(sum((z.n - 1) * z.words) AS BIGINT) AS saved
  FROM z JOIN a up ON up.conv_id = z.conv_id AND up.depth <= z.depth GROUP BY 1)
SELECT z.conv_id, CAST(z.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, z.n AS n_convs, z.children AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(z.ends) AS ends_sha256
FROM z JOIN u USING (path) LEFT JOIN a up ON up.conv_id = z.conv_id AND up.depth = z.depth - 1 LEFT JOIN z parent ON parent.path = up.path""",
}

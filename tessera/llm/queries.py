"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table.  ``ORACLE`` has DuckDB SQL for
those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (align, bpe, fingerprints, langid, merkle, packing, quality, secrets, sharding, simhash, token_counts,
                         topk, url_filter)
from tessera.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


#: Rules of the URL filter: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_VALUES} AS r(host, path, verdict)")
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]), rules)


ORACLE["op3_url_filters"] = f"""
WITH r(rule_host, rule_path, verdict) AS (VALUES {_RULE_VALUES}),
u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                            '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
m AS (
  SELECT p.page_id, max(struct_pack(n := length(rule_host || rule_path), h := length(rule_host),
                                    rule := rule_host || rule_path, verdict := verdict)) AS best
  FROM p JOIN r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, m.best.rule AS rule, coalesce(m.best.verdict, '{url_filter.DEFAULT}') AS verdict
FROM p LEFT JOIN m USING (page_id)"""


@query
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), width=3, limit=2)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


#: Bytes of a shard.
SHARD_BYTES = 1 << 20


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), SHARD_BYTES)


ORACLE["op7_sharding"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
n AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM d, range(0, 61) r(depth) GROUP BY ALL),
f AS (SELECT * FROM n WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1),
s AS (
  SELECT d.doc_id, d.n_bytes, d.h, min(f.depth) AS depth
  FROM d, f WHERE d.h >> (60 - f.depth) = f.prefix GROUP BY ALL)
SELECT s.doc_id, s.n_bytes,
       substr(lpad(printf('%s', bin(s.h)), 60, '0'), 1, s.depth::INT) AS shard,
       s.depth::INT AS depth, f.shard_bytes, f.shard_docs, f.shard_bytes > {SHARD_BYTES} AS oversize
FROM s JOIN f ON f.depth = s.depth AND f.prefix = s.h >> (60 - s.depth)"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return quality.quality_rules(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


_RULES = ", ".join(f"('{rule}', {len(cuts) - k}, {c!r}::DOUBLE)"
                   for rule, cuts in quality.CUTOFFS.items() for k, c in enumerate(cuts))
_SHARE = quality.ALPHA / len(quality.CUTOFFS)
#: The rules, the exact binomial bound (a sum of probabilities) and the choice
#: of cutoffs once more in SQL; documents are told apart by doc_id.
ORACLE["op8_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS gram FROM d, unnest(range(1, len(w) - 6)) r(i)),
c AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM g), unnest(range(i, i + 8)) r(j)
  WHERE times > 1 GROUP BY doc_id),
s AS (
  SELECT d.doc_id, d.lang, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper
  FROM d JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (
  SELECT * REPLACE (coalesce(word_chars, 0) AS word_chars),
         n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {round(100 * quality.MOST_REPEATED)} * n_words AS base_failed
  FROM s),
v AS (
  SELECT doc_id, lang, base_failed, unnest([
    struct_pack(rule := 'symbols', x := coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0)),
    struct_pack(rule := 'dup_lines', x := coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0)),
    struct_pack(rule := 'repeats', x := coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0)),
    struct_pack(rule := 'upper', x := coalesce(n_upper::DOUBLE / nullif(n_words, 0), 0)),
    struct_pack(rule := 'long_words', x := coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0)),
    struct_pack(rule := 'short_words', x := -coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0))], recursive := true)
  FROM b),
r(rule, step, cutoff) AS (VALUES {_RULES}),
k AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1)
  GROUP BY doc_id HAVING min(quality) = max(quality)),
cuts AS (SELECT rule, list(cutoff) AS cs FROM r GROUP BY rule),
w AS (
  SELECT doc_id, lang, rule, min(x) AS x, min(len(list_filter(cs, lambda c: x > c))) = max(len(list_filter(cs, lambda c: x > c))) AS alike
  FROM v JOIN cuts USING (rule) WHERE NOT base_failed GROUP BY doc_id, lang, rule),
once AS (SELECT * FROM w QUALIFY bool_and(alike) OVER (PARTITION BY doc_id, lang)),
n AS (
  SELECT lang, r.rule, step, cutoff, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 0) AS n_bad,
         count(*) FILTER (good = 1 AND x > cutoff) AS k, count(*) FILTER (good = 0 AND x > cutoff) AS k_bad
  FROM once JOIN k USING (doc_id) JOIN r USING (rule) GROUP BY ALL),
p AS (
  SELECT *, {quality.DELTA} / ((SELECT count(DISTINCT coalesce(lang, '?')) FROM n WHERE n.n > 0) * {len(quality.CUTOFFS)}) AS level,
         CASE WHEN n = 0 THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(
           lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE})))) END AS chance
  FROM n),
q AS (
  SELECT *, max(chance) OVER (PARTITION BY lang, rule ORDER BY step DESC) AS worst,
         k_bad / greatest(n_bad, 1) - k / n AS gain FROM p),
best AS (
  SELECT lang, rule, max_by(cutoff, struct_pack(gain := gain, step := step)) AS cutoff
  FROM q WHERE worst <= level AND gain > 0 GROUP BY lang, rule),
gone AS (
  SELECT DISTINCT v.doc_id FROM v JOIN best ON v.rule = best.rule AND v.lang IS NOT DISTINCT FROM best.lang AND v.x > best.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM gone) AS kept
FROM b"""


@query
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return bpe.bpe_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


#: Vectors that ask, results of each, and what components are multiplied by.
ASKS, BEST, FACTOR = 20, 20, 64


@query
def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    whole = rows.select("vec_id", topk.whole_components(F.col("embedding"), FACTOR).alias("vector"))
    return topk.top_k(whole, F.col("vec_id") % ASKS == 0, BEST)


ORACLE["op11_exact_top_k"] = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({FACTOR} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % {ASKS} = 0)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM s WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER best <= {BEST}"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(read_table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "n_chars", "text"]))


def _leaf(plus: str) -> str:
    """The digest of a document; ``plus`` is added to n_chars."""
    shown = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c}{plus if c == 'n_chars' else ''})::VARCHAR) || ':' || "
             f"({c}{plus if c == 'n_chars' else ''})::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return f"sha256({' || '.join(shown)})"


#: Documents whose tampered copy is checked, as ids: DuckDB has no CRC-32, so it is
#: written out bit by bit.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(0, 8)), lambda x, _:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
#: Each level's nodes from the one below, their paths upwards, and the tampered
#: leaves folded step by step.
ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf('')} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) % {merkle.TAMPERED} = 0 THEN {_leaf(' + 1')} ELSE {_leaf('')} END AS shown
  FROM documents),
d AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM l),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM d
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 2),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM top WHERE n > 1 GROUP BY pos // 2),
height AS (SELECT tree, max(level) AS h FROM nodes GROUP BY tree),
steps AS (
  SELECT d.tree, d.pos, s.level, (d.pos >> s.level) & 1 AS side, x.digest AS other
  FROM d JOIN nodes s ON s.tree = d.tree AND s.pos = d.pos >> s.level AND s.n > 1
  LEFT JOIN nodes x ON x.tree = s.tree AND x.level = s.level AND x.pos = xor(s.pos, 1)
  UNION ALL
  SELECT d.tree, d.pos, h + t.level, (r.pos >> t.level) & 1, x.digest
  FROM d JOIN height USING (tree) JOIN subroots r USING (tree) JOIN top t ON t.pos = r.pos >> t.level AND t.n > 1
  LEFT JOIN top x ON x.level = t.level AND x.pos = xor(t.pos, 1)),
proofs AS (SELECT tree, pos, sha256(coalesce(string_agg(other, '' ORDER BY level), '')) AS proof_sha256, count(*) AS n FROM steps GROUP BY ALL),
folds AS (
  SELECT tree, pos, 0 AS level, shown AS digest FROM d
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1, sha256(CASE WHEN other IS NULL THEN digest WHEN side = 1 THEN other || digest ELSE digest || other END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level),
folded AS (SELECT tree, pos, max_by(digest, level) AS folded_root FROM folds GROUP BY ALL),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN folded USING (tree, pos) JOIN subroots s USING (tree) CROSS JOIN root LEFT JOIN proofs p ON p.tree = d.tree AND p.pos = d.pos"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                              public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import language_id, toxicity
from tessella.llm.decontamination import decontaminate
from tessella.llm.divergence import divergence
from tessella.llm.exact_dedup import exact_dedup
from tessella.llm.jaccard import jaccard_components
from tessella.llm.lm_scoring import score
from tessella.llm.media import media_columns
from tessella.llm.merkle import manifest
from tessella.llm.packing import pack
from tessella.llm.subwords import piece_round_trip
from tessella.llm.token_counts import token_counts
from tessella.llm.token_output import token_output


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("in_history")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(documents(spark, sf_dir))


def op4_matroska_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_round_trip(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(doc_id AS VARCHAR), '')])),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
fields AS (SELECT d.doc_id, coalesce('=' || source, '') AS tree,
    concat(coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
    text, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents d LEFT JOIN bits USING (doc_id)),
hashed AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS tampered FROM fields),
rows AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (
  SELECT tree, 0 AS lvl, place AS idx, n, leaf AS node FROM rows
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
subroots AS (SELECT tree, lvl AS depth, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, place AS idx, n, subroot AS node FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 3, n),
top AS (SELECT lvl AS height, node AS root FROM tops WHERE n = 1),
steps AS (
  SELECT r, l AS step, tree, l AS lvl, rows.place // CAST(pow(3, l) AS BIGINT) AS q, true AS low FROM rows JOIN subroots USING (tree), unnest(range(depth)) AS t(l)
  UNION ALL
  SELECT r, depth + l, tree, l, subroots.place // CAST(pow(3, l) AS BIGINT), false FROM rows JOIN subroots USING (tree), top, unnest(range(height)) AS t(l)),
siblings AS (
  SELECT r, step, q, idx, node FROM steps JOIN nodes USING (tree, lvl) WHERE low AND idx // 3 = q // 3
  UNION ALL
  SELECT r, step, q, idx, node FROM steps JOIN tops USING (lvl) WHERE NOT low AND idx // 3 = q // 3),
sides AS (SELECT r, step, coalesce(string_agg(node, '' ORDER BY idx) FILTER (WHERE idx < q), '') AS a, coalesce(string_agg(node, '' ORDER BY idx) FILTER (WHERE idx > q), '') AS b FROM siblings GROUP BY r, step),
folds AS (
  SELECT r, 0 AS step, tampered AS now FROM rows
  UNION ALL
  SELECT f.r, f.step + 1, sha256(a || now || b) FROM folds f JOIN sides s ON f.r = s.r AND f.step = s.step),
proofs AS (SELECT r, sha256(string_agg(a || b, '' ORDER BY step)) AS proof_sha256 FROM sides GROUP BY r),
ends AS (SELECT r, arg_max(now, step) AS folded_root FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM rows JOIN subroots USING (tree) JOIN ends USING (r) LEFT JOIN proofs USING (r), top
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
own AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
c AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(o.n, 0) AS n, v, total, sum(coalesce(o.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own_total
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN totals t ON t.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 5)) // (own_total + 5 * v) AS BIGINT) AS p, CAST(1 + (1000000000::HUGEINT * (lang_n + 5)) // (total + 5 * v) AS BIGINT) AS q FROM c),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (FROM pairs UNION ALL FROM terms))
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP13_SQL = r"""
WITH upper_lower AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents, upper_lower),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, upper_lower),
windows AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[j : j + least(10, len(w)) - 1], ' ') AS x FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(j) WHERE len(w) > 0),
places AS (SELECT r, j, k, array_to_string(w[j : j + k - 1], ' ') AS x FROM d, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) AS t(j)),
found AS (SELECT r, j, places.k, item FROM places JOIN windows ON places.k = windows.k AND places.x = windows.x),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(j, j + k)) AS t(p) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_token_output": op3_token_output,
        "op4_matroska_media": op4_matroska_media,
        "op5_language_id": op5_language_id,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_toxicity": op7_toxicity,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_token_counts": op10_token_counts,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_source_divergence": op12_source_divergence,
        "op13_benchmark_decontamination": op13_benchmark_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op11_merkle_manifest": OP11_SQL, "op12_source_divergence": OP12_SQL, "op13_benchmark_decontamination": OP13_SQL}

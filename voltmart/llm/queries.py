"""The registered queries of this subpackage and, where SQL can say it, the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.llm import (
    align, decontaminate, html, langid, licenses, merkle, packing, quality, simhash, substring_dedup,
    suffix_dedup, token_files, toxicity,
)
from voltmart.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), cache_words=900_000)


@query
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_decontamination(spark, sf_dir):
    found = decontaminate.scan(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


ORACLES["op3_decontamination"] = """WITH words_of AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 13) AS n FROM words_of WHERE kind = 'b' AND len(w) > 0),
item_windows AS (SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
  SELECT id, least(len(w), 13) AS n, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
  FROM words_of WHERE kind = 'b' AND len(w) > 0)),
doc_windows AS (SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
  SELECT id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM words_of, sizes WHERE kind = 'd' AND len(w) >= n)),
found AS (SELECT d.id, d.i, d.n, b.id AS item FROM doc_windows d JOIN item_windows b ON d.s = b.s AND d.n = b.n),
hits AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words_of w LEFT JOIN hits h ON w.id = h.id LEFT JOIN items t ON w.id = t.id WHERE w.kind = 'd'"""


@query
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.measure(documents(spark, sf_dir))


@query
def op5_toxicity(spark, sf_dir):
    return toxicity.scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@query
def op9_quality(spark, sf_dir):
    return quality.assess(documents(spark, sf_dir)).drop("rejected_by")


ORACLES["op9_quality"] = """WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM
  (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY 1),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
s AS (SELECT d.doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE NOT (
    word_chars / n_words < 2 OR word_chars / n_words > 20 OR n_symbols / n_words > 0.3
    OR n_dup_lines / len(string_split(t, chr(10))) > 0.3
    OR length(regexp_replace(t, '[^A-Z]', '', 'g')) / greatest(1, word_chars) > 0.5
    OR len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\\x{80}-\\x{10FFFF}]'))) / n_words < 0.6) END AS kept FROM b"""


@query
def op4_language(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@query
def op6_html(spark, sf_dir):
    return html.extract(documents(spark, sf_dir, "pages"))


@query
def op2_token_files(spark, sf_dir):
    return token_files.round_trip(documents(spark, sf_dir), cache_words=900_000)


@query
def op10_licenses(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


@query
def op11_merkle(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return merkle.verify(docs, *merkle.lowered_where_checked(docs))


_LEAF = " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
)
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda s: ascii(s)::UBIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8),
    lambda k: 0::UBIGINT)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""
ORACLES["op11_merkle"] = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, source AS tree, sha256({_LEAF.format(text="text")}) AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN sha256({_LEAF.format(text=_SMALL)}) END AS other FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (SELECT 0 AS level, tree, pos, n, leaf AS digest FROM placed
  UNION ALL SELECT level + 1, tree, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 16),
heads AS (SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper_nodes AS (SELECT 0 AS level, pos, n, digest FROM heads
  UNION ALL SELECT level + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 16),
parents AS (SELECT 'low' AS kind, level, tree, pos // 16 AS up, list(digest ORDER BY pos) AS c FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT 'top', level, NULL, pos // 16, list(digest ORDER BY pos) FROM upper_nodes WHERE n > 1 GROUP BY ALL),
low AS (SELECT doc_id, tree, leaf, other, 0 AS level, pos, n, coalesce(other, leaf) AS folded, '' AS proof FROM placed
  UNION ALL SELECT doc_id, l.tree, leaf, other, l.level + 1, l.pos // 16, (n + 15) // 16,
    sha256(array_to_string(c[:l.pos % 16], '') || folded || array_to_string(c[l.pos % 16 + 2:], '')),
    proof || array_to_string(c[:l.pos % 16], '') || array_to_string(c[l.pos % 16 + 2:], '')
  FROM low l JOIN parents p ON kind = 'low' AND p.level = l.level AND p.tree IS NOT DISTINCT FROM l.tree AND p.up = l.pos // 16
  WHERE n > 1),
high AS (SELECT doc_id, leaf, h.digest AS subroot, 0 AS level, h.pos, h.n, folded, proof FROM low l
    JOIN heads h ON h.tree IS NOT DISTINCT FROM l.tree WHERE l.n = 1
  UNION ALL SELECT doc_id, leaf, subroot, h.level + 1, h.pos // 16, (n + 15) // 16,
    sha256(array_to_string(c[:h.pos % 16], '') || folded || array_to_string(c[h.pos % 16 + 2:], '')),
    proof || array_to_string(c[:h.pos % 16], '') || array_to_string(c[h.pos % 16 + 2:], '')
  FROM high h JOIN parents p ON kind = 'top' AND p.level = h.level AND p.up = h.pos // 16 WHERE n > 1)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM high h JOIN (SELECT digest FROM upper_nodes WHERE n = 1) ON true WHERE h.n = 1"""


@query
def op12_substring_dedup(spark, sf_dir):
    return substring_dedup.measure(documents(spark, sf_dir))


ORACLES["op12_substring_dedup"] = """WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM
  (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1),
cut AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM again) GROUP BY r),
words AS (SELECT d.r, p, w[p] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d) d
  ANTI JOIN (SELECT r, unnest(gone) AS p FROM cut) c ON d.r = c.r AND d.p = c.p),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM words GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@query
def op13_alignment(spark, sf_dir):
    return align.alignment(documents(spark, sf_dir))

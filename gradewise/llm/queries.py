"""Registered queries of this subpackage, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gradewise.llm import (
    bpe, collocations, conversation_repair, decontaminate, kneser_ney, license_scan, pii, quality_rules, rule_ensemble, setsketch,
    token_counts, toxicity, warc,
)
from gradewise.llm.labels import held_out
from gradewise.session import scratch_path


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    # The table has no paths: a document lies in the folder of its source and language.
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op2_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    held = held_out("doc_id", 7, 2)
    scored = kneser_ney.score(docs, kneser_ney.train(docs.where(~held)))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op3_rule_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    scored = rule_ensemble.score(docs, rule_ensemble.train(docs, _read(spark, sf, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    return quality_rules.score(docs, quality_rules.train(docs, _read(spark, sf, "labels")))


def op5_setsketch(spark: SparkSession, sf: str) -> DataFrame:
    return setsketch.groups(_read(spark, sf, "documents"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, _read(spark, sf, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe.encode(_read(spark, sf, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("packed_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    found = pii.find(docs, pii.train(docs))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = _read(spark, sf, "pages")
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    key = pages.schema["page_id"].dataType
    # The rows come by the pages' URLs; reading all blocks shows that none is missing.
    found = warc.lookup(spark, path, pages, payloads=False)
    return warc.checked(found, warc.read_back(spark, path, payloads=False)).select(
        F.col("page").cast(key).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(key).alias("refers_to"),
    )


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.mine(_read(spark, sf, "documents"))


def op12_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.count(_read(spark, sf, "documents"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    damaged = conversation_repair.damage(_read(spark, sf, "conversations"))
    repaired = conversation_repair.repair(damaged, present_col="present")
    told = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    return repaired.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(told, 256).alias("repaired_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_kneser_ney": op2_kneser_ney,
        "op3_rule_ensemble": op3_rule_ensemble,
        "op4_quality_rules": op4_quality_rules,
        "op5_setsketch": op5_setsketch,
        "op6_toxicity": op6_toxicity,
        "op7_bpe": op7_bpe,
        "op8_pii": op8_pii,
        "op9_warc": op9_warc,
        "op10_decontaminate": op10_decontaminate,
        "op11_collocations": op11_collocations,
        "op12_token_counts": op12_token_counts,
        "op13_conversation_repair": op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


_OP10 = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
item_windows AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS size,
    array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM words WHERE kind = 'i' AND len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT id AS doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS words
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM words, sizes WHERE kind = 'd' AND len(w) >= size)
),
hits AS (SELECT doc_id, p, d.size, item_id FROM doc_windows d JOIN item_windows i ON d.words = i.words AND d.size = i.size),
n_hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT doc_id, p, size FROM hits)) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN n_hit ON id = n_hit.doc_id LEFT JOIN found ON id = found.doc_id WHERE kind = 'd'
"""


_OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common >= 85 * (x.n + y.n - common)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM found LEFT JOIN sizes USING (doc_id)
"""

_OP9 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
FROM q
"""


_OP11 = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
  )
),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM pieces WHERE len(w) > 0),
one AS (SELECT lang, w[p] AS x, count(*) AS f FROM places GROUP BY ALL),
two AS (SELECT lang, w[p] AS x, w[p + 1] AS y, count(*) AS f FROM places WHERE p < len(w) GROUP BY ALL),
three AS (
  SELECT lang, w[p] AS x, w[p + 1] AS y, w[p + 2] AS z, count(*) AS f FROM places WHERE p + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10
),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
cuts AS (
  SELECT two.lang, two.x || ' ' || two.y AS phrase, two.f AS a, 1 AS k, i.f AS l, j.f AS r
  FROM two JOIN one i ON i.lang = two.lang AND i.x = two.x JOIN one j ON j.lang = two.lang AND j.x = two.y
  WHERE two.f >= 10 AND NOT EXISTS (
    FROM three t WHERE t.lang = two.lang AND 100 * t.f >= 50 * two.f AND ((t.x = two.x AND t.y = two.y) OR (t.y = two.x AND t.z = two.y))
  )
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, i.f, j.f
  FROM three t JOIN one i ON i.lang = t.lang AND i.x = t.x JOIN two j ON j.lang = t.lang AND j.x = t.y AND j.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, i.f, j.f
  FROM three t JOIN two i ON i.lang = t.lang AND i.x = t.x AND i.y = t.y JOIN one j ON j.lang = t.lang AND j.x = t.z
),
scored AS (SELECT *, CAST(1000000 * a::HUGEINT * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


_OP13 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
),
faults AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: unicode(substr(key, i, 1)))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM keyed, crc
),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fault WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM faults WHERE fault <> 0
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM damaged),
told AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut_off,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY p), 1) || left(role, 1) AS following
  FROM numbered
),
fates AS (SELECT *, blank OR again AS must_go, NOT blank AND NOT again AND cut_off AS truncated FROM told),
edits(edit, state, initial, goal, cost) AS (VALUES
  ('K', 'e', 's', 's', 0), ('K', 'e', 'u', 'u', 0), ('K', 's', 'u', 'u', 0), ('K', 'u', 'a', 'a', 0), ('K', 'a', 'u', 'u', 0),
  ('R', 'e', NULL, 'u', 1), ('R', 's', NULL, 'u', 1), ('R', 'u', NULL, 'a', 1), ('R', 'a', NULL, 'u', 1),
  ('D', 'e', NULL, 'e', 2), ('D', 's', NULL, 's', 2), ('D', 'u', NULL, 'u', 2), ('D', 'a', NULL, 'a', 2)
),
inserts(state, goal, edits, cost) AS (VALUES
  ('e', 'e', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0), ('e', 'u', 'I', 5), ('e', 'a', 'II', 10),
  ('s', 'u', 'I', 5), ('s', 'a', 'II', 10), ('u', 'a', 'I', 5), ('a', 'u', 'I', 5)
),
reach AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS p, goal AS state, CAST(cost AS BIGINT) AS cost, edits AS audit
  FROM (SELECT DISTINCT conv_id FROM damaged), inserts WHERE state = 'e'
  UNION ALL
  SELECT conv_id, p, state, cost, audit FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT r.conv_id, f.p, i.goal AS state, r.cost + e.cost + i.cost + CASE WHEN f.truncated AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost,
        r.audit || e.edit || i.edits AS audit
      FROM reach r JOIN fates f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.p = r.p + 1
      JOIN edits e ON e.state = r.state AND coalesce(e.initial, f.initial) = f.initial AND (e.edit = 'D' OR NOT f.must_go)
      JOIN inserts i ON i.state = e.goal
    )
  ) WHERE place = 1
),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM fates GROUP BY conv_id
),
cheapest AS (
  SELECT r.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
  FROM reach r JOIN counted c ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.n = r.p
  WHERE state IN ('e', 'a') QUALIFY row_number() OVER (PARTITION BY r.conv_id ORDER BY cost, audit) = 1
),
steps AS (
  SELECT conv_id, j, audit[j] AS edit, length(replace(audit[1:j], 'I', '')) AS p, length(replace(audit[1:j], 'D', '')) AS q
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM cheapest)
),
messages AS (
  SELECT s.conv_id, s.j, s.edit, s.q, f.role, f.initial, CASE s.edit WHEN 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN s.q = 1 AND s.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS system
  FROM steps s LEFT JOIN fates f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.p = s.p WHERE s.edit <> 'D'
),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY j) AS text FROM messages GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN cheapest c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL; the queries without it are tested against plain versions in `tests/llm`."""
    sql = {
        "op5_setsketch": _OP5, "op9_warc": _OP9, "op10_decontaminate": _OP10, "op11_collocations": _OP11, "op13_conversation_repair": _OP13,
    }
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

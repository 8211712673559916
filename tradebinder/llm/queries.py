"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tradebinder.llm import alignment, decontaminate, language, line_dedup, phrases, pii, quality_rules, quality_trees, repair, simhash_dedup, toxicity, warc
from tradebinder.llm.packing import pack

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.pages_through_archives(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.tokens_through_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after the removal of repeated lines, with the number of lines that are left."""
    kept = line_dedup.distinct_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.size(F.split("text", "\n")).alias("n_lines"), F.length("text").alias("n_chars"), "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths)


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_quality_trees, op2_simhash_dedup, op3_arc_to_warc, op4_toxicity, op5_quality_rules,
        op6_decontamination, op7_token_files, op8_line_dedup, op9_packing, op10_pii,
        op11_alignment, op12_language, op13_phrases, pipeline,
    )
    return {f.__name__: f for f in operators}


ARC_TO_WARC = """
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, CAST(from_hex(sha1(html)) AS BIT)::VARCHAR AS bits,
             row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, rid) AS place,
             first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST, rid) AS head FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(list_sum(list_transform(range(5), lambda k: CAST(substr(bits, 5 * i + k + 1, 1) AS INT) * (1 << (4 - k)))) AS INT), 1)), '')
           AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN head END AS refers_to
FROM d
"""

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, text FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT rid, i, w[i] || chr(9) || w[i + 1] || chr(9) || w[i + 2] AS g
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest([0, 1, 2]) AS k FROM r) GROUP BY rid),
l AS (SELECT rid, source, text, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
      FROM (SELECT rid, source, text, unnest(string_split(t, chr(10))) AS line FROM d)),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
often AS (SELECT l.source, norm FROM l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE norm <> ''
          GROUP BY l.source, norm, h.n HAVING count(DISTINCT coalesce(text, '')) > greatest(20, 0.1 * h.n)),
lines AS (SELECT l.rid, count(*) FILTER (l.norm <> '') - count(DISTINCT line) FILTER (l.norm <> '') AS dup,
                 coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (o.norm IS NULL), 0) AS stays
          FROM l LEFT JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.norm = o.norm GROUP BY l.rid),
c AS (SELECT d.doc_id, len(w.w) AS n_words, length(regexp_replace(d.t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, lines.dup AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words, lines.stays
      FROM d JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR n_repeat_words > 0.5 * n_words) AS base_failed,
       NOT (n_words < 50 OR n_repeat_words > 0.5 * n_words) AND stays >= 0.3 * word_chars AS kept
FROM c
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, w[i + 3] AS d FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
grams AS (SELECT lang, 1 AS k, a AS g, count(*) AS f FROM starts GROUP BY ALL HAVING f >= 30
          UNION ALL SELECT lang, 2, a || ' ' || b, count(*) AS f FROM starts WHERE b IS NOT NULL GROUP BY ALL HAVING f >= 30
          UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) AS f FROM starts WHERE c IS NOT NULL GROUP BY ALL HAVING f >= 30
          UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d, count(*) AS f FROM starts WHERE d IS NOT NULL GROUP BY ALL HAVING f >= 30),
parts AS (SELECT lang, k, g, f, j, array_to_string(string_split(g, ' ')[1:j], ' ') AS x, array_to_string(string_split(g, ' ')[j + 1:k], ' ') AS y
          FROM (SELECT *, unnest(range(1, k)) AS j FROM grams)),
cuts AS (SELECT p.lang, p.g, p.f AS a, x.f AS l, y.f AS r, p.j, CAST(2000000 AS HUGEINT) * p.f // (x.f + y.f) AS score
         FROM parts p JOIN grams x ON x.lang = p.lang AND x.g = p.x JOIN grams y ON y.lang = p.lang AND y.g = p.y),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS place FROM cuts),
inside AS (SELECT lang, array_to_string(string_split(g, ' ')[i:i + m - 1], ' ') AS g, max(f) AS longer
           FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM grams)) GROUP BY ALL),
free AS (SELECT b.lang, b.g AS phrase, b.a, b.l, b.r, b.score
         FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.g = i.g
         WHERE b.place = 1 AND (i.longer IS NULL OR 100 * i.longer < 80 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle() -> dict[str, str]:
    """SQL twins where SQL can express the query; tests/llm holds the others against brute force."""
    return {"op3_arc_to_warc": ARC_TO_WARC, "op5_quality_rules": QUALITY_RULES, "op13_phrases": PHRASES}

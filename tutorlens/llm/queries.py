"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tutorlens.llm import (
    best_fit_packing,
    byte_bpe,
    exact_dedup,
    extendible_sharding,
    feast_whitening,
    filter_audit,
    license_scan,
    projected_neighbours,
    quality_mil,
    quotation_linking,
    simhash_near_dedup,
    toxicity_crf,
    warc_archive,
)
from tutorlens.llm.common import table


#: Bytes of text in a shard: small files that a loader reads ahead whole.
SHARD_BYTES = 2 << 20


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return best_fit_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), max_tokens=1024, end_id=2)


def op3_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_crf.score(docs, toxicity_crf.fit(docs, table(spark, sf_dir, "labels")))


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup.near_dedup(table(spark, sf_dir, "documents"), width=4, max_distance=4)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_linking.link(table(spark, sf_dir, "conversations"))


def op9_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op10_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_mil.score(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def op11_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc_archive.archive(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc_archive.record_facts(warc_archive.restore(spark, folder))


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast_whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_best_fit_packing,
        op3_toxicity_crf,
        op4_extendible_sharding,
        op5_license_scan,
        op6_simhash_near_dedup,
        op7_byte_bpe,
        op8_quotation_linking,
        op9_projected_neighbours,
        op10_quality_mil,
        op11_warc_archive,
        op12_feast_whitening,
        op13_filter_audit,
        pipeline,
    )
}

_WIDTH = license_scan.windows_of(license_scan.TEMPLATES, license_scan.THRESHOLD)
_LEAST = license_scan.least_words(license_scan.TEMPLATES, license_scan.THRESHOLD)

ORACLE_SQL = {
    "op1_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
""",
    "op4_extendible_sharding": f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), e AS (
  SELECT doc_id, bytes, CAST(depth AS INTEGER) AS depth, h >> (60 - depth) AS prefix FROM d, range(0, 61) t(depth)
), buckets AS (
  SELECT depth, prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM e GROUP BY ALL
), leaves AS (
  SELECT doc_id, bytes, depth, prefix, shard_bytes, shard_docs FROM e JOIN buckets USING (depth, prefix)
  WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
       depth, shard_bytes, shard_docs
FROM leaves
""",
    "op5_license_scan": f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g') AS lines
  FROM documents
), w AS (
  SELECT row_id, doc_id, list_filter(string_split_regex(lines, '[ \\n]+'), lambda x: x <> '') AS words FROM d
), phrases(phrase, label) AS (VALUES {", ".join(f"({p.split()!r}, '{v}')" for p, v in license_scan.BASE_PHRASES.items())}),
templates(label, words, width, least) AS (VALUES {", ".join(f"('{k}', {sorted({*v.split()})!r}, {_WIDTH[k]}, {_LEAST[k]})" for k, v in license_scan.TEMPLATES.items())}),
places AS (
  SELECT row_id, label, unnest(list_filter(range(0, len(words)), lambda i: words[i + 1:i + len(phrase)] = phrase)) AS place
  FROM w, phrases
), base AS (
  SELECT row_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY row_id
), split_lines AS (
  SELECT row_id, generate_subscripts(string_split(lines, chr(10)), 1) AS line,
         list_filter(string_split(unnest(string_split(lines, chr(10))), ' '), lambda x: x <> '') AS words FROM d
), paragraphs AS (
  SELECT row_id, words, sum(CASE WHEN len(words) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY line) AS paragraph,
         sum(len(words)) OVER (PARTITION BY row_id ORDER BY line) - len(words) AS earlier
  FROM split_lines
), all_words AS (
  SELECT row_id, paragraph, earlier + generate_subscripts(words, 1) AS place, unnest(words) AS word FROM paragraphs WHERE len(words) > 0
), template_words AS (
  SELECT label, unnest(words) AS word, len(words) AS size, width, least FROM templates
), hits AS (
  SELECT row_id, paragraph, place, word, label, size, width, least FROM all_words JOIN template_words USING (word)
  QUALIFY len(list_distinct(list(word) OVER (PARTITION BY row_id, paragraph, label))) >= least
), blocks AS (
  SELECT a.row_id, a.paragraph, a.label, a.place AS start, max(z.place) AS last, count(DISTINCT z.word) / a.size AS containment
  FROM hits a JOIN hits z ON a.row_id = z.row_id AND a.paragraph = z.paragraph AND a.label = z.label AND z.place BETWEEN a.place AND a.place + a.width - 1
  GROUP BY a.row_id, a.paragraph, a.label, a.place, a.size, a.least HAVING count(DISTINCT z.word) >= a.least
), met AS (
  SELECT row_id, label, containment, start > coalesce(lag(last) OVER (PARTITION BY row_id, paragraph, label ORDER BY start), -1) AS new FROM blocks
), more AS (
  SELECT row_id, max(containment) AS containment, count(*) FILTER (new) AS n_blocks FROM met GROUP BY row_id
), every_label AS (
  SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row_id, label FROM places UNION ALL SELECT row_id, label FROM met) GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(containment, 0.0), CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score,
       coalesce(n_blocks, 0) AS n_blocks
FROM w LEFT JOIN base USING (row_id) LEFT JOIN more USING (row_id) LEFT JOIN every_label USING (row_id)
""",
    "op8_quotation_linking": r"""
WITH m AS (
  SELECT row_number() OVER () AS row_id, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), l AS (
  SELECT row_id, generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS place,
         unnest(string_split_regex(text, '\r?\n')) AS line FROM m
), s AS (
  SELECT row_id, place, length(regexp_replace(regexp_extract(line, '^[ \t]*(>[> \t]*)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]*(>[> \t]*)', '') AS content FROM l
), b AS (
  SELECT *, level <> lag(level, 1, -1) OVER w OR trim(content) = '' OR lag(trim(content) = '', 1, false) OVER w AS new
  FROM s WINDOW w AS (PARTITION BY row_id ORDER BY place)
), p AS (
  SELECT row_id, run, any_value(level) AS level, string_agg(content, chr(10) ORDER BY place) AS passage
  FROM (SELECT *, sum(new::INT) OVER (PARTITION BY row_id ORDER BY place) AS run FROM b) WHERE trim(content) <> ''
  GROUP BY row_id, run
), own AS (
  SELECT row_id, passage FROM p WHERE level = 0
  UNION ALL SELECT row_id, unnest(string_split(passage, chr(10))) FROM p WHERE level = 0
  UNION ALL SELECT row_id, string_agg(passage, chr(10) ORDER BY run) FROM p WHERE level = 0 GROUP BY row_id
), originals AS (
  SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(passage), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS words
  FROM own JOIN m USING (row_id)
), quotes AS (
  SELECT row_id, run, level, conv_id, turn, trim(regexp_replace(lower(passage), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS words
  FROM p JOIN m USING (row_id) WHERE level > 0
), quoted_lines AS (
  SELECT DISTINCT row_id, run, conv_id, turn, trim(regexp_replace(lower(line), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS words
  FROM (SELECT row_id, run, unnest(string_split(passage, chr(10))) AS line FROM p WHERE level > 0 AND contains(passage, chr(10))) JOIN m USING (row_id)
), needed AS (
  SELECT row_id, run, count(*) AS n FROM quoted_lines WHERE words <> '' GROUP BY ALL
), wrote_all AS (
  SELECT l.row_id, l.run, o.turn AS before FROM quoted_lines l JOIN needed n USING (row_id, run)
  JOIN originals o ON l.conv_id = o.conv_id AND l.words = o.words AND o.turn < l.turn
  WHERE l.words <> '' GROUP BY l.row_id, l.run, o.turn, n.n HAVING count(*) = n.n
), found AS (
  SELECT q.row_id, q.run, q.level, greatest(max(o.turn), max(a.before)) AS before
  FROM quotes q LEFT JOIN originals o ON q.conv_id = o.conv_id AND q.words = o.words AND o.turn < q.turn
  LEFT JOIN (SELECT row_id, run, max(before) AS before FROM wrote_all GROUP BY ALL) a ON q.row_id = a.row_id AND q.run = a.run
  GROUP BY ALL
), q AS (
  SELECT row_id, count(*) AS n_quotes, count(before) AS n_linked, max(level) AS quote_depth,
         first(before ORDER BY level, before DESC) FILTER (before IS NOT NULL) AS quoted
  FROM found GROUP BY row_id
), t AS (
  SELECT conv_id, turn, lag(turn) OVER w AS previous, row_number() OVER w AS position
  FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), c AS (
  SELECT row_id, trim(string_agg(passage, chr(10) || chr(10) ORDER BY run)) AS clean_text FROM p WHERE level = 0 GROUP BY row_id
)
SELECT m.conv_id, m.turn, m.role, coalesce(quoted, previous) AS reply_to, quoted IS NOT NULL AS linked,
       coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, coalesce(quote_depth, 0) AS quote_depth,
       coalesce(position, 1) AS position, coalesce(clean_text, '') AS clean_text
FROM m LEFT JOIN q USING (row_id) LEFT JOIN c USING (row_id) LEFT JOIN t ON m.conv_id = t.conv_id AND m.turn = t.turn
""",
    "op11_warc_archive": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, html, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS response_id FROM p
), digits AS (
  SELECT *, list_transform(range(0, 32), lambda k: (CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS digits
  FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(digits, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to
FROM digits
""",
    "op13_filter_audit": r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t
), f AS (
  SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM w
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), m AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM letters p, letters q, letters r, letters s, letters u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
), steps AS (
  SELECT m.*, filter_order, least(
    CASE WHEN a THEN strpos(filter_order, 'A') ELSE 9 END, CASE WHEN b THEN strpos(filter_order, 'B') ELSE 9 END,
    CASE WHEN c THEN strpos(filter_order, 'C') ELSE 9 END, CASE WHEN d THEN strpos(filter_order, 'D') ELSE 9 END,
    CASE WHEN e THEN strpos(filter_order, 'E') ELSE 9 END) AS gone
  FROM m, orders
), each AS (
  SELECT *, CAST(step AS INTEGER) AS place, substr(filter_order, CAST(step AS INTEGER), 1) AS letter FROM steps, range(1, 6) s(step)
), marked AS (
  SELECT *, CASE letter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
         a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails
  FROM each
), counted AS (
  SELECT part, filter_order, place, letter, sum(CASE WHEN gone > place THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN gone = place THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone < place AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = place THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = place THEN bad ELSE 0 END) AS toxic_lost
  FROM marked GROUP BY ALL
)
SELECT part, filter_order, place AS step, letter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
""",
}

"""The registered queries of this folder, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    block_crf, chat_collapse, chosen_path, importance, line_runs, log_bilinear, permutation_index, piece_table, private_data,
    quality_rules, warc_derivatives, weighted_mix, wu_manber,
)
from quayside.llm.common import table
from quayside import workspace


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.learn_from(docs, table(spark, sf_dir, "labels")))


def op2_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.rendered(spark, table(spark, sf_dir, "conversations"))


def op3_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_crf.extracted(spark, table(spark, sf_dir, "pages"))


def op4_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.scored(spark, table(spark, sf_dir, "documents"))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.report(spark, table(spark, sf_dir, "documents"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace.scratch(spark, "warc")
    warc_derivatives.write_warc(warc_derivatives.response_records(table(spark, sf_dir, "pages")), folder)
    return warc_derivatives.derived(warc_derivatives.read_warc(spark, folder))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.report(spark, table(spark, sf_dir, "documents"))


def op8_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_mix.mixed(table(spark, sf_dir, "documents"))


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.report(spark, table(spark, sf_dir, "documents"))


def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.report(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules, op2_chat_collapse, op3_html_crf, op4_log_bilinear, op5_chosen_path, op6_warc_derivatives,
        op7_line_runs, op8_wu_manber, op9_weighted_mix, op10_private_data, op11_permutation_index,
        op12_importance, op13_piece_table,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op2_chat_collapse": """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    list({'r': role, 't': text}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM placed WHERE pos = n GROUP BY prefix),
maximal AS (SELECT conv_id, n_copies FROM whole WHERE prefix NOT IN (SELECT prefix FROM placed WHERE pos < n))
SELECT p.conv_id, (p.pos - 1) // 256 AS part, p.n AS n_turns, m.n_copies,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
    ORDER BY p.pos) AS text
FROM placed p JOIN maximal m ON p.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY p.conv_id, (p.pos - 1) // 256, p.n, m.n_copies""",
    "op7_line_runs": f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.owner AS lost FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op8_wu_manber": f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM doc_words),
found AS (
  SELECT p.doc_id, p.s, x.n, x.item_id
  FROM (SELECT doc_id, s, l.n, list_slice(w, s, s + l.n - 1) AS words
        FROM places, (SELECT DISTINCT n FROM windows) l WHERE s + l.n - 1 <= len(w)) p
  JOIN windows x ON x.n = p.n AND x.words = p.words),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), 'null') AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)""",
    "op9_weighted_mix": r"""
WITH measured AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    length(translate(text, '#*$%&|<> ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS plain,
    length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS solid,
    (CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT *, -ln(u) / coalesce(CASE WHEN solid > 0 THEN greatest(0.1::DOUBLE, (10 * plain - 9 * solid) / solid) END, 1) AS key
  FROM measured),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM sources) - 2 * coalesce(sum(source_size) OVER (
      ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM sources),
targets AS (
  SELECT source, source_size,
    least(weight * (SELECT max(level) FROM levels WHERE weight * level <= 2 * source_size), 2::DOUBLE * source_size) AS target
  FROM levels),
budgeted AS (
  SELECT k.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
running AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM budgeted)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN size > 0 AND upto - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running""",
    "op13_piece_table": r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
drawn AS (
  SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, [CAST('0x' || substr(h, 1, 8) AS BIGINT),
    CAST('0x' || substr(h, 9, 8) AS BIGINT), CAST('0x' || substr(h, 17, 8) AS BIGINT), CAST('0x' || substr(h, 25, 8) AS BIGINT)] AS d
  FROM texts),
placed AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n, least(d[1] % (len(lines) + 1), d[2] % (len(lines) + 1)) AS a,
    greatest(d[1] % (len(lines) + 1), d[2] % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 100
      THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(list_slice(lines, 1, a), ''), '') AS p,
    coalesce(array_to_string(list_slice(lines, a + 1, b), ''), '') AS m,
    coalesce(array_to_string(list_slice(lines, b + 1, n), ''), '') AS s
  FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts""",
}

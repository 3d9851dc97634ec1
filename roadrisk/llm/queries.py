"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadrisk.llm import (bpe, decontam, embeddings, html_text, langid, linededup, mixing, pii, runs, secrets, simhash, tokens,
                          whitening)
from roadrisk.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.coding_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii, op2_mixing, op3_decontamination, op4_secrets, op5_html_text, op6_simhash, op7_line_dedup,
        op8_embeddings, op9_language_id, op10_token_counts, op11_periodic_runs, op12_whitening, op13_bpe_coding)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: DuckDB SQL for the queries that SQL can express. The others (hash functions,
#: compressors, tokenizers, trees, random draws) are tested against brute force.
ORACLE: dict[str, str] = {
    # Every window of every length, compared with every run of words of that length.
    "op3_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least({decontam.WINDOW}, len(w)) AS n,
         array_to_string(w[i:i + least({decontam.WINDOW}, len(w)) - 1], ' ') AS win
       FROM b, unnest(range(1, len(w) - least({decontam.WINDOW}, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM d, (SELECT DISTINCT n FROM bw) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT rid, i, n, item_id FROM dw JOIN bw USING (win, n)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)""",
    # All variants of all lines, as strings.
    "op7_line_dedup": rf"""
WITH RECURSIVE l AS (
  SELECT doc_id, i - 1 AS line_no, regexp_extract_all(string_split(text, chr(10))[i], '[^ 	-
]+') AS w
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i) WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, line_no, len(w) AS n, array_to_string(w, ' ') AS line, w FROM l WHERE len(w) > 0),
u AS (SELECT line, any_value(w) AS w, min((doc_id, line_no)) AS place, row_number() OVER (ORDER BY line) AS id FROM s GROUP BY line),
v AS (SELECT id, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS key
      FROM u, unnest(range(1, len(w) + 1)) AS t(i) WHERE len(w) >= {linededup.NEAR_WORDS}),
one AS (SELECT a.id AS x, b.id AS y FROM v a JOIN v b ON a.key = b.key AND a.i = b.i AND a.id <> b.id
        UNION SELECT u.id, v.id FROM u JOIN v ON u.line = v.key WHERE len(u.w) >= {linededup.NEAR_WORDS}),
links AS (SELECT x, y FROM one UNION SELECT y, x FROM one),
reach AS (SELECT DISTINCT x AS id, x AS other FROM links UNION SELECT r.id, k.y FROM reach r JOIN links k ON k.x = r.other),
classes AS (SELECT u.line, coalesce(min(o.place), any_value(u.place)) AS first
            FROM u LEFT JOIN reach r ON r.id = u.id LEFT JOIN u o ON o.id = r.other GROUP BY u.line),
gone AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS dropped
         FROM s JOIN classes USING (line) WHERE (doc_id, line_no) <> first GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_dropped,
  coalesce(dropped, '') AS dropped
FROM documents d LEFT JOIN lines USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    # Every pair of a label.
    "op8_embeddings": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {embeddings.COSINE}),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, k.y FROM reach r JOIN links k ON k.x = r.y),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN comp ON comp.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id""",
    # Every pair of equal words of a text; consecutive pairs at one distance are a repetition.
    "op11_periodic_runs": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
    xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295) AS h
  FROM documents),
t AS (SELECT *, CAST(len(w0) AS BIGINT) AS n, h // 10 AS g FROM d),
t2 AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM t),
w AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: w0[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END) + 1])
        ELSE w0 END AS w FROM t2),
u AS (SELECT rid, n, i, w[i + 1] AS word FROM w, unnest(range(n)) AS x(i)),
pairs AS (SELECT a.rid, b.i - a.i AS q, a.i FROM u a JOIN u b ON a.rid = b.rid AND a.word = b.word AND b.i > a.i AND b.i - a.i <= a.n // 4),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pairs),
repeats AS (SELECT rid, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY rid, q, k HAVING count(*) >= 3 * q AND count(*) + q >= 6),
runs AS (SELECT rid, s, l, min(q) AS q FROM repeats GROUP BY rid, s, l),
gone AS (SELECT DISTINCT rid, i FROM runs, unnest(range(s + q, s + l)) AS x(i)),
kept AS (SELECT u.rid, string_agg(word, ' ' ORDER BY i) AS body FROM u ANTI JOIN gone ON gone.rid = u.rid AND gone.i = u.i GROUP BY u.rid),
listed AS (SELECT rid, count(*) AS n, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY rid),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY l DESC, s, q) = 1)
SELECT w.doc_id, CAST(coalesce(listed.n, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
  CAST(best.q AS BIGINT) AS period, CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM w LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)""",
}

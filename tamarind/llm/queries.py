"""One query for each operator, with production parameters over whole tables,
and the DuckDB SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tamarind.llm.alignment import alignment
from tamarind.llm.decontaminate import contaminated
from tamarind.llm.fingerprint import fingerprints
from tamarind.llm.language import languages
from tamarind.llm.middle import fill_in_middle, restored
from tamarind.llm.mixing import mixture
from tamarind.llm.near_dup import near_duplicates
from tamarind.llm.repeats import remove_repeats
from tamarind.llm.secrets import find_secrets
from tamarind.llm.token_files import token_counts
from tamarind.llm.token_table import token_digests, write_tokens
from tamarind.llm.tool_calls import SCHEMAS, calls_of, link_calls
from tamarind.llm.toxicity import toxicity
from tamarind.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query(
    "op1_fingerprint",
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM d
), e AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM n
), w AS MATERIALIZED (
  SELECT *, list_filter(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS a,
         list_filter(string_split_regex(lower(edited), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS b FROM e
), h AS MATERIALIZED (
  SELECT *, CASE WHEN len(a) > 0 THEN list_transform(range(1, greatest(len(a) - 3, 2)), lambda i: left(md5(array_to_string(a[i : i + 4], ' ')), 16)) ELSE [] END AS ha,
         CASE WHEN len(b) > 0 THEN list_transform(range(1, greatest(len(b) - 3, 2)), lambda i: left(md5(array_to_string(b[i : i + 4], ' ')), 16)) ELSE [] END AS hb FROM w
), k AS MATERIALIZED (
  SELECT doc_id, text, edited,
         list_sort(list_distinct(CASE WHEN len(list_filter(ha, lambda x: x < '2')) > 0 THEN list_filter(ha, lambda x: x < '2') WHEN len(ha) > 0 THEN [list_min(ha)] ELSE [] END)) AS fa,
         list_sort(list_distinct(CASE WHEN len(list_filter(hb, lambda x: x < '2')) > 0 THEN list_filter(hb, lambda x: x < '2') WHEN len(hb) > 0 THEN [list_min(hb)] ELSE [] END)) AS fb FROM h
), m AS (
  SELECT *, coalesce(lead(fa) OVER (ORDER BY doc_id), first_value(fa) OVER (ORDER BY doc_id)) AS fn FROM k
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(fa, ',') AS fingerprint, array_to_string(fb, ',') AS edited_fingerprint,
       CASE WHEN len(fa) + len(fb) = 0 THEN 1.0 ELSE len(list_intersect(fa, fb)) / CAST(len(fa) + len(fb) - len(list_intersect(fa, fb)) AS DOUBLE) END AS near_edited,
       CASE WHEN len(fa) + len(fn) = 0 THEN 1.0 ELSE len(list_intersect(fa, fn)) / CAST(len(fa) + len(fn) - len(list_intersect(fa, fn)) AS DOUBLE) END AS near_next
FROM m
""",
)
def op1(spark, sf_dir):
    out = fingerprints(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("sketch", ",").alias("fingerprint"),
        F.array_join("edited_sketch", ",").alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query(
    "op10_near_dup",
    r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM w
), e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
link AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(m.b, s.doc_id) AS kept
FROM s LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON s.doc_id = m.a
""",
)
def op10(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op3_separator_scan")
def op3(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


@query("op9_token_table")
def op9(spark, sf_dir):
    path = scratch_path(spark, "token-table")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return token_digests(spark, path)


def remainder(n: int):
    """The fold of a document: crc32 of its id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op5_toxicity")
def op5(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").where(remainder(3) != 1)
    out = toxicity(table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


@query("op7_language")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = languages(docs, docs.where(remainder(4) != 2))
    return out.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op2_repeats")
def op2(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), 100).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(
    "op4_poisson_mix",
    r"""
WITH size AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM documents GROUP BY source),
total AS (SELECT sum(size) AS sizes, sum(pow(size, 0.5)) FILTER (WHERE size > 0) AS weights FROM size),
rate AS (SELECT source, CASE WHEN size > 0 THEN pow(size, 0.5) / weights * sizes / size ELSE 0.0 END AS rate FROM size, total),
cdf AS (
  SELECT source, rate, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM rate, generate_series(0, 400) g(k) WHERE rate > 0 AND k <= ceil(rate + 12 * sqrt(rate) + 30)
), drawn AS (
  SELECT *, CAST('0x' || left(md5(CAST(doc_id AS VARCHAR) || '|mix-1'), 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.text, count(*) AS copies FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.p <= d.u
  GROUP BY d.doc_id, d.source, d.text
)
SELECT doc_id, source, text, copies AS mix_copies, copy AS mix_copy,
       left(md5(CAST(doc_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR) || '|mix-1|order'), 16) AS mix_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)
""",
)
def op4(spark, sf_dir):
    out = mixture(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", "mix_copies", "mix_copy", "mix_key")


@query("op8_decontaminate")
def op8(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op6_tool_calls",
    r"""
WITH calls AS (
  SELECT conv_id, turn, text, left(md5(conv_id || ':' || turn), 12) AS call_id, left(md5(conv_id || ':' || (turn - 2)), 12) AS needed, length(text) AS n
  FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, left(md5(conv_id || ':' || (turn - 1)), 12) AS call_id, min(text) AS content FROM conversations WHERE role = 'assistant' GROUP BY ALL
), levels AS (
  SELECT c.conv_id, c.call_id, count(DISTINCT b.turn) - 1 AS level FROM calls c JOIN calls b
    ON b.conv_id = c.conv_id AND b.turn <= c.turn AND (c.turn - b.turn) % 2 = 0
   AND (SELECT count(DISTINCT m.turn) FROM calls m WHERE m.conv_id = c.conv_id AND m.turn BETWEEN b.turn AND c.turn AND (c.turn - m.turn) % 2 = 0) = (c.turn - b.turn) // 2 + 1
  GROUP BY ALL
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
  CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, l.level,
  c.call_id IS NOT NULL AND (n % 3 = 0 OR n % 11 BETWEEN 1 AND 9) AS valid,
  CASE WHEN c.call_id IS NULL THEN '$: not JSON; no tool None' WHEN n % 3 = 0 OR n % 11 BETWEEN 1 AND 9 THEN '' WHEN n % 11 = 0 THEN '$.limit: below 1' ELSE '$.limit: above 9' END AS errors,
  '{"arguments":' || CASE WHEN c.call_id IS NULL THEN 'null' WHEN n % 3 = 0 THEN '{"query":' || to_json(text) || ',"to":"en"}' ELSE '{"limit":' || (n % 11) || ',"query":' || to_json(text) || '}' END
    || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":' || CASE WHEN c.call_id IS NULL THEN 'null' WHEN n % 3 = 0 THEN '"translate"' ELSE '"search"' END
    || ',"result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}' AS json
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.call_id = c.call_id
""",
)
def op6(spark, sf_dir):
    calls, results = calls_of(table(spark, sf_dir, "conversations"))
    return link_calls(calls, results, SCHEMAS)


@query(
    "op13_fill_in_middle",
    r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || doc_id) AS h FROM documents
), k AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, left(text, least(c1, c2)) AS pre, substring(text, least(c1, c2) + 1, abs(c1 - c2)) AS mid, substring(text, greatest(c1, c2) + 1) AS suf FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""",
)
def op13(spark, sf_dir):
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restored("output", "form")).alias("restored_sha256"),
    )


@query("op11_secrets")
def op11(spark, sf_dir):
    out = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex", "net")]
    base = F.sha2(joined(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", *counts, base, joined("spans").alias("spans"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)

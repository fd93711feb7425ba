"""One thin query per operator: each applies it with production parameters to its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from geoweave.llm.secret_scan import RULES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.toxicity import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.language import identify

    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.embedding_join import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.quality import quality_scores, resample

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(quality_scores(docs, table(spark, sf_dir, "labels")))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.token_count import token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.minhash import Banding, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), banding=Banding(size=3, num=85, den=100))


def op11_divergence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_phrase_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.phrases import phrases

    return phrases(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geoweave.llm.secret_scan import digest, scan

    return digest(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity_grammar,
        op2_html_blocks,
        op3_language_kernel,
        op4_source_mixing,
        op5_decontamination,
        op6_embedding_near_dup,
        op7_quality_resampling,
        op8_warc_zip,
        op9_token_counts,
        op10_minhash_near_dup,
        op11_divergence_rows,
        op12_phrase_streams,
        op13_secret_trigrams,
        pipeline,
    )
}

_REACH = """
, reach AS (
  SELECT id, id AS goal FROM node
  UNION
  SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.goal
), comp AS (SELECT id, min(goal) AS component_id FROM reach GROUP BY id)
"""



def _spans_sql(rules) -> str:
    """Spans of every rule: the pieces between the matches and the matches themselves give the places."""

    def pattern(rule) -> str:
        # either case is spelt out, since (?i) also folds letters beyond a to z
        text = re.sub(r"[a-z](?=[a-z_]*[?|)])", lambda m: f"[{m[0]}{m[0].upper()}]", rule.pattern) if rule.ignore_case else rule.pattern
        return "'" + text.replace("'", "''") + "'"

    return " UNION ALL ".join(
        f"SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.min_length} AS least, regexp_extract_all(t, {pattern(r)}) AS whole, "
        f"regexp_extract_all(t, {pattern(r)}, {r.group}) AS part, regexp_split_to_array(t, {pattern(r)}) AS gap FROM d"
        for i, r in enumerate(rules)
    )


SQL: dict[str, str] = {
    "op11_divergence_rows": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
t AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT DISTINCT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS total,
    (SELECT count(*) FROM kept WHERE kept.lang = d.lang) AS v FROM d
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (total + 5 * v) AS p
  FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS p FROM kept
), pair AS (
  SELECT a.lang, a.source, b.source AS item, (SELECT coalesce(sum(abs(x.p - y.p)), 0) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), term AS (SELECT lang, source, term AS item, p.p - q.p AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p.p > q.p),
u AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
""",
    "op12_phrase_streams": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, g, count(*) AS n FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
    FROM w CROSS JOIN (VALUES (1), (2), (3)) AS o(k)
  ) GROUP BY ALL
), total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, n AS a, string_split(g, ' ') AS ws FROM g WHERE k > 1 AND n >= 10),
side AS (
  SELECT lang, k, g, a, j, array_to_string(ws[1:j], ' ') AS lg, array_to_string(ws[j + 1:k], ' ') AS rg
  FROM c JOIN (VALUES (1), (2)) AS o(j) ON j < k
), cut AS (
  SELECT side.lang, side.g, a, j, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score
  FROM side JOIN g x ON x.lang = side.lang AND x.g = lg JOIN g y ON y.lang = side.lang AND y.g = rg
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
covered AS (
  SELECT DISTINCT c.lang, c.g FROM c JOIN (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3
  ) y ON y.lang = c.lang AND y.part = c.g WHERE 100 * y.a >= 50 * c.a
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM best ANTI JOIN covered USING (lang, g)
)
SELECT lang, rank, g AS phrase, a, l, r, total AS n, CAST(score AS BIGINT) AS score FROM r JOIN total USING (lang) WHERE rank <= 2000
""",
    "op13_secret_trigrams": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_spans_sql(RULES)}),
e AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, ord, kind, length(whole[i]) AS n,
    list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS a
  FROM e WHERE length(part[i]) >= least
), j AS (
  SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) FILTER (ord < 3) AS base,
    string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) AS spans
  FROM s GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
""",
    "op6_embedding_near_dup": """
WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), link AS (
  SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id <> y.id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), node AS (SELECT id FROM v)"""
    + _REACH
    + """
SELECT id AS vec_id, (SELECT count(*) FROM link WHERE a = comp.id) AS n_links, component_id, id = component_id AS kept
FROM comp
""",
    "op10_minhash_near_dup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents
), s AS (
  SELECT id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS g FROM w
), n AS (SELECT id, len(g) AS n FROM s), u AS (SELECT id, unnest(g) AS h FROM s),
pair AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM u x JOIN u y ON x.h = y.h AND x.id <> y.id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), node AS (SELECT id FROM n)"""
    + _REACH
    + """
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, id = component_id AS kept FROM comp JOIN n USING (id)
""",
    "op8_warc_zip": """
WITH d AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hx FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY hx) AS best FROM d)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hx, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM g
""",
}

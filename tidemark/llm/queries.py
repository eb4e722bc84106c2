"""The registered queries of this subpackage and, where SQL can express one,
its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import collocations, decontaminate, html_text, mixing, neighbours, quality, secrets, sharding, simhash, spelling, suffix_dedup, token_counts, url_filter
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LOWER = "'abcdefghijklmnopqrstuvwxyz'"


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op1_decontaminate"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, {UPPER}, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, {UPPER}, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         unnest(list_transform(range(1, greatest(len(w) - 13, 0) + 2), lambda i: w[i:i + 12])) AS g
  FROM b WHERE len(w) > 0),
grams AS (
  SELECT rid, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'p': i, 'g': w[i:i + n - 1]}})) AS x
  FROM d, (SELECT DISTINCT len(g) AS n FROM win) WHERE len(w) >= n),
hits AS (SELECT DISTINCT rid, n, x.p AS p, item FROM grams JOIN win ON x.g = g),
hw AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN it USING (rid)
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


_TERM = lambda terms: f"[{', '.join(map(repr, terms))}]"
_FOUND = lambda terms: (
    f"len(list_filter({_TERM(terms)}, lambda t: regexp_matches(u, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"
)
_FITS = lambda rule: (
    f"((host = '{rule.partition('/')[0]}' OR ends_with(host, '.{rule.partition('/')[0]}')) AND starts_with(path, '/{rule.partition('/')[2]}'))"
)
_RULES = sorted(url_filter.RULES, key=lambda r: -len(r[0]))
ORACLES["op7_url_filter"] = rf"""
WITH r AS (
  SELECT page_id, translate(array_to_string(list_transform(regexp_extract_all(coalesce(url, ''), '%[2-7][0-9A-Fa-f]|[^%]+|%'),
           lambda p: CASE WHEN regexp_full_match(p, '%[2-7][0-9A-Fa-f]') THEN chr(TRY_CAST('0x' || p[2:3] AS INTEGER)) ELSE p END), ''), {UPPER}, {LOWER}) AS u,
         CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), {UPPER}, {LOWER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
j AS (
  SELECT page_id, host, path, CASE {' '.join(f"WHEN {_FITS(r)} THEN '{r}'" for r, _ in _RULES)} END AS rule,
         CAST({_FOUND(url_filter.STRICT)} AS INTEGER) AS n_strict, CAST({_FOUND(url_filter.SOFT)} AS INTEGER) AS n_soft
  FROM h)
SELECT page_id, host, path, rule, n_strict, n_soft,
       CASE {' '.join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in _RULES)}
            WHEN n_strict > 0 OR n_soft >= {url_filter.BLOCK_AT} THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


ORACLES["op10_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS size,
         md5(concat_ws(':', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS h,
         CAST('0x' || h[1:13] AS BIGINT) AS a, CAST('0x' || h[14:26] AS BIGINT) AS b
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS n, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(r - 1) % 3 + 1]::HUGEINT AS w, 3 * n AS cap FROM s),
o AS (
  SELECT *, row_number() OVER q AS pos, (SELECT sum(n) FROM s) - coalesce(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den
  FROM w WINDOW q AS (ORDER BY cap * (10 // w), r)),
level AS (SELECT num, den FROM o WHERE num * w <= cap * den ORDER BY pos LIMIT 1),
t AS (SELECT source, n, least(CAST(cap AS DOUBLE), CAST(level.num * w AS DOUBLE) / CAST(level.den AS DOUBLE)) AS target FROM o, level),
rate AS (SELECT *, CASE WHEN n > 0 THEN target / n ELSE 0 END AS rate FROM t),
j AS (SELECT d.*, n, target, rate, rate - floor(rate) AS part FROM d JOIN rate ON d.source IS NOT DISTINCT FROM rate.source),
tries AS (
  SELECT source, k, count(*) AS docs,
         abs(CAST(any_value(floor(rate)) * any_value(n) + sum(CASE WHEN ((a + k * b) % {mixing.DRAWS}) / {mixing.DRAWS}.0::DOUBLE < part THEN size ELSE 0 END) AS DOUBLE)
             - any_value(target)) AS missed
  FROM j, range({mixing.TRIES}) r(k) GROUP BY source, k),
best AS (SELECT source, CASE WHEN docs < {mixing.FEW} THEN 0 ELSE k END AS k FROM tries QUALIFY row_number() OVER (PARTITION BY source ORDER BY missed, k) = 1)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, target,
       CAST(size * least(3, floor(rate) + CAST(((a + k * b) % {mixing.DRAWS}) / {mixing.DRAWS}.0::DOUBLE < part AS INTEGER)) AS BIGINT) AS taken
FROM j JOIN best ON j.source IS NOT DISTINCT FROM best.source
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = rf"""
WITH p AS (
  SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
g AS MATERIALIZED (
  SELECT lang, k, w[i:i + k - 1] AS g, count(*)::HUGEINT AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k)
  GROUP BY ALL),
c AS (SELECT * FROM g WHERE k > 1 AND f >= {collocations.LEAST}),
cuts AS (
  SELECT c.lang, c.g, c.k, c.f, l.f AS l, r.f AS r, 2000000 * c.f // (l.f + r.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.g ORDER BY 2000000 * c.f // (l.f + r.f), cut) AS nth
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g l ON l.lang = c.lang AND l.g = c.g[1:cut] JOIN g r ON r.lang = c.lang AND r.g = c.g[cut + 1:c.k]),
covered AS (
  SELECT DISTINCT s.lang, s.g
  FROM (SELECT lang, f, k, g[i:i + m - 1] AS g FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) t(m) WHERE m < k)) longer
  JOIN c s ON s.lang = longer.lang AND s.g = longer.g
  WHERE 100 * longer.f >= {collocations.COVER} * s.f),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(array_to_string(g, ' '))) AS rank,
         array_to_string(g, ' ') AS phrase, f AS a, l, r, score
  FROM cuts ANTI JOIN covered USING (lang, g) WHERE nth = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {collocations.TOP}
"""


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))

"""The operators on the given tables, and the same results in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.audit import audit_filters
from tidemark.llm.centroids import cluster_vectors
from tidemark.llm.common import is_class, table
from tidemark.llm.decontamination import find_leaks
from tidemark.llm.dedup import near_duplicates
from tidemark.llm.language import identify_languages
from tidemark.llm.lines import drop_common_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.pii import KINDS, find_personal_data
from tidemark.llm.quality import score_quality
from tidemark.llm.sharding import assign_shards
from tidemark.llm.topk import top_products
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.urls import judge_pages


def _held_out(modulus, remainder):
    return is_class(F.col("doc_id"), modulus, remainder).alias("held_out")


def _learnable(modulus, remainder):
    return F.col("doc_id").isNotNull() & ~is_class(F.col("doc_id"), modulus, remainder)


def _predicted():
    return F.when(F.col("score") >= 0.7, F.lit(1)).otherwise(F.lit(0)).alias("predicted")


def op1_quality_classifier(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scored = score_quality(docs, labels, _learnable(4, 2))
    return scored.select(
        "doc_id", _held_out(4, 2), "score", _predicted()
    )


def op5_exact_topk(spark, d):
    return top_products(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_toxicity(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scored = score_toxicity(docs, labels, _learnable(3, 1))
    return scored.select(
        "doc_id", _held_out(3, 1), "score", _predicted()
    )


def op10_language_id(spark, d):
    found = identify_languages(table(spark, d, "documents"), _learnable(5, 0))
    return found.select(
        "doc_id", _held_out(5, 0), "lang_pred", "score"
    )


def op2_url_filters(spark, d):
    judged = judge_pages(table(spark, d, "pages"), table(spark, d, "labels"))
    rates = {c: F.round(c, 9) for c in ("bad_rate", "bad_low")}
    return judged.withColumns(rates)


def op3_minhash_dedup(spark, d):
    return near_duplicates(table(spark, d, "documents"))


def op4_mixing(spark, d):
    mixed = mix_sources(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_line_dedup(spark, d):
    kept = drop_common_lines(table(spark, d, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op8_decontamination(spark, d):
    return find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op9_sharding(spark, d):
    sharded = assign_shards(table(spark, d, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op11_centroid_clustering(spark, d):
    found = cluster_vectors(table(spark, d, "embeddings"))
    # One row per centroid, 40 at most.
    centroids = F.broadcast(
        found.centroids.select(
            "cluster",
            F.col("inertia").alias("cluster_inertia"),
            F.col("total_inertia").alias("inertia"),
            F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"),
        )
    )
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return found.assigned.join(centroids, "cluster").select(*names)


def op12_filter_audit(spark, d):
    return audit_filters(table(spark, d, "documents"), table(spark, d, "labels"))


def op13_personal_data(spark, d):
    found = find_personal_data(table(spark, d, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    digest = F.sha2(text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, text("spans").alias("spans"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_url_filters": op2_url_filters,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_mixing": op4_mixing,
    "op5_exact_topk": op5_exact_topk,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_sharding": op9_sharding,
    "op10_language_id": op10_language_id,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_filter_audit": op12_filter_audit,
    "op13_personal_data": op13_personal_data,
}

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP2 = f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {_UPPER}) AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
marks AS (
  SELECT CAST(doc_id AS VARCHAR) AS number, max(greatest(1 - quality, toxic)) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING max(greatest(1 - quality, toxic)) IS NOT NULL),
outcomes AS (
  SELECT host, bad FROM parts LEFT JOIN marks
    ON number = nullif(regexp_extract(path, '/(\\d+)(\\.html)?/?$', 1), '')),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
         list_extract(string_split(host, '.'), -1) AS suffix,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain
  FROM outcomes GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
tops AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
overall AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS rate FROM tops),
levels AS (
  SELECT 3 AS level, '1' AS parent, n, bad FROM tops WHERE n > 0
  UNION ALL SELECT 2, suffix, n, bad FROM domains WHERE n > 0
  UNION ALL SELECT 1, domain, n, bad FROM hosts WHERE n > 0),
per AS (
  SELECT level, sum(n) AS n, sum(bad) / sum(n) AS rate, sum(bad) AS bad, sum(n * n) AS n2,
         sum(bad * bad / n) AS b2, count(*) - 1 AS free
  FROM levels GROUP BY level, parent),
strength AS (
  SELECT l.level, coalesce(greatest(1.0, least(1000.0,
         CASE WHEN sum(b2 - bad * rate - rate * (1 - rate) * free)
                   / nullif(sum(rate * (1 - rate) * (n - n2 / n - free)), 0) > 0
              THEN sum(rate * (1 - rate) * (n - n2 / n - free))
                   / sum(b2 - bad * rate - rate * (1 - rate) * free) - 1
              ELSE 1000.0 END)), 1000.0) AS w
  FROM (SELECT unnest([1, 2, 3]) AS level) l LEFT JOIN per ON per.level = l.level GROUP BY l.level),
top_means AS (
  SELECT suffix, (bad + (SELECT rate FROM overall) * w) / (n + w) AS m
  FROM tops, strength WHERE level = 3),
domain_means AS (
  SELECT domain, (bad + t.m * w) / (n + w) AS m
  FROM domains JOIN top_means t USING (suffix), strength WHERE level = 2),
host_means AS (
  SELECT host, (bad + t.m * w) / (n + w) AS m, n + w AS total
  FROM hosts JOIN domain_means t USING (domain), strength WHERE level = 1),
fits AS (
  SELECT p.*, m, greatest(0.0, m - 1.645 * sqrt(m * (1 - m) / (total + 1))) AS low,
    CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'allow example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'block example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'allow org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'block net/'
    END AS fit
  FROM parts p JOIN host_means USING (host))
SELECT page_id, host, path, substr(fit, 7) AS rule,
       coalesce(left(fit, 5), CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       round(m, 9) AS bad_rate, round(low, 9) AS bad_low
FROM fits
"""

_OP4 = """
WITH rows AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', doc_id::VARCHAR, text)) AS digest,
         greatest(0.05, coalesce(length(regexp_replace(text, '\\P{L}+', '', 'g'))
                                 / nullif(length(text), 0), 0)) AS quality
  FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / quality AS key
  FROM rows),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1.0::DOUBLE AS weight
  FROM rows GROUP BY source),
ordered AS (
  SELECT *, 3.0::DOUBLE * source_size AS room, 3.0::DOUBLE * source_size / weight AS full_at,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NOT NULL, source) AS pos
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(room) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ordered
  WINDOW before AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         greatest(0, least(room, coalesce((SELECT min_by(level, pos) FROM levels WHERE full_at > level)
                                          * weight, room))) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, k.source,
         coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, digest, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
       epochs + (size > 0 AND ahead + size / 2 <= target - epochs * source_size)::BIGINT AS copies,
       copies * size AS taken
FROM placed
"""

_OP5 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP7 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, trim(translate(line, {_UPPER}), {_SPACES}) AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP12 = """
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS own,
         coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY md5(coalesce(text, ''))) AS least
  FROM documents),
masks AS (
  SELECT doc_id, part,
         (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, FALSE)::INT AS mask
  FROM docs),
flags AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM masks LEFT JOIN flags USING (doc_id) GROUP BY part, mask),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

_GAP = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"


def _op11(clusters=40, rounds=5):
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY first, v) - 1)::INTEGER AS cluster, v
  FROM (SELECT sha256('2:' || vec_id) AS first, v FROM kept
        WHERE vec_id IS NOT NULL ORDER BY first, v LIMIT {clusters}))"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT row, min(row(gap, cluster)) AS near FROM (
    SELECT k.row, c.cluster, {_GAP} AS gap FROM kept k, c{r} c) GROUP BY row)"""
        )
        if r < rounds:
            parts.append(
                f"""s{r} AS (
  SELECT near[2] AS cluster, i, sum(x) AS total, count(*) AS n FROM (
    SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept JOIN a{r} USING (row))
  GROUP BY 1, 2),
c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY i) AS v
    FROM s{r} GROUP BY cluster) m USING (cluster))"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, near[2] AS cluster, near[1] AS distance,
       (sum(near[1]) OVER (PARTITION BY near[2]))::BIGINT AS cluster_inertia,
       (sum(near[1]) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (row) JOIN c{rounds} c ON c.cluster = near[2]
"""


ORACLES = {
    "op2_url_filters": _OP2,
    "op4_mixing": _OP4,
    "op5_exact_topk": _OP5,
    "op7_line_dedup": _OP7,
    "op11_centroid_clustering": _op11(),
    "op12_filter_audit": _OP12,
}

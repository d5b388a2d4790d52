"""Robots documents, rules and decisions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import part, query
from lingmill.operators import robots as rb

AGENT = "lingmill/1.0"

part(
    "x_robots_lines",
    r"""
SELECT origin, n - 1 AS line_no, CASE WHEN raw = '' THEN 'blank' ELSE key END AS key, value
FROM (SELECT origin, n, raw, lower(trim(split_part(kept, ':', 1))) AS key, trim(substr(kept, strpos(kept, ':') + 1)) AS value, kept
      FROM (SELECT origin, n, raw, trim(regexp_replace(raw, '#.*$', '')) AS kept
            FROM (SELECT origin, unnest(string_split(content, chr(10))) AS raw,
                         generate_subscripts(string_split(content, chr(10)), 1) AS n
                  FROM x_robots_valid WHERE content IS NOT NULL)))
WHERE raw = '' OR (contains(kept, ':') AND key IN ('user-agent', 'allow', 'disallow', 'crawl-delay', 'request-rate'))
""",
)
part(
    "x_robots_rules",
    """
SELECT origin, group_no, line_no, key, url_decode(value) AS value FROM (
  SELECT *, max(CASE WHEN key NOT IN ('user-agent') THEN 1 ELSE 0 END) OVER (PARTITION BY origin, group_no) AS has_rule
  FROM (SELECT *, max(CASE WHEN key = 'blank' THEN 1 ELSE 0 END) OVER (PARTITION BY origin, group_no ORDER BY line_no) AS closed
        FROM (SELECT *, CAST(sum(start) OVER (PARTITION BY origin ORDER BY line_no) AS BIGINT) AS group_no
              FROM (SELECT *, CASE WHEN key = 'user-agent' AND coalesce(lag(key) OVER (PARTITION BY origin ORDER BY line_no), '') <> 'user-agent'
                              THEN 1 ELSE 0 END AS start FROM x_robots_lines)))
  WHERE closed = 0 AND group_no > 0)
WHERE has_rule = 1
""",
)
part(
    "x_robots_pick",
    """
SELECT origin, group_no FROM (
  SELECT origin, group_no, bool_or(key = 'user-agent' AND value = '*') AS star,
    bool_or(key = 'user-agent' AND contains('lingmill', lower(value))) AS named
  FROM x_robots_rules GROUP BY origin, group_no)
WHERE star OR named
QUALIFY row_number() OVER (PARTITION BY origin ORDER BY star, group_no) = 1
""",
)
part(
    "x_robots_delay",
    """
SELECT origin, CAST(arg_max(value, line_no) AS BIGINT) AS delay
FROM x_robots_rules JOIN x_robots_pick USING (origin, group_no)
WHERE key = 'crawl-delay' AND regexp_full_match(value, '[0-9]+') GROUP BY origin
""",
)
part(
    "x_decide",
    r"""
SELECT url, coalesce(hit.allow, true) AS can_fetch,
  CASE WHEN content IS NULL THEN 'no usable robots document for ' || o
       WHEN hit IS NULL THEN 'no rule applies'
       WHEN hit.allow THEN 'Allow: ' || hit.path ELSE 'Disallow: ' || hit.path END AS reason
FROM (
  SELECT u.url, u.o, arg_min({'allow': r.allow, 'path': r.path}, r.line_no) FILTER (WHERE r.path IS NOT NULL) AS hit
  FROM (SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS o,
               regexp_replace(url_decode(url), '^[a-z]+://[^/?#]*', '') AS path FROM pages) u
  LEFT JOIN (SELECT origin, line_no, key = 'allow' OR value = '' AS allow, regexp_replace(value, '[?]$', '') AS path
             FROM x_robots_rules JOIN x_robots_pick USING (origin, group_no) WHERE key IN ('allow', 'disallow')) r
    ON r.origin = u.o AND starts_with(u.path, r.path)
  GROUP BY u.url, u.o) d
JOIN x_robots_valid v ON v.origin = d.o
""",
)


def valid_docs(spark, sf):
    return rb.robots_validate(src.robots_docs(spark, sf))


@query("SELECT origin, CAST(status AS BIGINT) AS status, content_type, content FROM x_robots_valid")
def robots_validate(spark, sf):
    return valid_docs(spark, sf).withColumn("status", F.col("status").cast("bigint"))


@query("SELECT origin, group_no, CAST(line_no AS BIGINT) AS line_no, key, value FROM x_robots_rules")
def robots_rules(spark, sf):
    return rb.robots_rules(valid_docs(spark, sf))


@query("SELECT url, can_fetch, reason FROM x_decide")
def robots_decide(spark, sf):
    return rb.robots_decide(src.pages(spark, sf).select("url"), valid_docs(spark, sf), AGENT)


@query("SELECT url, can_fetch, reason FROM x_decide")
def robots_decide_by_prefix(spark, sf):
    return rb.robots_decide_by_prefix(src.pages(spark, sf).select("url"), valid_docs(spark, sf), AGENT)


@query(
    """
SELECT url, strftime(f.ts, '%Y-%m-%d %H:%M:%S.%f') AS fetch_time,
  CASE WHEN d.ts > f.ts - INTERVAL 24 HOUR THEN strftime(d.ts, '%Y-%m-%d %H:%M:%S.%f') END AS doc_time
FROM (SELECT event_id, ts, user_id % 50 AS u, 'https://u' || (user_id % 50) || '.example.org/' || event_id AS url FROM events WHERE event_type <> 'error') f
ASOF LEFT JOIN (SELECT DISTINCT user_id % 50 AS u, ts FROM events WHERE event_type = 'error') d ON f.u = d.u AND f.ts >= d.ts
"""
)
def robots_as_of(spark, sf):
    """Errors stand for fetched robots documents, all other events for fetches of pages on 50 hosts."""
    events = src.table(spark, sf, "events")
    origin = F.concat(F.lit("https://u"), (F.col("user_id") % 50).cast("string"), F.lit(".example.org"))
    docs = events.filter("event_type = 'error'").select(origin.alias("origin"), F.col("ts").alias("fetched_at"))
    page = F.concat(origin, F.lit("/"), F.col("event_id").cast("string"))
    fetches = events.filter("event_type <> 'error'").select(page.alias("url"), F.col("ts").alias("fetch_time"))
    found = rb.robots_as_of(fetches, docs)
    return found.select("url", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("fetch_time", "doc_time")))


@query(
    """
SELECT url, d.delay AS robots_delay, CASE WHEN d.delay IS NULL THEN 1 ELSE least(greatest(d.delay, 1), 10) END AS delay
FROM pages LEFT JOIN x_robots_delay d ON d.origin = regexp_extract(url, '^[a-z]+://[^/?#]*', 0)
"""
)
def crawl_delay(spark, sf):
    return rb.crawl_delay(src.pages(spark, sf).select("url"), valid_docs(spark, sf), AGENT)


@query(
    """
SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || '/robots.txt' AS robots_url
FROM pages WHERE NOT regexp_matches(url, '^[a-z]+://(blog|m)[.]')
"""
)
def robots_missing(spark, sf):
    docs = src.robots_docs(spark, sf).filter(F.rlike("origin", F.lit("://(blog|m)[.]")))
    return rb.robots_missing(src.pages(spark, sf), docs)


NOW = datetime(2024, 1, 30, 12, 0, 0)


@query(
    """
SELECT origin, status, content, fetched_at FROM (
  SELECT 'https://u' || user_id || '.example.org' AS origin, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END::BIGINT AS status,
    props AS content, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS fetched_at,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r
  FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00')
WHERE r = 1
"""
)
def robots_cache_valid(spark, sf):
    """Every event stands for one fetch of a user's robots document."""
    docs = src.table(spark, sf, "events").select(
        F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example.org")).alias("origin"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).cast("bigint").alias("status"),
        F.col("props").alias("content"),
        F.col("ts").alias("fetched_at"),
    )
    now = F.lit(NOW).cast("timestamp_ntz")
    valid = rb.robots_cache_valid(docs, now)
    return valid.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    """
SELECT url, can_fetch, CASE WHEN can_fetch THEN NOT contains(m, 'noindex') END AS can_index,
  CASE WHEN can_fetch THEN NOT contains(m, 'nofollow') END AS can_follow
FROM (SELECT url, lower(CASE WHEN url LIKE '%.html' THEN 'NOINDEX' WHEN url LIKE '%/' THEN 'noindex, NoFollow'
        WHEN url LIKE '%?%' THEN 'nofollow' ELSE '' END) AS m FROM pages) JOIN x_decide USING (url)
"""
)
def url_policy(spark, sf):
    return rb.url_policy(src.tagged_pages(spark, sf), valid_docs(spark, sf), AGENT)

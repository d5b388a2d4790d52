"""Picking, batching and updating the frontier, and whole crawl rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.language import model
from catalogue.registry import part, query
from catalogue.robots import AGENT, valid_docs
from lingmill.operators import frontier as fr
from lingmill.operators import links as lk
from lingmill.plans import crawl
from lingmill.sources import readers
from lingmill.sources.shared import materialize

BATCH = 100


def sql_batch(frontier: str, n: int) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY pass, n_host DESC, first_pos, first_url) AS batch_pos, url, host FROM (
  SELECT url, host, row_number() OVER h AS pass, count(*) OVER (PARTITION BY host) AS n_host,
    first_value(pos) OVER h AS first_pos, first_value(url) OVER h AS first_url
  FROM (SELECT pos, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM {frontier} ORDER BY pos, url LIMIT {n * 10})
  WINDOW h AS (PARTITION BY host ORDER BY pos, url))
ORDER BY 1 LIMIT {n}
"""


part("x_frontier", "SELECT page_id AS pos, url FROM pages")
part("x_batch", sql_batch("x_frontier", BATCH))


def sql_pos(url: str, round_no: int, seed: int = 0) -> str:
    return f"{round_no << 48} + CAST('0x' || substr(md5({url} || '{seed}'), 1, 12) AS BIGINT)"


def _batch(spark, sf):
    return fr.frontier_batch(src.frontier(spark, sf), BATCH)


@query("SELECT batch_pos, url, host FROM x_batch")
def frontier_batch(spark, sf):
    return _batch(spark, sf)


@query(
    """
SELECT pos, url, domain, CAST(dense_rank() OVER (ORDER BY pass, place // 25) - 1 AS BIGINT) AS batch FROM (
  SELECT *, row_number() OVER (PARTITION BY pass ORDER BY first_pos) - 1 AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY pos) - 1 AS pass, min(pos) OVER (PARTITION BY domain) AS first_pos
    FROM (SELECT pos, url, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\\.', '') AS domain FROM x_frontier)))
"""
)
def polite_batches(spark, sf):
    return fr.polite_batches(src.frontier(spark, sf), batch_size=25)


@query(f"SELECT {sql_pos('url', 3, 7)} AS pos, url FROM (SELECT DISTINCT url FROM x_plain_links)")
def frontier_shuffle(spark, sf):
    return fr.frontier_shuffle(lk.page_links(src.pages(spark, sf)), round_no=3, seed=7)


@query("SELECT batch_pos, url, host FROM x_batch WHERE url NOT IN (SELECT url FROM x_seen)")
def frontier_unseen(spark, sf):
    return fr.frontier_unseen(_batch(spark, sf), src.seen(spark, sf))


@query("SELECT batch_pos, url, host FROM x_batch WHERE url IN (SELECT url FROM x_seen)")
def frontier_discard(spark, sf):
    return fr.frontier_discard(_batch(spark, sf), src.seen(spark, sf))


@query(
    f"""
SELECT 'frontier' AS state, pos, url FROM x_frontier WHERE url NOT IN (SELECT url FROM x_batch)
UNION ALL SELECT 'frontier', {sql_pos('url', 1)}, url FROM (SELECT url FROM x_plain_links UNION SELECT url FROM pages)
  WHERE url NOT IN (SELECT url FROM x_seen UNION ALL SELECT url FROM x_batch UNION ALL SELECT url FROM x_frontier)
UNION ALL SELECT 'seen', NULL, url FROM (SELECT url FROM x_seen UNION SELECT url FROM x_batch)
"""
)
def frontier_update(spark, sf):
    """State and new links are stored tables, as between two rounds."""
    pages = src.pages(spark, sf)
    found = materialize(lk.page_links(pages).select("url").unionByName(pages.select("url")))
    seen, batch = materialize(src.seen(spark, sf)), materialize(_batch(spark, sf))
    waiting, seen = fr.frontier_update(src.frontier(spark, sf), seen, batch, found, 1)
    return waiting.select(F.lit("frontier").alias("state"), "pos", "url").unionByName(
        seen.select(F.lit("seen").alias("state"), F.lit(None).cast("bigint").alias("pos"), "url")
    )


# Three rounds over the pages as corpus. All pages are seeds; their links are not in the corpus,
# so a link that is picked fails and adds nothing.
ROUNDS, ROUND_SIZE = 3, 60
part("x_crawl_f0", f"SELECT {sql_pos('url', 0)} AS pos, url FROM pages")
for _r in range(1, ROUNDS + 1):
    part(f"x_crawl_b{_r}", sql_batch(f"x_crawl_f{_r - 1}", ROUND_SIZE))
    part(
        f"x_crawl_p{_r}",
        f"""
SELECT CAST({_r} AS BIGINT) AS round, batch_pos, url, coalesce(can_fetch, true) AS can_fetch,
  CAST(CASE WHEN NOT coalesce(can_fetch, true) THEN NULL WHEN page IS NULL THEN -1 ELSE 200 END AS BIGINT) AS status
FROM x_crawl_b{_r} LEFT JOIN (SELECT url, can_fetch FROM x_decide_all) USING (url) LEFT JOIN (SELECT url, url AS page FROM pages) USING (url)
""",
    )
    _done = " UNION ALL ".join(f"SELECT url FROM x_crawl_b{i}" for i in range(1, _r + 1))
    part(
        f"x_crawl_f{_r}",
        f"""
SELECT pos, url FROM x_crawl_f{_r - 1} WHERE url NOT IN ({_done})
UNION ALL SELECT {sql_pos('url', _r)}, url
FROM (SELECT DISTINCT l.url FROM x_plain_links l JOIN x_crawl_p{_r} p ON p.url = l.page WHERE p.status = 200)
WHERE url NOT IN ({_done}) AND url NOT IN (SELECT url FROM x_crawl_f{_r - 1})
""",
    )
# Decisions for pages and for links alike.
part(
    "x_decide_all",
    r"""
SELECT u.url, coalesce(arg_min(r.allow, r.line_no), true) AS can_fetch
FROM (SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS o,
             regexp_replace(url_decode(url), '^[a-z]+://[^/?#]*', '') AS path
      FROM (SELECT url FROM pages UNION SELECT url FROM x_plain_links)) u
LEFT JOIN (SELECT origin, line_no, key = 'allow' OR value = '' AS allow, regexp_replace(value, '[?]$', '') AS path
           FROM x_robots_rules JOIN x_robots_pick USING (origin, group_no) WHERE key IN ('allow', 'disallow')) r
  ON r.origin = u.o AND starts_with(u.path, r.path)
GROUP BY u.url
""",
)


part(
    "x_crawl_kept",
    """
SELECT url, segment_no, language FROM x_page_labels
WHERE language = 'en' QUALIFY count(*) OVER (PARTITION BY url) * 100 >= (SELECT count(*) FROM x_page_labels l WHERE l.url = x_page_labels.url) * 80
""",
)


def _crawl(spark, sf, **options):
    pages = src.pages(spark, sf)
    return crawl.crawl_rounds(
        pages.select("url"),
        pages.withColumn("status", F.lit(200)),
        # stored, as each round looks for its origins in them
        materialize(valid_docs(spark, sf).drop("fetched_at")),
        model(spark, sf),
        crawl.CrawlOptions(targets=("en",), num_rounds=ROUNDS, round_size=ROUND_SIZE, user_agent=AGENT, **options),
    )


@query(
    " UNION ALL ".join(
        f"SELECT round, batch_pos, url, status, can_fetch FROM x_crawl_p{_r}" for _r in range(1, ROUNDS + 1)
    )
)
def crawl_rounds(spark, sf):
    log = crawl.crawl_log(_crawl(spark, sf), range(1, ROUNDS + 1))
    return log.withColumn("status", F.col("status").cast("bigint"))


@query(
    "SELECT round, line AS text, language AS label FROM ("
    + " UNION ALL ".join(f"SELECT round, url, status FROM x_crawl_p{_r}" for _r in range(1, ROUNDS + 1))
    + ") JOIN x_crawl_kept USING (url) JOIN x_page_lines USING (url, segment_no) WHERE status = 200"
)
def crawl_round_text(spark, sf):
    """The text that the rounds wrote, their logs merged after every second round."""
    state = _crawl(spark, sf, merge_every=2)
    return readers.round_segments(spark, state.segments).select(F.col("round").cast("bigint").alias("round"), "text", "label")


@query(f"SELECT pos, url FROM x_crawl_f{ROUNDS}")
def crawl_frontier(spark, sf):
    """What waits after the rounds, read from the logs."""
    return _crawl(spark, sf, merge_every=2).frontier(ROUNDS)


@query(
    r"""
SELECT p.url, CAST(dense_rank() OVER (ORDER BY pass, place // 25) - 1 AS BIGINT) AS step,
  CASE WHEN d.delay IS NULL THEN 1 ELSE least(greatest(d.delay, 1), 10) END AS delay
FROM (
  SELECT *, row_number() OVER (PARTITION BY pass ORDER BY first_pos) - 1 AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY batch_pos) - 1 AS pass, min(batch_pos) OVER (PARTITION BY domain) AS first_pos
    FROM (SELECT batch_pos, url, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\.', '') AS domain
          FROM x_crawl_p1 WHERE can_fetch))) p
LEFT JOIN x_robots_delay d ON d.origin = regexp_extract(p.url, '^[a-z]+://[^/?#]*', 0)
"""
)
def crawl_fetch_plan(spark, sf):
    """Steps and pauses of the first round's URLs."""
    plan = _crawl(spark, sf, fetch_plan=True, step_size=25).fetch_plan(1)
    return plan.select("url", "step", F.col("delay").cast("bigint").alias("delay"))

"""Robots rules as tables: documents are taken apart once, then joined by origin.

Group and rule choice follow the robots parser of the Python 3.13 standard library: the first
group whose agent is part of our product token, else the first `*` group; the first rule in
file order whose path the URL begins with; no wildcards; no rule means allowed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill.functions import tags, urls
from lingmill.functions import text as tx
from lingmill.operators.ranking import running_max
from lingmill.sources.shared import materialize

# Robots.txt keys that make up a group.
_RULE_KEYS = ("allow", "disallow", "crawl-delay", "request-rate")

# The line ends that str.splitlines knows.
_LINE_END = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"


def robots_validate(docs: DataFrame) -> DataFrame:
    """Only status 200 with a plain-text type is a robots document; else content is NULL."""
    plain = (F.col("status") == 200) & F.contains(F.lower("content_type"), F.lit("text/plain"))
    return docs.withColumn("content", F.when(F.coalesce(plain, F.lit(False)), F.col("content")))


def robots_cache_valid(docs: DataFrame, now: Column | datetime, ttl: str = "24 hours") -> DataFrame:
    """The latest document of every origin, if it is younger than `ttl`."""
    now = now if isinstance(now, Column) else F.lit(now)
    fresh = docs.filter(F.col("fetched_at") > now - F.expr(f"interval {ttl}"))
    rest = [c for c in docs.columns if c != "origin"]
    latest = fresh.groupBy("origin").agg(F.max_by(F.struct(*rest), "fetched_at").alias("_last"))
    return latest.select("origin", *[f"_last.{c}" for c in rest])


def robots_as_of(fetches: DataFrame, docs: DataFrame, time_col: str = "fetch_time", ttl_hours: int = 24) -> DataFrame:
    """Add `doc_time`: when the document that held at the time of a fetch was itself fetched, NULL if none held.

    `fetches` has `url` and `time_col`, `docs` any number of versions (origin, fetched_at). The last version up to the
    time of the fetch holds, if it is younger than `ttl_hours`. Versions and fetches are put in order of origin and time
    together, and each fetch takes the last version before it along (see `ranking.running_max`), so no fetch looks at
    a list of versions, and a hot origin lies in several ranges.
    """
    age = F.expr(f"interval {int(ttl_hours)} hours")
    versions = docs.filter(F.col("origin").isNotNull() & F.col("fetched_at").isNotNull()).select("origin", "fetched_at").distinct()
    # a version holds at its very time already, so it comes first; the last column spreads fetches of one time
    asked = fetches.select(
        F.struct(*fetches.columns).alias("_fetch"), urls.origin(F.col("url")).alias("_origin"), F.col(time_col).alias("_at"),
        F.lit(None).cast(docs.schema["fetched_at"].dataType).alias("_version"), F.lit(1).alias("_turn"), F.xxhash64("url").alias("_place"),
    )
    held = versions.select(
        F.lit(None).cast(asked.schema["_fetch"].dataType).alias("_fetch"), F.col("origin").alias("_origin"), F.col("fetched_at").alias("_at"),
        F.col("fetched_at").alias("_version"), F.lit(0).alias("_turn"), F.lit(0).cast("bigint").alias("_place"),
    )
    last = running_max(asked.unionByName(held), ["_origin"], ["_at", "_turn", "_place"], "_version", "_last")
    fresh = F.when(F.col("_last") > F.col("_at") - age, F.col("_last"))
    return last.filter("_turn = 1").select(*(F.col("_fetch")[c].alias(c) for c in fetches.columns), fresh.alias("doc_time"))


def robots_missing(urls_df: DataFrame, docs: DataFrame) -> DataFrame:
    """(origin, robots_url): origins of the URLs that have no document yet."""
    wanted = urls_df.select(urls.origin(F.col("url")).alias("origin")).distinct()
    return wanted.join(docs.select("origin"), "origin", "left_anti").select(
        "origin", F.concat("origin", F.lit("/robots.txt")).alias("robots_url")
    )


def robots_rules(docs: DataFrame) -> DataFrame:
    """(origin, group_no, line_no, key, value): the lines that count, one document per origin.

    The windows run within one origin, that is within the lines of one document.
    """
    raw = F.col("raw")
    kept = tx.strip(F.regexp_replace(raw, "#.*$", ""))
    key = F.lower(tx.strip(F.substring_index(kept, ":", 1)))
    value = F.regexp_replace(kept, "^[^:]*:", "")
    lines = (
        docs.filter(F.col("content").isNotNull())
        .select("origin", F.posexplode(F.split("content", _LINE_END)).alias("line_no", "raw"))
        .select(
            "origin",
            "line_no",
            F.when(raw == "", "blank")
            .when(F.contains(kept, F.lit(":")) & key.isin("user-agent", *_RULE_KEYS), key)
            .alias("key"),
            tx.strip(value).alias("value"),
        )
        .filter(F.col("key").isNotNull())
    )
    in_doc = Window.partitionBy("origin").orderBy("line_no")
    so_far = in_doc.rowsBetween(Window.unboundedPreceding, 0)
    is_agent = F.col("key") == "user-agent"
    starts = is_agent & (F.coalesce(F.lag("key").over(in_doc), F.lit("")) != "user-agent")
    grouped = lines.withColumn("_start", starts.cast("int")).withColumn(
        "group_no", F.sum("_start").over(so_far)
    )
    in_group = Window.partitionBy("origin", "group_no").orderBy("line_no")
    closed = F.max((F.col("key") == "blank").cast("int")).over(
        in_group.rowsBetween(Window.unboundedPreceding, 0)
    )
    has_rule = F.max((F.col("key").isin(*_RULE_KEYS)).cast("int")).over(
        Window.partitionBy("origin", "group_no")
    )
    return (
        grouped.withColumn("_closed", closed)
        .filter((F.col("_closed") == 0) & (F.col("group_no") > 0))
        .withColumn("_has_rule", has_rule)
        .filter(F.col("_has_rule") == 1)
        .select(
            "origin",
            F.col("group_no").cast("bigint"),
            F.col("line_no").cast("bigint"),
            "key",
            urls.percent_decode(F.col("value")).alias("value"),
        )
    )


def product_token(user_agent: str) -> str:
    return user_agent.split("/")[0].lower()


def robots_policy(rules: DataFrame, user_agent: str) -> DataFrame:
    """(origin, rules, delay): what holds for our agent, one row per origin with any group.

    A document's rules fit into one row, so the join with URLs is one-to-one and the rule is
    picked inside the row: URLs are not multiplied by rules, and no second shuffle follows.
    """
    token = F.lit(product_token(user_agent))
    is_agent = F.col("key") == "user-agent"
    is_path = F.col("key").isin("allow", "disallow")
    rule = F.struct(
        F.col("line_no"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
        urls.robots_rule_path(F.col("value")).alias("path"),
    )
    is_delay = (F.col("key") == "crawl-delay") & F.rlike("value", F.lit("^[0-9]+$"))
    groups = rules.groupBy("origin", "group_no").agg(
        F.bool_or(is_agent & (F.col("value") == "*")).alias("star"),
        F.bool_or(is_agent & F.contains(token, F.lower("value"))).alias("named"),
        F.array_sort(F.collect_list(F.when(is_path, rule))).alias("rules"),
        F.max_by(F.col("value").try_cast("bigint"), F.when(is_delay, F.col("line_no"))).alias("delay"),
    )
    mine = groups.filter(F.col("star") | F.col("named"))
    best = F.min_by(F.struct("rules", "delay"), F.struct("star", "group_no"))
    picked = mine.groupBy("origin").agg(best.alias("_g"))
    return picked.select(
        "origin", F.col("_g.rules").alias("rules"), F.col("_g.delay").cast("bigint").alias("delay")
    )


def robots_decide(urls_df: DataFrame, docs: DataFrame, user_agent: str, enabled: bool = True) -> DataFrame:
    """Add `can_fetch` and `reason`. No document, or none that counts: allowed.

    `docs` holds validated documents, one per origin. The policy table is joined without a
    forced strategy: it is broadcast if it is small, and if not, adaptive execution splits
    an origin that has very many URLs.
    """
    if not enabled:
        return urls_df.withColumns(
            {"can_fetch": F.lit(True), "reason": F.lit("robots check is off")}
        )
    policy = robots_policy(robots_rules(docs), user_agent)
    known = docs.select("origin", F.col("content").isNotNull().alias("has_doc"))
    table = known.join(policy, "origin", "left")
    path = urls.robots_path(F.col("url"))
    hit = F.try_element_at(
        F.filter(F.col("rules"), lambda r: F.startswith(F.col("_path"), r["path"])), F.lit(1)
    )
    joined = urls_df.withColumns({"origin": urls.origin(F.col("url")), "_path": path}).join(
        table, "origin", "left"
    )
    return joined.withColumn("_hit", hit).select(*urls_df.columns, *_decision())


def _decision() -> tuple[Column, Column]:
    """`can_fetch` and `reason` from `origin`, `has_doc` and the rule `_hit`."""
    reason = (
        F.when(~F.coalesce("has_doc", F.lit(False)), F.concat(F.lit("no usable robots document for "), F.col("origin")))
        .when(F.col("_hit").isNull(), "no rule applies")
        .when(F.col("_hit.allow"), F.concat(F.lit("Allow: "), F.col("_hit.path")))
        .otherwise(F.concat(F.lit("Disallow: "), F.col("_hit.path")))
    )
    return F.coalesce(F.col("_hit.allow"), F.lit(True)).alias("can_fetch"), reason.alias("reason")


def robots_decide_by_prefix(urls_df: DataFrame, docs: DataFrame, user_agent: str) -> DataFrame:
    """The same rows as `robots_decide`, for origins with very many rules.

    No row carries the rules of its origin. A URL gets only the lengths that rule paths of its origin have, its
    beginnings of these lengths meet the rules by equality, and the least line number wins by a combining
    aggregate. Of rules with the same path the first is kept, so a URL meets one rule per length at most.
    """
    rules = robots_rules(docs)
    groups = rules.groupBy("origin", "group_no").agg(
        F.bool_or((F.col("key") == "user-agent") & (F.col("value") == "*")).alias("star"),
        F.bool_or((F.col("key") == "user-agent") & F.contains(F.lit(product_token(user_agent)), F.lower("value"))).alias("named"),
    )
    mine = groups.filter(F.col("star") | F.col("named")).groupBy("origin").agg(F.min_by("group_no", F.struct("star", "group_no")).alias("group_no"))
    allow = ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow")
    paths = rules.filter(F.col("key").isin("allow", "disallow")).join(mine, ["origin", "group_no"])
    paths = paths.select("origin", "line_no", allow, urls.robots_rule_path(F.col("value")).alias("path"))
    first = paths.groupBy("origin", "path").agg(F.min(F.struct("line_no", "allow")).alias("rule"))
    first = materialize(first)
    lengths = first.groupBy("origin").agg(F.collect_set(F.length("path")).alias("lengths"))
    known = docs.select("origin", F.col("content").isNotNull().alias("has_doc")).join(lengths, "origin", "left")

    asked = urls_df.select("url").distinct().withColumns({"origin": urls.origin(F.col("url")), "_path": urls.robots_path(F.col("url"))})
    asked = materialize(asked.join(known, "origin", "left"))
    fitting = F.filter("lengths", lambda n: n <= F.length("_path"))
    begun = asked.select("url", "origin", F.explode(F.transform(fitting, lambda n: F.substring(F.col("_path"), F.lit(1), n))).alias("path"))
    hits = begun.join(first, ["origin", "path"]).groupBy("url").agg(F.min(F.struct("rule.line_no", "rule.allow", "path")).alias("_hit"))
    decided = asked.join(hits, "url", "left").select("url", "origin", "has_doc", "_hit")
    return urls_df.join(decided, "url", "left").select(*(urls_df[c] for c in urls_df.columns), *_decision())


def crawl_delay(
    urls_df: DataFrame, docs: DataFrame, user_agent: str, default: int = 1, cap: int = 10
) -> DataFrame:
    """Add `robots_delay` (may be NULL) and `delay`: at least the default, at most the cap.

    Without a delay in the rules the default holds as it is, even above the cap.
    """
    policy = robots_policy(robots_rules(docs), user_agent).select(
        "origin", F.col("delay").alias("robots_delay")
    )
    asked = F.col("robots_delay")
    return (
        urls_df.withColumn("origin", urls.origin(F.col("url")))
        .join(policy, "origin", "left")
        .select(
            *urls_df.columns,
            asked,
            F.when(asked.isNull(), F.lit(default))
            .otherwise(F.least(F.greatest(asked, F.lit(default)), F.lit(cap)))
            .cast("bigint")
            .alias("delay"),
        )
    )


def robots_meta(pages: DataFrame) -> DataFrame:
    """Add `can_index`, `can_follow` and `meta_error` from the robots meta tag."""
    found = pages.withColumn("_meta", tags.robots_directives(F.col("html")))
    return found.select(
        *pages.columns,
        F.col("_meta.can_index").alias("can_index"),
        F.col("_meta.can_follow").alias("can_follow"),
        F.col("_meta.error").alias("meta_error"),
    )


def url_policy(pages: DataFrame, docs: DataFrame, user_agent: str, enabled: bool = True) -> DataFrame:
    """Everything that rules one URL: `can_fetch`, `can_index`, `can_follow`.

    What may not be fetched has no meta tag to look at: the meta columns are NULL. The tag is read where
    the page is, so html takes no part in the join with the rules.
    """
    read = robots_meta(pages.select("url", "html")).select("url", "can_index", "can_follow")
    decided = robots_decide(read, docs, user_agent, enabled)
    ok = F.col("can_fetch")
    return decided.select(
        "url",
        "can_fetch",
        F.when(ok, F.col("can_index")).alias("can_index"),
        F.when(ok, F.col("can_follow")).alias("can_follow"),
    )

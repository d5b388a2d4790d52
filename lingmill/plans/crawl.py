"""Frontier expansion over a corpus of pages, round by round.

A round picks URLs, checks robots rules, takes the pages out of the corpus (the join that
stands for fetching), parses them, and feeds the new links back. All state is Parquet in one
folder that rounds only add to (see `state`), so a run survives lost executors and resumes where it was.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.functions import urls
from lingmill.operators import fetch, language, robots
from lingmill.operators import frontier as fr
from lingmill.operators.language import LanguageModel
from lingmill.plans import parse
from lingmill.plans.state import CrawlState
from lingmill.sources import writers
from lingmill.sources.page_store import PageStore
from lingmill.sources.shared import materialize, run_folder


@dataclass(frozen=True)
class CrawlOptions:
    targets: tuple[str, ...] = ()
    filter_for_languages: bool = True
    min_share: float = 0.8
    round_size: int = 1000
    num_rounds: int = -1  # no limit, like 0
    lookahead: int = 10
    user_agent: str = "lingmill/1.0"
    robots_check: bool = True
    seed: int = 0
    #: The time of the first round, and how much later each further one is; robots documents age by it.
    started: datetime = datetime(2020, 1, 1)
    round_time: timedelta = timedelta(hours=1)
    robots_ttl: str = "24 hours"
    #: Rounds whose added URLs are merged into one sorted run.
    merge_every: int = 8
    start_fresh: bool = False
    #: Whether rounds write in which order and with which pauses their URLs may be fetched, and URLs of one step.
    fetch_plan: bool = False
    step_size: int = 250


def _found(corpus: DataFrame | PageStore, wanted: DataFrame) -> DataFrame:
    """(url, html, status) of the wanted URLs that the corpus has, each once; html only for accepted content types."""
    if isinstance(corpus, PageStore):
        found = corpus.lookup(wanted)
    else:
        # an inner join with the small batch filters the corpus in its scan
        found = corpus.join(wanted.select("url"), "url", "left_semi")
    if "headers" in found.columns:
        found = fetch.normalize_headers(found)
        found = found.withColumn("html", F.when(fetch.content_kind(F.col("headers")) == "html", F.col("html")))
    found = found.select("url", "html", F.col("status").cast("int").alias("status"))
    # a URL that the corpus has several times is one page
    first = F.min(F.struct("status", "html")).alias("_first")
    return found.groupBy("url").agg(first).select("url", "_first.html", "_first.status")


def crawl_round(
    state: CrawlState,
    round_no: int,
    corpus: DataFrame | PageStore,
    docs: DataFrame,
    model: LanguageModel,
    options: CrawlOptions,
) -> bool:
    """Run round `round_no` on the state of the round before; False if the frontier was empty.

    `corpus` is (url, html, status), and `headers` where there are any, or a store of such pages, of which only the
    buckets of the batch are read. A URL that it lacks counts as failed (status -1); of a repeated one the row with
    the least status and html counts. `docs` are validated robots documents; with `fetched_at` they are
    versions, and those that are known by the round's time and no older than `robots_ttl` count.
    """
    n = options.round_size
    looked, cursor = state.look(round_no, n * options.lookahead)
    if looked.isEmpty():
        return False
    state.write(fr.frontier_batch(looked, n, options.lookahead), "batch", round_no)
    batch = state.batch(round_no)
    # only the documents of the batch's origins are taken apart
    origins = batch.select(urls.origin(F.col("url")).alias("origin")).distinct()
    docs = docs.join(origins, "origin", "left_semi")
    if "fetched_at" in docs.columns:
        now = options.started + (round_no - 1) * options.round_time
        docs = robots.robots_cache_valid(docs.filter(F.col("fetched_at") <= F.lit(now)), now, options.robots_ttl)
    else:
        # an origin that is there several times is one document
        docs = docs.groupBy("origin").agg(F.min("content").alias("content"))
    # stored, as it is read for what is missing, for the decisions and for the pauses, and `docs` may be a query over many pages
    docs = materialize(docs)
    if options.robots_check:
        state.write(robots.robots_missing(batch, docs), "robots_missing", round_no)
    decided = robots.robots_decide(batch, docs, options.user_agent, options.robots_check)
    # stored, so that the planner knows its size when it picks the join with the corpus
    decided = materialize(decided.select("url", "can_fetch", "batch_pos"))
    if options.fetch_plan:
        # no step has two URLs of a domain; `delay` is the pause that a host asks for, within limits
        steps = fr.polite_batches(decided.filter("can_fetch").select("batch_pos", "url"), options.step_size, order="batch_pos")
        steps = robots.crawl_delay(steps.withColumnRenamed("batch", "step"), docs, options.user_agent)
        state.write(steps, "fetch_plan", round_no)
    found = _found(corpus, decided.filter("can_fetch"))
    fetched = decided.select("url", "can_fetch", "batch_pos").join(found, "url", "left").select(
        "url",
        F.when(F.coalesce("status", F.lit(-1)).between(200, 299), F.col("html")).alias("html"),
        F.when(F.col("can_fetch"), F.coalesce("status", F.lit(-1))).alias("status"),
        "can_fetch",
        "batch_pos",
    )
    state.write(fetched, "pages", round_no)
    pages = state.pages(round_no)

    out = parse.parsed_pages(
        pages.filter("can_fetch"),
        model,
        options.targets,
        min_share=options.min_share,
        enabled=options.filter_for_languages,
    )
    state.write(out, "parsed", round_no)
    parsed = state.parsed(round_no)
    segments = parse.segment_rows(parsed)
    writers.write_segments(segments.withColumn("round", F.lit(round_no)), state.segments)
    state.write(language.domain_language_counter(segments), "domain_languages", round_no)
    # everything picked has left the frontier: done, or forbidden
    n_added = state.add(state.unknown(parse.link_rows(parsed), round_no - 1), round_no, options.seed)
    state.end_round(round_no, cursor, n_added)
    return True


def crawl_rounds(
    seeds: DataFrame,
    corpus: DataFrame | PageStore,
    docs: DataFrame,
    model: LanguageModel,
    options: CrawlOptions,
    folder: str | None = None,
) -> CrawlState:
    """Rounds until the frontier is empty or `num_rounds` are done in all; resumes a given folder, or starts over in it
    with `start_fresh`."""
    spark = seeds.sparkSession
    state = CrawlState(spark, folder or run_folder(spark, "crawl"), fan=options.merge_every)
    if options.start_fresh:
        state.clear()
    done = state.last_round()
    if done is None:
        state.start(seeds, options.seed)
        done = 0
    while options.num_rounds <= 0 or done < options.num_rounds:
        if not crawl_round(state, done + 1, corpus, docs, model, options):
            break
        done += 1
    return state


def crawl_log(state: CrawlState, rounds: Iterable[int]) -> DataFrame:
    """(round, batch_pos, url, status, can_fetch): what each round did."""
    logs = [
        state.pages(r).select(F.lit(r).cast("bigint").alias("round"), "batch_pos", "url", "status", "can_fetch")
        for r in rounds
    ]
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out

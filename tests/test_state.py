"""The crawl's logs against plain sets, what a round writes, merges, and look-ups that read few files."""

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lingmill.operators import frontier as fr
from lingmill.plans import crawl
from lingmill.plans.state import CrawlState
from lingmill.sources import shared
from lingmill.sources.page_store import PageStore
from tests.test_plans import OPTIONS, SITE, corpus_of, docs_of, model  # noqa: F401


def urls_df(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def local(path):
    return path.removeprefix("file:")


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{local(path)}/**/*.parquet", recursive=True))


def one_round(state, round_no, n, links):
    """Look, pick, add: what a crawl round does with the state. `links` gives the links of a batch."""
    looked, cursor = state.look(round_no, n * 3)
    if looked.isEmpty():
        return None
    state.write(fr.frontier_batch(looked, n, 3), "batch", round_no)
    batch = [r["url"] for r in state.batch(round_no).orderBy("batch_pos").collect()]
    added = state.add(state.unknown(shared.materialize(urls_df(state.spark, links(batch))), round_no - 1), round_no)
    state.end_round(round_no, cursor, added)
    return batch


def web(batch):
    out = [b for b in batch]
    for b in batch:
        rng = random.Random(b)
        out += [f"http://h{rng.randrange(9)}.org/{rng.randrange(150)}" for _ in range(6)]
    return out


SEEDS = [f"http://h{i % 3}.org/{i}" for i in range(20)]


def positions(spark, urls, round_no):
    return {r["url"]: r["pos"] for r in fr.frontier_shuffle(urls_df(spark, urls), round_no).collect()} if urls else {}


def test_rounds_against_plain_sets(spark):
    state = CrawlState(spark, shared.run_folder(spark, "state"), bits=2, fan=2)
    state.start(urls_df(spark, SEEDS + SEEDS[:5]))
    waiting, seen = positions(spark, SEEDS, 0), set()
    for r in range(1, 9):
        batch = one_round(state, r, 8, web)
        window = sorted((p, u) for u, p in waiting.items())[:24]
        want = spark.createDataFrame(window, "pos long, url string")
        assert batch == [x["url"] for x in fr.frontier_batch(want, 8, 3).orderBy("batch_pos").collect()]
        known = set(waiting) | seen
        seen |= set(batch)
        new = set(web(batch)) - known
        waiting = {u: p for u, p in waiting.items() if u not in seen} | positions(spark, sorted(new), r)
        assert {x["url"]: x["pos"] for x in state.frontier(r).collect()} == waiting
        assert {x["url"] for x in state.seen(r).collect()} == seen
        assert sorted(x["url"] for x in state.known(r).collect()) == sorted(set(waiting) | seen)
    # rounds 0 to 7 went up to the third level; round 8 waits for another one
    assert [tuple(x) for x in state.progress(8)["runs"]] == [(3, 0, 7)]
    # runs that went into others are gone
    assert not glob.glob(f"{local(state.folder)}/known/level=1/rounds=0-1")


def test_merging_changes_nothing(spark):
    logs = []
    for fan in (2, 100):
        state = CrawlState(spark, shared.run_folder(spark, "state"), bits=3, fan=fan)
        state.start(urls_df(spark, SEEDS))
        logs.append([one_round(state, r, 5, web) for r in range(1, 5)])
        logs.append(sorted(state.frontier(4).collect()))
    assert logs[0] == logs[2] and logs[1] == logs[3]


def test_a_round_writes_what_it_did_not_the_frontier(spark):
    state = CrawlState(spark, shared.run_folder(spark, "state"), fan=100)
    big = spark.range(300_000).select(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".org/"), "id").alias("url"))
    state.start(big)
    frontier = size(state.path("added", 0))
    assert frontier > 3_000_000
    for r in (1, 2, 3):
        batch = one_round(state, r, 20, web)
        assert len(batch) == 20
        written = sum(size(state.path(t, r)) for t in ("looked", "batch", "added", "progress"))
        assert written < 0.02 * frontier
    assert state.frontier(3).count() == 300_000 - 60 + sum(state._read("url string", state.path("added", r)).count() for r in (1, 2, 3))


def test_looks_at_a_range_of_a_large_table(spark, monkeypatch):
    from lingmill.plans import state as module

    monkeypatch.setattr(module, "_NARROW", 100)
    state = CrawlState(spark, shared.run_folder(spark, "state"))
    urls = [f"http://h{i}.org/" for i in range(3000)]
    state.start(urls_df(spark, urls))
    order = sorted((p, u) for u, p in positions(spark, urls, 0).items())
    at = 0
    for r in range(1, 4):
        looked, cursor = state.look(r, 40)
        assert sorted(tuple(x) for x in looked.collect()) == order[at : at + 40]
        state.write(fr.frontier_batch(looked, 40, 1), "batch", r)
        state.end_round(r, cursor, state.add(urls_df(spark, []), r))
        at += 40


def test_empty_seeds_and_fresh_start(spark, model):  # noqa: F811
    folder = shared.run_folder(spark, "fresh")
    args = (corpus_of(spark), docs_of(spark), model)
    none = crawl.crawl_rounds(urls_df(spark, []), *args, crawl.CrawlOptions(**OPTIONS), folder)
    assert none.last_round() == 0 and none.frontier(0).isEmpty()
    again = crawl.crawl_rounds(urls_df(spark, ["http://s.org/2"]), *args, crawl.CrawlOptions(num_rounds=1, start_fresh=True, **OPTIONS), folder)
    assert [r["url"] for r in again.pages(1).collect()] == ["http://s.org/2"]


def scanned_files(df):
    """Files that the scans of an executed plan opened."""
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numFiles").value()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.fixture(scope="module")
def store(spark):
    pages = spark.range(20_000).select(
        F.concat(F.lit("http://h.org/"), "id").alias("url"), F.concat(F.lit("<p>"), "id").alias("html"), F.lit(200).alias("status")
    )
    worse = spark.createDataFrame([("http://h.org/7", "<p>later", 404), (None, "x", 200)], "url string, html string, status int")
    return PageStore.create(pages.unionByName(worse), shared.run_folder(spark, "store"), bits=9)


def test_a_batch_reads_the_files_of_its_buckets(spark, store):
    assert len(glob.glob(f"{local(store.folder)}/bucket=*")) == 512
    batch = shared.materialize(urls_df(spark, [f"http://h.org/{i * 7}" for i in range(60)] + ["http://h.org/7", "http://no.org/", None]))
    found = store.lookup(batch)
    rows = found.collect()
    assert sorted(r["url"] for r in rows) == sorted(f"http://h.org/{i * 7}" for i in range(60))
    assert {r["html"] for r in rows if r["url"] == "http://h.org/7"} == {"<p>7"}
    # one file for each bucket that the batch falls into, and the batch itself
    buckets = batch.filter("url is not null").selectExpr("shiftrightunsigned(xxhash64(url), 55) as b").distinct().count()
    assert buckets <= scanned_files(found) <= buckets + 16 < 100
    assert store.pages().count() == 20_000
    assert store.lookup(urls_df(spark, [])).collect() == []


def test_crawl_from_a_store_is_the_same(spark, model):  # noqa: F811
    seeds = urls_df(spark, ["http://s.org/0"])
    pages = corpus_of(spark).unionByName(corpus_of(spark))  # repeated pages are one
    kept = PageStore.create(pages, shared.run_folder(spark, "store"), bits=2)
    logs = []
    for corpus in (corpus_of(spark), pages, kept):
        state = crawl.crawl_rounds(seeds, corpus, docs_of(spark).unionByName(docs_of(spark)), model, crawl.CrawlOptions(merge_every=2, **OPTIONS))
        logs.append(sorted(crawl.crawl_log(state, range(1, state.last_round() + 1)).collect()))
    assert logs[0] == logs[1] == logs[2] and len(logs[0]) == 6


def test_content_type_and_age_of_documents(spark, model):  # noqa: F811
    day = datetime(2024, 5, 1)
    kinds = {"http://s.org/1": "application/pdf", "http://s.org/2": "Text/HTML; charset=utf-8"}
    corpus = spark.createDataFrame(
        [(u, h, 200, {"Content-Type": kinds.get(u, "text/html")}) for u, h in SITE.items()], "url string, html string, status int, headers map<string,string>"
    )
    docs = spark.createDataFrame(
        [("http://s.org", "User-agent: *\nDisallow: /", day - timedelta(hours=30)), ("http://s.org", "User-agent: *\nDisallow: /secret/", day - timedelta(hours=22)),
         ("http://s.org", "User-agent: *\nDisallow: /", day + timedelta(hours=9))],
        "origin string, content string, fetched_at timestamp",
    )
    options = dict(started=day, round_time=timedelta(hours=1), **OPTIONS)
    state = crawl.crawl_rounds(urls_df(spark, ["http://s.org/0"]), corpus, docs, model, crawl.CrawlOptions(**options))
    log = {r["url"]: (r["round"], r["status"], r["can_fetch"]) for r in crawl.crawl_log(state, range(1, state.last_round() + 1)).collect()}
    # the pdf is fetched but has no html, so its links are not found
    assert log["http://s.org/1"] == (2, 200, True) and "http://s.org/3" not in log and "http://s.org/secret/9" not in log
    assert log["http://s.org/4"] == (3, 200, True)
    missing = [state.spark.read.parquet(state.path("robots_missing", r)).count() for r in (1, 2, 3)]
    assert missing == [0, 0, 1]  # in the third round the document is 24 hours old

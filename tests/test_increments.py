"""The corpus round by round, versions of robots documents, very many rules, bad rows, counts from footers."""

import bisect
import json
import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lingmill.operators import dataset as ds
from lingmill.operators import ranking, robots, seeds
from lingmill.plans import dataset
from lingmill.sources import readers, shared, writers
from tests.test_state import scanned_files, size

ROW = "text string, language string, script string"


def corpus_rows(spark, texts):
    return spark.createDataFrame([(t, "kin" if t is None or len(t) % 2 else None, "Latn") for t in texts], ROW)


def test_rounds_merge_to_the_full_build(spark):
    rng = random.Random(2)
    rounds = [[f"Line {rng.randrange(300)}. Two" for _ in range(200)] + ["", "all have it"] for _ in range(4)]
    folder = shared.run_folder(spark, "merge")
    added = [dataset.merge_round(spark, corpus_rows(spark, texts), folder, n, bits=3) for n, texts in enumerate(rounds)]
    everything = corpus_rows(spark, [t for texts in rounds for t in texts])
    want = sorted(map(str, ds.dataset_dedup(everything).collect()))
    assert sorted(map(str, dataset.merged_corpus(spark, folder).collect())) == want and sum(added) == len(want)
    stats = ds.corpus_stats(ds.dataset_dedup(everything))
    assert sorted(map(str, dataset.merged_stats(spark, folder).collect())) == sorted(map(str, stats.collect()))
    # the same round again adds nothing
    assert dataset.merge_round(spark, everything, folder, 3) == 0


def test_a_dead_round_counts_for_nothing(spark):
    folder = shared.run_folder(spark, "merge")
    assert dataset.merged_corpus(spark, folder).count() == 0 and dataset.merged_stats(spark, folder).count() == 0
    dataset.merge_round(spark, corpus_rows(spark, ["a", "bb"]), folder, 1)
    corpus_rows(spark, ["half"]).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{folder}/lines/round=2")
    assert sorted(r["text"] for r in dataset.merged_corpus(spark, folder).collect()) == ["a", "bb"]
    assert dataset.merge_round(spark, corpus_rows(spark, ["half", "a", "c"]), folder, 2) == 2
    assert sorted(r["text"] for r in dataset.merged_corpus(spark, folder).collect()) == ["a", "bb", "c", "half"]


def test_a_round_reads_and_writes_its_own_buckets(spark):
    folder = shared.run_folder(spark, "merge")
    big = spark.range(50_000).select(F.concat(F.lit("line "), "id").alias("text"), F.lit("kin").alias("language"), F.lit("Latn").alias("script"))
    dataset.merge_round(spark, big, folder, 1, bits=8)
    assert dataset.merge_round(spark, corpus_rows(spark, ["one", "two 22", "line 7"]).withColumn("language", F.lit("kin")), folder, 2) == 2
    assert size(f"{folder}/lines/round=2") < 0.02 * size(f"{folder}/lines/round=1")
    few = dataset._lines(spark, folder, [1]).filter(F.col("bucket").isin([3, 5, 9]))
    few.collect()
    assert scanned_files(few) == 3


def test_a_round_is_not_stored_beside_the_corpus(spark):
    folder, top = shared.run_folder(spark, "merge"), shared.shared_dir(spark).removeprefix("file:")
    texts = ["a", "bb", None, "bb", "ccc", None]
    assert dataset.merge_round(spark, corpus_rows(spark, texts[:2]), folder, 1, bits=2) == 2
    before = set(os.listdir(top))
    # the lines of a round, its copies and the stored lines meet in one grouping; a table of the round's lines between is written in vain
    assert dataset.merge_round(spark, corpus_rows(spark, texts), folder, 2) == 2
    assert set(os.listdir(top)) == before
    assert sorted(str(r["text"]) for r in dataset.merged_corpus(spark, folder).collect()) == ["None", "a", "bb", "ccc"]


def test_a_fetch_sees_the_last_version_of_a_day(spark):
    rng = random.Random(6)
    start = datetime(2024, 3, 30)
    at = lambda: start + timedelta(minutes=rng.randrange(6000))
    docs = [(f"http://h{rng.randrange(4)}.org", at()) for _ in range(40)] + [("http://h1.org", None)]
    fetches = [(f"http://h{rng.randrange(5)}.org/{i}", at(), i) for i in range(300)]
    fetches += [("http://h0.org/x", t, 1) for o, t in docs[:9] if t]  # at the very time
    got = robots.robots_as_of(
        spark.createDataFrame(fetches, "url string, fetch_time timestamp, n int"), spark.createDataFrame(docs + docs[:5], "origin string, fetched_at timestamp")
    )
    assert got.columns == ["url", "fetch_time", "n", "doc_time"]
    rows = sorted((r["url"], r["fetch_time"], r["n"], r["doc_time"]) for r in got.collect() if r["doc_time"])
    want = []
    for url, t, n in fetches:
        held = [d for o, d in docs if d and url.startswith(o + "/") and t - timedelta(hours=24) < d <= t]
        if held:
            want.append((url, t, n, max(held)))
    assert got.count() == len(fetches) and rows == sorted(want)


def test_versions_of_a_hot_origin_are_not_listed_per_fetch(spark):
    rng = random.Random(8)
    start = datetime(2024, 3, 30)
    at = lambda: start + timedelta(seconds=rng.randrange(90_000))
    versions = sorted(at() for _ in range(2000))
    docs = [("http://hot.org", t) for t in versions[:1000] + versions[:50]] + [("http://hot.org", None), (None, start)]
    fetches = [("http://hot.org/x", rng.choice([at(), versions[7], None])) for _ in range(2000)] + [(None, start), ("http://cold.org/", start)]
    fetches += [("http://hot.org/late", versions[999] + timedelta(hours=h)) for h in (23, 24)]
    got = robots.robots_as_of(
        spark.createDataFrame(fetches, "url string, fetch_time timestamp"), spark.createDataFrame(docs, "origin string, fetched_at timestamp")
    )
    held = lambda u, t: bisect.bisect_right(versions, t, hi=1000) if t and (u or "").startswith("http://hot") else 0
    want = [(u, t, versions[i - 1] if (i := held(u, t)) and versions[i - 1] > t - timedelta(hours=24) else None) for u, t in fetches]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    # a list that each fetch goes through makes the work a product of fetches and versions
    plan = got._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan and "lambda" not in plan


def test_running_max_over_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, None, rng.randrange(1000)])) for i in range(3000)]
    table = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    got = {r["at"]: r["top"] for r in ranking.running_max(table, ["k"], ["at"], "v", "top", ranges=7).collect()}
    tops = {}
    for k, i, v in rows:
        tops[k] = max((x for x in (tops.get(k), v) if x is not None), default=None)
        # groups must not be NULL to be carried from range to range
        assert k is None or got[i] == tops[k]
    assert len(got) == 3000


def test_very_many_rules(spark):
    rng = random.Random(9)
    rules = "\n".join(f"{rng.choice(['Allow', 'Disallow'])}: /{rng.randrange(400)}/{rng.randrange(90)}" for _ in range(20_000))
    docs = [("http://hot.org", f"User-agent: *\n{rules}"), ("http://b.org", "User-agent: *\nDisallow: /a\nAllow: /\nDisallow:"), ("http://c.org", None)]
    docs += [(f"http://h{i}.org", "User-agent: lingmill\nDisallow: /%41\nAllow: /x?") for i in range(9)]
    pages = [f"http://hot.org/{rng.randrange(400)}/{rng.randrange(200)}" for _ in range(1000)]
    pages += [f"http://{rng.choice(['b', 'c', 'd', 'h1', 'h2', 'h7'])}.org/{rng.choice(['a', 'A', 'x', 'x?y', ''])}{i % 7}" for i in range(2000)]
    table = spark.createDataFrame(docs, "origin string, content string")
    asked = spark.createDataFrame([(u, i) for i, u in enumerate(pages)], "url string, id int")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    got = robots.robots_decide_by_prefix(asked, table, "lingmill/1.0")
    assert rows(got) == rows(robots.robots_decide(asked, table, "lingmill/1.0"))
    assert got.columns == ["url", "id", "can_fetch", "reason"]


def test_bad_rows_are_set_aside(spark, tmp_path):
    page = dict(url="http://a", status=200, html="<p>")
    lines = [page, page | {"status": 301}, page | {"url": ""}, page | {"html": ""}, {"url": "http://b"}, page | {"error": "timeout", "status": None}]
    (tmp_path / "raw.json").write_text("\n".join([*map(json.dumps, lines), "{cut", ""]))
    checked = readers.checked_pages(spark, str(tmp_path / "raw.json"))
    counts = {r["problem"]: r["n"] for r in readers.problem_counts(checked).collect()}
    kinds = ["none", "status not accepted", "no url", "no html", "no status", "fetch failed", "broken line"]
    assert counts == dict.fromkeys(kinds, 1)
    writers.write_set_aside(checked, f"{tmp_path}/aside")
    back = spark.read.schema("line string, problem string").json(f"{tmp_path}/aside")
    assert {r["problem"]: r["line"] for r in back.collect()} == {k: "{cut" if k == "broken line" else None for k in kinds[1:]}


def test_rows_are_counted_in_footers(spark):
    folder = shared.run_folder(spark, "rows")
    spark.range(1000).withColumn("part", F.col("id") % 3).write.partitionBy("part").parquet(folder)
    counted = readers.parquet_rows(spark, folder)
    assert counted.first()["n"] == 1000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    # other reads are planned as before
    assert "FileScan parquet" in spark.read.parquet(folder)._jdf.queryExecution().executedPlan().toString()


def test_index_reads_the_folders_it_needs(spark):
    rows = [(f"http://{c}{s}{la}.org/{i}", f"{la}.org", la, c, s) for c in "ab" for s in "xyz" for la in ("eng", "kin", "hau", None) for i in range(5)]
    folder = shared.run_folder(spark, "index")
    writers.write_index(spark.createDataFrame(rows, "url string, url_host_registered_domain string, content_languages string, crawl string, subset string"), folder)
    table = spark.createDataFrame([("kinyarwanda", "kin", "Latn"), ("none", "", "Latn")], "language string, iso6393 string, iso15924 string")
    found = seeds.index_of_languages(readers.stored_index(spark, folder), table, subset="y", crawl="b")
    assert {(r["url"][7:12], r["lang_script"]) for r in found.collect()} == {("bykin", "kin_Latn")} and found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(subset" in plan
    # of the four folders of crawl and subset the table's one language chooses one while the query runs; its own file is the other
    assert scanned_files(found) == 2

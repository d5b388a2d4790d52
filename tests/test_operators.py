"""Operators on small rows, against brute force in plain Python."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from lingmill.operators import dataset as ds
from lingmill.operators import fetch, language, ranking, robots, samples
from lingmill.operators import frontier as fr
from lingmill.operators import seeds as sd
from lingmill.sources import schemas


def frontier_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), schemas.FRONTIER)


@pytest.mark.parametrize(
    "urls, n, picked",
    [
        # the host with most URLs comes first, then turns are taken
        ("b/1 c/1 c/2 d/1 c/3 b/2", 1, "c/1"),
        ("b/1 c/1 c/2 d/1 c/3 b/2", 4, "c/1 b/1 d/1 c/2"),
        ("b/1 c/1 c/2 d/1 c/3 b/2", 50, "c/1 b/1 d/1 c/2 b/2 c/3"),
        # equal hosts: the one seen first
        ("z/1 y/1 x/1", 2, "z/1 y/1"),
        # one hot host, fewer hosts than places
        ("h/1 h/2 h/3 h/4", 3, "h/1 h/2 h/3"),
    ],
)
def test_frontier_batch(spark, urls, n, picked):
    frontier = frontier_of(spark, [f"http://{u}" for u in urls.split()])
    rows = fr.frontier_batch(frontier, n).orderBy("batch_pos").collect()
    assert [r.url.removeprefix("http://") for r in rows] == picked.split()
    assert [r.batch_pos for r in rows] == list(range(1, len(rows) + 1))


def test_frontier_batch_looks_ahead_so_far_and_no_further(spark):
    urls = [f"http://hot/{i}" for i in range(6)] + ["http://far/1"]
    near = fr.frontier_batch(frontier_of(spark, urls), 2, lookahead=3).orderBy("batch_pos").collect()
    far = fr.frontier_batch(frontier_of(spark, urls), 2, lookahead=4).orderBy("batch_pos").collect()
    assert [r.url for r in near] == ["http://hot/0", "http://hot/1"]
    assert [r.url for r in far] == ["http://hot/0", "http://far/1"]


def test_empty_frontier(spark):
    empty = spark.createDataFrame([], schemas.FRONTIER)
    assert fr.frontier_batch(empty, 5).count() == 0
    assert fr.polite_batches(empty).count() == 0


def test_polite_batches_by_hand(spark):
    urls = ["http://a/1", "http://www.a/2", "http://b/1", "http://c/1", "http://a/3", "http://c/2"]
    rows = fr.polite_batches(frontier_of(spark, urls), 2).collect()
    got = defaultdict(set)
    for r in rows:
        got[r.batch].add(r.url)
    # first turn a b c, second turn a c, third turn a; no more than two to a batch
    assert [got[k] for k in sorted(got)] == [
        {"http://a/1", "http://b/1"}, {"http://c/1"}, {"http://www.a/2", "http://c/2"}, {"http://a/3"}
    ]


@pytest.mark.parametrize("size, ranges", [(1, 7), (5, 7), (3, None), (250, 16)])
def test_polite_batches(spark, size, ranges):
    """A third of the URLs are of one domain; many ranges cut it into pieces."""
    rng = random.Random(size)
    urls = []
    for i in range(120):
        host = "hot.org" if rng.random() < 0.34 else f"{rng.choice(['', 'www.'])}h{rng.randint(0, 12)}.org"
        urls.append(f"https://{host}/{i}")
    rows = fr.polite_batches(frontier_of(spark, urls), size, ranges=ranges).collect()
    assert sorted(r.url for r in rows) == sorted(urls)
    assert {r.batch for r in rows} == set(range(max(r.batch for r in rows) + 1))
    got = defaultdict(list)
    for r in rows:
        got[r.batch].append(r.domain)
    assert all(len(d) <= size and len(set(d)) == len(d) for d in got.values())
    # a domain's URLs keep their order
    for domain in {r.domain for r in rows}:
        own = sorted((r for r in rows if r.domain == domain), key=lambda r: r.pos)
        assert [r.batch for r in own] == sorted(r.batch for r in own)


def test_row_rank_chunks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), i * 3) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, o bigint")
    got = {(r.k, r.o): r.r for r in ranking.row_rank(df, ["k"], "o", "r", ranges=10).collect()}
    seen = Counter()
    for k, o in sorted(rows, key=lambda x: x[1]):
        assert got[k, o] == seen[k]
        seen[k] += 1


def test_ranges_split_a_hot_host_of_a_shuffled_frontier(spark):
    """Positions of a shuffled frontier lie far apart; the largest group of a window stays near its share."""
    urls = spark.range(6000).select(
        F.concat(F.lit("http://"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")), F.lit("/"), "id").alias("url")
    )
    frontier = fr.frontier_shuffle(urls).withColumn("host", F.split("url", "/")[2])
    cut = ranking.in_ranges(frontier, ["host"], "pos", 20)
    assert cut.groupBy("host", "_chunk").count().agg(F.max("count")).first()[0] < 1000
    ranked = ranking.row_rank(frontier, ["host"], "pos", "r", 20).filter("host = 'hot'").orderBy("pos").collect()
    assert [r.r for r in ranked] == list(range(2000))


def test_samples_of_a_large_number(spark):
    lines = spark.range(9000).select(
        F.when(F.col("id") % 9 == 0, "small").otherwise("hot").alias("language"), F.concat(F.lit("f"), F.col("id") % 7).alias("file"),
        F.col("id").alias("line_id"), F.concat(F.lit("line "), "id").alias("line"),
    )
    got = samples.language_samples(lines, n=5000, max_files=7, min_files=1).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.language].append(r.slot)
    assert sorted(slots["hot"]) == list(range(1, 5001)) and sorted(slots["small"]) == list(range(1, 1001))
    assert len({r["sample"] for r in got}) == 6000


def test_frontier_update(spark):
    frontier = frontier_of(spark, ["http://a/1", "http://a/2", "http://b/1"])
    seen = spark.createDataFrame([("http://a/0",), ("http://a/2",)], schemas.SEEN)
    done = spark.createDataFrame([("http://a/1",), ("http://a/2",)], schemas.SEEN)
    links = spark.createDataFrame([(u,) for u in ["http://a/1", "http://b/1", "http://c/1", "http://c/1", "http://a/0"]], schemas.SEEN)
    after, seen_after = fr.frontier_update(frontier, seen, done, links, 1)
    rows = after.orderBy("pos").collect()
    assert [r.url for r in rows] == ["http://b/1", "http://c/1"]
    assert rows[1].pos >= 1 << fr.POS_BITS
    assert sorted(r.url for r in seen_after.collect()) == ["http://a/0", "http://a/1", "http://a/2"]


def random_robots(rng):
    lines = []
    for _ in range(rng.randint(0, 14)):
        lines.append(
            rng.choice(
                [
                    lambda: "User-agent: " + rng.choice(["*", "lingmill", "LING", "other", "mill/2", ""]),
                    lambda: rng.choice(["Disallow", "allow", "DISALLOW "]) + ": " + rng.choice(["/", "", "/a", "/a/b", "*", "/a*", "/%61/", "/a?x", "/a?", "/é", "/%C3%A9", "//a", "/a;"]),
                    lambda: "Crawl-delay: " + rng.choice(["5", "x", "0", "60", "1.5"]),
                    lambda: "Request-rate: 1/5",
                    lambda: "",
                    lambda: "   ",
                    lambda: "# note",
                    lambda: "Sitemap: /x",
                    lambda: "junk",
                    lambda: "Disallow: /b # tail",
                ]
            )()
        )
    return "\n".join(lines)


def test_robots_like_the_standard_library(spark):
    rng = random.Random(5)
    docs = {f"http://h{i}.org": random_robots(rng) for i in range(300)}
    paths = ["", "/", "/a", "/a/b/c", "/b", "/a?x=1", "/%61/z", "/é/x", "/a;", "//a"]
    doc_df = spark.createDataFrame([(o, 200, "text/plain", c) for o, c in docs.items()], "origin string, status int, content_type string, content string")
    urls = spark.createDataFrame([(o + p,) for o in docs for p in paths], "url string")
    valid = robots.robots_validate(doc_df)
    for agent in ("lingmill/1.0", "nobody"):
        got = {r.url: r.can_fetch for r in robots.robots_decide(urls, valid, agent).collect()}
        delays = {r.url: r.robots_delay for r in robots.crawl_delay(urls, valid, agent).collect()}
        for o, content in docs.items():
            parser = RobotFileParser()
            parser.parse(content.splitlines())
            for p in paths:
                assert got[o + p] == parser.can_fetch(agent, o + p), (agent, p, content)
            assert delays[o] == parser.crawl_delay(agent), content


def test_robots_missing_document_and_switch(spark):
    urls = spark.createDataFrame([("http://x.org/a",), ("http://y.org/a",)], "url string")
    docs = spark.createDataFrame(
        [("http://x.org", 200, "text/html", "User-agent: *\nDisallow: /")], "origin string, status int, content_type string, content string"
    )
    rows = robots.robots_decide(urls, robots.robots_validate(docs), "a").collect()
    assert all(r.can_fetch and r.reason.startswith("no usable robots document") for r in rows)
    raw = {r.url: r.can_fetch for r in robots.robots_decide(urls, docs, "a").collect()}
    assert raw == {"http://x.org/a": False, "http://y.org/a": True}
    assert all(r.can_fetch for r in robots.robots_decide(urls, docs, "a", enabled=False).collect())


def test_crawl_delay_bounds(spark):
    docs = spark.createDataFrame(
        [(f"http://d{d}.org", f"User-agent: *\nCrawl-delay: {d}") for d in (0, 5, 60)], "origin string, content string"
    )
    urls = spark.createDataFrame([(f"http://d{d}.org/",) for d in (0, 5, 60, 7)], "url string")
    got = {r.url: r.delay for r in robots.crawl_delay(urls, docs, "a").collect()}
    assert got == {"http://d0.org/": 1, "http://d5.org/": 5, "http://d60.org/": 10, "http://d7.org/": 1}


def test_robots_cache(spark):
    now = datetime(2025, 1, 2, 12)
    rows = [("a", "old", datetime(2025, 1, 1, 12)), ("b", "1", datetime(2025, 1, 2, 1)), ("b", "2", datetime(2025, 1, 2, 2))]
    docs = spark.createDataFrame(rows, "origin string, content string, fetched_at timestamp")
    assert [tuple(r)[:2] for r in robots.robots_cache_valid(docs, now).collect()] == [("b", "2")]


def test_language_share_edges(spark):
    rows = [("four_of_five", x) for x in ["k", "k", "k", "k", "z"]]
    rows += [("seven_of_nine", x) for x in ["k"] * 7 + ["z"] * 2] + [("none", "z")]
    df = spark.createDataFrame(rows, "page string, language string")
    for targets in (["k"], "k, k", ["k", "q"]):
        kept = language.page_language_filter(df, "page", targets)
        assert Counter(r.page for r in kept.collect()) == {"four_of_five": 4}
    assert language.page_language_filter(df, "page", "k", enabled=False).count() == 11


def test_lid_without_known_trigram(spark):
    train = spark.createDataFrame([("aa", "hello there hello"), ("bb", "guten tag und auf wiedersehen")], "lang string, line string")
    model = language.lid_train(train, "line", "lang")
    lines = spark.createDataFrame([(1, "hello"), (2, "wieder"), (3, "中文中文"), (4, "")], "id int, line string")
    got = {r.id: r.language for r in language.lid_predict(lines, ["id"], "line", model).collect()}
    assert got == {1: "aa", 2: "bb", 3: model.fallback, 4: model.fallback}
    assert model.fallback == "aa"  # fewer trigrams, so an unseen one is likelier


def test_trigrams_of_wide_characters(spark):
    df = spark.createDataFrame([("a\U0001f600b",)], "t string")
    assert df.select(language.trigrams(F.col("t"))).first()[0] == [" a\U0001f600", "a\U0001f600b", "\U0001f600b "]


def test_trigrams_by_stretches(spark):
    texts = ["", "a", "ab", "\U0001f600b", "two words", "line\nend", " ", None, "É" * 3000] + ["xyz Äb" * 20 + "q" * i for i in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {}
    exploded = language.exploded_trigrams(df, "t", "id")
    for r in exploded.collect():
        got.setdefault(r["id"], []).append(r["trigram"])
    want = {r["id"]: r["a"] for r in df.select("id", language.trigrams(F.col("t")).alias("a")).collect() if texts[r["id"]]}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    # lists are made once per row, not once more to see whether they are empty
    plan = exploded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("sequence(") == 1


def test_fetch_edges(spark):
    rows = [
        ("a", 200, {"Content-Type": "TEXT/html; x"}, "x", None),
        ("b", 299, {"content-type": "text/plain"}, "x", None),
        ("c", 300, {"content-type": "text/html"}, "x", None),
        ("d", None, None, None, "timeout"),
        ("e", 200, {"X": "y"}, "x", None),
        ("f", 200, {}, "", None),
    ]
    # names that differ in case only: the last one holds
    both = F.expr("map('Content-Type', 'text/plain', 'content-type', 'text/html')")
    pages = spark.createDataFrame(rows, schemas.RAW_PAGE)
    pages = pages.withColumn("headers", F.when(F.col("url") == "f", both).otherwise(F.col("headers")))
    got = {r.url: r for r in fetch.fetch_results(pages).collect()}
    assert {u for u, r in got.items() if r.html is not None} == {"a", "f"}
    assert got["a"].headers == {"content-type": "text/html; x"}
    assert got["f"].headers == {"content-type": "text/html"}
    assert {r.url for r in fetch.parseable(pages).collect()} == {"a", "b", "c", "e"}


def test_samples(spark):
    rows = [(lang, f"f{i % files}", i, f"{lang}{i}") for lang, files, n in (("x", 5, 400), ("y", 4, 50), ("z", 6, 12)) for i in range(n)]
    lines = spark.createDataFrame(rows, "language string, file string, line_id bigint, line string")
    plain = samples.language_samples(lines, n=100).collect()
    assert Counter(r.language for r in plain) == {"x": 100, "z": 6}
    assert len({r.sample for r in plain}) == 106
    assert all(int(r.sample[1:]) % {"x": 5, "z": 6}[r.language] < 3 for r in plain)
    again = samples.language_samples(lines, n=100).collect()
    assert sorted(plain) == sorted(again)
    drawn = samples.language_samples(lines, n=100, replace=True).collect()
    assert Counter(r.language for r in drawn) == {"x": 100, "z": 100}
    assert {r.sample for r in drawn if r.language == "z"} <= {r.sample for r in plain if r.language == "z"}
    assert 1 < len({r.sample for r in drawn if r.language == "x"}) < 100


def test_seeds(spark):
    index = spark.createDataFrame(
        [(1, "u1", "d1", "hau"), (2, "u1", "d1", "mos"), (3, "u2", "d1", "mos"), (4, "u3", "d2", "zzz")],
        "row_id bigint, url string, url_host_registered_domain string, content_languages string",
    )
    from lingmill.sources.readers import language_table

    table = language_table(spark)
    assert table.count() == 34  # one code is listed under two names
    assert sorted(map(tuple, sd.seed_urls(index, table, "row_id").collect())) == [("hau_Arab", "u1"), ("mos_Latn", "u2")]
    assert [tuple(r) for r in sd.unmapped_languages(index, table).collect()] == [("zzz", 1)]
    assert [tuple(r) for r in sd.domains_per_language(index, "row_id").collect()] == [("hau", 1), ("zzz", 1)]


def test_report(spark):
    stats = spark.createDataFrame(
        [("b", "Latn", 1, 2, 3), ("a", "Latn", 4, 5, 6)], "language string, script string, words bigint, characters bigint, sentences bigint"
    )
    report = ds.report_text(ds.stats_report(stats)).first().report
    assert report == (
        "language: a\nscript: Latn\nwords: 4\ncharacters: 5\nsentences: 6\n-----\n"
        "language: b\nscript: Latn\nwords: 1\ncharacters: 2\nsentences: 3"
    )


@pytest.mark.parametrize("n", [1, 7, 60, 500])
def test_pick_in_ranges_is_the_same(spark, n):
    rng = random.Random(n)
    hosts = [f"h{int(rng.paretovariate(0.7)) % 40}.org" for _ in range(900)]
    # positions over all bits, some of them equal
    rows = [(rng.choice([rng.randrange(1 << 62), 5 << 48, (5 << 48) + 1]), f"http://{h}/{i}") for i, h in enumerate(hosts)]
    table = spark.createDataFrame(rows, schemas.FRONTIER)
    want = sorted(map(tuple, fr.frontier_batch(table, n, 3).collect()))
    assert sorted(map(tuple, fr.frontier_batch_in_ranges(table, n, 3, ranges=5).collect())) == want and want[0][0] == 1
    first = sorted(rows)[: 3 * n]
    assert sorted(map(tuple, fr.first_rows(table, 3 * n).collect())) == first


@pytest.mark.parametrize("n_languages", [3, 8, 9, 3000])
def test_language_model_of_many_labels(spark, n_languages):
    rng = random.Random(n_languages)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:04d}": rng.sample(letters, 5) for i in range(n_languages)}
    say = lambda label: "".join(rng.choices(own[label], k=12))
    taught = [(label, say(label)) for label in own for _ in range(3)] + [(None, "nothing is known")]
    asked = [(i, say(rng.choice(list(own)))) for i in range(60)] + [(60, "ÄÖÜ"), (61, ""), (62, None)]
    model = language.lid_train(spark.createDataFrame(taught, "label string, line string"), "line", "label")
    lines = spark.createDataFrame(asked, "id int, line string")
    got = {r["id"]: r["language"] for r in language.lid_predict(lines, ["id"], "line", model).collect()}

    grams = lambda s: [f" {s.lower()} "[k : k + 3] for k in range(len(s))]
    counts = {}
    for label, line in taught[:-1]:
        for g in grams(line):
            counts.setdefault(label, Counter())[g] += 1
    v = len({g for c in counts.values() for g in c})
    log = lambda n, c: round(math.log(n / (sum(c.values()) + v)) * 1000000)
    for i, line in asked:
        scores = {label: sum(log(c[g] + 1, c) for g in grams(line or "")) for label, c in counts.items()}
        known = [g for g in grams(line or "") if any(g in c for c in counts.values())]
        best = max(scores.values()) if known else None
        want = sorted(label for label, s in scores.items() if s == best) if known else [model.fallback]
        assert got[i] in want and (got[i] == want[0] or len(want) > 1)

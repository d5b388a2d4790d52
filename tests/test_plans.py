"""Files, whole jobs, resume and streams on small rows."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from lingmill.operators import language
from lingmill.operators import links as lk
from lingmill.operators import warc
from lingmill.plans import crawl, dataset, parse
from lingmill.sources import readers, schemas, shared, writers
from lingmill.streaming import rounds

LINE = "This is a line of text, and it is long enough to stay in number {}."
OTHER = "Dies hier ist eine Zeile, und auch sie ist lang genug, Nummer {}."


@pytest.fixture(scope="module")
def model(spark):
    rows = [("eng_Latn", LINE.format(i)) for i in range(20)] + [("deu_Latn", OTHER.format(i)) for i in range(20)]
    return language.lid_train(spark.createDataFrame(rows, "label string, line string"), "line", "label")


def page(n, links, head="", other=0):
    text = "".join(f"<p>{LINE.format(n * 10 + i)}</p>" for i in range(4))
    text += "".join(f"<p>{OTHER.format(n * 10 + i)}</p>" for i in range(other))
    return f"<html><head>{head}</head><body>{text}" + "".join(f"<a href='{x}'>x</a>" for x in links) + "</body></html>"


SITE = {
    "http://s.org/0": page(0, ["1", "/2", "http://else.org/", "0#top"]),
    "http://s.org/1": page(1, ["3", "/secret/9"], other=1),  # share is 0.8: kept
    "http://s.org/2": page(2, ["4"], other=2),  # share is below: links only
    "http://s.org/3": page(3, ["/0"], head='<meta name="robots" content="noindex">'),
    "http://s.org/4": page(4, ["/5"], head='<meta name="robots" content="nofollow">'),
    "http://s.org/secret/9": page(9, []),
}


def corpus_of(spark):
    return spark.createDataFrame([(u, h, 200) for u, h in SITE.items()], "url string, html string, status int")


def docs_of(spark):
    return spark.createDataFrame([("http://s.org", "User-agent: *\nDisallow: /secret/")], "origin string, content string")


OPTIONS = dict(targets=("eng_Latn",), round_size=10)


def test_crawl_to_the_end(spark, model):
    seeds = spark.createDataFrame([("http://s.org/0",)], schemas.SEEN)
    state = crawl.crawl_rounds(seeds, corpus_of(spark), docs_of(spark), model, crawl.CrawlOptions(**OPTIONS))
    last = state.last_round()
    log = {r.url: (r.round, r.status, r.can_fetch) for r in crawl.crawl_log(state, range(1, last + 1)).collect()}
    assert log == {
        "http://s.org/0": (1, 200, True),
        "http://s.org/1": (2, 200, True),
        "http://s.org/2": (2, 200, True),
        "http://s.org/3": (3, 200, True),
        "http://s.org/4": (3, 200, True),
        "http://s.org/secret/9": (3, None, False),
    }
    assert state.frontier(last).isEmpty()
    assert sorted(r.url for r in state.seen(last).collect()) == sorted(log)
    parsed = {r.url: r for k in range(1, last + 1) for r in state.parsed(k).collect()}
    assert len(parsed["http://s.org/0"].segments) == 4
    assert len(parsed["http://s.org/1"].segments) == 4 and len(parsed["http://s.org/2"].segments) == 0
    assert len(parsed["http://s.org/3"].segments) == 0 and len(parsed["http://s.org/4"].segments) == 4


def test_resume_gives_the_same(spark, model):
    seeds = spark.createDataFrame([("http://s.org/0",)], schemas.SEEN)
    folder = shared.run_folder(spark, "resume")
    args = (seeds, corpus_of(spark), docs_of(spark), model)
    crawl.crawl_rounds(*args, crawl.CrawlOptions(num_rounds=1, **OPTIONS), folder)
    state = crawl.CrawlState(spark, folder)
    # a second round that died half-way: its seen URLs must not count
    state.write(spark.createDataFrame([("http://s.org/1",)], schemas.SEEN), "seen", 2)
    assert state.last_round() == 1
    crawl.crawl_rounds(*args, crawl.CrawlOptions(num_rounds=2, **OPTIONS), folder)
    lines = [r.text for k in (1, 2) for r in parse.segment_rows(state.parsed(k)).collect()]
    # a round that runs again replaces its text
    crawl.crawl_round(state, 2, *args[1:], crawl.CrawlOptions(num_rounds=2, **OPTIONS))
    stored = readers.round_segments(spark, state.segments)
    assert sorted(r.text for r in stored.collect()) == sorted(lines) != []
    stats = dataset.build_from_rounds(spark, state.segments, f"{folder}/out", "eng_Latn").collect()
    assert [(r.language, r.script) for r in stats] == [("eng", "Latn")]
    texts = [r.text for r in readers.dataset(spark, f"{folder}/out/dataset").collect()]
    assert sorted(texts) == sorted(set(lines))
    assert state.last_round() == 2
    assert {r.url for r in state.pages(2).collect()} == {"http://s.org/1", "http://s.org/2"}


def test_parse_round_and_files(spark, model, tmp_path):
    out = parse.parse_round(corpus_of(spark), model, "eng_Latn")
    assert out.new_urls.count() == 6
    assert {(r.host, r.language) for r in out.domain_languages.collect()} == {("s.org", "eng_Latn")}
    writers.write_json_lines(out.parsed, f"{tmp_path}/eng_Latn/parsed")
    back = readers.parsed_pages(spark, str(tmp_path))
    assert {r.label for r in back.select("label").collect()} == {"eng_Latn"}
    assert sorted(back.select("url", "parsed_urls").collect()) == sorted(out.parsed.select("url", "parsed_urls").collect())
    writers.write_segments(out.segments.withColumn("round", F.lit(1)), f"{tmp_path}/text")
    files = glob.glob(f"{tmp_path}/text/round=1/language=eng_Latn/*.txt")
    assert sum(len(open(f).read().splitlines()) for f in files) == out.segments.count()


def test_broken_json_is_dropped(spark, tmp_path):
    with gzip.open(tmp_path / "1.json.gz", "wt") as f:
        f.write('{"url": "a", "status": 200, "html": "x"}\nnot json\n{"url": "b", "status": -1, "error": "e"}\n')
    assert {r.url for r in readers.raw_pages(spark, str(tmp_path)).collect()} == {"a", "b"}


def test_dataset_job(spark, tmp_path):
    for label, lines in {"kin_Latn": ["One. Two", "One. Two", "  ", "last"], "amh_Ethi": ["x"], "hau_Latn": ["y"]}.items():
        os.makedirs(tmp_path / "in" / label / "textual_outputs")
        with open(tmp_path / "in" / label / "textual_outputs" / "00001.txt", "w") as f:
            f.write("\n".join(lines))  # the last line has no line end
    stats = dataset.build_dataset(spark, f"{tmp_path}/in", f"{tmp_path}/out", "kin_Latn, amh_Ethi", max_rows=2)
    rows = {r.language: r for r in stats.collect()}
    assert set(rows) == {"kin", "amh"}
    assert (rows["kin"].sentences, rows["kin"].words, rows["kin"].characters) == (3, 3, 11)
    back = readers.dataset(spark, f"{tmp_path}/out/dataset", ["kin_Latn"])
    assert sorted(r.text for r in back.collect()) == ["  ", "One. Two", "last"]
    assert "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString()
    files = glob.glob(f"{tmp_path}/out/dataset/language=kin/script=Latn/*.parquet")
    assert len(files) >= 2 and all("zstd" in f for f in files)
    assert glob.glob(f"{tmp_path}/out/stats.csv/*.csv")


def test_lists_and_samples(spark, tmp_path):
    urls = spark.createDataFrame([("kin_Latn", "http://a"), ("kin_Latn", " http://b "), ("hau_Latn", "  ")], "lang_script string, url string")
    writers.write_urls_by_label(urls, f"{tmp_path}/seeds")
    back = readers.url_list(spark, f"{tmp_path}/seeds/lang_script=kin_Latn")
    assert sorted(r.url for r in back.collect()) == ["http://a", "http://b"]
    assert readers.url_list(spark, f"{tmp_path}/seeds/lang_script=hau_Latn").count() == 0
    assert [r.url for r in readers.url_list(spark, seed_url=" http://x ").collect()] == ["http://x"]
    writers.write_samples(spark.createDataFrame([('a "b", c', "kin")], "sample string, language string"), f"{tmp_path}/samples")
    row = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/samples").first()
    assert tuple(row) == ('a "b", c', "kin")


def test_warc_bytes(spark, tmp_path):
    pages = spark.createDataFrame([("http://a/é", {"x": "y"}, "<p>é</p>"), ("http://b", None, None)], "url string, headers map<string,string>, html string")
    records = warc.warc_records(pages, "2025-01-01T00:00:00Z")
    head, _, block = records.first().record.partition("\r\n\r\n")
    assert block == "HTTP/1.0 200 OK\r\nx: y\r\n\r\n<p>é</p>"
    assert f"Content-Length: {len(block.encode())}" in head
    import base64
    import hashlib

    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    assert f"WARC-Payload-Digest: sha1:{digest}" in head
    writers.write_warc(records, f"{tmp_path}/warc")
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_path}/warc/part-*"))
    assert data.startswith(b"WARC/1.0\r\n") and data.endswith(b"</p>\r\n\r\n")
    assert [r.target_uri for r in readers.warc_target_uris(spark, f"{tmp_path}/warc").collect()] == ["http://a/é"]


def test_streams_over_two_arrivals(spark, model, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    rows = [(u, 200, None, h, None) for u, h in SITE.items()]
    for part in (rows[:3], rows[3:] + rows[:1]):
        writers.write_json_lines(spark.createDataFrame(part, schemas.RAW_PAGE), raw, mode="append")
        stream = rounds.raw_page_stream(spark, raw)
        rounds.stream_parse(stream, model, "eng_Latn", out, f"{tmp_path}/c1").awaitTermination()
        rounds.stream_seen_urls(lk.page_links(rounds.raw_page_stream(spark, raw)), f"{tmp_path}/urls", f"{tmp_path}/c2").awaitTermination()
    parsed = rounds.read_parsed(spark, out)
    # a page that came in both batches is parsed in both, in folders of their own
    assert parsed.select("url").distinct().count() == 6
    assert parsed.count() == 7
    seen = [r.url for r in spark.read.schema(schemas.SEEN).parquet(f"{tmp_path}/urls").collect()]
    assert len(seen) == len(set(seen)) == 7


def test_stream_rounds_commit_all_outputs_together(spark, model, tmp_path, monkeypatch):
    raw, out, checkpoint = f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/c"
    rows = [(u, 200, None, h, None) for u, h in SITE.items()]

    def arrive(part):
        writers.write_json_lines(spark.createDataFrame(part, schemas.RAW_PAGE), raw, mode="append")

    def run():
        rounds.stream_rounds(rounds.raw_page_stream(spark, raw), model, "eng_Latn", out, checkpoint).awaitTermination()

    def urls_of(table, column="url"):
        return sorted(r[column] for r in rounds.read_committed(spark, out, table).select(column).collect())

    assert all(urls_of(t) == [] for t in ("parsed", "segments", "links"))
    arrive(rows[:3])
    run()
    first = urls_of("parsed")
    assert first == sorted(u for u, *_ in rows[:3])
    # the second batch dies between its outputs: nothing of it is there
    arrive(rows[3:] + rows[:1])

    def dies(segments):
        raise RuntimeError("lost")

    monkeypatch.setattr(rounds, "domain_language_counter", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    assert urls_of("parsed") == first and set(urls_of("links", "page")) <= set(first)
    monkeypatch.undo()
    run()
    # six pages in two arrivals, one of them in both, are six rows
    assert urls_of("parsed") == sorted(SITE)
    parsed = rounds.read_committed(spark, out, "parsed")
    want = sorted((r.url, r.segment_no, r.text, r.language) for r in parse.segment_rows(parsed).collect())
    got = rounds.read_committed(spark, out, "segments").select("url", "segment_no", "text", "language").collect()
    assert sorted(map(tuple, got)) == want != []
    assert [tuple(r) for r in rounds.read_committed(spark, out, "domain_languages").groupBy("host").agg(F.sum("n")).collect()] == [("s.org", len(want))]


def test_shared_folder_comes_from_the_session():
    class Session:
        """Only the settings of a session; nothing else may be asked."""

        conf = {"spark.checkpoint.dir": "/shared/place/"}

    assert shared.shared_dir(Session()) == "/shared/place"


def test_a_round_works_its_robots_documents_out_once(spark, model):
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    docs = docs_of(spark)
    n = docs.count()
    docs = docs.withColumn("content", F.udf(counted, "string")("content"))
    options = crawl.CrawlOptions(**(OPTIONS | {"num_rounds": 1, "fetch_plan": True}))
    crawl.crawl_rounds(spark.createDataFrame([(u,) for u in SITE], "url string"), corpus_of(spark), docs, model, options)
    # read for the documents that are missing, for the decisions and for the pauses
    assert 0 < seen.value <= n

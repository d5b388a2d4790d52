"""Files and streams: written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.language import model
from catalogue.pages import PARSED_SEGMENTS, TARGETS
from catalogue.registry import query
from lingmill.operators import fetch, warc
from lingmill.operators import links as lk
from lingmill.plans import parse
from lingmill.sources import readers, writers
from lingmill.sources.shared import materialize, run_folder
from lingmill.streaming import rounds

DATE = "2024-01-31T00:00:00Z"


@query("SELECT url, CAST(status AS BIGINT) AS status, error, length(html) AS n_chars FROM x_raw")
def src_pages(spark, sf):
    folder = run_folder(spark, "raw")
    writers.write_json_lines(src.raw_pages(spark, sf), folder)
    pages = readers.raw_pages(spark, folder)
    return pages.select(
        "url", F.col("status").cast("bigint"), "error", F.length("html").cast("bigint").alias("n_chars")
    )


@query(
    """
SELECT CASE WHEN page_id % 7 = 3 THEN 'broken line' WHEN page_id % 7 = 5 THEN 'no url' WHEN r.error IS NOT NULL THEN 'fetch failed'
  WHEN r.status IS NULL THEN 'no status' WHEN r.status NOT BETWEEN 200 AND 300 THEN 'status not accepted'
  WHEN coalesce(r.html, '') = '' THEN 'no html' ELSE 'none' END AS problem, count(*) AS n
FROM pages JOIN x_raw r USING (url) GROUP BY 1
"""
)
def page_problems(spark, sf):
    """Lines of which one in seven is cut off and one has no URL; those with a problem are set aside and read back."""
    folder = run_folder(spark, "lines")
    ids = src.table(spark, sf, "pages").select("page_id", "url")
    raw = src.raw_pages(spark, sf).join(ids, "url").withColumn("url", F.when(F.col("page_id") % 7 != 5, F.col("url")))
    line = F.to_json(F.struct("url", "status", "headers", "html", "error"))
    cut = F.when(F.col("page_id") % 7 == 3, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    raw.select(cut.alias("value")).write.text(f"{folder}/raw")
    checked = readers.checked_pages(spark, f"{folder}/raw")
    writers.write_set_aside(checked, f"{folder}/aside")
    aside = spark.read.schema("url STRING, problem STRING").json(f"{folder}/aside")
    good = checked.filter("problem is null")
    return readers.problem_counts(aside.select("problem").unionByName(good.select("problem")))


@query("SELECT url FROM pages")
def seed_urls(spark, sf):
    folder = run_folder(spark, "seeds")
    padded = src.pages(spark, sf).select(F.concat(F.lit("  "), F.col("url"), F.lit("\t\n ")).alias("url"))
    writers.write_url_list(padded, folder, compress=True)
    return readers.url_list(spark, folder)


@query(
    f"""
SELECT label, count(*) AS n FROM (
  SELECT CASE regexp_extract(html, '<html lang="([a-z]+)"', 1) WHEN 'de' THEN 'deu_Latn' WHEN 'en' THEN 'eng_Latn'
         WHEN 'es' THEN 'spa_Latn' WHEN 'fr' THEN 'fra_Latn' END AS label FROM pages) GROUP BY label
"""
)
def parsed_urls_by_lang(spark, sf):
    """Parsed pages in one folder per language, listed as URLs per language."""
    from lingmill.functions import tags

    folder = run_folder(spark, "outputs")
    parsed = src.pages(spark, sf).select(
        "url",
        src.corpus_label(tags.html_lang(F.col("html"))).alias("label"),
        F.array().cast("array<struct<text:string,language:string>>").alias("segments"),
        lk.link_array(F.col("url"), F.col("html")).alias("parsed_urls"),
    )
    writers.write_parsed_by_label(parsed, folder)
    crawled = readers.parsed_pages_by_label(spark, folder).select("label", "url")
    writers.write_urls_by_label(crawled, f"{folder}-urls", label="label")
    listed = spark.read.schema("value STRING, label STRING").text(f"{folder}-urls")
    return listed.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT text, language, script, count(*) AS n FROM x_corpus GROUP BY ALL")
def segments_from_files(spark, sf):
    """Text folders per language, language and script read back from the folder names."""
    folder = run_folder(spark, "text")
    writers.write_text_by_label(src.corpus_rows(spark, sf), folder)
    found = readers.text_by_label(spark, folder)
    return found.groupBy("text", "language", "script").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""
SELECT coalesce(CASE regexp_extract(html, '<html lang="([a-z]+)"', 1) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in src.LABELS.items())} END, 'und_Zyyy') AS label,
  url, coalesce(l.n, 0) AS links
FROM pages LEFT JOIN (SELECT page AS url, count(*) AS n FROM x_plain_links GROUP BY page) l USING (url)
"""
)
def parsed_folders(spark, sf):
    """Parsed pages below `<label>/parsed/`, one folder for each label that the pages have, read back with the label of the folder."""
    from lingmill.functions import tags

    folder = run_folder(spark, "outputs")
    label = F.coalesce(src.corpus_label(tags.html_lang(F.col("html"))), F.lit("und_Zyyy"))
    parsed = materialize(src.pages(spark, sf).select("url", label.alias("label"), lk.link_array(F.col("url"), F.col("html")).alias("parsed_urls")))
    for row in parsed.select("label").distinct().collect():
        writers.write_json_lines(parsed.filter(F.col("label") == row["label"]).drop("label"), f"{folder}/{row['label']}/parsed")
    found = readers.parsed_pages(spark, folder)
    return found.select("label", "url", F.coalesce(F.size("parsed_urls"), F.lit(0)).cast("bigint").alias("links"))


@query(
    """
SELECT text, coalesce(language, 'und') AS language, coalesce(script, 'Zyyy') AS script, count(*) AS n FROM x_corpus GROUP BY ALL
"""
)
def segment_folders(spark, sf):
    """Text below `<language>_<script>/textual_outputs/`, one folder for each label there is, labels read from the folders."""
    folder = run_folder(spark, "text")
    rows = src.corpus_rows(spark, sf)
    label = F.concat_ws("_", F.coalesce("language", F.lit("und")), F.coalesce("script", F.lit("Zyyy")))
    rows = materialize(rows.select("text", label.alias("label")))
    for row in rows.select("label").distinct().collect():
        rows.filter(F.col("label") == row["label"]).select("text").write.text(f"{folder}/{row['label']}/textual_outputs")
    found = readers.segment_files(spark, folder)
    return found.groupBy("text", "language", "script").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT line AS text, doc_id % 3 AS round, {src.SQL_LABEL} AS label, count(*) AS n FROM x_lines GROUP BY ALL")
def round_segment_files(spark, sf):
    """Lines as the text of three rounds, the first of them written twice."""
    folder = run_folder(spark, "segments")
    rows = src.doc_lines(spark, sf).select(
        (F.col("doc_id") % 3).cast("int").alias("round"), src.corpus_label(F.col("lang")).alias("language"), F.col("line").alias("text")
    )
    writers.write_segments(rows, folder)
    writers.write_segments(rows.filter("round = 0"), folder)
    found = readers.round_segments(spark, folder)
    return found.groupBy("text", F.col("round").cast("bigint").alias("round"), "label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang AS iso6393, min(source) AS language, 'Latn' AS iso15924 FROM documents GROUP BY lang")
def language_table(spark, sf):
    """A language table with several names for a code, as CSV; each code and script is there once."""
    folder = run_folder(spark, "languages")
    docs = src.table(spark, sf, "documents")
    names = docs.select(F.col("source").alias("language"), F.col("lang").alias("iso6393"), F.lit("Latn").alias("iso15924"))
    names.distinct().write.option("header", True).csv(folder)
    return readers.language_table(spark, folder)


_RECORD = r"""
SELECT url AS target_uri, 'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Record-ID: <urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4)
  || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>' || e || 'WARC-Target-URI: ' || url || e
  || 'WARC-Date: DATE' || e || 'WARC-Payload-Digest: sha1:' || digest || e || 'Content-Type: application/http; msgtype=response' || e
  || 'Content-Length: ' || strlen(block) || e || e || block AS record
FROM (SELECT url, e, digest, block, md5(url || chr(10) || 'DATE' || chr(10) || digest) AS h FROM (
  SELECT url, e, 'HTTP/1.0 200 OK' || e || 'content-type: ' || lower(content_type) || e || 'server: ' || lower(server) || e || e || html AS block,
    translate(to_base(CAST('0x' || substr(s, 1, 10) AS BIGINT), 32, 8) || to_base(CAST('0x' || substr(s, 11, 10) AS BIGINT), 32, 8)
      || to_base(CAST('0x' || substr(s, 21, 10) AS BIGINT), 32, 8) || to_base(CAST('0x' || substr(s, 31, 10) AS BIGINT), 32, 8),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest
  FROM (SELECT url, html, content_type, server, status, chr(13) || chr(10) AS e, sha1(html) AS s FROM x_raw)
  WHERE status >= 200 AND status < 300 AND starts_with(lower(content_type), 'text/html')))
""".replace("DATE", DATE)


def _warc(spark, sf):
    return warc.warc_records(fetch.fetch_results(src.raw_pages(spark, sf)), DATE)


@query(_RECORD)
def warc_records(spark, sf):
    return _warc(spark, sf)


@query("SELECT url AS target_uri FROM x_raw WHERE status >= 200 AND status < 300 AND starts_with(lower(content_type), 'text/html')")
def warc_target_uris(spark, sf):
    folder = run_folder(spark, "warc")
    writers.write_warc(_warc(spark, sf), folder)
    return readers.warc_target_uris(spark, folder)


@query("SELECT url, segments, parsed_urls FROM x_parsed")
def stream_parse(spark, sf):
    """Raw-page files taken in by a stream, parsed batch by batch."""
    folder = run_folder(spark, "stream")
    raw = src.pages(spark, sf).withColumn("status", F.lit(200))
    writers.write_json_lines(raw, f"{folder}/raw")
    stream = rounds.raw_page_stream(spark, f"{folder}/raw")
    rounds.stream_parse(stream, model(spark, sf), TARGETS, folder, f"{folder}/checkpoint").awaitTermination()
    return rounds.read_parsed(spark, folder).select(
        "url",
        F.size("segments").cast("bigint").alias("segments"),
        F.size("parsed_urls").cast("bigint").alias("parsed_urls"),
    )


@query("SELECT DISTINCT url FROM x_plain_links")
def stream_seen_urls(spark, sf):
    """Links of streamed pages, each URL the first time only."""
    folder = run_folder(spark, "seen")
    writers.write_json_lines(src.pages(spark, sf), f"{folder}/raw")
    links = lk.page_links(rounds.raw_page_stream(spark, f"{folder}/raw"))
    rounds.stream_seen_urls(links, f"{folder}/urls", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema("url STRING").parquet(f"{folder}/urls")


def _stream_rounds(spark, sf, table):
    """Pages that arrive twice: as they are, and once more in a second arrival."""
    folder = run_folder(spark, "stream")
    raw = src.pages(spark, sf).withColumn("status", F.lit(200))
    for _ in range(2):
        writers.write_json_lines(raw, f"{folder}/raw", mode="append")
        stream = rounds.raw_page_stream(spark, f"{folder}/raw")
        rounds.stream_rounds(stream, model(spark, sf), TARGETS, folder, f"{folder}/checkpoint").awaitTermination()
    return rounds.read_committed(spark, folder, table)


@query(PARSED_SEGMENTS)
def stream_round_segments(spark, sf):
    return _stream_rounds(spark, sf, "segments").withColumn("segment_no", F.col("segment_no").cast("bigint"))


@query("SELECT page, url FROM x_plain_links")
def stream_round_links(spark, sf):
    return _stream_rounds(spark, sf, "links")

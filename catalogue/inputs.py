"""Inputs that the given tables do not hold as such, derived from them by Spark.

Each has a twin among the SQL parts (`x_...`), made by the same rules. All are whole-table:
what differs from row to row is decided by what the URL or text looks like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import part
from lingmill.functions import tags, urls
from lingmill.operators import lines as ln
from lingmill.operators import links as lk


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    # these two come as files of one row group, which Spark cannot split: dealing out the columns that a query
    # needs gives all cores work. Only the catalogue does so; no operator of the library depends on it.
    key = {"documents": "doc_id", "pages": "page_id"}.get(name)
    return df.repartition(key) if key else df


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("url", "html")


# --- fetched pages: status and headers by the look of the URL --------------------------------

def _like(pattern: str):
    return F.col("url").like(pattern)


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    status = (
        F.when(_like("%spam-farm%"), 404)
        .when(_like("%cheap-pills%"), F.lit(None))
        .when(_like("%/"), 301)
        .when(_like("%utm_source%"), 300)
        .when(_like("%.html"), 204)
        .otherwise(200)
        .cast("int")
    )
    kind = (
        F.when(_like("%#top"), "Text/HTML; charset=UTF-8")
        .when(_like("%page=2%"), "application/PDF")
        .otherwise("text/html")
    )
    server = F.concat(F.lit("Host "), F.upper(urls.netloc(F.col("url"))))
    headers = F.when(
        _like("http://www.%"), F.create_map(F.lit("Server"), server)
    ).otherwise(F.create_map(F.lit("Server"), server, F.lit("Content-Type"), kind))
    error = F.when(_like("%cheap-pills%"), F.concat(F.lit("timeout at "), F.col("url")))
    return pages(spark, sf).select("url", status.alias("status"), headers.alias("headers"), "html", error.alias("error"))


part(
    "x_raw",
    r"""
SELECT url, html,
  CASE WHEN url LIKE '%spam-farm%' THEN 404 WHEN url LIKE '%cheap-pills%' THEN NULL
       WHEN url LIKE '%/' THEN 301 WHEN url LIKE '%utm\_source%' ESCAPE '\' THEN 300
       WHEN url LIKE '%.html' THEN 204 ELSE 200 END AS status,
  CASE WHEN url LIKE 'http://www.%' THEN NULL
       WHEN url LIKE '%#top' THEN 'Text/HTML; charset=UTF-8'
       WHEN url LIKE '%page=2%' THEN 'application/PDF' ELSE 'text/html' END AS content_type,
  'Host ' || upper(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) AS server,
  CASE WHEN url LIKE '%cheap-pills%' THEN 'timeout at ' || url END AS error
FROM pages
""",
)


# --- pages with head tags, relative links and links to leave out -----------------------------

def tagged_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with robots meta and base tags put in by the look of the URL."""
    meta = (
        F.when(_like("%.html"), '<META content="NOINDEX" name="robots">')
        .when(_like("%/"), "<meta name='robots' content='noindex, NoFollow'><meta name=robots content=all>")
        .when(_like("%?%"), "<!-- <meta name=\"robots\" content=\"noindex\"> --><meta name=robots content=nofollow>")
        .when(_like("%#top"), '<meta name="robots" content="NOARCHIVE,NOCACHE">')
        .otherwise("")
    )
    base = (
        F.when(_like("http://%"), '<base target="_top"><base href="/sub/dir/x">')
        .when(_like("https://m.%"), '<base href="http://other.example.org/q/">')
        .otherwise("")
    )
    page = F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head>"), meta, base))
    # links of some pages become relative, others get links of every kind beside them
    html = (
        F.when(_like("%#top"), F.replace(page, F.lit('<a href="/'), F.lit('<a class="a>b" href="../')))
        .when(_like("%page=2%"), F.replace(page, F.lit("</nav>"), F.lit(_EXTRA_LINKS + "</nav>")))
        .otherwise(page)
    )
    return pages(spark, sf).select("url", html.alias("html"))


# Fixed text: links of every kind that the rules tell apart.
_EXTRA_LINKS = (
    "<a href='#'>1</a><a href='#x'>2</a><a href='./'>3</a><a href=''>4</a><a>5</a>"
    "<a href='mailto:a@example.org'>6</a><a href='//other.example.com/z'>7</a>"
    "<A HREF=/up/down/../side#frag>8</A><a href='?q=1&amp;r=2'>9</a><a href='/twice/'>10</a>"
    "<a href='/twice'>11</a><!-- <a href='/hidden'>12</a> --><script>'<a href=\"/no\">'</script>"
)

part(
    "x_tagged",
    f"""
SELECT url,
  CASE WHEN url LIKE '%#top' THEN replace(h, '<a href="/', '<a class="a>b" href="../')
       WHEN url LIKE '%page=2%' THEN replace(h, '</nav>', {"'" + _EXTRA_LINKS.replace("'", "''") + "</nav>'"})
       ELSE h END AS html
FROM (
  SELECT url, replace(html, '<head>', '<head>' ||
    CASE WHEN url LIKE '%.html' THEN '<META content="NOINDEX" name="robots">'
         WHEN url LIKE '%/' THEN '<meta name=''robots'' content=''noindex, NoFollow''><meta name=robots content=all>'
         WHEN url LIKE '%?%' THEN '<!-- <meta name="robots" content="noindex"> --><meta name=robots content=nofollow>'
         WHEN url LIKE '%#top' THEN '<meta name="robots" content="NOARCHIVE,NOCACHE">' ELSE '' END ||
    CASE WHEN url LIKE 'http://%' THEN '<base target="_top"><base href="/sub/dir/x">'
         WHEN url LIKE 'https://m.%' THEN '<base href="http://other.example.org/q/">' ELSE '' END) AS h
  FROM pages)
""",
)


# --- lines of documents ----------------------------------------------------------------------

def doc_lines(spark: SparkSession, sf: str, **rules) -> DataFrame:
    """Clean lines of all documents: doc_id, lang, source, line_no, line."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return ln.clean_lines(docs, "text", **rules)


SQL_WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"regexp_replace({x}, '{SQL_WS}+', ' ', 'g')"


def sql_lower_n(x: str) -> str:
    return f"length(regexp_replace({x}, '[^a-oq-z]+', '', 'g')) + length(regexp_replace({x}, '[^b]+', '', 'g'))"


def sql_upper_n(x: str) -> str:
    return f"length(regexp_replace({x}, '[^A-OQ-Z]+', '', 'g')) + length(regexp_replace({x}, '[^B]+', '', 'g'))"


def sql_keep(x: str) -> str:
    return (
        f"length({x}) >= 50 AND right({x}, 3) <> '...' "
        f"AND ({sql_lower_n(x)}) * 100 <= length({x}) * 95 AND ({sql_upper_n(x)}) * 5 <= length({x})"
    )


part(
    "x_stripped",
    f"""
SELECT doc_id, lang, source, n, {sql_strip("raw")} AS s
FROM (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS raw,
             generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
WHERE {sql_strip("raw")} <> ''
""",
)
part(
    "x_lines",
    f"""
SELECT doc_id, lang, source, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS line_no, line
FROM (SELECT doc_id, lang, source, min(n) AS n, line
      FROM (SELECT doc_id, lang, source, n, {sql_collapse("s")} AS line FROM x_stripped WHERE {sql_keep("s")})
      GROUP BY ALL)
""",
)

# Corpus labels of the languages in the `lang` column.
LABELS = {"de": "deu_Latn", "en": "eng_Latn", "es": "spa_Latn", "fr": "fra_Latn"}


def corpus_label(lang):
    label = F.lit(None).cast("string")
    for code, name in LABELS.items():
        label = F.when(lang == code, name).otherwise(label)
    return label


SQL_LABEL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " END"


def corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(text, language, script): all clean lines, copies kept."""
    label = F.split(corpus_label(F.col("lang")), "_")
    return doc_lines(spark, sf).select(
        F.col("line").alias("text"), label[0].alias("language"), label[1].alias("script")
    )


part(
    "x_corpus",
    f"""
SELECT line AS text, split_part(label, '_', 1) AS language, split_part(label, '_', 2) AS script
FROM (SELECT line, {SQL_LABEL} AS label FROM x_lines)
""",
)
part("x_dataset", "SELECT DISTINCT text, language, script FROM x_corpus")


# --- crawl index -----------------------------------------------------------------------------

# ISO 639-3 codes of the page languages.
ISO = {"de": "deu", "en": "eng", "es": "spa", "fr": "fra"}
# A language table without Spanish, and with one code twice.
INDEX_LANGUAGES = [
    ("english", "eng", "Latn"),
    ("german", "deu", "Latn"),
    ("french", "fra", "Latn"),
    ("français", "fra", "Latn"),
]


def index_rows(spark: SparkSession, sf: str) -> DataFrame:
    lang = tags.html_lang(F.col("html"))
    code = F.lit(None).cast("string")
    for short, iso in ISO.items():
        code = F.when(lang == short, iso).otherwise(code)
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("row_id"),
        "url",
        urls.registered_domain(F.col("url")).alias("url_host_registered_domain"),
        code.alias("content_languages"),
    )


def index_copies(spark: SparkSession, sf: str) -> DataFrame:
    """The index with every URL cut at `?` and `#`, so that URLs repeat."""
    return index_rows(spark, sf).withColumn("url", F.regexp_replace("url", "[^/]*$", ""))


part(
    "x_index",
    r"""
SELECT page_id AS row_id, url,
  regexp_extract(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '([^.]+\.[^.]+)$', 1) AS url_host_registered_domain,
  CASE regexp_extract(html, '<html lang="([a-z]+)"', 1)
    WHEN 'de' THEN 'deu' WHEN 'en' THEN 'eng' WHEN 'es' THEN 'spa' WHEN 'fr' THEN 'fra' END AS content_languages
FROM pages
""",
)
part(
    "x_index_copies",
    "SELECT row_id, regexp_replace(url, '[^/]*$', '') AS url, url_host_registered_domain, content_languages FROM x_index",
)


# --- frontier and seen set -------------------------------------------------------------------

def frontier(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), "url")


def seen(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier crawl took: pages with a query, and all links of pages over plain http."""
    done = pages(spark, sf).filter(F.contains("url", F.lit("?"))).select("url")
    linked = lk.page_links(pages(spark, sf).filter(F.startswith("url", F.lit("http://"))))
    return done.unionByName(linked.select("url")).distinct()


part(
    "x_plain_links",
    r"""
SELECT DISTINCT page, url FROM (
  SELECT url AS page,
    regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || regexp_replace(unnest(regexp_extract_all(html, '<a href="([^"#]*)', 1)), '/$', '') AS url
  FROM pages)
""",
)
part(
    "x_seen",
    """
SELECT url FROM pages WHERE contains(url, '?')
UNION SELECT url FROM x_plain_links WHERE starts_with(page, 'http://')
""",
)


# --- robots documents ------------------------------------------------------------------------

def robots_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One robots document per origin of the pages, written from what the origin holds."""
    section = F.regexp_extract("url", "^[a-z]+://[^/]*/([a-z]+)/", 1)
    origins = (
        table(spark, sf, "pages")
        .select(urls.origin(F.col("url")).alias("origin"), section.alias("section"))
        .groupBy("origin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("section").alias("low"), F.max("section").alias("high"))
    )
    host = F.regexp_replace("origin", "^[a-z]+://", "")
    agent = F.when(F.startswith(host, F.lit("blog.")), "User-agent: LingMill\nUser-agent: friend").otherwise(
        "User-Agent : *  # all"
    )
    rules = (
        F.when(F.startswith(host, F.lit("m.")), "Disallow:")
        .when(
            F.startswith(host, F.lit("www.")),
            F.concat(F.lit("Allow: /%65n/1\nDisallow: /%65n/\nDisallow: /"), F.col("high"), F.lit("?")),
        )
        .otherwise(F.concat(F.lit("Disallow: /"), F.col("high"), F.lit("/\nAllow: /"), F.col("low"), F.lit("/")))
    )
    content = F.concat(
        F.lit("# rules of "), host, F.lit("\nUser-agent: otherbot\nDisallow: /\n\n"),
        agent, F.lit("\nSitemap: /map.xml\n"), rules,
        F.lit("\n# note\nCrawl-delay: "), F.col("n").cast("string"),
        F.lit("\n\nDisallow: /dead\nUser-agent: gone\n\nUser-agent: *\nDisallow: /de/\nCrawl-Delay: x\n"),
    )
    return origins.select(
        "origin",
        F.when(F.contains(host, F.lit("cheap-pills")), 404).otherwise(200).alias("status"),
        F.when(F.contains(host, F.lit("spam-farm")), "text/html").otherwise("Text/Plain; charset=utf-8").alias("content_type"),
        content.alias("content"),
    )


part(
    "x_robots_docs",
    r"""
SELECT origin,
  CASE WHEN contains(host, 'cheap-pills') THEN 404 ELSE 200 END AS status,
  CASE WHEN contains(host, 'spam-farm') THEN 'text/html' ELSE 'Text/Plain; charset=utf-8' END AS content_type,
  '# rules of ' || host || chr(10) || 'User-agent: otherbot' || chr(10) || 'Disallow: /' || chr(10) || chr(10)
  || CASE WHEN starts_with(host, 'blog.') THEN 'User-agent: LingMill' || chr(10) || 'User-agent: friend' ELSE 'User-Agent : *  # all' END
  || chr(10) || 'Sitemap: /map.xml' || chr(10)
  || CASE WHEN starts_with(host, 'm.') THEN 'Disallow:'
          WHEN starts_with(host, 'www.') THEN 'Allow: /%65n/1' || chr(10) || 'Disallow: /%65n/' || chr(10) || 'Disallow: /' || high || '?'
          ELSE 'Disallow: /' || high || '/' || chr(10) || 'Allow: /' || low || '/' END
  || chr(10) || '# note' || chr(10) || 'Crawl-delay: ' || n || chr(10) || chr(10)
  || 'Disallow: /dead' || chr(10) || 'User-agent: gone' || chr(10) || chr(10)
  || 'User-agent: *' || chr(10) || 'Disallow: /de/' || chr(10) || 'Crawl-Delay: x' || chr(10) AS content
FROM (SELECT origin, regexp_replace(origin, '^[a-z]+://', '') AS host, count(*) AS n, min(section) AS low, max(section) AS high
      FROM (SELECT regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin,
                   regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)/', 1) AS section FROM pages)
      GROUP BY origin)
""",
)
part(
    "x_robots_valid",
    """
SELECT origin, status, content_type,
  CASE WHEN status = 200 AND contains(lower(content_type), 'text/plain') THEN content END AS content
FROM x_robots_docs
""",
)

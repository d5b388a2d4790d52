"""Language model and language filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import part, query
from lingmill.operators import language as lg
from lingmill.sources.shared import materialize

part(
    "x_counts",
    """
SELECT lang AS language, t AS trigram, count(*) AS n
FROM (SELECT lang, substr(s, unnest(range(1, length(s) - 1)), 3) AS t
      FROM (SELECT lang, ' ' || lower(line) || ' ' AS s FROM x_lines))
GROUP BY ALL
""",
)
part(
    "x_totals",
    """
SELECT language, total, v, CAST(round(ln(CAST(1 AS DOUBLE) / (total + v)) * 1000000) AS BIGINT) AS unseen
FROM (SELECT language, sum(n) AS total, (SELECT count(DISTINCT trigram) FROM x_counts) AS v FROM x_counts GROUP BY language)
""",
)
part(
    "x_model",
    """
SELECT language, trigram, n, CAST(round(ln(CAST(n + 1 AS DOUBLE) / (total + v)) * 1000000) AS BIGINT) AS score, unseen
FROM x_counts JOIN x_totals USING (language)
""",
)


def sql_best_label(keys: str, lines: str) -> str:
    """Best label per line of `lines` (keys..., line)."""
    return f"""
SELECT {keys}, arg_max(language, (score, -r)) AS language
FROM (
  SELECT {keys}, language, r, k * unseen + coalesce(gain, 0) AS score
  FROM (SELECT {keys}, length(line) AS k, language, unseen, row_number() OVER (PARTITION BY {keys} ORDER BY language) AS r
        FROM {lines}, x_totals)
  LEFT JOIN (
    SELECT {keys}, language, sum(score - unseen) AS gain
    FROM (SELECT {keys}, substr(s, unnest(range(1, length(s) - 1)), 3) AS trigram
          FROM (SELECT {keys}, ' ' || lower(line) || ' ' AS s FROM {lines}))
    JOIN x_model USING (trigram) GROUP BY ALL) USING ({keys}, language))
GROUP BY {keys}
"""


def model(spark, sf):
    """Trained on all clean lines of all documents."""
    return lg.lid_train(src.doc_lines(spark, sf).select("lang", "line"), "line", "lang")


@query("SELECT language, trigram, n, score FROM x_model")
def lid_train(spark, sf):
    lines = src.doc_lines(spark, sf)
    return lg.lid_scores(lg.trigram_counts(lines, "line", "lang"))


@query(sql_best_label("doc_id, line_no", "x_lines"))
def lid_predict(spark, sf):
    # stored, as the lines are read for the model, for their trigrams and for the result
    lines = materialize(src.doc_lines(spark, sf).select("doc_id", "lang", F.col("line_no").cast("bigint").alias("line_no"), "line"))
    trained = lg.lid_train(lines, "line", "lang")
    return lg.lid_predict(lines.drop("lang"), ["doc_id", "line_no"], "line", trained).drop("line")


def _segments(spark, sf):
    """A source stands for a page whose segments are in several languages."""
    return src.doc_lines(spark, sf).select("source", "doc_id", F.col("lang").alias("language"), F.col("line").alias("text"))


@query("SELECT source, lang AS language, count(*) AS n FROM x_lines GROUP BY ALL")
def page_language_counts(spark, sf):
    return lg.page_language_counts(_segments(spark, sf), "source")


part(
    "x_share",
    "SELECT source, count(*) AS total, count_if(lang IN ('en', 'fr')) AS target FROM x_lines GROUP BY source",
)


@query("SELECT source, total, target FROM x_share")
def page_language_share(spark, sf):
    return lg.page_language_share(_segments(spark, sf), "source", "en, fr,en")


@query(
    """
SELECT source, doc_id, lang AS language, line AS text FROM x_lines
WHERE lang IN ('en', 'fr') AND source IN (SELECT source FROM x_share WHERE target * 100 >= total * 80)
"""
)
def page_language_filter(spark, sf):
    return lg.page_language_filter(_segments(spark, sf), "source", ["en", "fr"])


@query("SELECT source, doc_id, lang AS language, line AS text FROM x_lines WHERE lang IN ('es', 'fr')")
def segment_language_filter(spark, sf):
    return lg.page_language_filter(_segments(spark, sf), "source", "es,fr", enabled=False)

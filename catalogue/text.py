"""Lines and paragraphs of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import query
from lingmill.functions import text as tx
from lingmill.operators import lines as ln


def _docs(spark, sf):
    return src.table(spark, sf, "documents").select("doc_id", "text")


@query("SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM x_lines")
def clean_lines(spark, sf):
    return ln.clean_lines(_docs(spark, sf)).select("doc_id", F.col("line_no").cast("bigint"), "line")


def _stripped(spark, sf):
    lines = ln.stripped_lines(_docs(spark, sf))
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


_NUMBERED = """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS line_no, s AS line FROM x_stripped
"""


@query(f"SELECT doc_id, line_no, line FROM ({_NUMBERED}) WHERE length(line) >= 50")
def line_min_length(spark, sf):
    return _stripped(spark, sf).filter(tx.long_enough(F.col("line")))


@query(
    f"""
SELECT doc_id, line_no, CAST(length(regexp_replace(line, '[^.,!?]', '', 'g')) AS BIGINT) AS n_marks
FROM ({_NUMBERED})
"""
)
def line_sentence_marks(spark, sf):
    lines = ln.line_measures(_docs(spark, sf))
    return lines.select("doc_id", F.col("line_no").cast("bigint"), "n_marks")


@query(
    f"""
SELECT doc_id, line_no, CAST({src.sql_lower_n("line")} AS BIGINT) AS n_lower,
  CAST({src.sql_upper_n("line")} AS BIGINT) AS n_upper,
  ({src.sql_lower_n("line")}) * 100 <= length(line) * 95
    AND ({src.sql_upper_n("line")}) * 5 <= length(line) AS kept
FROM ({_NUMBERED})
"""
)
def line_case_ratio(spark, sf):
    lines = ln.line_measures(_docs(spark, sf))
    return lines.select(
        "doc_id",
        F.col("line_no").cast("bigint"),
        "n_lower",
        "n_upper",
        tx.case_shares_ok(F.col("line")).alias("kept"),
    )


@query(f"SELECT doc_id, line_no, line FROM ({_NUMBERED}) WHERE right(line, 3) <> '...'")
def line_ellipsis(spark, sf):
    return _stripped(spark, sf).filter(tx.not_cut_off(F.col("line")))


@query(
    f"""
SELECT doc_id, count(*) AS clean, count(DISTINCT line) AS distinct_lines
FROM (SELECT doc_id, {src.sql_collapse("s")} AS line FROM x_stripped WHERE {src.sql_keep("s")})
GROUP BY doc_id
"""
)
def block_distinct_lines(spark, sf):
    both = _docs(spark, sf).select(
        "doc_id",
        F.size(tx.clean_block(F.col("text"), distinct=False)).cast("bigint").alias("clean"),
        F.size(tx.clean_block(F.col("text"))).cast("bigint").alias("distinct_lines"),
    )
    return both.filter(F.col("clean") > 0)


@query(
    f"""
SELECT doc_id, CAST(n - 1 AS BIGINT) AS paragraph_no,
  {src.sql_strip("replace(replace(replace(p, chr(10) || '•', chr(1)), chr(10), ''), chr(1), chr(10) || '•')")} AS paragraph
FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p,
             generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS n FROM documents)
"""
)
def paragraph_unwrap(spark, sf):
    out = ln.paragraph_unwrap(_docs(spark, sf))
    return out.select("doc_id", F.col("paragraph_no").cast("bigint"), "paragraph")

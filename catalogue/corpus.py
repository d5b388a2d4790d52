"""The corpus, its statistics and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import part, query
from lingmill.operators import dataset as ds
from lingmill.operators import samples as sm
from lingmill.plans import dataset
from lingmill.plans.dataset import write_corpus
from lingmill.sources import readers, writers
from lingmill.sources.shared import materialize, run_folder

part(
    "x_stats",
    r"""
SELECT language, script, CAST(sum(len(string_split(s, ' '))) AS BIGINT) AS words,
  CAST(sum(length(s)) AS BIGINT) AS characters, count(*) AS sentences
FROM (SELECT language, script, unnest(string_split(regexp_replace(text, '([.!?])[ ]+', '\1' || chr(1), 'g'), chr(1))) AS s
      FROM x_dataset)
GROUP BY language, script
""",
)


def _corpus(spark, sf):
    return ds.dataset_dedup(src.corpus_rows(spark, sf))


@query("SELECT text, language, script FROM x_dataset")
def dataset_dedup(spark, sf):
    return _corpus(spark, sf)


@query("SELECT language, script, words, characters, sentences FROM x_stats")
def corpus_stats(spark, sf):
    return ds.corpus_stats(_corpus(spark, sf))


@query(
    """
SELECT language, script, 'language: ' || language || chr(10) || 'script: ' || script || chr(10) || 'words: ' || words
  || chr(10) || 'characters: ' || characters || chr(10) || 'sentences: ' || sentences AS report FROM x_stats
"""
)
def stats_report(spark, sf):
    return ds.stats_report(ds.corpus_stats(_corpus(spark, sf)))


@query(
    """
SELECT string_agg('language: ' || language || chr(10) || 'script: ' || script || chr(10) || 'words: ' || words || chr(10)
  || 'characters: ' || characters || chr(10) || 'sentences: ' || sentences, chr(10) || '-----' || chr(10) ORDER BY language, script) AS report
FROM x_stats
"""
)
def stats_report_text(spark, sf):
    return ds.report_text(ds.stats_report(ds.corpus_stats(_corpus(spark, sf))))


@query(
    """
SELECT row_number() OVER (ORDER BY language NULLS FIRST, script NULLS FIRST) - 1 AS row, language, script, words, characters, sentences FROM x_stats
"""
)
def stats_csv(spark, sf):
    """Written with its numbering and read back."""
    folder = run_folder(spark, "stats")
    writers.write_stats(ds.corpus_stats(_corpus(spark, sf)), folder)
    found = spark.read.option("header", True).csv(folder)
    return found.select(
        F.col("_c0").cast("bigint").alias("row"), "language", "script", *(F.col(c).cast("bigint") for c in ("words", "characters", "sentences"))
    )


@query("SELECT language, script, words, characters, sentences FROM x_stats")
def dataset_build(spark, sf):
    """The whole second job: write the Parquet dataset, read it back, count."""
    return write_corpus(_corpus(spark, sf), run_folder(spark, "dataset"))


@query("SELECT count(*) AS n FROM x_dataset")
def dataset_rowcount(spark, sf):
    folder = run_folder(spark, "dataset")
    write_corpus(_corpus(spark, sf), folder)
    return readers.parquet_rows(spark, f"{folder}/dataset")


def _merged(spark, sf):
    """Three rounds that share lines: a half of all lines, a third, and all of them."""
    # stored, as segments of rounds are
    rows, folder = materialize(src.corpus_rows(spark, sf)), run_folder(spark, "merged")
    part = F.xxhash64("text", "language")
    for n, segments in enumerate((rows.filter(part % 2 == 0), rows.filter(part % 3 == 0), rows), 1):
        dataset.merge_round(spark, segments, folder, n, bits=4)
    return folder


@query("SELECT text, language, script FROM x_dataset")
def dataset_merge(spark, sf):
    return dataset.merged_corpus(spark, _merged(spark, sf))


@query("SELECT language, script, words, characters, sentences FROM x_stats")
def dataset_merge_stats(spark, sf):
    return dataset.merged_stats(spark, _merged(spark, sf))


@query("SELECT text, language, script FROM x_dataset WHERE language || '_' || script IN ('deu_Latn', 'fra_Latn')")
def dataset_language_filter(spark, sf):
    return ds.dataset_dedup(ds.dataset_language_filter(src.corpus_rows(spark, sf), "deu_Latn, fra_Latn"))


@query(
    f"""
SELECT doc_id, split_part(label, '_', 1) AS language, split_part(label, '_', 2) AS script
FROM (SELECT doc_id, {src.SQL_LABEL} AS label FROM documents)
"""
)
def label_split(spark, sf):
    label = F.concat(F.lit("__label__"), src.corpus_label(F.col("lang")))
    docs = src.table(spark, sf, "documents").select("doc_id", label.alias("label"))
    return ds.with_label_parts(docs, "label")


# Lines per (language, source): a source stands for one text file of a language.
part(
    "x_sample_files",
    """
SELECT lang, source FROM (
  SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY source) AS r, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT DISTINCT lang, source FROM x_lines))
WHERE r <= 3 AND n >= 5
""",
)
part(
    "x_samples",
    """
SELECT lang AS language, slot, line AS sample FROM (
  SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY md5('0/' || lang || '/' || line_id), line_id) AS slot
  FROM (SELECT lang, line, doc_id * 1000000 + line_no AS line_id FROM x_lines JOIN x_sample_files USING (lang, source)))
WHERE slot <= 100
""",
)


def _sample_lines(spark, sf):
    return src.doc_lines(spark, sf).select(
        F.col("lang").alias("language"),
        F.col("source").alias("file"),
        (F.col("doc_id") * 1000000 + F.col("line_no")).alias("line_id"),
        "line",
    )


@query("SELECT language, slot, sample FROM x_samples")
def language_samples(spark, sf):
    return sm.language_samples(_sample_lines(spark, sf))


# Draw j (1 to 100) gives line k + 1 of the hash order, or one of the k lines drawn so far.
part(
    "x_sample_sizes",
    "SELECT lang AS language, count(*) AS size FROM x_lines JOIN x_sample_files USING (lang, source) GROUP BY lang",
)


@query(
    """
SELECT d.language, j AS slot, sample FROM (
  WITH RECURSIVE draws AS (
    SELECT language, size, 0::BIGINT AS j, 0::BIGINT AS k, 0::BIGINT AS pick FROM x_sample_sizes
    UNION ALL
    SELECT language, size, j + 1, CASE WHEN d < k THEN k ELSE k + 1 END, CASE WHEN d < k THEN d + 1 ELSE k + 1 END
    FROM (SELECT *, ('0x' || substr(md5('0/' || language || '/' || (j + 1)), 1, 15))::BIGINT % size AS d FROM draws)
    WHERE j < 100
  ) SELECT * FROM draws WHERE j > 0
) d JOIN x_samples s ON d.language = s.language AND d.pick = s.slot
"""
)
def language_samples_with_replacement(spark, sf):
    return sm.language_samples(_sample_lines(spark, sf), replace=True)


@query("SELECT language, sample FROM x_samples")
def sample_files(spark, sf):
    """Samples written as CSV and read back."""
    folder = run_folder(spark, "samples")
    writers.write_samples(sm.language_samples(_sample_lines(spark, sf)), folder)
    return spark.read.schema("sample STRING, language STRING").option("header", True).option("escape", '"').csv(folder)


@query("SELECT language, count(*) AS n FROM x_samples GROUP BY language")
def sample_counts(spark, sf):
    return sm.sample_counts(sm.language_samples(_sample_lines(spark, sf)))

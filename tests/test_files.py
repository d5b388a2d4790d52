"""Folders per label hold every row, whatever its label."""

from pyspark.sql import functions as F

from catalogue import files
from catalogue import inputs as src
from lingmill.sources import readers, writers

DOCS = [(1, "eine Zeile mit Worten darin", "de"), (2, "una riga con alcune parole", "it"), (3, "a line of many words", None)]
LANGS = ["de", "it", "fr", None]


def test_rows_of_other_and_no_language_stay(spark, tmp_path):
    docs = [(i, f"{t}, " * 5, la, "a", len(t)) for i, t, la in DOCS]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = src.corpus_rows(spark, str(tmp_path)).groupBy("text", "language", "script").agg(F.count("*").alias("n"))
    got = files.segments_from_files(spark, str(tmp_path))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert want.filter("language is null").count() == 2 and rows(got) == rows(want)


def test_pages_of_other_and_no_language_stay(spark, tmp_path):
    html = lambda la: f'<html lang="{la}"><body></body></html>' if la else "<html></html>"
    pages = [(i, f"http://h{i}.org/", html(la)) for i, la in enumerate(LANGS)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["label"]: r["n"] for r in files.parsed_urls_by_lang(spark, str(tmp_path)).collect()}
    assert got == {"deu_Latn": 1, "fra_Latn": 1, None: 2}


def test_every_label_comes_back(spark, tmp_path):
    labels = ["deu_Latn", "srp_Cyrl", "a_b_c", None]
    table = spark.createDataFrame([(f"u{i}", la) for i, la in enumerate(labels)], "url string, label string")
    writers.write_parsed_by_label(table, f"{tmp_path}/out")
    found = readers.parsed_pages_by_label(spark, f"{tmp_path}/out").select("url", "label").collect()
    assert {r["url"]: r["label"] for r in found} == {f"u{i}": la for i, la in enumerate(labels)}

"""Seed lists out of a crawl index (url, url_host_registered_domain, content_languages)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.operators.ranking import first_per_key
from lingmill.sources.shared import materialize


def index_filter(
    index: DataFrame, languages: Iterable[str], subset: str | None = None, crawl: str | None = None
) -> DataFrame:
    """Index rows in the wanted languages; plain comparisons that reach the Parquet scan."""
    keep = F.col("content_languages").isin(list(dict.fromkeys(languages)))
    if subset is not None:
        keep = keep & (F.col("subset") == subset)
    if crawl is not None:
        keep = keep & (F.col("crawl") == crawl)
    return index.filter(keep)


def index_of_languages(index: DataFrame, languages: DataFrame, subset: str | None = None, crawl: str | None = None) -> DataFrame:
    """Index rows whose language the table has, with `lang_script`, as `with_scripts` after `index_filter`.

    On an index that is stored by crawl, subset and language (`writers.write_index`) the comparisons choose folders as
    the query is planned, and the table chooses those of its languages as it runs.
    """
    # stored, so that the planner sees that it is small; the condition tells it that the table chooses
    table = materialize(_code_scripts(languages)).filter(F.length("iso6393") > 0)
    kept = index
    for column, value in (("subset", subset), ("crawl", crawl)):
        kept = kept.filter(F.col(column) == value) if value is not None else kept
    return kept.join(table, kept["content_languages"] == table["iso6393"]).select(
        *kept.columns, F.concat_ws("_", "iso6393", "iso15924").alias("lang_script")
    )


def url_dedup(index: DataFrame, order: str) -> DataFrame:
    """The first row of every URL by `order`."""
    return first_per_key(index, "url", order)


def urls_per_language(index: DataFrame) -> DataFrame:
    """URLs per language, most first."""
    return (
        index.groupBy(F.col("content_languages").alias("language"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "language")
    )


def domains_per_language(index: DataFrame, order: str) -> DataFrame:
    """Domains per language, most first; a domain counts for the language of its first row."""
    rows = index.select("url_host_registered_domain", "content_languages", order)
    return urls_per_language(first_per_key(rows, "url_host_registered_domain", order))


def with_scripts(index: DataFrame, languages: DataFrame) -> DataFrame:
    """Add `lang_script`; rows in a language that the table does not have are left out."""
    table = _code_scripts(languages)
    return index.join(table, index["content_languages"] == table["iso6393"]).select(
        *index.columns, F.concat_ws("_", "iso6393", "iso15924").alias("lang_script")
    )


def unmapped_languages(index: DataFrame, languages: DataFrame) -> DataFrame:
    """Languages of the index that the table does not have, with their number of rows."""
    table = _code_scripts(languages)
    lost = index.join(table, index["content_languages"] == table["iso6393"], "left_anti")
    return urls_per_language(lost)


def _code_scripts(languages: DataFrame) -> DataFrame:
    """Each script of a code once. No join strategy is forced: the planner broadcasts the table when
    it sees that it is small."""
    return languages.select("iso6393", "iso15924").distinct()


def seed_urls(index: DataFrame, languages: DataFrame, order: str) -> DataFrame:
    """(lang_script, url): the distinct URLs of the index, ready to be written per language."""
    return with_scripts(url_dedup(index, order), languages).select("lang_script", "url")

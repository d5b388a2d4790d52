"""Round files taken in as they arrive."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lingmill.operators.language import LanguageModel, domain_language_counter
from lingmill.operators.ranking import first_per_key
from lingmill.plans import parse
from lingmill.sources import schemas

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def raw_page_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of JSON-line files of fetched pages."""
    reader = spark.readStream.schema(schemas.RAW_PAGE).option("mode", "DROPMALFORMED")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_parse(
    pages: DataFrame,
    model: LanguageModel,
    targets: Iterable[str] | str,
    out_folder: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Parse each arriving batch and store it under its batch number.

    A batch that runs again after a failure overwrites its own folder, so nothing is doubled.
    Parsed pages go to `parsed/batch=N`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # a URL may come several times in one batch; the copy with the least hash is parsed, on every run
        hashed = batch.withColumn("_order", F.xxhash64("html"))
        once = first_per_key(hashed, "url", "_order").drop("_order")
        parsed = parse.parsed_pages(once, model, targets, **options)
        parsed.write.mode("overwrite").parquet(f"{out_folder}/parsed/batch={batch_id}")

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: What a batch of `stream_rounds` writes, with the layout of each table.
OUTPUTS = {
    "parsed": schemas.PARSED_PAGE,
    "segments": "url STRING, segment_no INT, text STRING, language STRING",
    "links": "page STRING, url STRING",
    "domain_languages": "host STRING, language STRING, n BIGINT",
}


def stream_rounds(
    pages: DataFrame,
    model: LanguageModel,
    targets: Iterable[str] | str,
    out_folder: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Parse each page the first time its URL arrives, and store all that a round derives from it.

    Which URLs have been there is state of the stream, on disk and in the checkpoint; of copies that arrive in one batch any
    one is parsed. A batch writes its parsed pages, segments, links and counts of languages per host into folders
    of its own, and its entry in `commits` last. Readers (`read_committed`) see the batches that are there, so the outputs of a
    batch appear together or not at all; a batch that runs again overwrites what it left.
    """
    use_disk_state(pages.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse.parsed_pages(batch, model, targets, **options)
        parsed.write.mode("overwrite").parquet(f"{out_folder}/parsed/batch={batch_id}")
        parsed = batch.sparkSession.read.schema(schemas.PARSED_PAGE).parquet(f"{out_folder}/parsed/batch={batch_id}")
        segments = parse.segment_rows(parsed)
        tables = {"segments": segments, "links": parse.link_rows(parsed), "domain_languages": domain_language_counter(segments)}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{out_folder}/{name}/batch={batch_id}")
        done = batch.sparkSession.createDataFrame([(batch_id,)], "committed BIGINT")
        done.write.mode("overwrite").parquet(f"{out_folder}/commits/batch={batch_id}")

    first = pages.filter(F.col("url").isNotNull()).dropDuplicates(["url"])
    return (
        first.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_committed(spark: SparkSession, out_folder: str, table: str) -> DataFrame:
    """A table of `OUTPUTS` with the rows of all committed batches."""
    try:
        commits = spark.read.schema("committed BIGINT").parquet(f"{out_folder}/commits")
        batches = [r["committed"] for r in commits.collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        batches = []
    if not batches:
        return spark.createDataFrame([], OUTPUTS[table])
    return spark.read.schema(OUTPUTS[table]).parquet(*(f"{out_folder}/{table}/batch={b}" for b in batches))


def read_parsed(spark: SparkSession, out_folder: str) -> DataFrame:
    return spark.read.schema(f"{schemas.PARSED_PAGE}, batch INT").parquet(f"{out_folder}/parsed").drop("batch")


def new_url_stream(links: DataFrame) -> DataFrame:
    """Each URL the first time it comes up. The state is the seen set: it never expires.

    Run it with `use_disk_state` so that the state is not limited by executor memory.
    """
    return links.select("url").dropDuplicates(["url"])


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB on the executors' disks, with changes sent to the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def stream_seen_urls(links: DataFrame, out_folder: str, checkpoint: str) -> StreamingQuery:
    """Write the URLs that are new, in files that later batches only add to. The state is kept on disk."""
    use_disk_state(links.sparkSession)
    return (
        new_url_stream(links)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

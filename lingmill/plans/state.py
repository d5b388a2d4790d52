"""State of a crawl: logs that rounds only add to.

A round writes what it has done and nothing else: the URLs it looked at, the batch it picked, the links it found that were new.
The frontier is never stored: it is what was looked at and not picked, and all added URLs behind the place up to which rounds
have looked. Positions follow the rounds, so the next URLs are found by position in the first added tables that
have any left.

Whether a link is known is asked of all URLs ever added. Those of the last rounds are read as the rounds left them; every
`fan` rounds they are merged into one run that is bucketed and sorted by URL, every `fan` runs of one level into one of
the next. So a URL is written again once per level, which is the logarithm of the number of rounds, and
a look-up reads the buckets of its URLs only.

The last write of a round is its entry in `progress`; it names the runs, so a merge counts only with it, and a round
that died is simply done again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lingmill.operators import frontier as fr
from lingmill.sources import schemas
from lingmill.sources.page_store import url_bucket
from lingmill.sources.shared import remove_folder

_PROGRESS = (
    "finished INT, cursor_pos BIGINT, cursor_url STRING, "
    "added ARRAY<STRUCT<round: INT, n: BIGINT>>, runs ARRAY<STRUCT<level: INT, first: INT, last: INT>>"
)
#: Rows of an added table that are worth a narrower range of positions.
_NARROW = 100_000


class CrawlState:
    """Where the tables of a crawl are, and how they are read. `bits` is the logarithm of the buckets of a run, `fan` the
    number of rounds, or of runs of a level, that are merged."""

    def __init__(self, spark: SparkSession, folder: str, bits: int = 6, fan: int = 8):
        self.spark = spark
        self.folder = folder
        self.bits = bits
        self.fan = fan

    @property
    def segments(self) -> str:
        """Folder of the segment text of all rounds, which the dataset job reads."""
        return f"{self.folder}/segments"

    def path(self, table: str, round_no: int) -> str:
        return f"{self.folder}/{table}/round={round_no}"

    def write(self, df: DataFrame, table: str, round_no: int) -> None:
        df.write.mode("overwrite").parquet(self.path(table, round_no))

    def _read(self, schema: str, *paths: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # ---- progress

    def last_round(self) -> int | None:
        """The last finished round; None if there is no state yet."""
        try:
            done = self.spark.read.schema("finished INT").parquet(f"{self.folder}/progress")
            return done.agg(F.max("finished")).first()[0]
        except AnalysisException as error:
            # only a folder that is not there means a new crawl; anything else must not lead to overwriting one
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def progress(self, round_no: int) -> Row:
        """The entry of a finished round: a few numbers per level and per round that has URLs left."""
        return self._read(_PROGRESS, self.path("progress", round_no)).first()

    def finish(self, round_no: int, cursor: tuple[int | None, str | None], added: list, runs: list) -> None:
        """The last write of a round; what is not marked here is done again."""
        row = (round_no, *cursor, [tuple(a) for a in added], [tuple(r) for r in runs])
        self.spark.createDataFrame([row], _PROGRESS).coalesce(1).write.mode("overwrite").parquet(self.path("progress", round_no))

    # ---- tables of a round

    def batch(self, round_no: int) -> DataFrame:
        return self._read("batch_pos BIGINT, url STRING, host STRING", self.path("batch", round_no))

    def looked(self, round_no: int) -> DataFrame:
        return self._read(schemas.FRONTIER, self.path("looked", round_no))

    def pages(self, round_no: int) -> DataFrame:
        return self._read("url STRING, html STRING, status INT, can_fetch BOOLEAN, batch_pos BIGINT", self.path("pages", round_no))

    def fetch_plan(self, round_no: int) -> DataFrame:
        """In which step each URL of a round may be fetched, and the pause between two fetches of its host."""
        schema = "batch_pos BIGINT, url STRING, domain STRING, step BIGINT, robots_delay BIGINT, delay BIGINT"
        return self._read(schema, self.path("fetch_plan", round_no))

    def parsed(self, round_no: int) -> DataFrame:
        return self._read(schemas.PARSED_PAGE, self.path("parsed", round_no))

    # ---- the frontier and the seen set, as far as they are wanted whole

    def _left(self, round_no: int) -> DataFrame:
        """What was looked at and not picked."""
        if round_no == 0:
            return self._read(schemas.FRONTIER)
        return fr.without_urls(self.looked(round_no), self.batch(round_no)).select("pos", "url")

    def _behind(self, added: list[int], cursor: tuple[int | None, str | None]) -> DataFrame:
        """Added URLs behind the place up to which rounds have looked."""
        rows = self._read(schemas.FRONTIER, *(self.path("added", r) for r in added))
        pos, url = cursor
        if pos is None:
            return rows
        # the first condition reaches the files, which are sorted by position
        return rows.filter((F.col("pos") >= pos) & ((F.col("pos") > pos) | (F.col("url") > url)))

    def frontier(self, round_no: int) -> DataFrame:
        """(pos, url) of all URLs that wait after round `round_no`."""
        at = self.progress(round_no)
        behind = self._behind([a["round"] for a in at["added"]], (at["cursor_pos"], at["cursor_url"]))
        return self._left(round_no).unionByName(behind)

    def seen(self, round_no: int) -> DataFrame:
        """(url) of all URLs that rounds up to `round_no` picked."""
        return self._read("url STRING", *(self.path("batch", r) for r in range(1, round_no + 1)))

    def known(self, round_no: int) -> DataFrame:
        """(url) of all URLs that were ever added."""
        runs = self.progress(round_no)["runs"]
        return self._recent(runs, round_no).unionByName(self._runs(runs).select("url"))

    def _recent(self, runs: list, round_no: int) -> DataFrame:
        first = max((r["last"] for r in runs), default=-1) + 1
        return self._read(schemas.FRONTIER, *(self.path("added", r) for r in range(first, round_no + 1))).select("url")

    def _run_path(self, level: int, first: int, last: int) -> str:
        return f"{self.folder}/known/level={level}/rounds={first}-{last}"

    def _runs(self, runs: list) -> DataFrame:
        schema = "url STRING, bucket INT"
        out = self._read(schema)
        for r in runs:
            out = out.unionByName(self._read(schema, self._run_path(r["level"], r["first"], r["last"])))
        return out

    # ---- what a round does

    def start(self, seeds: DataFrame, seed: int = 0) -> None:
        """State of round 0: the seeds in pseudo-random order, nothing looked at."""
        n = self.add(seeds, 0, seed)
        self.finish(0, (None, None), [(0, n)] if n else [], [])

    def add(self, urls_df: DataFrame, round_no: int, seed: int = 0) -> int:
        """Write the distinct URLs as those that round `round_no` adds, sorted by position; how many there are."""
        rows = fr.frontier_shuffle(urls_df.filter(F.col("url").isNotNull()), round_no, seed)
        self.write(rows.repartitionByRange("pos").sortWithinPartitions("pos", "url"), "added", round_no)
        return self._read(schemas.FRONTIER, self.path("added", round_no)).count()

    def look(self, round_no: int, n: int) -> tuple[DataFrame, tuple[int | None, str | None]]:
        """The first `n` URLs of the frontier, written as those that round `round_no` looks at; and how far that is.

        What earlier rounds left comes first, since positions only grow. The rest comes from the first added tables with
        URLs behind the cursor; of a large one only a range of positions is read that holds enough, as they are
        spread evenly.
        """
        at = self.progress(round_no - 1)
        cursor = (at["cursor_pos"], at["cursor_url"])
        left = self._left(round_no - 1)
        wanted = n - left.count() if round_no > 1 else n
        behind, rounds, found = self._behind([], cursor), [], 0
        for entry in at["added"] if wanted > 0 else []:
            rounds.append(entry["round"])
            behind = self._behind(rounds, cursor)
            if entry["n"] > max(_NARROW, 4 * wanted):
                behind = self._narrow(behind, entry, cursor, wanted - found)
                break
            if len(at["added"]) > len(rounds):
                found = behind.count()
                if found >= wanted:
                    break
        more = behind.orderBy("pos", "url").limit(max(wanted, 0)) if wanted <= fr.ONE_TASK else fr.first_rows(behind, wanted)
        self.write(left.unionByName(more), "looked", round_no)
        looked = self.looked(round_no)
        last = looked.agg(F.max(F.struct("pos", "url")).alias("at")).first()["at"]
        return looked, cursor if last is None else max(cursor, tuple(last), key=lambda c: (c[0] is not None, c))

    def _narrow(self, behind: DataFrame, entry: Row, cursor: tuple[int | None, str | None], wanted: int) -> DataFrame:
        """`behind` up to a position before which there are `wanted` rows of the last table that it reads."""
        start = entry["round"] << fr.POS_BITS
        at, end = max(start, cursor[0] or 0), start + (1 << fr.POS_BITS)
        step = (2 * wanted << fr.POS_BITS) // entry["n"] + 1
        while at + step < end:
            part = behind.filter(F.col("pos") < at + step)
            if part.filter(F.col("pos") >= start).count() >= wanted:
                return part
            step *= 4
        return behind

    def unknown(self, new: DataFrame, round_no: int) -> DataFrame:
        """Distinct URLs of `new` that were never added up to round `round_no`; `new` is a stored table.

        Only the buckets that the URLs fall into are read; their numbers (as many as there are buckets at most)
        become a filter on the folders.
        """
        new = new.select("url").filter(F.col("url").isNotNull()).distinct()
        runs = self.progress(round_no)["runs"]
        known = self._recent(runs, round_no)
        if runs:
            buckets = [r[0] for r in new.select(url_bucket(F.col("url"), self.bits)).distinct().collect()]
            known = known.unionByName(self._runs(runs).filter(F.col("bucket").isin(buckets)).select("url"))
        return fr.drop_known(new, known)

    def merged(self, runs: list, round_no: int) -> list:
        """`runs` with what is due after round `round_no` merged; writes the new run, leaves the old ones."""
        runs = [tuple(r) for r in runs]
        first = max((last for _, _, last in runs), default=-1) + 1
        if round_no - first + 1 < self.fan:
            return runs
        level, parts = 1, [self._read(schemas.FRONTIER, *(self.path("added", r) for r in range(first, round_no + 1))).select("url")]
        # levels that are full by the new run go into it at once, so that it is written once
        while len(same := [r for r in runs if r[0] == level]) >= self.fan - 1:
            parts.append(self._runs([Row(level=a, first=b, last=c) for a, b, c in same]).select("url"))
            runs = [r for r in runs if r[0] != level]
            first, level = min(b for _, b, _ in same), level + 1
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        (
            whole.withColumn("bucket", url_bucket(F.col("url"), self.bits))
            .repartition("bucket")
            .sortWithinPartitions("bucket", "url")
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#url", True)
            .partitionBy("bucket")
            .parquet(self._run_path(level, first, round_no))
        )
        return [*runs, (level, first, round_no)]

    def end_round(self, round_no: int, cursor: tuple[int | None, str | None], n_added: int) -> None:
        """Merge what is due, mark the round as done, and remove runs that neither this round nor the one before names."""
        before = self.progress(round_no - 1)
        at = -1 if cursor[0] is None else cursor[0] >> fr.POS_BITS
        added = [a for a in before["added"] if a["round"] >= at] + [(round_no, n_added)] * (n_added > 0)
        runs = self.merged(before["runs"], round_no)
        self.finish(round_no, cursor, added, runs)
        if round_no > 1:
            named = {tuple(r) for r in (*before["runs"], *runs)}
            for r in self.progress(round_no - 2)["runs"] if round_no > 2 else []:
                if tuple(r) not in named:
                    remove_folder(self.spark, self._run_path(*r))

    def clear(self) -> None:
        """Forget the crawl: the next one in this folder starts over. Progress goes first, so a half-done removal is no state."""
        remove_folder(self.spark, f"{self.folder}/progress")
        remove_folder(self.spark, self.folder)

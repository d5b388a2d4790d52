"""The list of URLs still to fetch, the set of URLs done, and how a round picks from them.

Frontier: (pos BIGINT, url STRING), picked in order of (pos, url). Seen: (url STRING), unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill.functions import urls
from lingmill.operators.ranking import row_rank, running_total
from lingmill.sources.shared import materialize

# Frontier positions of one round differ in this many bits; the round number stands above.
POS_BITS = 48
# Rows that a round may look at in one task.
ONE_TASK = 2_000_000
# Bits of a position by which rows are counted at a time.
_STEP = 16


def shuffled_pos(url: Column, round_no: int | Column, seed: int = 0) -> Column:
    """Position of a URL: rounds in order, and within a round a fixed pseudo-random order.

    The order comes from a hash of the URL and the seed, so it is the same on every run and
    needs neither a sort nor a counter over all rows.
    """
    bits = F.conv(F.substring(F.md5(F.concat(url, F.lit(str(seed)))), 1, POS_BITS // 4), 16, 10)
    start = (round_no if isinstance(round_no, Column) else F.lit(round_no)).cast("bigint")
    return start * F.lit(1 << POS_BITS) + bits.cast("bigint")


def frontier_shuffle(urls_df: DataFrame, round_no: int = 0, seed: int = 0) -> DataFrame:
    """Frontier rows for the distinct URLs, in pseudo-random order."""
    distinct = urls_df.select("url").distinct()
    return distinct.select(shuffled_pos(F.col("url"), round_no, seed).alias("pos"), "url")


def frontier_batch(frontier: DataFrame, n: int, lookahead: int = 10) -> DataFrame:
    """The next `n` URLs, from as many hosts as can be: (batch_pos, url, host).

    Looks at the first `n * lookahead` URLs only. One URL per host and pass, hosts with the
    most URLs first. As long as one task can hold what is looked at, the look-ahead is a distributed top-k and all that
    follows works on its bounded result; beyond that see `frontier_batch_in_ranges`, which gives the same rows.
    """
    if n * lookahead > ONE_TASK:
        return frontier_batch_in_ranges(frontier, n, lookahead)
    window_rows = (
        frontier.select("pos", "url", urls.netloc(F.col("url")).alias("host"))
        .orderBy("pos", "url")
        .limit(n * lookahead)
    )
    by_host = Window.partitionBy("host")
    in_order = by_host.orderBy("pos", "url")
    ranked = window_rows.withColumns(
        {
            "pass": F.row_number().over(in_order),
            "n_host": F.count(F.lit(1)).over(by_host),
            "first": F.min(F.struct("pos", "url")).over(by_host),
        }
    )
    turn = ("pass", F.desc("n_host"), "first")
    picked = ranked.orderBy(*turn).limit(n)
    # at most n rows are left here
    return picked.select(
        F.row_number().over(Window.orderBy(*turn)).cast("bigint").alias("batch_pos"), "url", "host"
    )


def first_rows(frontier: DataFrame, n: int) -> DataFrame:
    """The first `n` rows by (pos, url), without a task that holds them all.

    Positions are counted by their leading bits to find where the n-th row is, then those that begin like it by
    their next bits, and so on: each step brings one small count per group of positions to the driver.
    """
    low, left, shift = None, n, 64
    inside = frontier
    while shift > 0:
        shift -= _STEP
        part = F.shiftright(F.col("pos"), shift)
        counts = sorted(tuple(r) for r in inside.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        for at, rows in counts:
            if rows >= left:
                break
            left -= rows
        else:
            return frontier  # there are no more
        low = at << shift
        inside = frontier.filter((F.col("pos") >= low) & (F.col("pos") <= low + (1 << shift) - 1))
    # rows of one position: a few
    return frontier.filter(F.col("pos") < low).unionByName(inside.orderBy("url").limit(left))


def frontier_batch_in_ranges(frontier: DataFrame, n: int, lookahead: int = 10, ranges: int | None = None) -> DataFrame:
    """`frontier_batch` for any `n`: no task holds more than a range of the rows.

    URLs are numbered within their host in ranges. How many there are per pass and size of host says where the pick
    ends, so only the rows before that are put in order, again in ranges.
    """
    looked = first_rows(frontier.select("pos", "url"), n * lookahead)
    named = looked.select("url", urls.netloc(F.col("url")).alias("host"), F.struct("pos", "url").alias("_order"))
    passes = materialize(row_rank(named, ["host"], "_order", "_pass", ranges))
    hosts = passes.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"), F.min("_order").alias("_first"))
    joined = materialize(passes.join(hosts, "host").withColumn("_cell", F.struct("_pass", (-F.col("n_host")).alias("_less"))))
    cells = joined.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    starts = running_total(cells, [], "_cell", F.col("_n"), "_start", ranges).filter(F.col("_start") < n).select("_cell", "_start")
    placed = row_rank(joined.join(starts, "_cell"), ["_cell"], "_first", "_place", ranges)
    at = F.col("_start") + F.col("_place") + 1
    return placed.filter(at <= n).select(at.cast("bigint").alias("batch_pos"), "url", "host")


def polite_batches(
    urls_df: DataFrame, batch_size: int = 250, order: str = "pos", ranges: int | None = None
) -> DataFrame:
    """Add `domain` and `batch`: no batch has two URLs of a domain or more than `batch_size` URLs.

    Pass i takes the i-th URL of every domain; a pass is cut into batches in order of each
    domain's first URL. Batches are numbered from 0 over all passes. `order` is a unique
    BIGINT column. Works for whole tables: see `ranking` for how hot domains are cut.
    """
    named = urls_df.withColumn("domain", urls.domain(F.col("url")))
    # read four times below, so it is written once
    passes = materialize(row_rank(named, ["domain"], order, "_pass", ranges))
    firsts = passes.filter("_pass = 0").select("domain", F.col(order).alias("_first"))
    placed = passes.join(firsts, "domain")
    placed = row_rank(placed, ["_pass"], "_first", "_place", ranges)
    sub = F.expr(f"_place div {int(batch_size)}L")
    per_pass = passes.groupBy("_pass").agg(F.count(F.lit(1)).alias("_size"))
    n_batches = F.expr(f"(_size + {int(batch_size) - 1}L) div {int(batch_size)}L")
    starts = running_total(per_pass, [], "_pass", n_batches, "_start", ranges)
    return placed.join(starts.select("_pass", "_start"), "_pass").select(
        *urls_df.columns, "domain", (F.col("_start") + sub).cast("bigint").alias("batch")
    )


def frontier_unseen(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """URLs of the batch that are not in the seen set.

    First the seen URLs that are in the batch are found, then those few are taken off the batch. A batch is a
    stored table: where the planner sees that it is small, the big seen set is scanned once and not shuffled.
    """
    return batch.join(_known(batch, seen), "url", "left_anti")


def frontier_discard(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """URLs of the batch that are in the seen set."""
    return batch.join(_known(batch, seen), "url", "left_semi")


def _known(batch: DataFrame, seen: DataFrame) -> DataFrame:
    return seen.select("url").join(batch.select("url"), "url", "left_semi").distinct()


def without_urls(frontier: DataFrame, batch: DataFrame) -> DataFrame:
    """Frontier minus the URLs of a batch (done or given up)."""
    return frontier.join(batch.select("url"), "url", "left_anti")


def drop_known(new: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct new URLs that are not known.

    The known set is cut down to the new URLs first. If the planner finds the new URLs small
    (they are the links of one round), the known set is scanned without a shuffle.
    """
    new = new.select("url").distinct()
    hits = known.select("url").join(new, "url", "left_semi").distinct()
    return new.join(hits, "url", "left_anti")


def frontier_update(
    frontier: DataFrame,
    seen: DataFrame,
    processed: DataFrame,
    new_links: DataFrame,
    round_no: int,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Frontier and seen set after a round.

    Processed URLs leave the frontier and become seen. New links are appended in
    pseudo-random order, unless they are seen, processed or already waiting.
    """
    waiting = without_urls(frontier, processed)
    seen_after = seen.select("url").unionByName(
        frontier_unseen(processed.select("url").distinct(), seen)
    )
    fresh = drop_known(new_links, seen_after.unionByName(waiting.select("url")))
    added = fresh.select(shuffled_pos(F.col("url"), round_no, seed).alias("pos"), "url")
    return waiting.select("pos", "url").unionByName(added), seen_after

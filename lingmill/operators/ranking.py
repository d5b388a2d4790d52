"""Exact ranks and running totals without ever putting a whole group into one task.

A plain window sorts each group in one task; a host with a third of all URLs would make that
task the job. Here the rows are cut into ranges of (keys, order) by their own distribution, so a
big group lies in several ranges and each range has about as many rows as any other. Totals per
group and range are added up first (few rows), and rows are ranked only within their range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize


def in_ranges(df: DataFrame, keys: Sequence[str], order: str, ranges: int | None = None) -> DataFrame:
    """`df` with `_chunk`, the number of the range of (keys, order) that a row lies in; stored, so that it stays.

    `ranges` is their number; by default that of the shuffle partitions, which adaptive execution lowers for small inputs.
    """
    by = [*keys, order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return materialize(dealt.withColumn("_chunk", F.spark_partition_id()))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    name: str,
    ranges: int | None = None,
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the group that come before this one.

    `keys` must not be NULL; `order` is a column that can be sorted, unique within a group. A task holds one range
    of a group, never more, however the values of `order` are spread.
    """
    keys = list(keys)
    chunk = "_chunk"
    chunked = in_ranges(df.withColumn("_value", value.cast("bigint")), keys, order, ranges)
    totals = chunked.groupBy(*keys, chunk).agg(F.sum("_value").alias("_total"))
    # a group has at most one total per range
    before = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(chunk).alias("_c"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy(*keys, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    same = F.col(chunk) == F.col("_c")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    ranked = chunked.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return ranked.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_inside")).cast("bigint").alias(name)
    )


def row_rank(
    df: DataFrame, keys: Sequence[str], order: str, name: str, ranges: int | None = None
) -> DataFrame:
    """Add `name`: 0 for the first row of each group by `order`, 1 for the second and so on."""
    return running_total(df, keys, order, F.lit(1), name, ranges)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None
) -> DataFrame:
    """Add `name`: the greatest `value` of the rows of the group up to this one by `order`, this one included; NULL if none has one.

    Rows without a key are kept, but no value is carried from one range of them to the next. A task holds one range of a
    group, never more. Of rows that are equal in `order` any may come first, so only values that rise with it, or an
    `order` that is unique, give a fixed result.
    """
    keys, chunk = list(keys), "_chunk"
    chunked = in_ranges(df, [*keys, *order[:-1]], order[-1], ranges)
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # a group has at most one maximum per range
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    tops = chunked.filter(F.col(value).isNotNull()).groupBy(*keys, chunk).agg(F.max(value).alias("_top"))
    spans = chunked.select(*keys, chunk).distinct().join(tops, [*keys, chunk], "left")
    offsets = spans.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(chunk).alias("_c"), F.max("_top").over(before).alias("_offset")
    ).filter(F.col("_offset").isNotNull())
    same = F.col(chunk) == F.col("_c")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    ranked = chunked.withColumn("_inside", F.max(value).over(inside))
    return ranked.join(offsets, same, "left").select(*df.columns, F.greatest("_offset", "_inside").alias(name))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the least `order` of every key.

    An aggregate, not a window: each map task keeps one row per key before the shuffle, so a
    key with a third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("_first")
    return df.groupBy(key).agg(first).select(*[key if c == key else f"_first.{c}" for c in df.columns])

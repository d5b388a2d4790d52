"""Exact top-k by inner product: queries in blocks against shards of all vectors.

Both sides are packed into matrices of bounded size. A cell is one block of queries and one shard; it
gives, for each of its queries, the k best of the shard. Those lists are merged in a tree whose fan-in is
fixed, so no task sees more than `fan_in` lists of a query, however many shards there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize

_EXACT_IN_DOUBLE = 2.0**53
_LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class TopKOptions:
    k: int = 20
    shard_rows: int = 8192
    query_rows: int = 1024
    fan_in: int = 16


def quantised(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component as BIGINT; NULL for a vector that is NULL or has a component
    that is NULL, not a number or infinite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * factor).cast("long")))


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(dim, name, ids, data): the vectors of one length, about `size` to a row, sorted by id.

    Rows are dealt out by a hash of id and vector after equal rows are folded, so parts are even.
    """
    parts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = rows.join(parts, "dim").withColumn(name, F.pmod(F.xxhash64("id", "vector"), F.col("parts")))

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("id", kind="stable")
        data = np.array(batch["vector"].tolist(), dtype="<i8").reshape(len(batch), -1)
        return pd.DataFrame(
            {
                "dim": batch["dim"].iloc[:1].to_numpy(),
                name: batch[name].iloc[:1].to_numpy(),
                "ids": [batch["id"].to_numpy(dtype="<i8").tobytes()],
                "data": [data.tobytes()],
            }
        )

    return dealt.select("dim", name, "id", "vector").groupBy("dim", name).applyInPandas(
        pack, f"dim int, {name} long, ids binary, data binary"
    )


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles or longs where they cannot lose a digit, else in Python's
    integers, kept within the range of a long."""
    if not vectors.size:
        return np.zeros((len(queries), len(vectors)), dtype=np.int64)
    bound = float(np.abs(queries.astype(float)).max()) * float(np.abs(vectors.astype(float)).max()) * vectors.shape[1]
    if bound < _EXACT_IN_DOUBLE:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    if bound < 2.0**62:
        return queries @ vectors.T
    return np.clip(queries.astype(object) @ vectors.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids; `ids` ascend and differ."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        chosen = np.concatenate([above, equal[: k - len(above)]])
        ids, scores = ids[chosen], scores[chosen]
    order = np.lexsort((ids, -scores.astype(object) if scores.size and scores.min() == _LONG.min else -scores))
    return ids[order], scores[order]


def _cell(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> Iterator[tuple]:
    scores = _products(q, v)
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    if len(starts) < len(ids):  # different vectors under one id: its best score counts
        scores, ids = np.maximum.reduceat(scores, starts, axis=1), ids[starts]
    for query, row in zip(q_ids, scores):
        own = np.searchsorted(ids, query)
        if own < len(ids) and ids[own] == query:
            found = _best(np.delete(ids, own), np.delete(row, own), k)
        else:
            found = _best(ids, row, k)
        yield int(query), found


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    options: TopKOptions = TopKOptions(),
) -> DataFrame:
    """(query_id, rank, <id_col>, score): for every query row the k best other rows, ranks from 1.

    `is_query` picks the queries among `vectors`; it sees the columns of `vectors`. Scores are integer inner
    products of `floor(64 * x)`; ties go to the smaller id. A row with a NULL id, or a vector that is NULL or
    holds a component that is NULL or not finite, takes no part. Only vectors of equal length are compared.
    Equal rows count once; if different vectors share an id, the id counts once with its best score,
    for queries as for candidates, and never as its own candidate. Fewer than k candidates give all of them;
    an empty table gives none. Other columns are neither read nor returned.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vector)).alias("vector"), is_query.alias("query")
    ).filter("id is not null and vector is not null")
    rows = materialize(rows.dropDuplicates(["id", "vector"]).withColumn("dim", F.size("vector")))
    shards = materialize(_packed(rows, options.shard_rows, "shard"))
    blocks = materialize(
        _packed(rows.filter("query"), options.query_rows, "block").withColumnsRenamed({"ids": "q_ids", "data": "q_data"})
    )
    # every block meets every shard of its length: one row per pair of packed matrices
    each_shard = shards.groupBy("dim").agg(F.collect_list("shard").alias("each"))
    cells = (
        shards.join(blocks.groupBy("dim").agg(F.collect_list("block").alias("each")), "dim")
        .withColumn("block", F.explode("each"))
        .drop("each")
        .join(blocks.join(each_shard, "dim").withColumn("shard", F.explode("each")).drop("each"), ["dim", "shard", "block"])
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, shard, q_ids, q_data, ids, data in zip(
                *(batch[c] for c in ("dim", "shard", "q_ids", "q_data", "ids", "data"))
            ):
                q_ids, ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                q, v = (np.frombuffer(x, "<i8").reshape(len(i), dim) for x, i in ((q_data, q_ids), (data, ids)))
                found = list(_cell(q_ids, q, ids, v, options.k))
                yield pd.DataFrame(
                    {
                        "query_id": [query for query, _ in found],
                        "part": np.full(len(found), shard),
                        "found": [
                            [{"back": ~int(s), "id": int(i)} for i, s in zip(*best)] for _, best in found
                        ],
                    }
                )

    # `back` is the complement of the score: it ascends as the score falls and never overflows
    lists = cells.select("dim", "shard", "q_ids", "q_data", "ids", "data").mapInPandas(
        search, "query_id long, part long, found array<struct<back: bigint, id: bigint>>"
    )
    most = shards.agg(F.count("*")).first()[0]
    while most > 1:
        lists = _merged(lists.withColumn("part", F.floor(F.col("part") / options.fan_in)), options.k)
        most = -(-most // options.fan_in)
    return _merged(lists.withColumn("part", F.lit(0)), options.k).select(
        "query_id", F.posexplode("found").alias("at", "item")
    ).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("item.id").alias(id_col),
        F.bitwise_not("item.back").alias("score"),
    )


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of the lists of each query and part; an id in several lists counts once, by its best."""

    def first_of_each(items: Column) -> Column:
        # sorted, so an id's first place is its best; lists hold k items each, so this stays small
        seen = F.aggregate(
            items,
            F.struct(F.array().cast("array<bigint>").alias("ids"), F.array().cast("array<struct<back:bigint,id:bigint>>").alias("kept")),
            lambda a, x: F.when(
                (F.size(a["ids"]) >= k) | F.array_contains(a["ids"], x["id"]), a
            ).otherwise(F.struct(F.array_append(a["ids"], x["id"]).alias("ids"), F.array_append(a["kept"], x).alias("kept"))),
            lambda a: a["kept"],
        )
        return seen

    merged = lists.groupBy("query_id", "part").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    return merged.select("query_id", "part", first_of_each(F.col("found")).alias("found"))

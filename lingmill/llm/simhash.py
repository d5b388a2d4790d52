"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Two fingerprints link if they differ in at most `RADIUS` = 2 bits. Candidates come from tables keyed by
the fingerprint under a mask (Pagh, "CoveringLSH", 2016): each of the 64 bits has a nonzero vector of 3 bits, and
the mask of table v keeps the bits whose vector is not orthogonal to v. Any two bits have some v that is
orthogonal to both, so every pair within the radius meets in one of the 7 tables at least.

A pair within the radius is then found without comparing pairs: two fingerprints differ in at most 2 bits
exactly if they have a common point at a distance of at most 1 from each. So each fingerprint that met
another one gives itself and its one-bit changes, and equal points link. At most 65 fingerprints share a
point, however many documents are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.llm.common import text_key
from lingmill.llm.components import components
from lingmill.sources.shared import materialize

BITS = 64
RADIUS = 2
_SEED = 42
#: Shingles hashed at a time, so that a very long text needs little memory.
_CHUNK = 1 << 16


def covering_masks() -> list[int]:
    """The 7 masks as unsigned numbers; bit i has the vector i mod 7 + 1."""
    vectors = range(1, 1 << (RADIUS + 1))
    return [sum(1 << i for i in range(BITS) if (v & (i % len(vectors) + 1)).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text: bit i is 1 if it is in over half of the XXH64 of all shingles, repeats included.

    Words part at ASCII white space, A-Z count as a-z. Fewer words than a shingle make one shingle; no word
    gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, _CHUNK):
        end = min(count, at + _CHUNK)
        parts = (words[at + k : end + k] for k in range(shingle)) if len(words) > shingle else [[b" ".join(words)]]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(s, _SEED) for s in map(b" ".join, zip(*parts))), dtype="<u8", count=end - at
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def simhash(text: Column, shingle: int) -> Column:
    """Fingerprint of a text column as a signed BIGINT."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_signed(fingerprint(value, shingle)) for value in batch], dtype="int64")

    return of(text)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join all of the different values of `fp` within the radius, directly or by way
    of others within it."""
    masks = F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.lit(v).alias("v")) for v, m in enumerate(covering_masks())))
    table = prints.select("fp", F.explode(masks).alias("m")).select(
        "fp", "m.v", "m.mask", F.col("fp").bitwiseAND(F.col("m.mask")).alias("kept")
    )
    # a bucket with one fingerprint links nothing; min and max combine before the shuffle
    crowded = table.groupBy("v", "kept").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    met = table.join(crowded.select("v", "kept"), ["v", "kept"], "left_semi")
    free = met.groupBy("fp").agg(F.bit_or(F.bitwise_not("mask")).alias("free"))
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    changed = F.transform(F.filter(flips, lambda f: f.bitwiseAND(F.col("free")) != 0), lambda f: f.bitwiseXOR(F.col("fp")))
    points = free.select("fp", F.explode(F.concat(F.array("fp"), changed)).alias("point"))
    # at most 65 fingerprints per point
    shared = points.groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("near")).filter(F.size("near") > 1)
    return shared.select(F.get("near", F.lit(0)).alias("a"), F.explode(F.slice("near", 2, BITS)).alias("b")).distinct()


def _labelled(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """(id, h1, h2, fp, component, component_id) of every row; h1 and h2 stand for the text."""
    h1, h2 = text_key(F.col(text))
    prints = materialize(
        docs.select(F.col(id_col).alias("id"), h1.alias("h1"), h2.alias("h2"), simhash(F.col(text), shingle).alias("fp"))
    )
    least = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    linked = components(fingerprint_links(least.select("fp")))
    grouped = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = materialize(grouped.select("fp", "component").join(ids, "component"))
    return prints.join(by_print, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row per input row: id, fingerprint (BIGINT), component_id (the smallest id that links reach).

    NULL, empty and blank texts have the fingerprint 0 and link like any other. Equal texts, however
    many, are one fingerprint and never multiply. A NULL id has no part in a minimum; the component is NULL if
    it has no other id. Repeated rows stay repeated. An empty table gives an empty result. Other columns are
    neither read nor returned.
    """
    found = _labelled(docs, id_col, text, shingle)
    return found.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row of `docs`, with all its columns, for each group of near-duplicates.

    It is the row with the smallest id, NULL ids last, then by a hash of the text; of repeated rows any one. NULL,
    empty and blank texts are one group, with any that their fingerprint links to. An empty table gives an empty
    result; only the id and the text are read, whatever else the columns are called.
    """
    found = materialize(_labelled(docs, id_col, text, shingle).select("id", "h1", "h2", "component"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")).alias("least")
    chosen = found.groupBy("component").agg(least).select("least.id", "least.h1", "least.h2")
    counted = found.groupBy("id", "h1", "h2").agg(F.count("*").alias("rows"))

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["id"].eqNullSafe(b["id"]) & (a["h1"] == b["h1"]) & (a["h2"] == b["h2"])

    others = counted.join(chosen, same(counted, chosen), "left_anti").select("id", "h1", "h2")
    several = counted.filter("rows > 1")
    several = several.join(chosen, same(several, chosen), "left_semi").select("id", "h1", "h2")
    others, several = materialize(others), materialize(several)
    h1, h2 = text_key(F.col("row")[text])
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row")[id_col].alias("id"), h1.alias("h1"), h2.alias("h2"))
    # only rows that are there several times have to be brought together
    # a part of all documents goes, so the table grows with them: the same join at every size
    gone = others.unionByName(several).hint("merge")
    once = rows.join(gone, same(rows, gone), "left_anti")
    repeated = rows.join(several, same(rows, several), "left_semi").dropDuplicates(["id", "h1", "h2"])
    return once.unionByName(repeated).select(*(F.col("row")[c].alias(c) for c in docs.columns))

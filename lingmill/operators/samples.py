"""Sample lines per language: (language, file, line_id, line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sampled_files(lines: DataFrame, max_files: int = 3, min_files: int = 5) -> DataFrame:
    """(language, file): the first files by name of every language that has enough files.

    Works on the distinct files, not on the lines.
    """
    files = lines.select("language", "file").distinct()
    by_language = Window.partitionBy("language")
    ranked = files.withColumns(
        {
            "_rank": F.row_number().over(by_language.orderBy("file")),
            "_files": F.count(F.lit(1)).over(by_language),
        }
    )
    return ranked.filter((F.col("_rank") <= max_files) & (F.col("_files") >= min_files)).select(
        "language", "file"
    )


#: Parts that a language is cut into before its lines are ranked.
PARTS = 64


def _draw_key(seed: int) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("language"), F.col("line_id").cast("string")))


def language_samples(
    lines: DataFrame,
    n: int = 100,
    max_files: int = 3,
    min_files: int = 5,
    seed: int = 0,
    replace: bool = False,
) -> DataFrame:
    """(language, slot, sample): `n` random lines per language, the same ones on every run.

    `line_id` is unique per language. Without `replace` slots are 1..n in hash order, fewer if
    the language has fewer lines. Each language is cut into `PARTS` parts by a hash of the line; the best `n`
    of each part are ranked again, so that no task sorts a whole language, however large `n` is.

    With `replace`, lines may repeat, as in n independent draws. The draws are made on the
    slot numbers: draw j gives a line not drawn before with probability (N - k) / N, where k
    lines were drawn so far, else one of those k, each being equally likely. The lines
    themselves are the first k of the hash order.
    """
    files = sampled_files(lines, max_files, min_files)
    chosen = lines.join(files, ["language", "file"], "left_semi")
    order = Window.partitionBy("language").orderBy("_key", "line_id")
    within = Window.partitionBy("language", "_part").orderBy("_key", "line_id")
    part = F.pmod(F.xxhash64("line_id"), F.lit(PARTS))
    top = (
        chosen.select("language", "line_id", "line", _draw_key(seed).alias("_key"), part.alias("_part"))
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= n)
        .withColumn("slot", F.row_number().over(order))
        .filter(F.col("slot") <= n)
        .select("language", F.col("slot").cast("bigint"), F.col("line").alias("sample"))
    )
    if not replace:
        return top
    sizes = chosen.groupBy("language").agg(F.count(F.lit(1)).alias("_size"))

    def draw(j: Column) -> Column:
        hashed = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("language"), j.cast("string")))
        return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint") % F.col("_size")

    start = F.struct(F.lit(0).cast("bigint").alias("k"), F.array().cast("array<bigint>").alias("picks"))

    def step(acc: Column, j: Column) -> Column:
        known = draw(j) < acc["k"]
        return F.struct(
            F.when(known, acc["k"]).otherwise(acc["k"] + 1).alias("k"),
            F.concat(acc["picks"], F.array(F.when(known, draw(j) + 1).otherwise(acc["k"] + 1))).alias("picks"),
        )

    picks = sizes.select(
        "language",
        F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step)["picks"]).alias("_draw", "_slot"),
    )
    joined = picks.join(top, (picks["language"] == top["language"]) & (F.col("_slot") == F.col("slot")))
    return joined.select(picks["language"], (F.col("_draw") + 1).cast("bigint").alias("slot"), "sample")


def sample_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("language").agg(F.count(F.lit(1)).alias("n"))

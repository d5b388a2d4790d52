"""One query for each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.llm import licenses, lid, line_quality, mixing, pieces, pii, ring, secrets, simhash, spelling, topk, toxicity, whitening
from lingmill.llm.common import table
from lingmill.sources.shared import materialize


def op1_lid_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = lid.lid_dictionaries(docs.filter(fold != 0))
    found = lid.lid_compress(docs, model)
    return found.select(
        "doc_id",
        (fold == 0).alias("held_out"),
        F.col("best").alias("lang_pred"),
        "score",
        (F.col("lang") == lid.UNKNOWN).alias("rejected"),
    )


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


_OP2_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS body,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
),
repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id
),
lines AS (
    SELECT doc_id, source, body,
           regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS line,
           len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
    FROM (SELECT doc_id, source, body, unnest(lines) AS line FROM docs)
),
above AS (
    SELECT source, line
    FROM (SELECT source, line, count(DISTINCT body) AS n FROM lines GROUP BY ALL)
    JOIN (SELECT source, count(DISTINCT body) AS texts FROM docs GROUP BY ALL) USING (source)
    WHERE n >= 10 AND (n > 0.1::DOUBLE * texts OR n >= 100)
),
lost AS (
    SELECT doc_id, sum(n) AS removed_words FROM lines JOIN above USING (source, line) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(removed_words, 0)::BIGINT AS removed_words
    FROM docs LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 50 OR n_repeat_words > 0.5::DOUBLE * n_words AS base_failed,
       NOT (n_words < 50 OR n_repeat_words > 0.5::DOUBLE * n_words)
       AND NOT removed_words > 0.5::DOUBLE * n_words AS kept
FROM measured
"""


def op4_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(F.filter("spans", pii.is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.span_digest(F.col("spans"), pii.BASE), 256).alias("base_sha256"),
        pii.span_digest(F.col("spans"), pii.KINDS).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


#: The vocabulary that op8 and the pipeline use: a file on the driver, which sends its pieces to the executors.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.PieceModel.load(PIECES))

#: Weights of the domains that `labels` tells apart, for op5 and the pipeline.
TARGETS = {"good": 0.8, "plain": 0.15, "toxic": 0.05}
#: Good and plain documents are not thinned out to reach them.
MIXING = mixing.MixingOptions(whole=("good", "plain"))


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labelled documents: toxic, or good or plain by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")
    return table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixing_rates(docs, labelled_domains(spark, sf_dir), TARGETS, options=MIXING)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    span = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"),
        F.array_max("found.score").alias("best_score"),
        F.array_join(span, ",").alias("spans"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = materialize(secrets.candidates(docs, "doc_id", "text", "source", secrets.SecretOptions()))
    # findings of four fifths of the documents, labelled where their context is clear, and made ones
    part = found.filter(F.crc32(F.col("id").cast("string")) % 5 != 0)
    known = secrets.findings_by_rule(part).select("candidate", "before", "after", "path", "label")
    return secrets.judge_candidates(found, docs, known.unionByName(secrets.made_findings(spark)))


def op3_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.ring_shards(table(spark, sf_dir, "documents")).withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every 199th run of a document loses a letter
    options = spelling.SpellingOptions(damage=199)
    found = spelling.spelling_variants(table(spark, sf_dir, "documents"), options=options)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.learn_toxicity(docs, labels.filter(~held_out))
    found = toxicity.score_toxicity(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "clauses")


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # NULL where a BIGINT cannot hold it; `deviation_exact` always can
    return found.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_lid_compression,
        op2_line_quality,
        op3_ring_shards,
        op4_simhash_covering,
        op5_soft_mixing,
        op6_exact_top_k,
        op7_license_scan,
        op8_sentencepiece,
        op9_pii,
        op10_secret_scan,
        op11_spelling_variants,
        op12_toxicity_grammar,
        op13_feast_whitening,
    )
}

ORACLE = {"op2_line_quality": _OP2_SQL, "op6_exact_top_k": _OP6_SQL}

"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lingmill.llm import lid, licenses, line_quality, mixing, pieces, pii, queries, ring, secrets, simhash, topk

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, row string, fp long, h1 long, host string, shard string, spans string, rate string"
)
LONG = "lang wort und noch ein wort " * 20000


def rows(*docs):
    return [(i, t, la, s, len(t or ""), 1, "r", 2, 3, "h", "s", "x", "y") for i, t, la, s in docs]


DOCS = rows(
    (1, "the cat sat on the mat and then it ran off to the barn " * 6, "en", "a"),
    (1, "the cat sat on the mat and then it ran off to the barn " * 6, "en", "a"),
    (2, "le chat est sur le tapis et puis il part vers la grange " * 6, "fr", "a"),
    (3, None, "en", None),
    (None, "", None, "a"),
    (4, " \t\n ", "fr", "b"),
    (5, LONG, "de", None),
    (6, "123 456 !!", None, "b"),
    (None, "mail me at a.b@example.com token = \"0f1e2d3c4b5a69788796a5b4c3d2e1f0\"", "en", "b"),
)
LABELS = "doc_id long, domain string"

OPERATORS = {
    "lid": lambda d: lid.lid_compress(d, lid.lid_dictionaries(d)),
    "line_quality": line_quality.line_quality,
    "clean_lines": line_quality.clean_lines_and_keep,
    "ring": lambda d: ring.ring_shards(d, options=ring.RingOptions(shards=3, virtual_nodes=4)),
    "simhash": simhash.near_duplicates,
    "one_of_each": simhash.one_of_each,
    "licenses": licenses.scan_licenses,
    "pii": pii.detect,
    "masked": pii.masked,
    "pieces": lambda d: pieces.encode(d, pieces.PieceModel.load(queries.PIECES)),
    "secrets": lambda d: secrets.scan_secrets(
        d, secrets.findings_by_rule(secrets.candidates(d, "doc_id", "text", "source", secrets.SecretOptions()))
    ),
    "mixing": lambda d: mixing.mixing_rates(
        d, d.sparkSession.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (None, "x"), (9, None)], LABELS), {"x": 1, "y": 1}
    ),
    "mixed": lambda d: mixing.mixed(d, d.sparkSession.createDataFrame([], LABELS), {"x": 1, "y": 1}),
}
SAME_ROWS = {"lid", "line_quality", "ring", "simhash", "licenses", "pii", "masked", "pieces", "mixing", "mixed"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    found = OPERATORS[name](spark.createDataFrame(DOCS, SCHEMA)).collect()
    if name in SAME_ROWS:
        assert len(found) == len(DOCS)
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d[0]) for d in DOCS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["clean_lines", "one_of_each", "masked", "mixed"])
def test_columns_stay(spark, name):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    assert OPERATORS[name](docs).schema.names == docs.schema.names


def test_defined_values(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    tongue = {r["doc_id"]: r for r in OPERATORS["lid"](docs).collect()}
    assert (tongue[3]["best"], tongue[3]["score"], tongue[6]["lang"]) == ("und", 0.0, "und")
    assert tongue[2]["best"] == "fr" and tongue[5]["best"] == "de"
    near = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert near[(3, 0)] == 3 and near[(4, 0)] == 3 and near[(None, 0)] == 3
    one = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert one.count(1) == 1 and 4 not in one and 3 in one
    ids = {r["doc_id"]: r for r in OPERATORS["pieces"](docs).collect()}
    assert ids[3]["ids"] is None and ids[3]["n_tokens"] == 0 and ids[5]["round_trip"]
    assert [r["is_secret"] for r in OPERATORS["secrets"](docs).collect()].count(True) == 1


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert 0 < after.count()
        if i < 4:
            assert after.columns == docs.columns
        docs = after


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, -1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (None, [1.0, 1.0]), (20, [0.5]), (7, [2.0]), (8, []), (9, [1.0, 1.0]), (9, [3.0, 0.0]),
    ]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("dim", F.lit(1))
    small = topk.TopKOptions(k=3, shard_rows=2, query_rows=1, fan_in=2)
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, options=small).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == [(0, 1, 9, 3 * 4096), (0, 2, 1, 4096), (0, 3, 2, 4096), (20, 1, 7, 32 * 128)]
    assert topk.top_k(table.limit(0), F.col("vec_id") == 0).collect() == []

"""The toxicity grammar: the machine against its transducers one after another, clauses, learning, held-out rows."""

import random

import pytest
from pyspark.sql import functions as F

from lingmill.llm import queries, toxicity
from lingmill.llm.toxicity import ToxicityModel

SF = "/root/testdata/sf0.1"
PLAIN = ToxicityModel({}, frozenset(), toxicity._NO_LABELS)


@pytest.mark.parametrize("seed", range(3))
def test_composition_equals_the_cascade(seed):
    random.seed(seed)
    machine = toxicity.grammar()
    for _ in range(300):
        symbols = random.choices(toxicity.SYMBOLS, k=random.randint(0, 25))
        text, total = symbols, 0.0
        for part in toxicity.CASCADE:
            text, weight = part()(text)
            total += weight
        assert machine(symbols) == (text, pytest.approx(total))


def weight(text):
    return PLAIN.clauses(text)[0]


def test_clauses_not_words():
    assert weight("You are an idiot.") > weight("An idiot.") > weight("You are not an idiot.") > 0
    assert weight("You are an idiot.") > weight("He said that you are an idiot.")
    assert weight("You are an idiot.") > weight('It read "you are an idiot" there.')
    assert weight("I will kill you.") > weight("They kill.") > weight("I will not kill you.")
    assert weight("The weather is good. You may sit.") == 0
    # what was said ends with its clause, a quotation with its line
    assert weight("He said so. You are an idiot.") == weight("You are an idiot.")
    assert weight('A stray " mark.\nYou are an idiot.') == weight("You are an idiot.")
    # a negation reaches three words
    assert weight("not one two three idiot") == weight("idiot") > weight("not one two idiot")


def test_model_goes_by_beginnings():
    model = ToxicityModel({"zork": 3, "plonk$": 4}, frozenset({"idiot"}), toxicity._NO_LABELS)
    assert model.clauses("zorkeln")[0] == 3 and model.clauses("plonk")[0] == 4
    assert model.clauses("plonked idiot azork")[0] == 0


def test_learns_units_and_curve(spark):
    random.seed(4)
    word = lambda: "".join(random.choices("abdelmnorst", k=random.randint(3, 7)))
    rows = []
    for i in range(1200):
        words = [word() for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            words[random.randrange(40)] = "zorg" + random.choice(["en", "ig", "heit", "lich"])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn_toxicity(docs.select("doc_id", "text"), docs.filter("doc_id < 900"))
    assert set(model.units) == {"zorg"}
    found = toxicity.score_toxicity(docs.filter("doc_id >= 900"), model).join(docs, "doc_id")
    assert found.filter("predicted != toxic").count() == 0
    again = toxicity.learn_toxicity(docs.select("doc_id", "text"), docs.filter("doc_id < 900"))
    assert again.units == model.units and again.curve == model.curve


def test_held_out_documents(spark):
    found = queries.op12_toxicity_grammar(spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = rows.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    held = rows.filter("held_out").withColumn("marked", F.rlike("text", F.lit("(?i)(idiot|moron|scum|loser|trash|clown|stupid|pathetic|worthless|disgusting)")))
    # some labels of these tables stand on documents without any such word
    hits = held.agg(F.sum((F.col("marked") & (F.col("toxic") == 1)).cast("int")), F.sum((F.col("marked") & (F.col("toxic") == 1) & (F.col("predicted") == 1)).cast("int")),
                    F.sum((F.col("toxic") == 0).cast("int")), F.sum(((F.col("toxic") == 0) & (F.col("predicted") == 1)).cast("int"))).first()
    assert hits[0] > 40 and hits[1] >= 0.95 * hits[0] and hits[3] <= 0.02 * hits[2]


def test_odd_rows(spark):
    long = "word and more words " * 50000 + "you idiot"
    docs = [(1, None), (2, ""), (2, ""), (None, "You are an idiot!"), (3, long), (4, "x" * 500000), (5, "\n\n!!\"\"")]
    table = spark.createDataFrame([(i, t, 1.0, "u") for i, t in docs], "doc_id long, text string, score double, unit string")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1), (2, 7)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(table, labels)
    rows = toxicity.score_toxicity(table, model).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert by_id[1]["score"] == by_id[2]["score"] == by_id[4]["score"] == by_id[5]["score"] < 0.1
    assert by_id[None]["predicted"] == by_id[3]["predicted"] == 1
    assert not toxicity.score_toxicity(table.limit(0), model).collect()
    assert toxicity.learn_toxicity(table.limit(0), labels).units == {}

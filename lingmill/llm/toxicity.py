"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insults of four strengths, threats, targets, words of intent, negations, verbs of saying, quotation
marks, ends of clauses and lines, and all others. Five transducers read them one after another: reported speech and
negation rewrite what they cover, targets add to insults near them, and insults and threats give the weights. Their
composition is one machine, which is built once and reads every text in one pass, symbol by symbol. What counts is
the weight of whole clauses: an insult that is denied or quoted weighs little, one aimed at somebody more.

Which words insult is learned from labelled documents: words, and beginnings of words for languages that inflect,
that toxic documents have significantly more often. A logistic curve over the best clause and the sum of all clauses
makes the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize

# Words with a part in the grammar, in English, German, French and Spanish.
INSULTS = "idiot idiots moron morons imbecile scumbag loser losers dumbass trottel vollidiot abruti connard crétin imbécil gilipollas estúpido".split()
THREATS = "kill hurt strangle stab shoot murder töten umbringen erschießen tuer égorger matar apuñalar".split()
TARGETS = "you your yours u him her them they du dich dir euch ihn vous toi ton tu te usted ustedes vosotros".split()
INTENT = "will gonna going shall must should werde wirst vais allons voy vamos".split()
NEGATIONS = "not no never isn't aren't don't doesn't didn't wasn't cannot can't without nicht kein keine nie niemals pas jamais sans nunca jamás sin".split()
REPORTING = (
    "said says say called calls wrote writes quoted claimed claims accused sagte sagt nannte nennt schrieb behauptete "
    "disait appelait écrivait prétend dijo llamó escribió afirma"
).split()

LEVELS = ("1", "2", "3", "4")
_PLAIN = ("O", "Y", "W", "E")
SYMBOLS = (*_PLAIN, "N", "R", "Q", "L", "T", *(f"I{x}" for x in LEVELS))
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«».!?;\n]")
_MARKS = {"\n": "L", **dict.fromkeys(".!?;", "E"), **dict.fromkeys("\"“”„«»", "Q")}
#: Symbols of words that a task remembers.
_REMEMBERED = 1 << 18


@dataclass(frozen=True)
class ToxicityOptions:
    """`train_rows` bounds the labelled rows that are learned from: half of them of each label, one per hash bucket, and
    of those units of words in `support` toxic rows or more, `entries` of them. `margin` is what the evidence for a
    unit must have beyond the logarithm of the number of units that were tried, `odds` the logarithm of how much more
    of the toxic rows than of the others must have it, `shortest` and `longest` the letters of a beginning."""

    train_rows: int = 16000
    support: int = 4
    margin: float = 4.0
    odds: float = 2.0
    entries: int = 20000
    shortest: int = 4
    longest: int = 9
    ridge: float = 0.02


@dataclass(frozen=True)
class Transducer:
    """A sequential transducer: for each state and input symbol the next state, the output symbol and a weight. Starts
    in state 0."""

    arcs: list[dict[str, tuple[int, str, float]]]

    def __call__(self, symbols: Iterable[str]) -> tuple[list[str], float]:
        state, out, total = 0, [], 0.0
        for symbol in symbols:
            state, symbol, weight = self.arcs[state][symbol]
            out.append(symbol)
            total += weight
        return out, total


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that reads as `first` does and writes what `second` makes of it; weights add up."""
    number, arcs, todo = {(0, 0): 0}, [], [(0, 0)]
    for a, b in todo:
        row = {}
        for symbol, (a2, between, w1) in first.arcs[a].items():
            b2, out, w2 = second.arcs[b][between]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            row[symbol] = (number[a2, b2], out, w1 + w2)
        arcs.append(row)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """Insults (I) and threats (T) behind a verb of saying in the same clause, or between quotation marks in the same
    line, become reported ones (r, rT)."""
    arcs = []
    for state in (0, 1, 2):  # plain, behind a verb of saying, quoted
        row = {}
        for x in SYMBOLS:
            after = {"L": 0, "E": 2 * (state == 2), "Q": 0 if state == 2 else 2, "R": state or 1}.get(x, state)
            out = {"R": "O", "Q": "O", "L": "E"}.get(x, x)
            if state and x[0] in "IT":
                out = f"r{x[1:]}" if x[0] == "I" else "rT"
            row[x] = (after, out, 0.0)
        arcs.append(row)
    return Transducer(arcs)


def negation(window: int = 3) -> Transducer:
    """Insults and threats up to `window` words behind a negation become denied ones (n, nT)."""
    reads = (*_PLAIN, "N", "T", "rT", *(f"{k}{x}" for k in "Ir" for x in LEVELS))
    arcs = []
    for left in range(window + 1):
        row = {}
        for x in reads:
            after = {"N": window, "E": 0}.get(x, max(left - 1, 0))
            out = "O" if x == "N" else x
            if left and x[0] in "IT":
                out = f"n{x[1:]}" if x[0] == "I" else "nT"
            row[x] = (after, out, 0.0)
        arcs.append(row)
    return Transducer(arcs)


_SCORED = (*_PLAIN, "T", "rT", "nT", *(f"{k}{x}" for k in "Irn" for x in LEVELS))


def target(window: int = 4, bonus: float = 1.0) -> Transducer:
    """A target and an insult at most `window` words apart, either first, weigh `bonus` more."""
    states = [("", 0), *((kind, left) for kind in "YI" for left in range(1, window + 1))]
    arcs = []
    for kind, left in states:
        row = {}
        for x in _SCORED:
            weight, after = 0.0, (kind, left - 1) if left > 1 else ("", 0)
            if x == "E":
                after = ("", 0)
            elif x == "Y":
                weight, after = bonus * (kind == "I"), ("Y", window)
            elif x[0] == "I":
                weight, after = bonus * (kind == "Y"), after if kind == "Y" and after[1] else ("I", window)
            row[x] = (states.index(after), x, weight)
        arcs.append(row)
    return Transducer(arcs)


def insult(reported: float = 0.4, denied: float = 0.25) -> Transducer:
    """Insults weigh their strength, reported and denied ones a part of it."""
    part = {"I": 1.0, "r": reported, "n": denied}
    row = {x: (0, "O", float(x[1]) * part[x[0]]) if x[0] in part and x[1] in LEVELS else (0, x, 0.0) for x in _SCORED}
    return Transducer([row])


def threat(window: int = 3) -> Transducer:
    """A threat weighs 0.5, behind a word of intent 2, and 2 more with a target up to `window` words behind it; a reported
    or denied one 0.25."""
    reads = (*_PLAIN, "T", "rT", "nT")
    states = [(a, b) for a in range(window + 1) for b in range(window + 1)]  # left of intent, left of threat
    arcs = []
    for intent, threatened in states:
        row = {}
        for x in reads:
            weight, after = 0.0, (max(intent - 1, 0), max(threatened - 1, 0))
            if x == "E":
                after = (0, 0)
            elif x == "W":
                after = (window, after[1])
            elif x == "T":
                weight, after = 2.0 if intent else 0.5, (after[0], window)
            elif x == "Y" and threatened:
                weight, after = 2.0, (after[0], 0)
            elif x in ("rT", "nT"):
                weight = 0.25
            row[x] = (states.index(after), "O" if x[-1] == "T" else x, weight)
        arcs.append(row)
    return Transducer(arcs)


CASCADE = (reported_speech, negation, target, insult, threat)


def grammar() -> Transducer:
    made = [part() for part in CASCADE]
    machine = made[0]
    for part in made[1:]:
        machine = compose(machine, part)
    return machine


def units_of(word: str, options: ToxicityOptions) -> list[str]:
    """A word with an end mark, and its beginnings."""
    return [f"{word}$", *(word[:k] for k in range(options.shortest, min(len(word), options.longest) + 1))]


def words_of(text: str | None) -> set[str]:
    return {t for t in _TOKEN.findall((text or "").lower()) if t not in _MARKS}


@dataclass
class ToxicityModel:
    """`units`: the strength (1 to 4) of each insulting word (ends in $) or beginning; `without`: fixed insults that the labels
    speak against. `curve`: bias, weight of the best clause and weight of the sum."""

    units: dict[str, int]
    without: frozenset[str]
    curve: tuple[float, float, float]
    options: ToxicityOptions = ToxicityOptions()
    _known: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        number = {x: i for i, x in enumerate(SYMBOLS)}
        machine = grammar()
        self._next = [[row[x][0] for x in SYMBOLS] for row in machine.arcs]
        self._weight = [[row[x][2] for x in SYMBOLS] for row in machine.arcs]
        self._number = number
        self._fixed = {
            **dict.fromkeys(TARGETS, "Y"), **dict.fromkeys(INTENT, "W"), **dict.fromkeys(NEGATIONS, "N"),
            **dict.fromkeys(REPORTING, "R"), **dict.fromkeys(THREATS, "T"), **_MARKS,
            **{w: "I2" for w in INSULTS if w not in self.without},
        }

    def symbol(self, token: str) -> str:
        strength = max((self.units.get(u, 0) for u in units_of(token, self.options)), default=0)
        fixed = self._fixed.get(token, "O")
        if strength and fixed[0] in "OI":
            return f"I{max(strength, int(fixed[1]) if fixed[0] == 'I' else 0)}"
        return fixed

    def clauses(self, text: str | None) -> tuple[float, float, int]:
        """The weights of the best clause and of all clauses, and how many have any."""
        known, number, next_, weights = self._known, self._number, self._next, self._weight
        ends = (number["E"], number["L"])
        state, clause, best, total, matched = 0, 0.0, 0.0, 0.0, 0
        # one line after another, so that a long text is never held as one list of words
        for line in (text or "").lower().split("\n"):
            for token in _TOKEN.findall(line):
                x = known.get(token)
                if x is None:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    x = known[token] = number[self.symbol(token)]
                clause += weights[state][x]
                state = next_[state][x]
                if x in ends and clause:
                    best, total, matched, clause = max(best, clause), total + clause, matched + 1, 0.0
            x = number["L"]
            state = next_[state][x]
            if clause:
                best, total, matched, clause = max(best, clause), total + clause, matched + 1, 0.0
        return best, total, matched

    def score(self, best: float, total: float) -> float:
        bias, a, b = self.curve
        return 1 / (1 + math.exp(-min(max(bias + a * best + b * math.log1p(total), -500), 500)))


#: The curve where there is nothing to learn from: a clause of weight 3 has a score of about a half.
_NO_LABELS = (-3.0, 0.8, 0.4)


def _drawn(docs: DataFrame, labelled: DataFrame, id_col: str, text: str, label: str, options: ToxicityOptions) -> tuple[DataFrame, dict[int, int]]:
    """(id, text, label) of the drawn rows, and how many ids have each label. Of several labels of an id 1 counts."""
    labels = (
        labelled.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .withColumn("h", F.xxhash64("id"))
    )
    labels = materialize(labels)
    half = max(1, options.train_rows // 2)
    least = labels.groupBy("label", F.pmod("h", F.lit(half)).alias("bucket")).agg(F.min(F.struct("h", "id")).alias("least"))
    # train_rows ids at most, so the texts are not shuffled for them
    chosen = F.broadcast(least.select(F.col("least.id").alias("id"), "label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(chosen, "id")
    return materialize(rows.dropDuplicates(["id"])), {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}


#: Hashes by which near copies are told; each is the smallest over a text's runs of three words.
_SKETCH = 4


def _smallest(text: str | None) -> list[int]:
    words = [t for t in _TOKEN.findall((text or "").lower()) if t not in _MARKS]
    runs = {" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(r) for r in runs), dtype="<u8")
    mixed = [hashes * np.uint64(2 * k + 0x9E3779B97F4A7C15) ^ (hashes >> np.uint64(7 + k)) for k in range(_SKETCH)]
    return [int(m.min().view("<i8")) for m in mixed]


def _different(rows: DataFrame) -> DataFrame:
    """`rows` without most near copies: of those of a label that share a smallest hash the one with the least id stays.

    A group of copies is one observation; taken as many, all its rare words would look like evidence.
    """

    @F.pandas_udf("array<long>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_smallest(t) for t in batch], dtype=object)

    keys = materialize(rows.select("id", "label", sketch("text").alias("s")))
    for k in range(_SKETCH):
        least = keys.groupBy("label", F.col("s")[k].alias("m")).agg(F.min("id").alias("id"))
        keys = keys.join(least.select("id", "label"), ["id", "label"], "left_semi")
    return materialize(rows.join(F.broadcast(keys.select("id")), "id", "left_semi"))


def _evidence(yes: Column, no: Column, all_yes: int, all_no: int) -> Column:
    """How much likelier the counts are if a unit has its own share of toxic rows than if it has that of all rows."""
    share = all_yes / (all_yes + all_no)
    own = yes / (yes + no)
    return yes * F.log(own / share) + F.when(no > 0, no * F.log((1 - own) / (1 - share))).otherwise(0.0)


def learn_toxicity(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    options: ToxicityOptions = ToxicityOptions(),
) -> ToxicityModel:
    """Insulting units and the curve, from the rows of `docs` that `labelled` (`id_col`, `label`: 1 toxic, 0 not) tells of.

    Rows with a NULL id or another label teach nothing. Without rows of both labels only the fixed words count.
    """
    rows, shares = _drawn(docs, labelled, id_col, text, label, options)
    rows = _different(rows)
    got = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    yes_rows, no_rows = got.get(1, 0), got.get(0, 0)
    if not yes_rows or not no_rows:
        return ToxicityModel({}, frozenset(), _NO_LABELS, options)

    @F.pandas_udf("array<string>")
    def units(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([sorted({u for w in words_of(t) for u in units_of(w, options)}) for t in batch], dtype=object)

    counted = rows.select("label", F.explode(units("text")).alias("unit")).groupBy("unit").agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")
    )
    counted = materialize(counted)
    tried = counted.count()
    yes, no = F.col("yes"), F.col("no")
    # counts of the draw, as if as many rows of each label had been drawn as there are
    odds = F.log((yes + 0.5) / (yes_rows + 1.0)) - F.log((no + 0.5) / (no_rows + 1.0))
    enough = (yes >= options.support) & (odds > options.odds) & (_evidence(yes, no, yes_rows, no_rows) > math.log(max(tried, 1)) + options.margin)
    fixed = F.col("unit").isin(*(f"{w}$" for w in INSULTS))
    learned = counted.withColumn("odds", odds).withColumn("enough", enough).filter(F.col("enough") | fixed)
    found = learned.orderBy(F.desc("enough"), F.desc("yes"), "unit").limit(options.entries).collect()
    without = frozenset(r["unit"][:-1] for r in found if not r["enough"] and r["no"] >= options.support and r["odds"] < 0.5)
    chosen = {r["unit"]: (r["yes"], r["no"]) for r in found if r["enough"]}
    strengths = _strengths(chosen, yes_rows, no_rows, options)
    model = ToxicityModel(strengths, without, _NO_LABELS, options)
    weighed = rows.select("label", grammar_scores(F.col("text"), model).alias("g")).select("label", "g.best", "g.total").toPandas()
    model.curve = _curve(weighed, shares, options.ridge)
    return model


def _strengths(units: dict[str, tuple[int, int]], yes_rows: int, no_rows: int, options: ToxicityOptions) -> dict[str, int]:
    """Strength of the units that are needed: {unit: (toxic rows, others)} holds those with enough evidence.

    A beginning goes if the rows of one longer unit explain it; a longer unit goes if it does not tell
    toxic rows significantly better than the beginning that already counts.
    """

    def odds(yes: int, no: int) -> float:
        return math.log((yes + 0.5) / (yes_rows + 1)) - math.log((no + 0.5) / (no_rows + 1))

    def better(yes: int, no: int, share: float) -> float:
        own = yes / (yes + no)
        return 0.0 if own <= share else yes * math.log(own / share) + (no * math.log((1 - own) / (1 - share)) if no else 0.0)

    largest: dict[str, tuple[int, int]] = {}
    for unit, (yes, no) in units.items():
        for k in range(options.shortest, len(unit)):
            largest[unit[:k]] = max(largest.get(unit[:k], (0, 0)), (yes, no))
    own = {}
    for unit, (yes, no) in units.items():
        covered_yes, covered_no = largest.get(unit, (0, 0))
        rest = yes - covered_yes, max(no - covered_no, 0)
        if rest[0] >= options.support and odds(*rest) > options.odds:
            own[unit] = (yes, no)
    kept: dict[str, tuple[int, int]] = {}
    for unit in sorted(own, key=len):
        before = [unit[:k] for k in range(options.shortest, len(unit)) if unit[:k] in kept]
        yes, no = own[unit]
        # shares of 1 leave nothing to be better at
        if not before or better(yes, no, kept[before[-1]][0] / sum(kept[before[-1]])) > 2 * options.margin:
            kept[unit] = (yes, no)
    return {unit: min(4, max(1, round(odds(*counts) / 1.5))) for unit, counts in kept.items()}


def _curve(rows: pd.DataFrame, shares: dict[int, int], ridge: float) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; rows of a label weigh as much as all that have it."""
    rows = rows.sort_values(["label", "best", "total"])
    y = rows["label"].to_numpy(float)
    x = np.stack([np.ones(len(rows)), rows["best"].to_numpy(float), np.log1p(rows["total"].to_numpy(float))], axis=1)
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (len(y) - y.sum())) / (shares[0] + shares[1])
    penalty, beta = np.diag([1e-6, ridge, ridge]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1])), max(0.0, float(beta[2]))


def grammar_scores(text: Column, model: ToxicityModel) -> Column:
    """STRUCT(score, best, total, clauses) of a text: the score, the weights of the best and of all clauses that match, and their
    number."""
    sent = (model.units, model.without, model.curve, model.options)

    @F.pandas_udf("score double, best double, total double, clauses long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = ToxicityModel(*sent)
        for batch in batches:
            found = [own.clauses(t) for t in batch]
            yield pd.DataFrame([(own.score(b, t), b, t, n) for b, t, n in found], columns=["score", "best", "total", "clauses"])

    return of(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 if the score reaches the threshold), best, total, clauses.

    Whole texts are read. NULL and empty texts have no clause and the score of the curve's bias. Repeated rows stay repeated and
    equal texts have equal scores; an empty table gives an empty result. Other columns are neither read nor
    returned.
    """
    found = docs.select(F.col(id_col).alias(id_col), grammar_scores(F.col(text), model).alias("g"))
    return found.select(
        id_col, "g.score", (F.col("g.score") >= threshold).cast("int").alias("predicted"), "g.best", "g.total", "g.clauses"
    )

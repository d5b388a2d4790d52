"""Spelling variants: words of the corpus that are one edit apart, and the word each stands for.

The vocabulary is an acceptor, a transducer makes one edit (an inserted, deleted or replaced code point), and the
composition acceptor . edit . acceptor accepts exactly the pairs of words that are one edit apart. It is composed in
parts that need not know of each other: let the shorter word of a pair have m code points, parted into its first
m/2 and the rest. One edit leaves one of the parts alone, so both words begin with the same m/2 code points, or end
with the same other ones. Every word goes to the parts of its own length and of the length below, forwards by how it
begins and, read backwards, by how it ends; those of one part leave the same state of the whole acceptor. Within a
part the acceptors are minimal, and states that have no word in common behind an edit are not entered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SpellingOptions:
    """Code points and occurrences that a word needs, how many times as often as a word its form occurs, and, to
    plant misspellings, of how many runs in their documents one loses a letter (none: no run does)."""

    min_length: int = 6
    min_count: int = 5
    ratio: int = 5
    damage: int | None = None


class Acceptor:
    """Minimal acyclic acceptors that share their states: `arcs` of each state, and whether it is `final`."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def add(self, words: list[str]) -> int:
        """The first state of an acceptor of `words`, which are different and in order of code points."""
        open_: list[list] = [[{}, False]]  # the states along the last word
        last = ""

        def close(depth: int) -> None:
            while len(open_) > depth + 1:
                arcs, final = open_.pop()
                open_[-1][0][last[len(open_) - 1]] = self._state(arcs, final)

        for word in words:
            same, most = 0, min(len(word), len(last))
            while same < most and word[same] == last[same]:
                same += 1
            close(same)
            open_.extend([{}, False] for _ in range(len(word) - same))
            open_[-1][1] = True
            last = word
        close(0)
        return self._state(*open_[0])


class OneEdit:
    """The composition of two acceptors with a transducer that replaces or inserts one code point."""

    def __init__(self, states: Acceptor) -> None:
        self.arcs, self.final = states.arcs, states.final
        self._meets: dict[tuple[int, int], bool] = {}

    def meets(self, s: int, t: int) -> bool:
        """Whether some rest of a word is accepted from both states."""
        known, todo = self._meets, [(s, t)]
        while todo:
            pair = todo[-1]
            if pair not in known:
                x, y = pair
                nexts = [(self.arcs[x][c], self.arcs[y][c]) for c in self.arcs[x] if c in self.arcs[y]]
                if x == y or self.final[x] and self.final[y] or any(known.get(n) for n in nexts):
                    known[pair] = True
                elif (first := next((n for n in nexts if n not in known), None)) is not None:
                    todo.append(first)
                    continue
                else:
                    known[pair] = False
            todo.pop()
        return known[s, t]

    def common(self, s: int, t: int, but: str = "") -> Iterator[str]:
        """The rests that are accepted from both states, without those that begin with `but`."""
        todo, path = [(s, t, 0, "")], []
        while todo:
            x, y, depth, c = todo.pop()
            path[max(depth - 1, 0) :] = [c] if depth else []
            if self.final[x] and self.final[y]:
                yield "".join(path)
            for c, x2 in self.arcs[x].items():
                y2 = self.arcs[y].get(c)
                if y2 is not None and not (depth == 0 and c == but) and self.meets(x2, y2):
                    todo.append((x2, y2, depth + 1, c))

    def pairs(self, s: int, t: int) -> Iterator[tuple[str, str]]:
        """(a, b): a accepted from s, b from t, b one code point longer or as long and then greater.

        Of the places where one code point may have been inserted the last counts, so no pair comes twice.
        """
        todo, path = [(s, t, 0, "")], []
        while todo:
            x, y, depth, c = todo.pop()
            path[max(depth - 1, 0) :] = [c] if depth else []
            for b, y2 in self.arcs[y].items():
                if self.meets(x, y2):
                    before = "".join(path)
                    for rest in self.common(x, y2, but=b):
                        yield before + rest, before + b + rest
                for a, x2 in self.arcs[x].items():
                    if a < b and self.meets(x2, y2):
                        before = "".join(path)
                        for rest in self.common(x2, y2):
                            yield before + a + rest, before + b + rest
                x2 = self.arcs[x].get(b)
                if x2 is not None:
                    todo.append((x2, y2, depth + 1, b))


def one_edit_pairs(shorter: list[str], longer: list[str]) -> Iterator[tuple[str, str]]:
    """The pairs (a, b) one edit apart: a of `shorter`, b of `longer`, or of `shorter` and greater.

    All words of `shorter` have one length, all of `longer` have one code point more; both lists hold
    different words in order of code points.
    """
    states = Acceptor()
    first = states.add(shorter)
    both = states.add(sorted(shorter + longer)) if longer else first
    yield from OneEdit(states).pairs(first, both)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", options: SpellingOptions = SpellingOptions()) -> DataFrame:
    """(word, n): words of `min_length` code points or more that occur `min_count` times or more in all texts.

    Words are the longest runs of `A-Z a-z` and U+00C0 to U+00FF; only A-Z become small. With `damage` a run loses the
    code point at h modulo its length if `damage` divides h, the CRC-32 of id, colon and run (a NULL id: of colon and
    run). NULL and empty texts have no words; repeated rows count each. Counts combine before the shuffle.
    """
    shortest = options.min_length
    run = F.lit(rf"[A-Za-zÀ-ÿ]{{{shortest},}}+")
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), run, F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if options.damage is not None:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word")))
        at = (F.col("h") % F.length("word")).cast("int")
        without = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("word", F.when(F.col("h") % options.damage == 0, without).otherwise(F.col("word")))
        runs = runs.filter(F.length("word") >= shortest)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= options.min_count)


def _parts(vocabulary: DataFrame) -> DataFrame:
    """(part, back, m, w, n): every word in the parts where it can meet another one; `w` is read backwards if `back`."""
    size, word = F.length("word"), F.col("word")

    def part(m: Column, back: bool) -> Column:
        half = F.floor(m / 2).cast("int")
        key = F.substring(F.reverse(word), F.lit(1), m - half) if back else F.substring(word, F.lit(1), half)
        w = F.reverse(word) if back else word
        return F.struct(F.xxhash64(F.lit(back), m, key).alias("part"), F.lit(back).alias("back"), m.alias("m"), w.alias("w"))

    # as the longer word of a pair it goes where a word of one code point less goes
    places = F.array(*(part(m, back) for m in (size, size - 1) for back in (False, True)))
    return vocabulary.select(F.explode(places).alias("p"), "n").select("p.*", "n").filter("m > 0")


def _compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of each part; rows come sorted by part and word."""
    columns = ["a", "b", "n_a", "n_b"]
    out: list[tuple] = []

    def compose(group: list[tuple[bool, int, str, int]]) -> None:
        back, m = group[0][:2]
        count = {w: n for _, _, w, n in group}
        words = list(count)
        shorter, longer = [w for w in words if len(w) == m], [w for w in words if len(w) > m]
        if not shorter or len(words) < 2:
            return
        half = m // 2
        for a, b in one_edit_pairs(shorter, longer):
            if back:
                x, y = a[::-1], b[::-1]
                if x[:half] != y[:half]:  # others are found forwards
                    out.append((x, y, count[a], count[b]))
            else:
                out.append((a, b, count[a], count[b]))

    held, last = [], None
    for batch in batches:
        for part, back, m, w, n in batch[["part", "back", "m", "w", "n"]].itertuples(index=False, name=None):
            if (part, back, m) != last:
                if len(held) > 1:
                    compose(held)
                held, last = [], (part, back, m)
            held.append((back, m, w, n))
        if len(out) > 10000:
            yield pd.DataFrame(out, columns=columns)
            out.clear()
    if len(held) > 1:
        compose(held)
    yield pd.DataFrame(out, columns=columns)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): every two words of `vocabulary` (word, n; different words) that are one edit apart, once.

    An empty vocabulary has no pairs. Nothing is cut off: a part holds the words that share half of their
    letters, and all its pairs are found.
    """
    parts = _parts(vocabulary.filter("word is not null"))
    dealt = parts.repartition("part").sortWithinPartitions("part", "back", "m", "w")
    return dealt.mapInPandas(_compose, "a string, b string, n_a long, n_b long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: forms are followed, twice as far in each round.

    A form occurs `ratio` times as often as its word, so no chain is longer than the logarithm of the counts.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if roots.filter("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", options: SpellingOptions = SpellingOptions()
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary, see `word_counts`.

    `n_near` counts the words one edit away. The form of a word is the most frequent of them (ties: the smallest in
    code-point order), if it occurs `ratio` times as often or more, else NULL. `root` follows forms to the last; it is the
    word itself where there is no form. An empty table, or one of NULL and empty texts, gives an empty
    result. Columns other than those named are not read.
    """
    vocabulary = materialize(word_counts(docs, id_col, text, options))
    pairs = materialize(near_words(vocabulary))
    sides = pairs.select(F.col("a").alias("word"), F.col("n_b").alias("m"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_a").alias("m"), F.col("a").alias("other"))
    )
    near = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("best")
    )
    found = vocabulary.join(near, "word", "left")
    often = -F.col("best.less")
    is_form = often >= options.ratio * F.col("n")
    found = materialize(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, often).alias("form_n"),
        )
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

"""Spelling variants against pairs found by trying every edit of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from lingmill.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def one_apart(a, b):
    """Equal length and one place differs, or one code point of the longer one left out gives the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(6))
def test_composition_finds_every_pair_once(seed):
    random.seed(seed)
    letters = "ab" if seed % 2 else "aàb-z"
    m = 2 + seed
    make = lambda k: sorted({"".join(random.choices(letters, k=k)) for _ in range(60)})
    shorter, longer = make(m), make(m + 1)
    want = {(a, b) for a in shorter for b in longer if one_apart(a, b)}
    want |= {(a, b) for a in shorter for b in shorter if a < b and one_apart(a, b)}
    found = list(spelling.one_edit_pairs(shorter, longer))
    assert len(found) == len(set(found)) and set(found) == want


def test_minimal_acceptor_shares_endings():
    states = spelling.Acceptor()
    states.add(sorted(["walking", "talking", "walked", "talked"]))
    # the first state, behind w or t, behind a, l and k, behind i and in, behind e, and the end
    assert len(states.arcs) == 1 + 1 + 3 + 2 + 1 + 1


def test_near_words(spark):
    random.seed(3)
    words = {"".join(random.choices("abcé", k=random.randint(6, 9))) for _ in range(700)}
    words |= {w[:i] + w[i + 1 :] for w in list(words)[:60] if len(w) > 6 for i in (0, 2, len(w) - 1)}
    words = sorted(words)
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    found = [tuple(sorted((r["a"], r["b"]))) for r in spelling.near_words(table).collect()]
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if abs(len(a) - len(b)) < 2 and one_apart(a, b)}
    assert len(found) == len(set(found)) and set(found) == want


def variants_by_hand(docs, options):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if options.damage and h % options.damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= options.min_length:
                n[word] += 1
    n = {w: k for w, k in n.items() if k >= options.min_count}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    out = {}
    for w in n:
        near = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_apart(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = [n[w], len(near), best if best and n[best] >= options.ratio * n[w] else None]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row += [n[row[2]] if row[2] else None, root]
    return {w: tuple(r) for w, r in out.items()}


def as_rows(found):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in found.collect()}


def test_variants_against_every_edit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = queries.op11_spelling_variants(spark, SF)
    rows = found.collect()
    want = variants_by_hand(docs.collect(), spelling.SpellingOptions(damage=199))
    assert len(rows) == len(want) and as_rows(found) == want
    assert any(r["form"] for r in rows)


def test_chains_ties_and_odd_rows(spark):
    common, rare, rarest = "letters " * 250, "lettars " * 50, "lattars " * 10
    docs = [
        (1, common), (2, rare + rarest), (3, None), (None, ""), (4, "ab cd 12 -- " * 9), (5, "x" * 300000 + " ") , (5, "x" * 300000),
        (6, ("x" * 300000 + " ") * 3), (7, "Été " * 9 + "ÉTÉété " * 6), (8, "abcdef abcdeg abcdeh " * 5), (8, "abcdef abcdeg abcdeh " * 5),
        (9, "abcdeX " * 2), (9, "abcdeX " * 2), (9, "abcdeX " * 1),
    ]
    options = spelling.SpellingOptions()
    table = spark.createDataFrame([(i, t, "w", "f") for i, t in docs], "doc_id long, text string, word string, form string")
    found = as_rows(spelling.spelling_variants(table, options=options))
    assert found == variants_by_hand(docs, options)
    assert found["lattars"] == (10, 1, "lettars", 50, "letters")
    assert found["x" * 300000][0] == 5
    assert not spelling.spelling_variants(table.limit(0)).collect()

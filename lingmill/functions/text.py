"""Line cleaning and sentence counting as Column expressions.

A whole block of text is cleaned inside its own row (array in, array out), so
cleaning needs no shuffle and no Python worker, however large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip and re "\s" treat as
# white space. Java's own "\s" knows the ASCII ones only.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# The same without the blank, as what is not in the ranges around it: quick for common letters.
_OTHER_SPACE = (
    r"[^\x20-\x84\x0e-\x1b\x00-\x08\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff\u3001-\x{10ffff}]"
)

# The letters that count for the letter-case shares. The
# "reference" alphabet has no "p" and has "b" twice, and results depend on it.
ALPHABETS = {
    "reference": "abcdefghijklmnobqrstuvwxyz",
    "ascii": "abcdefghijklmnopqrstuvwxyz",
}

# Marks that end or divide a sentence.
SENTENCE_MARKS = ".,!?"

_SENTENCE_BREAK = "\x01"


def strip(text: Column) -> Column:
    """Cut Unicode white space at both ends."""
    # the ends are looked at first: a regular expression for the end of a text tries every
    # white space inside it
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    cut = F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")
    return F.when(F.rlike(ends, F.lit(WHITESPACE)), cut).otherwise(text)


def collapse_whitespace(text: Column) -> Column:
    """Turn every run of white space into one blank."""
    # most lines have single blanks only and stay as they are
    needed = F.contains(text, F.lit("  ")) | F.rlike(text, F.lit(_OTHER_SPACE))
    return F.when(needed, F.regexp_replace(text, f"{WHITESPACE}+", " ")).otherwise(text)


def char_count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _repeats(alphabet: str) -> str:
    """What an alphabet lists beyond the first time."""
    return "".join(c for i, c in enumerate(alphabet) if c in alphabet[:i])


def letter_count(line: Column, alphabet: str) -> Column:
    """How many characters of `line` are in `alphabet`, each as often as it is listed there."""
    letters = "".join(sorted(set(alphabet)))
    total = F.length(F.regexp_replace(line, f"[^{letters}]+", ""))
    for char in _repeats(alphabet):
        total = total + char_count(line, char)
    return total


def _letter_bound(line: Column, alphabet: str) -> Column:
    """A cheap upper bound of `letter_count`: as if all but the blanks were letters."""
    total = F.length(F.replace(line, F.lit(" "), F.lit("")))
    for char in _repeats(alphabet):
        total = total + char_count(line, char)
    return total


def lower_count(line: Column, alphabet: str = "reference") -> Column:
    return letter_count(line, ALPHABETS[alphabet])


def upper_count(line: Column, alphabet: str = "reference") -> Column:
    return letter_count(line, ALPHABETS[alphabet].upper())


def mark_count(line: Column) -> Column:
    """Number of sentence marks in the line."""
    return F.length(F.regexp_replace(line, f"[^{SENTENCE_MARKS}]+", ""))


def long_enough(line: Column, min_len: int = 50) -> Column:
    return F.length(line) >= min_len


def case_shares_ok(
    line: Column,
    max_lower: float = 0.95,
    max_upper: float = 0.2,
    alphabet: str = "reference",
) -> Column:
    """Neither too many lower-case nor too many upper-case letters.

    Shares are compared as whole numbers in units of 1/10000, so that a line that sits
    exactly on a limit is kept on every engine.
    """
    n = F.length(line).cast("bigint")

    def at_most(count: Column, share: float) -> Column:
        return count.cast("bigint") * 10000 <= n * round(share * 10000)

    # blanks alone keep most lines below the lower-case limit; only else are letters counted
    low = at_most(_letter_bound(line, ALPHABETS[alphabet]), max_lower)
    low = low | at_most(lower_count(line, alphabet), max_lower)
    return low & at_most(upper_count(line, alphabet), max_upper)


def not_cut_off(line: Column, bad_suffix: str = "...") -> Column:
    return ~F.endswith(line, F.lit(bad_suffix))


def keep_line(
    line: Column,
    min_len: int = 50,
    max_lower: float = 0.95,
    max_upper: float = 0.2,
    bad_suffix: str = "...",
    min_marks: int = 0,
    alphabet: str = "reference",
) -> Column:
    """The whole test for one stripped line; the cheap checks come first."""
    keep = long_enough(line, min_len) & not_cut_off(line, bad_suffix)
    if min_marks > 0:
        keep = keep & (mark_count(line) >= min_marks)
    return keep & case_shares_ok(line, max_lower, max_upper, alphabet)


def stripped_lines(block: Column) -> Column:
    """The lines of a block, stripped, without empty ones, in order."""
    lines = F.transform(F.split(block, "\n"), strip)
    return F.filter(lines, lambda x: x != "")


def clean_block(block: Column, distinct: bool = True, **rules) -> Column:
    """ARRAY of the clean lines of one block; see `keep_line` for the rules.

    Lines keep their order of appearance. With `distinct` a line is kept once per block.
    """
    kept = F.filter(stripped_lines(block), lambda x: keep_line(x, **rules))
    lines = F.transform(kept, collapse_whitespace)
    return F.array_distinct(lines) if distinct else lines


def paragraphs(text: Column) -> Column:
    """ARRAY of paragraphs: parted by blank lines, line wraps undone except before a bullet."""
    joined = F.transform(F.split(text, "\n\n"), lambda x: F.regexp_replace(x, "\n(?![•])", ""))
    return F.transform(joined, strip)


def _marked_sentences(line: Column) -> Column:
    text = F.trim(line)
    return F.regexp_replace(text, "([.!?])[ ]+", "$1" + _SENTENCE_BREAK)


def sentences(line: Column) -> Column:
    """ARRAY of sentences: a break is `.`, `!` or `?` followed by blanks.

    This is a rule, not a trained splitter: it also breaks after abbreviations ("Mr. Smith").
    """
    return F.filter(F.split(_marked_sentences(line), _SENTENCE_BREAK), lambda s: s != "")


def sentence_counts(line: Column) -> Column:
    """STRUCT(sentences, words, characters) of one line, all BIGINT.

    Words are what stands between single blanks inside a sentence, so empty words count.
    Characters leave out the gaps between sentences. Nothing is exploded: with one break
    character per gap, sentences = breaks + 1, words = blanks + sentences.
    """
    marked = _marked_sentences(line)
    breaks = char_count(marked, _SENTENCE_BREAK)
    empty = marked == ""
    return F.struct(
        F.when(empty, 0).otherwise(breaks + 1).cast("bigint").alias("sentences"),
        F.when(empty, 0).otherwise(char_count(marked, " ") + breaks + 1).cast("bigint").alias("words"),
        (F.length(marked) - breaks).cast("bigint").alias("characters"),
    )

"""Personal data in text: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds (email, ip, card, phone) are reported wherever their pattern and validator hold. Further kinds
(iban, nanp, ssn) are reported if their score reaches `min_score`: a confirmed checksum is worth more than
a bare pattern, a word of the kind's context nearby adds to it, a word that speaks against it takes away.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which they are listed.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Kinds of the method: country code, check digits and account; ten digits in the American form; three groups.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NANP = re.compile(r"(?<![0-9+])\([2-9][0-9]{2}\)\x20?[2-9][0-9]{2}-[0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Characters of an account number by country.
IBAN_LENGTH = {
    entry[:2]: int(entry[2:])
    for entry in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 "
        "FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
        "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 "
        "RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "nanp", "ssn")

#: Words within `context_chars` of a span that speak for or against its kind.
CONTEXT = {
    "email": ("email", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "credit", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "nanp": ("phone", "tel", "call", "mobile", "fax"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = ("example", "sample", "isbn", "version", "order", "invoice", "part")
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class PiiOptions:
    """Scores of a span: `pattern` where only the pattern holds, `checked` where a checksum confirms it,
    plus `near` with a context word within `context_chars`, minus `near` with a word against it."""

    context_chars: int = 40
    pattern: float = 0.5
    checked: float = 0.8
    near: float = 0.2
    min_score: float = 0.5


def luhn(digits: str) -> bool:
    """True if the digits pass the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    """True if the account number leaves 1 when divided by 97, letters counting from A = 10."""
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int | None:
    """End of the number at `start` that passes mod 97: where its country's length ends, or else at `end`."""
    length, ends = IBAN_LENGTH.get(text[start : start + 2]), [end]
    if length:
        places = [at for at in range(start, end) if text[at] != " "]
        if len(places) >= length:
            ends.insert(0, places[length - 1] + 1)
    for at in ends:
        whole = at == len(text) or not (text[at].isascii() and text[at].isalnum())
        if whole and 15 <= len(text[start:at].replace(" ", "")) <= 34 and mod_97(text[start:at]):
            return at
    return None


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _is_ip(text: str) -> bool:
    # leading zeros go first: a part may be longer than Python turns into a number
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in text.split(".")))


def _is_card(text: str) -> bool:
    digits = _only_digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


# kind, pattern, a character without which it cannot match, validator, whether that is a checksum
_RULES = (
    ("email", EMAIL, "@", None, False),
    ("ip", IP, ".", _is_ip, False),
    ("card", CARD, "", _is_card, True),
    ("phone", PHONE, "+", lambda s: 9 <= len(_only_digits(s)) <= 15, False),
    ("iban", IBAN, "", lambda s: 15 <= len(s.replace(" ", "")) <= 34 and mod_97(s), True),
    ("nanp", NANP, "(", None, False),
    ("ssn", SSN, "-", None, False),
)
_DIGIT = re.compile("[0-9]")

# What the patterns of email and ip are made of. A search with the whole pattern would try every character of a long run of
# digits or letters as a start; these find the same places and read each run once.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Places of `EMAIL`: back from each @ as far as its first part goes, and on as far as the domain does."""
    at, after = text.find("@"), 0
    while at >= 0:
        before = text[after:at]
        start = after + len(before.rstrip(_LOCAL))
        after = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            after = domain.end()
        at = text.find("@", after)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Places of `IP`: every four neighbours of a run of numbers with dots between them, from its beginning."""
    for run in _DOTTED.finditer(text):
        if "." in run.group():
            parts, at = run.group().split("."), run.start()
            for i in range(0, len(parts) - 3, 4):
                end = at + sum(map(len, parts[i : i + 4])) + 3
                yield at, end
                at = end + 1


def _score(text: str, kind: str, start: int, end: int, checked: bool, options: PiiOptions) -> float:
    around = text[max(0, start - options.context_chars) : start] + " " + text[end : end + options.context_chars]
    words = set(_WORD.findall(around.lower()))
    score = options.checked if checked else options.pattern
    score += options.near * (not words.isdisjoint(CONTEXT[kind])) - options.near * (not words.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, score)), 6)


def find_pii(text: str | None, options: PiiOptions = PiiOptions()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start; places are code points, end exclusive.

    Matches are the leftmost that do not overlap, kind by kind; one that its validator turns down is dropped
    and the search goes on behind it. An iban may end earlier than its pattern does (`iban_end`).
    """
    found = []
    has_digit = bool(text) and _DIGIT.search(text) is not None
    for kind, pattern, needs, valid, checked in _RULES:
        if not text or needs not in text or not (has_digit or kind == "email"):
            continue
        own = _SEARCH.get(kind)
        for start, end in own(text) if own else (m.span() for m in pattern.finditer(text)):
            if valid is None or valid(text[start:end]):
                score = _score(text, kind, start, end, checked, options)
                if kind in BASE or score >= options.min_score:
                    found.append((kind, start, end, score))
    return found


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Places of the account numbers. The pattern also takes capitals and digits that follow a number, and may begin
    with a word before it; so the country's length is tried first, and if none holds the search goes on one character
    further."""
    at = 0
    while m := IBAN.search(text, at):
        end = iban_end(text, *m.span())
        if end is None:
            at = m.start() + 1
        else:
            yield m.start(), end
            at = end


#: Kinds that are not searched by their pattern alone.
_SEARCH = {"email": _emails, "ip": _ips, "iban": _ibans}


def pii_spans(text: Column, options: PiiOptions = PiiOptions()) -> Column:
    """ARRAY of STRUCT(kind, start, end, score) of a text column; empty for NULL."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long, score: double>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [
                    [dict(zip(("kind", "start", "end", "score"), s)) for s in find_pii(value, options)]
                    for value in batch
                ],
                dtype=object,
            )

    return spans(text)


def detect(docs: DataFrame, id_col: str = "doc_id", text: str = "text", options: PiiOptions = PiiOptions()) -> DataFrame:
    """One row per input row: id and `spans`.

    NULL and empty texts have none; texts of any length are searched whole. Repeated rows stay
    repeated, a NULL id stays NULL, an empty table gives an empty result. Other columns are not read.
    """
    return docs.select(F.col(id_col).alias(id_col), pii_spans(F.col(text), options).alias("spans"))


def mask_text(text: str | None, options: PiiOptions = PiiOptions()) -> str | None:
    """`text` with each span replaced by its kind in square brackets; of overlapping spans the one that starts
    first (then the longer) is replaced, and what another one has beyond it goes too. NULL stays NULL."""
    spans = sorted((start, -end, kind) for kind, start, end, _ in find_pii(text, options))
    if not spans:
        return text
    parts, at = [], 0
    for start, back, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, -back)
    return "".join(parts) + text[at:]


def masked(docs: DataFrame, text: str = "text", options: PiiOptions = PiiOptions()) -> DataFrame:
    """`docs` with all its columns and rows, personal data in `text` masked.

    NULL and empty texts stay as they are, repeated rows stay repeated, an empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([mask_text(value, options) for value in batch], dtype=object)

    return docs.withColumn(text, mask(F.col(text)))


def is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def span_digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

"""Links and head information of an HTML text, by JVM-side regular expressions."""

from __future__ import annotations

from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill.functions.bind import bind

# One attribute: name, then the value bare or in quotes. A quoted value is eaten whole, so a
# name inside another attribute's value is never taken for an attribute.
# Possessive (`++`, `*+`): such a repetition takes no stack however long the tag is.
_ATTR = r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++[^\s>]*+))?"""
_ATTRS = r"""((?:[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+)?+)"""

# A character reference: decimal, hexadecimal or named, its semicolon often left out.
_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]{0,31};?)"

# Names with the characters that they stand for, and the numbers that stand for other characters than their own, as
# HTML defines them. Both tables are taken from the standard library.
_NUMBERS = {str(n): unescape(f"&#{n};") for n in (0, 13, *range(0x80, 0xA0))}
# One text each, searched for "\0key\1": a map of this size would swell every plan that it is in.
_BY_NAME = "".join(f"\0{k}\1{v}" for k, v in html5.items()) + "\0"
_BY_NUMBER = "".join(f"\0{k}\1{v}" for k, v in _NUMBERS.items()) + "\0"
_OLD_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


def _looked_up(table: Column, key: Column) -> Column:
    """The value of a key in such a text, NULL if it has none."""
    mark = F.concat(F.lit("\0"), key, F.lit("\1"))
    value = F.call_function("substring_index", table, mark, F.lit(-1))
    value = F.substring_index(value, "\0", 1)
    return F.when(F.contains(table, mark), value)


def visible_markup(html: Column) -> Column:
    """The HTML without comments and without the content of script and style."""
    return F.regexp_replace(
        html,
        r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)",
        "",
    )


def tags(markup: Column, name: str) -> Column:
    """ARRAY of the attribute texts of all start tags called `name`, in document order."""
    return F.regexp_extract_all(markup, F.lit(rf"(?is)<{name}{_ATTRS}>"), F.lit(1))


def _attr_values(tag: Column, name: str) -> Column:
    names = F.regexp_extract_all(tag, F.lit(f"(?s){_ATTR}"), F.lit(1))
    values = F.regexp_extract_all(tag, F.lit(f"(?s){_ATTR}"), F.lit(2))
    pairs = F.zip_with(names, values, lambda n, v: F.struct(F.lower(n).alias("n"), v.alias("v")))
    return F.transform(F.filter(pairs, lambda p: p["n"] == name), lambda p: p["v"])


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute as it is written, without quotes; NULL if the tag has none; the last of several wins."""
    raw = F.try_element_at(_attr_values(tag, name), F.lit(-1))
    return F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute, see `raw_attribute`."""
    return bind(raw_attribute(tag, name), decode_entities)


def _character(number: Column, by_number: Column) -> Column:
    """The character with this number (BIGINT), as HTML reads it: replaced if it cannot be one, none if it is no text."""
    replaced = _looked_up(by_number, number.cast("string"))
    wrong = number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    silent = (
        number.between(1, 8) | number.between(0xE, 0x1F) | number.between(0x7F, 0x9F) | number.between(0xFDD0, 0xFDEF)
        | (number == 0xB) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    own = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(wrong, "\ufffd").when(replaced.isNotNull(), replaced).when(silent, "").otherwise(own)


def _decoded(reference: Column, tables: Column) -> Column:
    digits = F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1)
    # more digits than a character can have: no character, however long the number
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    base = F.when(F.rlike(reference, F.lit("^&#[xX]")), 16).otherwise(10)
    number = F.when(F.length(short) <= 8, F.conv(short, 16, 10).cast("bigint"))
    number = F.when(base == 16, number).otherwise(F.when(F.length(short) <= 8, short.cast("bigint")))
    name = F.substring(reference, 2, 40)
    # without a semicolon, the longest of the old names that the text begins with
    start = F.regexp_extract(name, f"^({_OLD_NAMES})", 1)
    return F.when(F.startswith(reference, F.lit("&#")), _character(number, tables["by_number"])).otherwise(
        F.coalesce(
            _looked_up(tables["by_name"], name),
            F.concat(_looked_up(tables["by_name"], start), F.substring(reference, F.length(start) + 2, F.lit(40))),
            reference,
        )
    )


def decode_entities(text: Column) -> Column:
    """All character references decoded, decimal, hexadecimal and named, as the standard library's `unescape` does."""
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    # the same expression parts the text, so there is one part more than there are references
    between = F.split(text, _REFERENCE)
    # the tables are named once, so that the plan holds each of them once
    tables = F.struct(F.lit(_BY_NAME).alias("by_name"), F.lit(_BY_NUMBER).alias("by_number"))
    pieces = bind(tables, lambda t: F.transform(found, lambda r, i: F.concat(F.get(between, i), _decoded(r, t))))
    whole = F.concat(F.array_join(pieces, ""), F.element_at(between, -1))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def base_and_hrefs(html: Column) -> Column:
    """STRUCT(base, hrefs): what `base_href` and `hrefs` give. The markup is cut out and references are decoded once for both."""

    def read(markup: Column) -> Column:
        written = F.filter(F.transform(tags(markup, "a"), lambda t: raw_attribute(t, "href")), lambda v: v.isNotNull())
        bases = F.filter(F.transform(tags(markup, "base"), lambda t: raw_attribute(t, "href")), lambda v: v.isNotNull())
        # most pages have no <base>: a plain test saves them the regular expressions
        base = F.when(F.rlike(html, F.lit("(?i)<base")), F.try_element_at(bases, F.lit(1)))
        values = F.transform(F.concat(F.array(base), written), decode_entities)
        return bind(values, lambda v: F.struct(F.get(v, F.lit(0)).alias("base"), F.slice(v, 2, F.size(v)).alias("hrefs")))

    return bind(visible_markup(html), read)


def hrefs(html: Column) -> Column:
    """ARRAY of the href values of all `<a href>`, in document order, copies kept."""
    return base_and_hrefs(html)["hrefs"]


def base_href(html: Column) -> Column:
    """href of the first `<base href>`, or NULL."""
    found = F.filter(
        F.transform(tags(visible_markup(html), "base"), lambda t: attribute(t, "href")),
        lambda v: v.isNotNull(),
    )
    # most pages have no <base>: a plain substring test saves them the regular expressions
    return F.when(F.rlike(html, F.lit("(?i)<base")), F.try_element_at(found, F.lit(1)))


def robots_content(html: Column) -> Column:
    """content of the first `<meta name="robots">`, NULL if there is none."""
    metas = F.filter(
        tags(visible_markup(html), "meta"),
        lambda t: attribute(t, "name") == "robots",
    )
    content = attribute(F.try_element_at(metas, F.lit(1)), "content")
    return F.when(F.rlike(html, F.lit("(?i)<meta")), content)


def html_lang(html: Column) -> Column:
    """lang attribute of the `<html>` tag, or NULL."""
    return attribute(F.try_element_at(tags(html, "html"), F.lit(1)), "lang")


def robots_directives(html: Column) -> Column:
    """STRUCT(can_index, can_follow, error) from the robots meta tag.

    No tag or an empty one allows both. The value `none` is not understood, on purpose.
    Text that cannot be read (NULL) allows neither.
    """
    known = html.isNotNull()
    return bind(
        F.lower(F.coalesce(robots_content(html), F.lit(""))),
        lambda content: F.struct(
            (known & ~F.contains(content, F.lit("noindex"))).alias("can_index"),
            (known & ~F.contains(content, F.lit("nofollow"))).alias("can_follow"),
            F.when(~known, "html is missing").when(content == "", "no robots tag").alias("error"),
        ),
    )

"""URL parts, resolution and percent coding as Column expressions.

`parse_url` is avoided on purpose: under ANSI mode it fails the job on a bad URL, and its
HOST is NULL for host names with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill.functions.bind import bind

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def netloc(url: Column) -> Column:
    """Host with port and user, letter case kept; empty if there is none."""
    return F.regexp_extract(url, _NETLOC, 1)


def origin(url: Column) -> Column:
    """`scheme://netloc`, the key of robots documents."""
    return F.concat(scheme(url), F.lit("://"), netloc(url))


def domain(url: Column) -> Column:
    """The netloc without one leading `www.`."""
    return F.regexp_replace(netloc(url), r"^www\.", "")


def registered_domain(url: Column) -> Column:
    """Last two labels of the host."""
    host = F.regexp_replace(netloc(url), r"(^.*@)|(:\d*$)", "")
    return F.substring_index(F.lower(host), ".", -2)


def robots_url(url: Column) -> Column:
    return F.concat(origin(url), F.lit("/robots.txt"))


def cut_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def cut_trailing_slash(url: Column) -> Column:
    """Remove one `/` at the end."""
    return F.regexp_replace(url, "/$", "")


def _tidy(url: Column) -> Column:
    """What a URL parser drops first: leading control characters, inner tabs and newlines."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def _path(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def _query(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^?#]*(\?[^#]+)", 1)


def drop_empty_parts(rest: Column) -> Column:
    """Remove `;`, `?` and `#` that nothing follows in their part."""
    rest = F.regexp_replace(rest, r"^([^#]*)#$", "$1")
    rest = F.regexp_replace(rest, r"^([^?#]*)\?(#.*)?$", "$1$2")
    return F.regexp_replace(rest, r"^((?:[^?#]*/)?[^/;?#]*);([?#].*)?$", "$1$2")


def _pop_dots(path: Column) -> Column:
    """Resolve `.` and `..` in a path."""

    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    # a path that ends in dots names a folder
    tail = F.when(F.rlike(path, F.lit(r"(^|/)\.\.?$")), F.array(F.lit(""))).otherwise(F.slice(kept, 1, 0))
    return F.array_join(F.concat(kept, tail), "/")


def _rooted(path: Column) -> Column:
    return F.regexp_replace(path, "^(?!/)", "/")


def _join_path(base_path: Column, path: Column) -> Column:
    # a relative path replaces what follows the last slash of the base; doubled slashes go
    merged = F.concat(F.regexp_replace(base_path, "[^/]*$", ""), path)
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.regexp_replace(merged, "/{2,}", "/"))
    return bind(
        full,
        lambda p: _rooted(F.when(F.rlike(p, F.lit(r"(^|/)\.\.?(/|$)")), _pop_dots(p)).otherwise(p)),
    )


def _resolve_on_host(base_rest: Column, rest: Column) -> Column:
    """Path, query and fragment of a link without host, from those of its base."""
    path, query = _path(rest), _query(rest)
    fragment = F.regexp_extract(rest, "(#.+)$", 1)
    # parameters (`;...` of the last segment) stay out of the dots
    bare = F.regexp_extract(path, "^((?:.*/)?[^/;]*)", 1)
    params = F.regexp_extract(path, "^(?:.*/)?+[^/;]*+(;.*)", 1)
    return F.when(path != "", F.concat(_join_path(_path(base_rest), bare), params, query, fragment)).otherwise(
        F.concat(_path(base_rest), F.when(query == "", _query(base_rest)).otherwise(query), fragment)
    )


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of `href` as seen from `base` (an http or https URL)."""

    def joined(v: Column) -> Column:
        base, href, rest = v["base"], v["href"], v["rest"]
        own, of_base = scheme(href), scheme(base)
        return (
            F.when(href == "", base)
            .when((own != "") & (own != of_base), href)
            .when(v["has_host"], F.concat(of_base, F.lit(":"), rest))
            .otherwise(
                F.concat(
                    of_base,
                    F.lit("://"),
                    netloc(base),
                    drop_empty_parts(_resolve_on_host(F.regexp_replace(base, _NETLOC, ""), rest)),
                )
            )
        )

    def parts(v: Column) -> Column:
        # the link without its scheme; an empty host is none
        bare = F.regexp_replace(v["href"], _SCHEME, "")
        # decided here: without its empty host a path may begin with two slashes as well
        has_host = F.rlike(bare, F.lit("^//[^/?#]"))
        host = F.regexp_extract(bare, "^(//[^/?#]+)", 1)
        rest = F.concat(host, drop_empty_parts(F.regexp_replace(bare, "^//[^/?#]*", "")))
        return bind(
            F.struct(v["base"].alias("base"), v["href"].alias("href"), rest.alias("rest"), has_host.alias("has_host")), joined
        )

    return bind(F.struct(_tidy(base).alias("base"), _tidy(href).alias("href")), parts)


def percent_decode(text: Column) -> Column:
    """Undo %XX; a `+` stays, and a `%` that starts no code stays."""
    # most texts have no code, and are left alone
    ready = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.contains(text, F.lit("%")), F.try_url_decode(ready)).otherwise(text)


def robots_path(url: Column) -> Column:
    """The decoded part of a URL that robots rules are compared with; `/` if empty."""
    rest = F.regexp_replace(_tidy(percent_decode(url)), _SCHEME, "")
    rest = F.regexp_replace(rest, r"^//[^/?#]*", "")
    rest = F.regexp_replace(drop_empty_parts(rest), "^//", "////")
    return F.regexp_replace(rest, "^$", "/")


def robots_rule_path(value: Column) -> Column:
    """The form of a (decoded) rule value that is compared with `robots_path`.

    The stdlib parser compares percent-quoted forms. Quoting maps each byte to a code of its
    own of which none begins another, so comparing the decoded forms decides the same.
    """
    return drop_empty_parts(_tidy(value))

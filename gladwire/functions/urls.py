"""URL functions on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions.text import _col, bind, non_empty

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_scheme(url: Column | str) -> Column:
    """Lower-case scheme, empty where there is none."""
    return F.lower(F.regexp_extract(_col(url), _SCHEME, 1))


def url_netloc(url: Column | str) -> Column:
    """Host part, empty where there is none."""
    return F.regexp_extract(_col(url), _NETLOC, 1)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _PATH, 1)


def clean_url(url: Column | str) -> Column:
    """URL without query and fragment; the scheme is lower-cased."""
    url = _col(url)
    tidy = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    bare = F.regexp_replace(tidy, r"(?s)[?#].*$", "")
    lowered = F.concat(url_scheme(bare), F.regexp_replace(bare, r"^[^:]*", ""))
    return F.when(url.rlike(r"^[\x00-\x20]*[A-Za-z0-9+.\-]*[A-Z][A-Za-z0-9+.\-]*:"), lowered).otherwise(bare)


def is_reddit_internal(url: Column | str) -> Column:
    """True where a Reddit domain occurs anywhere in the URL, query included."""
    return reduce(Column.__or__, [_col(url).contains(d) for d in fixed.REDDIT_DOMAINS])


def is_external_link(url: Column | str) -> Column:
    """True for an ``http…`` link that does not lead back to Reddit."""
    url = _col(url)
    return url.startswith("http") & ~is_reddit_internal(url) & ~url.contains(fixed.REDDIT_GALLERY)


def favicon_url(url: Column | str) -> Column:
    """Icon address of the site; null where the URL has no scheme or host."""
    scheme, netloc = non_empty(url_scheme(url)), non_empty(url_netloc(url))
    return F.concat(scheme, F.lit("://"), netloc, F.lit("/favicon.ico"))


def _fold_dots(segments: Column) -> Column:
    """Drop ``.`` segments and let ``..`` remove the segment before it."""

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    open_end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(folded, open_end)


def _drop_inner_blanks(segments: Column) -> Column:
    last = F.size(segments) - 1
    numbered = F.transform(segments, lambda s, i: F.struct(s.alias("s"), i.alias("i")))
    return F.filter(numbered, lambda e: (e["s"] != "") | (e["i"] == 0) | (e["i"] == last))["s"]


def _resolve_path(base_path: Column, path: Column) -> Column:
    """Path of a relative reference, seen from the base path."""
    folder = (
        F.when(F.contains(base_path, F.lit("/")), F.split(F.regexp_replace(base_path, r"[^/]+$", ""), "/"))
        .when(base_path == "", F.array(F.lit("")))
        .otherwise(F.array().cast("array<string>"))
    )
    relative = bind(F.concat(folder, F.split(path, "/")), _drop_inner_blanks)
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(relative)
    joined = F.array_join(bind(segments, _fold_dots), "/")
    return F.coalesce(non_empty(joined), F.lit("/"))


def _origin(base: Column) -> Column:
    """Scheme and host of a URL, as far as it has them."""
    scheme, netloc = non_empty(url_scheme(base)), non_empty(url_netloc(base))
    return F.concat(
        F.coalesce(F.concat(scheme, F.lit(":")), F.lit("")),
        F.coalesce(F.concat(F.lit("//"), netloc), F.lit("")),
    )


def make_absolute(url: Column | str, base: Column | str) -> Column:
    """The URL as seen from a page at ``base``."""
    base = _col(base)

    def resolve(url: Column) -> Column:
        scheme, path = url_scheme(base), url_path(url)
        tail = F.regexp_extract(url, r"(?s)^[^?#]*(.*)$", 1)
        has_host = url_netloc(base) != ""
        rooted = bind(
            _resolve_path(url_path(base), path),
            lambda p: F.when(has_host & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p),
        )
        query = F.when(tail.startswith("?"), F.lit("")).otherwise(
            F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
        )
        return (
            F.when(url.startswith("//"), F.concat(scheme, F.lit(":"), url))
            .when(url.startswith("http://") | url.startswith("https://"), url)
            .when(url == "", base)
            .when(base == "", url)
            .when((url_scheme(url) != "") & (url_scheme(url) != scheme), url)
            .when(path == "", F.concat(_origin(base), url_path(base), query, tail))
            .otherwise(F.concat(_origin(base), rooted, tail))
        )

    return bind(_col(url), resolve)

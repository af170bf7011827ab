"""Date functions on columns. Timestamps are UTC (the session zone is set to UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire.functions.text import _col, bind, trim_title

# fixed values: date forms in feeds, tried in this order after the weekday is cut
_FEED_FORMS = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm Z",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm",
    "d MMM yyyy",
)

# fixed values: zone names of RFC 822
_ZONES = {
    "UT": "+0000", "GMT": "+0000", "UTC": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def _parse_rfc(text: Column) -> Column:
    name = F.regexp_extract(text, r" ([A-Z]{1,3})$", 1)
    offset = F.create_map(*[F.lit(x) for pair in _ZONES.items() for x in pair])[name]
    numeric = F.when(
        offset.isNotNull(), F.concat(F.regexp_replace(text, r"[A-Z]+$", ""), offset)
    ).otherwise(text)
    return bind(
        _in_full(numeric), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(form)) for form in _FEED_FORMS])
    )


def _in_full(text: Column) -> Column:
    """Short month names, years of four digits (90-99 are the nineties), offsets without colon."""
    short = F.regexp_replace(text, r"^(\d{1,2} \p{L}{3})\p{L}*\.? ", "$1 ")
    nineties = F.regexp_replace(short, r"^(\d{1,2} \p{L}{3}) (9\d)(?= |$)", "$1 19$2")
    years = F.regexp_replace(nineties, r"^(\d{1,2} \p{L}{3}) (\d{2})(?= |$)", "$1 20$2")
    return F.regexp_replace(years, r" ([+-]\d{2}):(\d{2})$", " $1$2")


def parse_feed_date(text: Column | str) -> Column:
    """RFC-822 or ISO-8601 text as a timestamp; null where it is neither."""
    cleaned = F.regexp_replace(trim_title(text), r"^\p{L}+,\s*", "")

    def parse(text: Column) -> Column:
        iso = F.when(text.rlike(r"^\d{4}-\d{2}"), F.try_to_timestamp(text))
        return F.coalesce(iso, F.when(text.rlike(r"^\d{1,2} "), _parse_rfc(text)))

    return bind(F.regexp_replace(cleaned, r"\s+", " "), parse)


def published_or_updated(published: Column | str, updated: Column | str) -> Column:
    """The published date, or the updated date where the first is missing or unreadable."""
    return F.coalesce(parse_feed_date(published), parse_feed_date(updated))


def format_datetime(moment: Column | str) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_col(moment), "yyyy-MM-dd HH:mm:ss")


def iso_timestamp(moment: Column | str) -> Column:
    """Timestamp as ISO text with milliseconds and ``Z``."""
    return F.date_format(_col(moment), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

"""HTML functions on columns.

Tag patterns read the pages whose tags are well-formed; the others go through the
tokenizer of ``gladwire.functions.pages``. Both give the same for well-formed pages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions.pages import is_doubtful, read_page, read_pages
from gladwire.functions.text import _col, bind, non_empty, trim_title
from gladwire.functions.urls import (
    clean_url, favicon_url, is_external_link, is_reddit_internal, make_absolute,
)

# Rest of a tag up to its ">"; quoted values may hold ">".
_TAG_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Comments, scripts and styles: tags inside them are text.
_OPAQUE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"

_DIV_OR_ANCHOR = rf"(?i)<(?:a\b|/?div\b){_TAG_REST}"


def markup(html: Column | str) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(_col(html), _OPAQUE, " ")


def tags(html: Column | str, name: str) -> Column:
    """All opening tags of one element, in document order."""
    return F.regexp_extract_all(_col(html), F.lit(rf"(?i)<{name}(?=[\s/>]){_TAG_REST}"), F.lit(0))


_REFERENCE = r"&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"


def _character(reference: Column) -> Column:
    """The character of a numeric reference; the reference itself where there is none."""
    digits = F.regexp_extract(reference, r"&#[xX]?([0-9a-fA-F]+);", 1)
    is_hex = F.lower(reference).startswith("&#x")
    point = F.conv(digits, 16, 10).cast("int")
    point = F.when(is_hex, point).otherwise(digits.try_cast("int"))
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    known = F.when(valid, point).otherwise(0x20)
    character = F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")
    return F.when(valid, character).otherwise(reference)


def _numeric(text: Column) -> Column:
    """Numeric references decoded: the pieces between them, with the characters in between."""
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    pieces = F.split(text, _REFERENCE)
    joined = F.array_join(
        F.zip_with(pieces, found, lambda piece, r: F.concat(piece, F.coalesce(_character(r), F.lit("")))), ""
    )
    return F.when(F.contains(text, F.lit("&#")), joined).otherwise(text)


def _unescape(text: Column) -> Column:
    text = bind(text, _numeric)
    for coded, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _unquote(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in a tag, the last of several; null where the tag has none."""

    def find(tag: Column) -> Column:
        pairs = F.arrays_zip(
            F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)).alias("name"),
            F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2)).alias("value"),
        )
        return F.try_element_at(F.filter(pairs, lambda p: F.lower(p["name"]) == name), F.lit(-1))["value"]

    return _unescape(bind(bind(tag, find), _unquote))


def _read(html: Column | str) -> Column:
    """The page as the tokenizer reads it; null where patterns are enough."""
    html = _col(html)
    return read_page(F.when(is_doubtful(html), html))


def _named_image(metas: Column) -> Column:
    """Names are tried in a fixed order. Per name the first tag with that ``property``
    counts, else the first with that ``name``; where its content is empty the next
    name is tried, not the next tag."""

    def content_of(metas: Column, name: str) -> Column:
        by_property = F.get(F.filter(metas, lambda m: m["property"] == name), F.lit(0))
        by_name = F.get(F.filter(metas, lambda m: m["name"] == name), F.lit(0))
        return non_empty(trim_title(F.coalesce(by_property, by_name)["content"]))

    return bind(metas, lambda m: F.coalesce(*[content_of(m, n) for n in fixed.IMAGE_META_NAMES]))


def _metas(body: Column | str) -> Column:
    return F.transform(
        tags(body, "meta"),
        lambda t: F.struct(
            attribute(t, "property").alias("property"), attribute(t, "name").alias("name"),
            attribute(t, "content").alias("content"),
        ),
    )


def _usable_image(sources: Column) -> Column:
    """The first source that is not empty and not inlined as data."""
    trimmed = F.transform(sources, trim_title)
    return F.get(F.filter(trimmed, lambda s: (s != "") & ~s.startswith("data:")), F.lit(0))


def _images(body: Column | str) -> Column:
    return F.transform(tags(body, "img"), lambda t: attribute(t, "src"))


def _either(page: Column, read: Column, by_patterns: Column) -> Column:
    return F.when(page.isNotNull(), read).otherwise(by_patterns)


def meta_image(html: Column | str, page_url: Column | str) -> Column:
    """Image named in the meta tags."""
    page = _read(html)
    image = _either(page["metas"], _named_image(page["metas"]), _named_image(_metas(markup(html))))
    return make_absolute(image, page_url)


def first_img(html: Column | str, page_url: Column | str) -> Column:
    """Source of the first image that has one and is not inlined as data."""
    page = _read(html)
    image = _either(page["metas"], _usable_image(page["images"]), _usable_image(_images(markup(html))))
    return make_absolute(image, page_url)


def thumbnail(html: Column | str, page_url: Column | str) -> Column:
    """Meta image, else first image, else the site icon; the icon where there is no HTML."""
    page = _read(html)
    read = F.coalesce(_named_image(page["metas"]), _usable_image(page["images"]))
    by_patterns = bind(markup(html), lambda body: F.coalesce(_named_image(_metas(body)), _usable_image(_images(body))))
    image = make_absolute(_either(page["metas"], read, by_patterns), page_url)
    return F.coalesce(image, favicon_url(page_url))


def hrefs(html: Column | str) -> Column:
    """Link targets in document order."""
    return F.transform(tags(html, "a"), lambda t: attribute(t, "href"))


def first_external_link(links: Column | str) -> Column:
    """First external link of an array, cleaned; null where there is none."""
    return bind(F.get(F.filter(_col(links), is_external_link), F.lit(0)), clean_url)


def _outside_target(target: Column) -> Column:
    """The link of a post element, cleaned; null where it leads back to Reddit."""
    return bind(non_empty(target), lambda link: F.when(~is_reddit_internal(link), clean_url(link)))


def _post_target(body: Column) -> Column:
    return attribute(F.get(tags(body, "shreddit-post"), F.lit(0)), "content-href")


def reddit_entry_link(blocks: Column | str) -> Column:
    """External link of a post from the HTML blocks of its feed entry."""
    blocks = _col(blocks)
    pages = read_pages(F.transform(blocks, lambda b: F.when(is_doubtful(b), b)))

    def link_of(block: Column, page: Column) -> Column:
        by_patterns = bind(
            markup(block),
            lambda body: F.coalesce(_outside_target(_post_target(body)), first_external_link(hrefs(body))),
        )
        read = F.coalesce(_outside_target(page["post"]), first_external_link(page["links"]))
        return F.when(page.isNotNull(), read).otherwise(by_patterns)

    found = F.filter(F.zip_with(blocks, pages, link_of), lambda link: link.isNotNull())
    return F.get(found, F.lit(0))


def post_content_links(body: Column) -> Column:
    """Link targets inside the first ``div`` marked as post content.

    A fold over the ``div`` and ``a`` tags after that ``div`` keeps only the depth and
    the place where the ``div`` is closed.
    """
    marked = F.filter(
        tags(body, "div"), lambda t: F.coalesce(attribute(t, "data-testid") == "post-content", F.lit(False))
    )
    after = bind(
        F.get(marked, F.lit(0)), lambda tag: F.substr(body, F.instr(body, tag) + F.length(tag))
    )
    parts = F.regexp_extract_all(after, F.lit(_DIV_OR_ANCHOR), F.lit(0))

    def step(state: Column, tag: Column) -> Column:
        start = F.lower(F.substring(tag, 1, 5))
        change = F.when(start == "</div", F.lit(-1)).when(start.startswith("<div"), F.lit(1)).otherwise(F.lit(0))
        is_open = state["depth"] > 0
        return F.struct(
            F.when(is_open, state["depth"] + change).otherwise(F.lit(0)).alias("depth"),
            (state["length"] + is_open.cast("int")).alias("length"),
        )

    def inside(parts: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))
        length = F.aggregate(parts, start, step, lambda state: state["length"])
        return F.filter(F.slice(parts, F.lit(1), length), lambda tag: F.lower(F.substring(tag, 1, 2)) == "<a")

    return F.transform(bind(parts, inside), lambda tag: attribute(tag, "href"))


def reddit_page_link(html: Column | str) -> Column:
    """External link of a post from its page: post element, post content, any link."""
    page = _read(html)
    read = F.coalesce(
        _outside_target(page["post"]), first_external_link(page["content"]), first_external_link(page["links"])
    )
    by_patterns = bind(
        markup(html),
        lambda body: F.coalesce(
            _outside_target(_post_target(body)),
            first_external_link(post_content_links(body)),
            first_external_link(hrefs(body)),
        ),
    )
    return _either(page["metas"], read, by_patterns)


def reddit_page_link_or_post(html: Column | str, post_url: Column | str) -> Column:
    """Older rule: as ``reddit_page_link``, and the cleaned post URL where nothing is found."""
    return F.coalesce(reddit_page_link(html), clean_url(post_url))

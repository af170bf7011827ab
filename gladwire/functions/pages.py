"""Reading of HTML that tag patterns cannot be trusted with: a tokenizer and a stack of open elements.

Patterns (``gladwire.functions.html``) serve pages whose tags are all well-formed. Others, with unclosed or
stray quotes, named character references in attributes, unbalanced divisions or unclosed
comments, go through the tokenizer of Python's ``html.parser``, in Arrow batches. For
the first kind the function gets null, so only doubtful pages leave the JVM.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire.functions.text import _col

# An opening or closing tag without any oddity.
_TIDY_TAG = (
    r"""<(?:/[a-zA-Z][^\s<>/"']*+\s*+|[a-zA-Z][^\s<>/"']*+"""
    r"""(?:\s++[^\s<>/"'=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"'=`]++))?+)*+\s*+/?+)>"""
)
_TIDY_OPAQUE = r"(?is)<!--.*?-->|<(script|style)\b[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+)*+>.*?</\1\s*+>|<![a-z][^>]*+>"
# A reference in a tag that the patterns do not decode.
_NAMED = r"(?i)<[a-z][^<>]*?&(?:(?!(?:amp|lt|gt|quot|apos);)[a-z][a-z0-9]*+(?![a-z0-9=])|#x?[0-9a-f]++(?!;))"

PAGE = (
    "metas array<struct<property:string, name:string, content:string>>, images array<string>, "
    "links array<string>, post string, content array<string>"
)
# Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def is_doubtful(html: Column | str) -> Column:
    """Whether patterns may read the page otherwise than a tokenizer would."""
    seen = F.regexp_replace(_col(html), _TIDY_OPAQUE, " ")
    left = F.regexp_replace(seen, _TIDY_TAG, " ")
    opened, closed = F.regexp_count(seen, F.lit(r"(?i)<div[\s/>]")), F.regexp_count(seen, F.lit(r"(?i)</div[\s>]"))
    return F.rlike(left, F.lit("<[a-zA-Z/!?]")) | F.rlike(seen, F.lit(_NAMED)) | F.rlike(
        seen, F.lit(r"(?i)<(?:script|style)[\s>]")
    ) | ((opened != closed) & F.contains(seen, F.lit("post-content")))


class _Page(HTMLParser):
    """Meta tags, images, links and post content of one page, in document order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = {"metas": [], "images": [], "links": [], "post": None, "content": []}
        self.open: list[str] = []
        # place in the stack of the first division marked as post content; -1 once it is closed
        self.inside: int | None = None
        self.seen_post = False

    def handle_starttag(self, tag, attrs):
        values = {}
        for name, value in attrs:
            values[name] = value or ""
        if tag == "meta":
            self.found["metas"].append({k: values.get(k) for k in ("property", "name", "content")})
        elif tag == "img" and "src" in values:
            self.found["images"].append(values["src"])
        elif tag == "a" and "href" in values:
            self.found["links"].append(values["href"])
            if self.inside is not None and self.inside >= 0:
                self.found["content"].append(values["href"])
        elif tag == "shreddit-post" and not self.seen_post:
            self.seen_post, self.found["post"] = True, values.get("content-href")
        if tag == "div" and self.inside is None and values.get("data-testid") == "post-content":
            self.inside = len(self.open)
        if tag not in _VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        # an end tag closes the innermost element of its name with all in it, or nothing
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at] == tag:
                del self.open[at:]
                break
        if self.inside is not None and len(self.open) <= self.inside:
            self.inside = -1


def page_of(html: str | None) -> dict | None:
    """What the tokenizer finds in a page; null for null."""
    if html is None:
        return None
    page = _Page()
    page.feed(html)
    page.close()
    return page.found


def read_page(html: Column) -> Column:
    """``PAGE`` of a column of pages."""

    @F.pandas_udf(PAGE)
    def read(pages: pd.Series) -> pd.DataFrame:
        names = ("metas", "images", "links", "post", "content")
        found = [page_of(p) or dict.fromkeys(names) for p in pages]
        return pd.DataFrame({n: pd.Series([f[n] for f in found], dtype=object) for n in names})

    return read(html)


def read_pages(htmls: Column) -> Column:
    """``PAGE`` of each of an array of pages; null for null pages."""

    @F.pandas_udf(f"array<struct<{_as_struct(PAGE)}>>")
    def read(arrays: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else [page_of(p) for p in a] for a in arrays], dtype=object)

    return read(htmls)


def _as_struct(fields: str) -> str:
    """Fields of a table as fields of a struct type."""
    depth, out = 0, []
    for part in fields.split(", "):
        out.append(part.replace(" ", ":", 1) if depth == 0 else part)
        depth += part.count("<") - part.count(">")
    return ", ".join(out)

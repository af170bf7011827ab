"""Images and links of web pages.

The generated pages hold no images and no absolute links, so the queries add
some to each page by its own url.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import Tables
from gladwire.functions import html, urls
from gladwire.operators import enrich
from gladwire.sources import feeds

def _number():
    return F.col("page_id").cast("string")


def _french():
    return F.col("url").contains("/fr/")


def _blog():
    return F.col("url").contains("blog.")


def _plain():
    return F.col("url").startswith("http://")


def _with_images(t: Tables) -> DataFrame:
    """Meta images on blogs and French pages, images on plain-http pages, none elsewhere."""
    head = F.concat(
        F.lit('<!-- <meta property="og:image" content="/no.png"> --><meta content=\'\' property="og:image">'),
        F.when(_blog(), F.concat(F.lit("<META name='twitter:image' content=' /img/"), _number(), F.lit(".png?a=1&#038;b=2&#x26;c=&#xe9;&#128512;&#0;&amp; '/>")))
        .when(_french(), F.concat(F.lit('<meta data-x=">" property=twitter:image:src content=//cdn.example.org/'), _number(), F.lit(">")))
        .otherwise(F.lit("")),
    )
    body = F.when(
        _plain(),
        F.concat(F.lit('<script>"<img src=/no.gif>"</script><img src=""><img src="data:image/gif,x"><IMG alt="a" SRC="/pic/'),
                 _number(), F.lit('.gif"><img src="/later.gif">')),
    ).otherwise(F.lit(""))
    return t.read("pages").withColumn("html", F.concat(head, "html", body))


_META = """CASE WHEN contains(url, 'blog.') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/img/' || page_id || '.png?a=1&b=2&c=é😀&#0;&'
     WHEN contains(url, '/fr/') THEN regexp_extract(url, '^(https?):', 1) || '://cdn.example.org/' || page_id END"""
_IMG = """CASE WHEN url LIKE 'http://%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/pic/' || page_id || '.gif' END"""
_ICON = "regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/favicon.ico'"


@check("meta_image", f"SELECT page_id, {_META} AS image FROM pages")
def meta_image(t: Tables) -> DataFrame:
    return _with_images(t).select("page_id", html.meta_image(html.markup("html"), "url").alias("image"))


@check("first_img", f"SELECT page_id, {_IMG} AS image FROM pages")
def first_img(t: Tables) -> DataFrame:
    return _with_images(t).select("page_id", html.first_img(html.markup("html"), "url").alias("image"))


@check("thumbnail_chain", f"SELECT page_id, coalesce({_META}, {_IMG}, {_ICON}) AS thumbnail_url FROM pages")
def thumbnail_chain(t: Tables) -> DataFrame:
    return _with_images(t).select("page_id", html.thumbnail("html", "url").alias("thumbnail_url"))


def _with_status(pages: DataFrame) -> DataFrame:
    status = F.when(_plain(), 404).when(~_blog(), 200)
    return pages.withColumn("status", status)


@check("page_scan", """
    SELECT page_id, CASE WHEN url NOT LIKE 'http://%' AND NOT contains(url, 'blog.') THEN md5(html) END AS html
    FROM pages""")
def page_scan(t: Tables) -> DataFrame:
    seen = enrich.page_html(_with_status(t.read("pages")))
    return seen.select("page_id", F.md5(F.col("html").cast("binary")).alias("html"))


@check("thumbnail_join", f"""
    SELECT page_id, copy, CASE WHEN copy = 'own' AND contains(url, '/en/') THEN 'own:' || url
                WHEN url LIKE 'http://%' OR contains(url, 'blog.') THEN {_ICON}
                ELSE coalesce({_META}, {_IMG}, {_ICON}) END AS thumbnail_url
    FROM pages, (VALUES ('own'), ('bare')) c(copy)""")
def thumbnail_join(t: Tables) -> DataFrame:
    pages = _with_status(_with_images(t))
    base = t.read("pages").select("page_id", "url")
    own = base.select(
        "*", F.lit("own").alias("copy"),
        F.when(F.col("url").contains("/en/"), F.concat(F.lit("own:"), "url")).alias("thumbnail_url"),
    )
    bare = base.select("*", F.lit("bare").alias("copy"), F.lit("").alias("thumbnail_url"))
    # every page comes twice, once without HTML
    found = pages.select("url", "status", "html")
    twice = found.unionByName(found.withColumn("html", F.lit(None).cast("string")))
    done, _ = enrich.add_thumbnails(own.unionByName(bare), twice)
    return done.select("page_id", "copy", "thumbnail_url")


@check("first_external_link", r"""
    SELECT page_id, CASE WHEN len(found) > 0 THEN 'https://out.example.org' || found[1] END AS link
    FROM (SELECT page_id, list_filter(regexp_extract_all(html, 'href="(/[^"]*)"', 1),
                                      lambda h: length(h) > 6) AS found FROM pages)""")
def first_external_link(t: Tables) -> DataFrame:
    # short links are made internal ones, the others lead outside with a query
    links = F.transform(
        html.hrefs("html"),
        lambda h: F.when(F.length(h) > 6, F.concat(F.lit("https://out.example.org"), h, F.lit("?q=1#f")))
        .otherwise(F.concat(F.lit("https://www.reddit.com"), h)),
    )
    return t.read("pages").select("page_id", html.first_external_link(links).alias("link"))


def _post_pages(t: Tables) -> DataFrame:
    """Pages of posts: with a post element, with links in the content, or with links elsewhere."""
    element = F.concat(F.lit('<shreddit-post content-href="https://a.example.org/'), _number(), F.lit('?s=1"></shreddit-post>'))
    gallery = F.lit('<shreddit-post content-href="https://www.reddit.com/gallery/x"></shreddit-post>')
    early = F.lit('<a href="https://early.example.org/x">e</a>')
    content = F.concat(
        F.lit('<div class="p" data-testid="post-content"><div><a href="/r/x">x</a></div><p><a href="https://i.redd.it/x">y</a>'),
        F.when(_plain(), F.concat(F.lit('<a class="l" href="https://b.example.org/'), _number(), F.lit('#f">z</a>'))).otherwise(F.lit("")),
        F.lit('</p></div><div><a href="https://late.example.org/x">l</a></div>'),
    )
    extra = F.when(_blog(), element).when(_french(), F.concat(gallery, early, content)).otherwise(F.lit(""))
    return t.read("pages").withColumn("html", F.concat("html", extra))


_PAGE_LINK = """CASE WHEN contains(url, 'blog.') THEN 'https://a.example.org/' || page_id
    WHEN contains(url, '/fr/') AND url LIKE 'http://%' THEN 'https://b.example.org/' || page_id
    WHEN contains(url, '/fr/') THEN 'https://early.example.org/x' END"""


@check("legacy_headline_filter", f"""
    SELECT page_id, coalesce({_PAGE_LINK}, regexp_replace(url, '[?#].*$', '')) AS original_url
    FROM pages WHERE contains(url, 'blog.') OR contains(url, '/fr/') OR contains(url, '/en/')""")
def legacy_headline_filter(t: Tables) -> DataFrame:
    """Blogs and French pages are posts with a link; the other posts have none, or are media."""
    post = F.concat(F.lit("https://www.reddit.com/r/x/comments/"), _number())
    link = (
        F.when(_blog() | _french(), post).when(F.col("url").contains("/en/"), F.col("url"))
        .when(F.col("page_id") % 2 == 0, post).otherwise(F.concat(F.lit("https://i.redd.it/"), _number()))
    )
    linked = _post_pages(t).withColumn("link", link)
    entries = linked.select("page_id", "link", F.lit(" a title ").alias("title"))
    pages = linked.select(F.col("link").alias("url"), "html")
    return feeds.older_headlines(entries, pages).select("page_id", "original_url")


@check("reddit_page_link", f"SELECT page_id, {_PAGE_LINK} AS link FROM pages")
def reddit_page_link(t: Tables) -> DataFrame:
    return _post_pages(t).select("page_id", html.reddit_page_link("html").alias("link"))


@check("reddit_page_link_legacy", f"""
    SELECT page_id, coalesce({_PAGE_LINK}, regexp_replace(url, '[?#].*$', '')) AS link FROM pages""")
def reddit_page_link_legacy(t: Tables) -> DataFrame:
    link = html.reddit_page_link_or_post("html", "url")
    return _post_pages(t).select("page_id", link.alias("link"))


# --- pages that tag patterns cannot read -------------------------------------


def _quarter(n: int):
    return F.col("page_id") % 4 == n


def _untidy(t: Tables) -> DataFrame:
    """Named references, stray quotes, a quote that is never closed; every fourth page as it is."""
    def text(*parts):
        return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))

    head = (
        F.when(_quarter(0), text('<meta property="og:image" content="/caf&eacute;/', _number(), '&ndash;x.png?a=1&b=2">'))
        .when(_quarter(1), text('<meta property="og:title" content="say "cheese""><meta property="og:image" content="/q/', _number(), '.png">'))
        .when(_quarter(2), text('<img alt=none><img src="/cut/', _number(), '.gif><b title="x"><img src="/later.gif">'))
        .otherwise(F.lit(""))
    )
    return t.read("pages").withColumn("html", F.concat(head, "html"))


_HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_UNTIDY_META = f"""CASE page_id % 4 WHEN 0 THEN {_HOST} || '/café/' || page_id || '–x.png?a=1&b=2'
                        WHEN 1 THEN {_HOST} || '/q/' || page_id || '.png' END"""
_UNTIDY_IMG = f"""CASE page_id % 4 WHEN 2 THEN {_HOST} || '/cut/' || page_id || '.gif><b title=' END"""


@check("meta_image_untidy", f"SELECT page_id, {_UNTIDY_META} AS image FROM pages")
def meta_image_untidy(t: Tables) -> DataFrame:
    return _untidy(t).select("page_id", html.meta_image("html", "url").alias("image"))


@check("first_img_untidy", f"SELECT page_id, {_UNTIDY_IMG} AS image FROM pages")
def first_img_untidy(t: Tables) -> DataFrame:
    return _untidy(t).select("page_id", html.first_img("html", "url").alias("image"))


@check("thumbnail_chain_untidy", f"""
    SELECT page_id, coalesce({_UNTIDY_META}, {_UNTIDY_IMG}, {_ICON}) AS thumbnail_url FROM pages""")
def thumbnail_chain_untidy(t: Tables) -> DataFrame:
    return _untidy(t).select("page_id", html.thumbnail("html", "url").alias("thumbnail_url"))


def _untidy_posts(t: Tables) -> DataFrame:
    """Post content in nested divisions that an outer element closes, or that never closes."""
    early = F.concat(F.lit('<a href="https://early.example.org/'), _number(), F.lit('">e</a>'))
    inside = F.concat(
        F.lit('<section><div class="c" data-testid="post-content"><div><div><a href="https://www.reddit.com/r/x">x</a></div></div>'
              '<p>open<br><a href="https://in.example.org/&Eacute;/'), _number(),
        F.lit('?x=1">n</a></section><a href="https://late.example.org/x">l</a>'),
    )
    outside = F.lit('<section><div data-testid="post-content"><div><a href="https://i.redd.it/x">x</a></section>'
                    '<a href="https://late.example.org/x">l</a>')
    element = F.concat(F.lit('<shreddit-post title="a "b" c" content-href="https://el.example.org/'), _number(), F.lit('">'))
    extra = (
        F.when(_quarter(0), F.concat(early, inside)).when(_quarter(1), F.concat(early, outside))
        .when(_quarter(2), F.concat(early, element)).otherwise(F.lit(""))
    )
    return t.read("pages").withColumn("html", F.concat("html", extra))


@check("reddit_page_link_untidy", """
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://in.example.org/É/' || page_id
        WHEN 1 THEN 'https://early.example.org/' || page_id WHEN 2 THEN 'https://el.example.org/' || page_id END AS link
    FROM pages""")
def reddit_page_link_untidy(t: Tables) -> DataFrame:
    return _untidy_posts(t).select("page_id", html.reddit_page_link("html").alias("link"))


@check("reddit_entry_link_untidy", """
    SELECT page_id, CASE page_id % 4 WHEN 2 THEN 'https://el.example.org/' || page_id
        WHEN 3 THEN 'https://tidy.example.org/' || page_id ELSE 'https://early.example.org/' || page_id END AS link
    FROM pages""")
def reddit_entry_link_untidy(t: Tables) -> DataFrame:
    tidy = F.concat(F.lit('<a href="https://tidy.example.org/'), _number(), F.lit('?q">t</a>'))
    blocks = F.array(F.lit("<p>no link &eacute;</p>"), F.col("html"), tidy)
    return _untidy_posts(t).select("page_id", html.reddit_entry_link(blocks).alias("link"))

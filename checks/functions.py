"""Scalar functions and projections on the articles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import check
from checks.views import INPUT_TEXT, Tables, stamp
from gladwire import fixed, schemas
from gladwire.functions import dates, labels, text, urls
from gladwire.operators import articles as article_ops
from gladwire.session import new_folder, read_evolved

_WORDS = r"CAST(len(regexp_extract_all(body, '\S+')) AS INTEGER)"


@check("trim_title", r"""
    SELECT doc_id, pos, regexp_replace(line, '^\s+|\s+$', '', 'g') AS title FROM v_lines""")
def trim_title(t: Tables) -> DataFrame:
    lines = t.read("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    padded = F.concat(F.lit("  \t"), "line", F.lit("  \n"))
    return lines.select("doc_id", "pos", text.trim_title(padded).alias("title"))


@check("input_text", f"SELECT seq, {INPUT_TEXT} AS text FROM v_articles")
def input_text(t: Tables) -> DataFrame:
    return t.articles.select("seq", text.input_text("title", "body").alias("text"))


@check("truncate_text", "SELECT seq, substring(body, 1, 3800) AS text FROM v_articles")
def truncate_text(t: Tables) -> DataFrame:
    return t.articles.select("seq", text.truncate_text("body").alias("text"))


@check("too_short", f"SELECT seq, {_WORDS} AS words, {_WORDS} < 30 AS short FROM v_articles")
def too_short(t: Tables) -> DataFrame:
    return t.articles.select(
        "seq", text.word_count("body").alias("words"), text.too_short("body").alias("short")
    )


@check("summary_key", """
    SELECT seq, sha256('{"max_length":130,"min_length":30,"text":' || CAST(to_json(body) AS VARCHAR) || '}')
           AS cache_key FROM v_articles""")
def summary_key(t: Tables) -> DataFrame:
    return t.articles.select("seq", labels.summary_key("body").alias("cache_key"))


@check("category_key", """
    SELECT seq, sha256('{"categories":["de","en","fr"],"body":' || CAST(to_json(body) AS VARCHAR)
                       || ',"title":' || CAST(to_json(title) AS VARCHAR) || '}') AS cache_key
    FROM v_articles""")
def category_key(t: Tables) -> DataFrame:
    names = F.array(F.lit("fr"), F.lit("en"), F.lit("de"))
    return t.articles.select("seq", labels.category_key("title", "body", names).alias("cache_key"))


def _given_category():
    lang = F.col("lang")
    return (
        F.when(lang == "en", "science-tech").when(lang == "fr", "Human Interest")
        .when(lang == "de", "").otherwise(F.col("title"))
    )


@check("canonical_category", """
    SELECT seq, CASE lang WHEN 'en' THEN 'Science & Tech' WHEN 'fr' THEN 'Community'
                          WHEN 'de' THEN NULL ELSE title END AS category FROM v_articles""")
def canonical_category(t: Tables) -> DataFrame:
    return t.articles.select("seq", labels.canonical_category(_given_category()).alias("category"))


@check("category_slug", """
    SELECT seq, CASE lang WHEN 'fr' THEN 'community' END AS slug FROM v_articles""")
def category_slug(t: Tables) -> DataFrame:
    return t.articles.select("seq", labels.category_slug(_given_category()).alias("slug"))


@check("format_datetime", f"SELECT event_id, {stamp('ts')} AS moment FROM events")
def format_datetime(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", dates.format_datetime("ts").alias("moment"))


@check("iso_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS moment FROM events")
def iso_timestamp(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", dates.iso_timestamp("ts").alias("moment"))


@check("parse_feed_date", f"""
    SELECT event_id, {stamp("CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts - INTERVAL 2 HOUR "
                            "WHEN 'click' THEN ts + INTERVAL 5 HOUR ELSE ts END")} AS moment
    FROM events""")
def parse_feed_date(t: Tables) -> DataFrame:
    kind, rfc = F.col("event_type"), F.date_format("ts", "d MMM yyyy HH:mm:ss")
    written = (
        F.when(kind == "error", F.concat(F.lit("about "), rfc))
        .when(kind == "view", F.concat(F.lit("Thu, "), rfc, F.lit(" +0200")))
        .when(kind == "click", F.concat(F.date_format("ts", "d MMMM yyyy HH:mm:ss"), F.lit(" -05:00")))
        .when(kind == "signup", F.concat(F.lit("Mon,  "), F.date_format("ts", "d MMM yy HH:mm:ss"), F.lit(" GMT")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    moment = dates.parse_feed_date(written)
    return t.read("events").select("event_id", dates.format_datetime(moment).alias("moment"))


@check("published_fallback", f"""
    SELECT event_id, {stamp("CASE event_type WHEN 'view' THEN ts WHEN 'error' THEN NULL "
                            "ELSE ts + INTERVAL 1 DAY END")} AS published_at
    FROM events""")
def published_fallback(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    rows = t.read("events").select(
        "event_id",
        F.when(kind == "view", F.date_format("ts", "d MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == "click", "soon").alias("published"),
        F.when(kind != "error", F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("updated"),
    )
    done = article_ops.with_published(rows)
    return done.select("event_id", dates.format_datetime("published_at").alias("published_at"))


@check("scores_json", """
    SELECT seq, n_chars / 1000.0::DOUBLE AS health, length(title) / 8.0::DOUBLE AS sports FROM v_articles""")
def scores_json(t: Tables) -> DataFrame:
    scores = F.create_map(
        F.lit("Health"), F.col("n_chars") / F.lit(1000.0), F.lit("Sports"), F.length("title") / F.lit(8.0)
    )
    written = t.articles.select("seq", labels.scores_json(scores).alias("j"))
    back = written.select("seq", labels.scores_from_json("j").alias("m"))
    return back.select("seq", F.col("m")["Health"].alias("health"), F.col("m")["Sports"].alias("sports"))


@check("clean_url", """
    SELECT page_id, regexp_replace(url, '[?#].*$', '') AS plain,
           'https' || regexp_replace(substring(url, position(':' IN url)), '[?#].*$', '') AS upper_scheme
    FROM pages""")
def clean_url(t: Tables) -> DataFrame:
    shouted = F.concat(F.lit("HTTPS"), F.regexp_extract("url", "(:.*)$", 1))
    return t.read("pages").select(
        "page_id", urls.clean_url("url").alias("plain"), urls.clean_url(shouted).alias("upper_scheme")
    )


@check("is_reddit_internal", """
    SELECT page_id, contains(u, 'reddit.com') OR contains(u, 'redd.it') AS internal
    FROM (SELECT page_id, CASE WHEN contains(url, '/fr/') THEN url || '?ref=reddit.com'
                               WHEN contains(url, 'blog.') THEN 'https://v.redd.it/' || page_id
                               ELSE url END AS u FROM pages)""")
def is_reddit_internal(t: Tables) -> DataFrame:
    url = F.col("url")
    seen = F.when(url.contains("/fr/"), F.concat(url, F.lit("?ref=reddit.com"))).when(
        url.contains("blog."), F.concat(F.lit("https://v.redd.it/"), F.col("page_id").cast("string"))
    ).otherwise(url)
    return t.read("pages").select("page_id", urls.is_reddit_internal(seen).alias("internal"))


@check("favicon_url", """
    SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/favicon.ico' AS icon,
           CAST(NULL AS VARCHAR) AS no_icon FROM pages""")
def favicon_url(t: Tables) -> DataFrame:
    path = urls.url_path("url")
    return t.read("pages").select(
        "page_id", urls.favicon_url("url").alias("icon"), urls.favicon_url(path).alias("no_icon")
    )


@check("make_absolute", r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^(https?):', 1) AS scheme,
                      regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin,
                      regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, scheme || '://cdn.example.org/a.png' AS by_scheme,
           origin || '/img/' || page_id || '.png?w=1#x' AS by_root,
           origin || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '')
               || page_id || '.png' AS by_folder,
           'http://other.example.org/' || page_id AS whole
    FROM p""")
def make_absolute(t: Tables) -> DataFrame:
    number = F.col("page_id").cast("string")
    return t.read("pages").select(
        "page_id",
        urls.make_absolute(F.lit("//cdn.example.org/a.png"), "url").alias("by_scheme"),
        urls.make_absolute(F.concat(F.lit("/x/../img/./"), number, F.lit(".png?w=1#x")), "url").alias("by_root"),
        urls.make_absolute(F.concat(F.lit("q/../"), number, F.lit(".png")), "url").alias("by_folder"),
        urls.make_absolute(F.concat(F.lit("http://other.example.org/"), number), "url").alias("whole"),
    )


@check("event_payload", """
    SELECT event_id, event_type AS event, 'u' || user_id AS source_id, substring(props, 1, 120) AS title,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
           round(value / 7, 4) AS uplifting_score, round(value * 1000 / 7, 1) AS duration_ms
    FROM events""")
def event_payload(t: Tables) -> DataFrame:
    payload = labels.event_payload(
        F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit(None).cast("string"),
        F.col("props"), F.lit("stored"), F.when(F.col("event_type") == "error", "error"),
        F.col("value") / 7, F.col("value") * 1000 / 7,
    )
    return t.read("events").select("event_id", payload.alias("p")).select(
        "event_id", "p.event", "p.source_id", "p.title", "p.status", "p.uplifting_score", "p.duration_ms"
    )


@check("normalise_fields", f"""
    SELECT seq, CASE lang WHEN 'en' THEN url WHEN 'fr' THEN 'o:' || url WHEN 'de' THEN 'r:' || url ELSE '' END AS url,
           {stamp("CASE lang WHEN 'es' THEN NULL WHEN 'en' THEN published_at "
                  "ELSE published_at + INTERVAL 1 DAY END")} AS published_at
    FROM v_articles""")
def normalise_fields(t: Tables) -> DataFrame:
    lang, day = F.col("lang"), F.expr("INTERVAL 1 DAY")
    rows = t.articles.select(
        "seq", "lang",
        F.when(lang == "en", F.col("url")).when(lang == "fr", "").alias("url"),
        F.when(lang == "fr", F.concat(F.lit("o:"), "url")).when(lang == "de", "").alias("original_url"),
        F.when(lang == "de", F.concat(F.lit("r:"), "url")).alias("rss_link"),
        F.when(lang == "en", F.col("published_at")).alias("published_at"),
        F.when(lang.isin("fr", "de"), F.col("published_at") + day).alias("published"),
    )
    done = article_ops.fill_url_and_date(rows)
    return done.select("seq", "url", dates.format_datetime("published_at").alias("published_at"))


@check("article_row", f"""
    SELECT seq, title, url,
           CASE lang WHEN 'en' THEN url WHEN 'fr' THEN link WHEN 'de' THEN 'r:' || url ELSE url END AS source_url,
           CASE lang WHEN 'en' THEN url WHEN 'fr' THEN '' END AS external_url,
           CASE WHEN lang <> 'es' THEN body END AS content,
           CASE lang WHEN 'en' THEN 'Arts & Culture' WHEN 'fr' THEN NULL ELSE lang END AS category,
           source_id, n_chars / 8.0::DOUBLE AS uplifting_score,
           {stamp("published_at")} AS published_at, '2024-05-06 07:08:09' AS crawled_at,
           n_chars / 8.0::DOUBLE >= 0.75 AS is_uplifting
    FROM v_articles""")
def article_row(t: Tables) -> DataFrame:
    lang = F.col("lang")
    rows = t.articles.select(
        "seq", "title", "url", "source_id", "published_at",
        F.when(lang == "en", F.col("url")).when(lang == "fr", "").alias("external_url"),
        F.when(lang == "fr", F.col("link")).alias("source_url"),
        F.when(lang == "de", F.concat(F.lit("r:"), "url")).alias("rss_link"),
        F.lit("").alias("content"),
        F.when(lang != "es", F.col("body")).alias("body"),
        F.when(lang == "en", "arts-culture").when(lang == "fr", "").otherwise(lang).alias("category"),
        (F.col("n_chars") / F.lit(8.0)).alias("uplifting_score"),
    )
    moment = F.to_timestamp(F.lit("2024-05-06 07:08:09"))
    done = article_ops.store_rows(rows, moment, raw=True)
    return done.select(
        "seq", "title", "url", "source_url", "external_url", "content", "category", "source_id",
        "uplifting_score", dates.format_datetime("published_at").alias("published_at"),
        dates.format_datetime("crawled_at").alias("crawled_at"), "is_uplifting",
    )


@check("category_lookup", "SELECT seq, title FROM v_articles WHERE lang = 'fr'")
def category_lookup(t: Tables) -> DataFrame:
    return article_ops.of_category(t.articles.withColumn("category", F.col("lang")), "fr").select("seq", "title")


@check("schema_evolve", """
    SELECT id, title, url, CAST(NULL AS VARCHAR) AS source_url, CAST(NULL AS DOUBLE) AS category_confidence
    FROM v_final""")
def schema_evolve(t: Tables) -> DataFrame:
    older = t.final.select("id", "title", "url")
    newer = article_ops.add_missing_columns(older, schemas.ARTICLES)
    return newer.select("id", "title", "url", "source_url", "category_confidence")


@check("labels_intersect", """
    SELECT seq, CASE WHEN lang = 'fr' THEN 'A' END AS a, 'x' AS x_label,
           CASE WHEN lang = 'fr' THEN 2 ELSE 1 END AS labels
    FROM v_articles""")
def labels_intersect(t: Tables) -> DataFrame:
    # where only B and X are scored, X is allowed; where A and B are, neither is
    scores = F.when(
        F.col("lang") == "fr", F.create_map(F.lit("A"), F.lit(0.5), F.lit("B"), F.lit(0.25))
    ).otherwise(F.create_map(F.lit("B"), F.lit(0.5), F.lit("X"), F.lit(0.25)))
    kept = t.articles.select("seq", labels.allowed_scores(scores, ["X", "Y"]).alias("m"))
    return kept.select(
        "seq", F.when(F.col("m")["A"].isNotNull(), "A").alias("a"), F.lit("x").alias("x_label"),
        F.size("m").alias("labels"),
    )


_SCORES = ", ".join(
    f"length(title) % {7 + i} / {7 + i}.0::DOUBLE AS s{i}" for i in range(len(fixed.MODEL_TOPICS))
)
_BEST = "greatest(" + ", ".join(f"s{i}" for i in range(len(fixed.MODEL_TOPICS))) + ")"
_NAMES = " ".join(f"WHEN s{i} = {_BEST} THEN '{n}'" for i, n in enumerate(fixed.MODEL_TOPICS))


@check("argmax_category", f"""
    SELECT seq, CASE {_NAMES} END AS category, {_BEST} AS confidence
    FROM (SELECT seq, {_SCORES} FROM v_articles)""")
def argmax_category(t: Tables) -> DataFrame:
    length = F.length("title")
    probabilities = F.array(
        *[length % (7 + i) / F.lit(float(7 + i)) for i in range(len(fixed.MODEL_TOPICS))]
    )
    names = F.array(*[F.lit(n) for n in fixed.MODEL_TOPICS])
    rows = t.articles.select("seq", F.map_from_arrays(names, probabilities).alias("m")).withColumn(
        "category", labels.argmax_label(F.col("m"))
    )
    return rows.select("seq", "category", F.col("m")[F.col("category")].alias("confidence"))


@check("schema_evolve_files", """
    SELECT doc_id AS id, CASE WHEN doc_id % 4 <> 0 THEN source END AS source_id,
           CASE WHEN doc_id % 4 > 1 THEN n_chars END AS size,
           CASE doc_id % 4 WHEN 2 THEN (n_chars % 64) / 4.0::DOUBLE WHEN 3 THEN n_chars / 4.0::DOUBLE END AS score,
           lang FROM documents""")
def schema_evolve_files(t: Tables) -> DataFrame:
    """One scan over files of four schemas: narrower numbers, columns that lack, columns too many."""
    path, part = new_folder(t.spark, "evolved"), F.col("doc_id") % 4
    docs = t.read("documents")
    kinds = (
        (F.col("doc_id").cast("int").alias("id"), "lang"),
        (F.col("doc_id").cast("int").alias("id"), F.col("source").alias("source_id"), "lang", F.lit(True).alias("gone")),
        (F.col("doc_id").alias("id"), F.col("source").alias("source_id"), F.col("n_chars").cast("int").alias("size"),
         ((F.col("n_chars") % 64) / 4).cast("float").alias("score"), "lang"),
        ("lang", (F.col("n_chars") / 4).alias("score"), F.col("n_chars").cast("long").alias("size"),
         F.col("source").alias("source_id"), F.col("doc_id").alias("id")),
    )
    for i, columns in enumerate(kinds):
        docs.filter(part == i).select(*columns).write.mode("append").parquet(path)
    wanted = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("source_id", T.StringType()), T.StructField("size", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("lang", T.StringType()),
    ])
    return read_evolved(t.spark, path, wanted)

"""The operators of this subpackage on the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gladwire.llm import decontam, exactdup, hmm, imatch, langid, linededup, neardup, negatives, pieces, secrets, sharding, toxicity, whitening
from gladwire.llm.common import fold
from gladwire.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: query(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finite(embeddings: DataFrame) -> DataFrame:
    """Rows whose vector and all its entries are numbers."""
    return embeddings.filter(
        "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    )


@register("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = langid.train(docs.filter(fold("doc_id", 5) != 0))
    predict = langid.predictor(spark, prototypes)
    found = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), predict("text").alias("p"))
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")
    )


@register("op2_hidden_markov")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = hmm.score(docs, fold("doc_id", 7) != 2)
    return scored.withColumn("held_out", fold("doc_id", 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    rows = toxicity.training_rows(docs, labels, lambda doc_id: fold(doc_id, 3) != 1)
    score = toxicity.scorer(spark, toxicity.train(rows))
    scored = docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


@register("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", secrets.scanner(spark)("text").alias("s")).select("doc_id", "s.*")


@register("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register(
    "op10_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
        FROM documents WHERE text IS NOT NULL),
    ds AS (
        SELECT doc_id, len(w) AS n, i AS place, array_to_string(w[i + 1:i + 5], ' ') AS sh
        FROM d, LATERAL (SELECT unnest(range(len(w) - 4)) AS i)),
    b AS (
        SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
        FROM benchmark WHERE text IS NOT NULL),
    bs AS (
        SELECT item_id, len(w) AS m, array_to_string(w[i + 1:i + 5], ' ') AS sh, count(*) AS weight
        FROM b, LATERAL (SELECT unnest(range(len(w) - 4)) AS i) GROUP BY ALL),
    starts AS (
        SELECT DISTINCT doc_id, item_id, m, n, unnest(range(
            least(greatest(place - m + 5, 0), greatest(n - m, 0)), least(place, greatest(n - m, 0)) + 1)) AS start
        FROM ds JOIN bs USING (sh)),
    windows AS (
        SELECT s.doc_id, s.item_id, s.start, ds.sh, count(*) AS c
        FROM starts s JOIN ds ON ds.doc_id = s.doc_id AND ds.place BETWEEN s.start AND least(s.start + s.m, s.n) - 5
        GROUP BY ALL),
    sums AS (
        SELECT w.doc_id, w.item_id, w.start, sum(w.c) AS own, sum(least(w.c, coalesce(bs.weight, 0))) AS shared
        FROM windows w LEFT JOIN bs ON bs.item_id = w.item_id AND bs.sh = w.sh GROUP BY ALL),
    scored AS (
        SELECT doc_id, item_id, start, shared::DOUBLE / (own + whole - shared)::DOUBLE AS similarity
        FROM sums JOIN (SELECT item_id, sum(weight) AS whole FROM bs GROUP BY item_id) USING (item_id))
    SELECT doc_id, item_id, start::INT AS start, similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS rn FROM scored)
    WHERE rn = 1 AND similarity >= 0.8
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


@register(
    "op7_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, l.i AS pos, trim(l.line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
        FROM documents, LATERAL (
            SELECT unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS i) AS l),
    windows AS (
        SELECT doc_id, pos AS first, lead(pos, 2) OVER w AS last,
               md5(line || chr(10) || lead(line) OVER w || chr(10) || lead(line, 2) OVER w) AS h
        FROM lines WHERE line != '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, first) AS n
        FROM windows WHERE last IS NOT NULL),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM ranked WHERE n > 1),
    kept AS (
        SELECT d.doc_id, l.i AS pos, l.line
        FROM documents d, LATERAL (
            SELECT unnest(string_split(d.text, chr(10))) AS line,
                   unnest(range(len(string_split(d.text, chr(10))))) AS i) AS l
        WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = d.doc_id AND g.pos = l.i))
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
           coalesce(g.n, 0)::INT AS removed_lines
    FROM documents d
    LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY doc_id) k
        ON k.doc_id = d.doc_id
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op9_imatch")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare(docs, imatch.lexicon(docs))


@register("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokenized(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@register("op8_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, size=2, percent=80).drop("text_hash")


@register(
    "op13_exact_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register(
    "op12_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
        FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN pairs USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite(table(spark, sf_dir, "embeddings"))
    vector = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    prepared = rows.select("vec_id", label.alias("label"), vector.alias("vector"))
    return negatives.mine(prepared, F.col("vec_id") % 100 == 0)


@register("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    most = F.lit(1 << 52)  # whole numbers beyond are no exact doubles
    entry = lambda c: F.greatest(F.least(F.floor(F.lit(64) * c.cast("double")), most), -most) + 1_000_000
    vector = F.transform("embedding", entry)
    rows = finite(table(spark, sf_dir, "embeddings")).select("vec_id", vector.alias("vector"))
    blocks, size = whitening.packed(rows)
    model, covariance = whitening.fit(blocks, size)
    error = whitening.identity_error(covariance, model)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    value = whitening.apply(blocks, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return value.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )

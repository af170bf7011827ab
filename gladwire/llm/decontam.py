"""Benchmark decontamination: SimHash fingerprints of item-sized windows, in DataFrame operations.

A document leaks an item if some window of as many words as the item has a
weighted shingle similarity of at least ``THRESHOLD`` with it: shingles of
five words, each weighing as often as it occurs, least weights over greatest.
Such a window shares shingles with the item, at least the weight that the
threshold implies, so only windows with enough places of shared shingles are
looked at, all of them. They get 64-bit SimHash fingerprints of
their words. Fingerprints within a Hamming distance of ``RADIUS`` agree in at
least one of ``RADIUS + 1`` blocks, so a join on the blocks finds them all;
what lies within the radius is verified exactly. Windows beyond it are
verified too, unless their places of shared shingles show that they do not
reach the best similarity found within it. So the radius decides what is
verified first, and no result depends on it.

Words are runs of letters and digits in lower case. An item of fewer words
than a shingle is one shingle of its length; a document shorter than the item
has one window, all of it.

Defined cases: a null text or item, or one without a word, leaks nothing;
repeated rows get the same verdict, as do rows with equal id and text; a null
id is an id of its own; equal items each count; empty tables give no leaks;
columns of any name besides are carried along by ``drop_leaks``. Texts are
read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import written

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
RADIUS = 15
# A side of at most so many rows of a few numbers is broadcast.
SMALL = 500_000
# What names a window.
KEYS = ["id", "th", "item", "start"]

_LANES = 32
_LANE_MASK = 0x0000000100000001


def words(text: Column | str) -> Column:
    """Hashes of the words of a text; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def shingles(hashed: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, by place."""
    last = F.size(hashed) - size
    every = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(hashed, i + k) for k in range(size)))
    )
    return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))


def _small(rows: DataFrame) -> DataFrame:
    """The rows of a written table, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= SMALL else rows


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), words("text").alias("w")
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_hash, item_id, start, similarity``: the best window of each leaked item."""
    items = written(
        benchmark.select("item_id", words("text").alias("iw")).filter("size(iw) > 0")
        .withColumn("m", F.size("iw")).withColumn("item", F.monotonically_increasing_id())
        .withColumn("s", F.least("m", F.lit(SHINGLE))),
        "items",
    )
    sizes = sorted(r["s"] for r in items.select("s").distinct().collect())
    every = [
        items.filter(F.col("s") == s).select("item", "m", "s", F.explode(shingles(F.col("iw"), s)).alias("sh"))
        for s in sizes
    ]
    if not every:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, text_hash bigint, item_id bigint, start int, similarity double"
        )
    item_shingles = every[0]
    for more in every[1:]:
        item_shingles = item_shingles.unionByName(more)
    item_shingles = written(
        item_shingles.groupBy("item", "m", "s", "sh").agg(F.count(F.lit(1)).alias("weight")), "item-shingles"
    )
    anchors = written(_anchors(docs, item_shingles, sizes), "anchors")
    windows = written(_windows(docs, anchors), "windows")
    near = written(_within_radius(windows, items), "near")
    first = written(_verified(_only(windows, near), item_shingles), "verified")
    more = _only(windows, written(_beyond_radius(windows, near, first), "beyond"))
    verified = first.unionByName(_verified(more, item_shingles))
    best = verified.groupBy("id", "th", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("b")
    )
    return best.join(items.select("item", "item_id"), "item").select(
        F.col("id").alias("doc_id"), F.col("th").alias("text_hash"), "item_id",
        (-F.col("b.back")).alias("start"), F.col("b.similarity").alias("similarity"),
    )


def _anchors(docs: DataFrame, item_shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """``id, th, item, m, s, at``: places of a document where a shingle of an item stands."""
    known = _small(item_shingles.select("item", "m", "s", "sh"))
    hashed = _documents(docs)
    found = None
    for s in sizes:
        # The outer form with a filter keeps the array from being computed twice.
        placed = hashed.select(
            "id", "th", F.posexplode_outer(shingles(F.col("w"), s)).alias("at", "sh")
        ).filter("sh is not null")
        part = placed.join(known.filter(F.col("s") == s), "sh").select("id", "th", "item", "m", "s", "at")
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def _windows(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """``id, th, item, start, m, s, bound, ww``: the words of each window with enough anchors.

    No window is more similar to its item than ``bound``.
    """
    per_item = anchors.groupBy("id", "th", "item", "m", "s").agg(F.collect_set("at").alias("ats"))
    keys = written(anchors.select("id", "th").distinct(), "anchored")
    same = F.col("id").eqNullSafe(F.col("kid")) & (F.col("th") == F.col("kth"))
    own = (
        docs.withColumn("th", F.xxhash64("text")).select(F.col("doc_id").alias("id"), "th", "text")
        .join(_small(keys.select(F.col("id").alias("kid"), F.col("th").alias("kth"))), same, "left_semi")
        .dropDuplicates(["id", "th"])
        .select(F.col("id").alias("kid"), F.col("th").alias("kth"), words("text").alias("w"))
    )
    joined = per_item.join(own, same).drop("kid", "kth")
    last = F.greatest(F.size("w") - F.col("m"), F.lit(0))
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                "ats",
                lambda at: F.sequence(
                    F.least(F.greatest(at - F.col("m") + F.col("s"), F.lit(0)), last), F.least(at, last)
                ),
            )
        )
    )
    # The anchors inside a window bound the weight it can share with the item.
    held = F.least(F.size("w"), F.col("m")) - F.col("s") + 1 + F.col("m") - F.col("s") + 1
    needed = held * THRESHOLD / (1 + THRESHOLD) - 1e-6
    inside = lambda start: F.size(
        F.filter("ats", lambda at: (at >= start) & (at <= start + F.col("m") - F.col("s")))
    )
    hopeful = F.filter(
        F.transform(starts, lambda start: F.struct(start.alias("start"), inside(start).alias("anchors"))),
        lambda w: w["anchors"] >= needed,
    )
    spread = joined.select(
        "id", "th", "item", "m", "s", "w", held.alias("held"), F.explode(hopeful).alias("h")
    ).select("id", "th", "item", "m", "s", "w", "held", "h.start", "h.anchors")
    # More anchors than half of both weights: a shingle repeats, and the bound says nothing.
    bound = F.when(F.col("anchors") * 2 < F.col("held"), F.col("anchors") / (F.col("held") - F.col("anchors")))
    return spread.select(
        "id", "th", "item", "start", "m", "s", F.coalesce(bound, F.lit(1.0)).alias("bound"),
        F.expr("slice(w, start + 1, m)").alias("ww"),
    )


def _fingerprint(lanes: list[Column], words_in: Column) -> Column:
    """Bit k is set where more than half of the words have it set."""
    bits = F.lit(0).cast("bigint")
    for k, lane in enumerate(lanes):
        for j in range(BITS // _LANES):
            count = F.shiftrightunsigned(lane, 32 * j).bitwiseAND(F.lit(0xFFFFFFFF))
            at = k + 32 * j
            value = (1 << at) if at < 63 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(count * 2 > words_in, F.lit(value)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def fingerprints(rows: DataFrame, keys: list[str], hashed: str) -> DataFrame:
    """``keys, fp``: SimHash of the array ``hashed``.

    Two counters of 32 bits share a long, so 32 sums count all 64 bits over
    all words: an array holds less than 2^31 of them.
    """
    each = rows.select(*keys, F.explode(hashed).alias("h"))
    lanes = [
        F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(_LANE_MASK))).alias(f"l{k}") for k in range(_LANES)
    ]
    counted = each.groupBy(*keys).agg(*lanes, F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, _fingerprint([F.col(f"l{k}") for k in range(_LANES)], F.col("n")).alias("fp"))


def _blocks(fp: Column) -> Column:
    """The fingerprint in ``RADIUS + 1`` blocks of bits."""
    width = BITS // (RADIUS + 1)
    cut = [
        F.struct(
            F.lit(b).alias("block"),
            F.shiftrightunsigned(fp, b * width).bitwiseAND(F.lit((1 << width) - 1)).alias("value"),
        )
        for b in range(RADIUS + 1)
    ]
    return F.array(*cut)


def _within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """``id, th, item, start`` of the windows whose fingerprint lies within the radius of their item's."""
    of_windows = fingerprints(windows, KEYS, "ww")
    of_items = fingerprints(items, ["item"], "iw").withColumnRenamed("fp", "ifp")
    left = of_windows.select(*KEYS, "fp", F.explode(_blocks(F.col("fp"))).alias("b"))
    right = of_items.select("item", "ifp", F.explode(_blocks(F.col("ifp"))).alias("b"))
    return (
        left.select(*KEYS, "fp", "b.block", "b.value")
        .join(right.select("item", "ifp", "b.block", "b.value"), ["item", "block", "value"])
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
        .select(*KEYS).distinct()
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[k])
    return same


def _only(windows: DataFrame, chosen: DataFrame) -> DataFrame:
    return windows.join(chosen, _same(windows, chosen, KEYS), "left_semi")


def _beyond_radius(windows: DataFrame, near: DataFrame, verified: DataFrame) -> DataFrame:
    """``id, th, item, start`` of the other windows that may reach the best verified one of their item."""
    rest = windows.select(*KEYS, "bound")
    rest = rest.join(near, _same(rest, near, KEYS), "left_anti")
    best = verified.groupBy("id", "th", "item").agg(F.max("similarity").alias("best"))
    found = rest.join(best, _same(rest, best, ["id", "th", "item"]), "left")
    return found.filter(F.col("bound") >= F.coalesce("best", F.lit(THRESHOLD)) - 1e-6).select(
        *(rest[k] for k in KEYS)
    )


def _verified(near: DataFrame, item_shingles: DataFrame) -> DataFrame:
    """Windows that reach the threshold, with their exact similarity."""
    keys = KEYS
    sizes = range(1, SHINGLE + 1)
    own = F.coalesce(
        *(F.when(F.least("s", F.size("ww")) == s, shingles(F.col("ww"), s)) for s in sizes)
    )
    each = near.select(*keys, F.explode(own).alias("sh")).groupBy(*keys, "sh").agg(F.count(F.lit(1)).alias("n"))
    totals = item_shingles.groupBy("item").agg(F.sum("weight").alias("item_weight"))
    matched = each.join(item_shingles.select("item", "sh", "weight"), ["item", "sh"], "left")
    sums = matched.groupBy(*keys).agg(
        F.sum("n").alias("own_weight"), F.sum(F.least("n", F.coalesce("weight", F.lit(0)))).alias("shared")
    )
    similarity = F.col("shared") / (F.col("own_weight") + F.col("item_weight") - F.col("shared"))
    return sums.join(totals, "item").select(*keys, similarity.alias("similarity")).filter(
        F.col("similarity") >= THRESHOLD
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    found = written(leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaks")
    bad = _small(found.select(F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")))
    same = docs["doc_id"].eqNullSafe(bad["_leak_id"]) & (F.xxhash64(docs["text"]) == bad["_leak_hash"])
    return docs.join(bad, same, "left_anti")

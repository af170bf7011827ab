"""Near-duplicate groups by bottom-k sketches from one hash function.

A document is the set of its word shingles. One hash orders all shingles; the
``KEEP`` least values of a set are its sketch. Equal sets are one class from the
start. Inverted lists hold the classes by retained values, in runs: ``RUN``
values that follow each other in a sketch. Two sets above the threshold have
long stretches of the order in common, so they share a run: surely, where the
sketches hold the whole sets, and but for about 5e-10 at the very threshold
where sets are larger. Single values would put all documents that use one
common shingle into one list; runs keep the lists short.

Where sketches hold the whole sets, no link is lost. For larger sets two filters are statistical:
of pairs at the very threshold about 5e-10 share no run, and up to 4e-6 of those that no list ties
into one family lie beyond ``PARITY_FAR`` (binomial tails; both fall fast above the threshold).

From the lists to the groups, no list is expanded into its pairs:

1. Every member of a list is held against the list's first one, by the
   estimate from the union of both sketches. What lies above ``WEAK`` ties them into a family.
2. Members of one list in different families are compared by parity sketches
   inside the join, so that only likely pairs leave it; these tie families.
3. In a family all are verified against the first member, with exact
   sets. The members that fail are compared exactly with all others, in blocks of
   bounded size, and only links that join two parts leave a task.
4. Links are contracted to components.

Work on an unusual family, with many members just below the threshold, grows
with the members that fail times its size; all else is linear.

Defined cases: a text that is null or has no word has the empty set, is
linked with nothing and is kept; with fewer words than a shingle the whole
sequence is one shingle; equal sets are linked, at any size; a null id is
larger than any other, and a group without any id keeps the text with the
least hash; rows that repeat an id and a text are one document, so they are
kept or dropped together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows, text_words, written

SHINGLE = 5
PERCENT = 80
KEEP = 96
RUN, SHORT_RUN = 4, 3
# Sets of at most so many shingles also use short runs, of at least so many long ones.
SHORT_UPTO, LONG_FROM = 15, 13
# Estimates that tie a family, and a pair across families.
WEAK = 0.4
PARITY_WORDS = 8
# Bits by which the parity of two sketches of larger sets may differ: about 24 are expected at the threshold.
PARITY_FAR = 52
# A block of a family: at most about so many members and so many shingles.
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 200_000


# --- sets and sketches, in tasks ---------------------------------------------


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles, as signed longs."""
    words = text_words(text)
    if not words:
        return np.zeros(0, dtype=np.int64)
    if len(words) < size:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, runs), dtype=np.uint64)
    return np.unique(hashed.view(np.int64))


def parity(sketch: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of the values falls on them."""
    places = (sketch.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)
    odd = (np.bincount(places.astype(np.int64), minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``id, th, n, digest, sketch, bits`` of every document of ``doc_id, text``."""
    own = docs.select("text", F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"))
    kind = own.schema["id"].dataType.simpleString()

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets = [shingle_set(t, size) for t in batch.column(0).to_pylist()]
                yield {
                    "id": batch.column(1), "th": batch.column(2), "n": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "sketch": [s[:KEEP] for s in sets], "bits": [parity(s[:KEEP]) for s in sets],
                }

    return arrow_rows(
        own, f"id {kind}, th bigint, n bigint, digest binary, sketch array<bigint>, bits array<bigint>", work
    )


# --- inverted lists ----------------------------------------------------------


def _runs(sketch: Column, size: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(sketch) - size),
        lambda i: F.xxhash64(F.lit(size), *(F.get(sketch, i + k) for k in range(size))),
    )


def _all_but_one(sketch: Column) -> Column:
    """Hash of each set of four within a set of five; sets of four link only with these."""
    return F.transform(
        F.sequence(F.lit(0), F.size(sketch) - 1),
        lambda i: F.xxhash64(F.lit(-4), F.array_remove(sketch, F.get(sketch, i))),
    )


def list_keys(sketch: Column, n: Column) -> Column:
    """The inverted lists of a class."""
    none = F.array().cast("array<bigint>")
    return F.concat(
        F.when(n >= LONG_FROM, _runs(sketch, RUN)).otherwise(none),
        F.when((n >= SHORT_RUN) & (n <= SHORT_UPTO), _runs(sketch, SHORT_RUN)).otherwise(none),
        F.when(n == 5, _all_but_one(sketch)).otherwise(none),
        F.when(n == 4, F.array(F.xxhash64(F.lit(-4), sketch))).otherwise(none),
    )


def _lists(classes: DataFrame) -> DataFrame:
    """``key, cid, hub``: members of the lists that hold more than one class."""
    postings = classes.select("cid", F.explode_outer(list_keys(F.col("sketch"), F.col("n"))).alias("key"))
    postings = postings.filter("key is not null")
    shared = postings.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("most"))
    return postings.join(shared.filter("hub != most").select("key", "hub"), "key")


def _estimate(a: Column, b: Column) -> Column:
    """Jaccard similarity by the sketch of the union: its least values, and how many both have."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, KEEP)
    return F.size(F.array_intersect(F.array_intersect(a, b), least)) / F.size(least)


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("sketch").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _first_ties(lists: DataFrame, classes: DataFrame) -> DataFrame:
    pairs = lists.filter("hub != cid").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    return _with_sketches(pairs, classes).filter(_estimate(F.col("sa"), F.col("sb")) >= WEAK).select("a", "b")


def _ties_across(lists: DataFrame, families: DataFrame, classes: DataFrame) -> DataFrame:
    """Likely pairs of one list in different families."""
    family = F.coalesce("family", "cid")
    named = lists.join(families, "cid", "left").select("key", "cid", family.alias("family"))
    mixed = named.groupBy("key").agg(F.min("family").alias("f0"), F.max("family").alias("f1")).filter("f0 != f1")
    # Written, so that both sides of the join are dealt out anew and hot lists can be split.
    rows = written(
        named.join(mixed.select("key"), "key").join(classes.select("cid", "n", "bits"), "cid"), "mixed-lists"
    )
    a, b = (rows.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("cid", "family", "n", "bits"))) for x in "ab")
    far = sum(
        (F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(PARITY_WORDS)),
        F.lit(0),
    )
    n_a, n_b = F.col("n_a"), F.col("n_b")
    whole = (n_a <= KEEP) & (n_b <= KEEP)
    condition = (
        (a["key"] == b["key"]) & (F.col("cid_a") < F.col("cid_b")) & (F.col("family_a") != F.col("family_b"))
        & (n_a * 100 >= n_b * PERCENT) & (n_b * 100 >= n_a * PERCENT)
        & (far <= F.when(whole, (n_a + n_b) * (100 - PERCENT) / (100 + PERCENT)).otherwise(PARITY_FAR))
    )
    pairs = a.join(b, condition).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct()
    return _with_sketches(pairs, classes).filter(_estimate(F.col("sa"), F.col("sb")) >= WEAK).select("a", "b")


# --- components --------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) of the graph of ``a, b``, by contracting stars.

    Every round hangs the neighbours of a node under the least of them, so
    the number of rounds grows with the logarithm of the longest path.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = written(edges.filter("a != b").select(high, low).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u != v").distinct(), "edges")
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lows.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        now = written(small, "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    inner = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return inner.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# --- exact links -------------------------------------------------------------


def linked(a, b, percent: int = PERCENT) -> bool:
    """Whether two sets reach the threshold."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(a & b)
    return 100 * both >= percent * (small + large - both)


class Parts:
    """Which members of a block are in one part."""

    def __init__(self, parts: list[int]):
        self.above = {p: p for p in parts}

    def find(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def _linked_texts(size: int, percent: int):
    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        # The first member of a family stands in many rows in turn.
        last, held, out = None, frozenset(), []
        for x, y in zip(a, b, strict=True):
            if x != last:
                last, held = x, frozenset(shingle_set(x, size).tolist())
            out.append(linked(held, frozenset(shingle_set(y, size).tolist()), percent))
        return pd.Series(out, dtype=bool)

    return same


def _member_texts(docs: DataFrame, classes: DataFrame, families: DataFrame) -> DataFrame:
    """``family, cid, n, text`` of the classes in families: the text of each class' first document."""
    wanted = written(
        families.join(classes.select("cid", "n", "rep"), "cid")
        .select("family", "cid", "n", F.col("rep.id").alias("rid"), F.col("rep.th").alias("rth")),
        "members",
    )
    same = F.col("doc_id").eqNullSafe(F.col("rid")) & (F.xxhash64("text") == F.col("rth"))
    # The members grow with the documents: never a side to broadcast.
    own = docs.select("doc_id", "text").join(wanted.hint("merge"), same).dropDuplicates(["cid"])
    return written(own.select("family", "cid", "n", "text"), "member-texts")


def _exact_links(members: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to the first member of each family, and the further ones between its parts."""
    first = members.filter("family = cid").select("family", F.col("text").alias("first_text"))
    tested = written(
        members.filter("family != cid").join(first, "family").select(
            "family", "cid", "n", _linked_texts(size, percent)("first_text", "text").alias("ok")
        ),
        "tested",
    )
    star = tested.filter("ok").select(F.col("family").alias("a"), F.col("cid").alias("b"))
    blocks = F.ceil(
        F.greatest(F.count(F.lit(1)) / BLOCK_MEMBERS, F.sum("n") / BLOCK_SHINGLES, F.lit(1.0))
    ).cast("int")
    # Families in which somebody failed and somebody is left to compare with.
    of_failed = tested.filter(~F.col("ok")).groupBy("family").agg(blocks.alias("fail_blocks"))
    of_rest = tested.groupBy("family").agg(blocks.alias("main_blocks"), F.count(F.lit(1)).alias("others"))
    open_families = of_failed.join(of_rest, "family").filter("others > 1").select(
        "family", "fail_blocks", "main_blocks"
    )
    rows = (
        members.join(open_families, "family")
        .join(tested.select("cid", "ok"), "cid", "left")
        .withColumn("failed", ~F.coalesce("ok", F.lit(True)))
        .withColumn("part", F.when(F.col("failed"), F.col("cid")).otherwise(F.col("family")))
        .withColumn("at", F.xxhash64("cid"))
    )
    mine = F.pmod("at", F.col("fail_blocks")).cast("int")
    main = F.pmod("at", F.col("main_blocks")).cast("int")
    last_fail, last_main = F.col("fail_blocks") - 1, F.col("main_blocks") - 1
    # A cell is a block of failed ones against a block of the main part, or of failed ones.
    cell = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    every_fail, every_main = F.sequence(F.lit(0), last_fail), F.sequence(F.lit(0), last_main)
    cells = F.when(
        F.col("failed"),
        F.concat(
            F.transform(every_main, lambda y: cell(0, mine, y)),
            F.transform(every_fail, lambda y: cell(1, F.least(mine, y), F.greatest(mine, y))),
        ),
    ).otherwise(F.transform(every_fail, lambda x: cell(0, x, main)))
    dealt = rows.select(F.explode(cells).alias("cell"), "family", "cid", "part", "failed", "text").select(
        "family", "cell.kind", "cell.x", "cell.y", "cid", "part", "failed", "text"
    )
    # Few rows, but much work on each: a fixed number of tasks, which is not merged.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "family", "kind", "x", "y").sortWithinPartitions("family", "kind", "x", "y", "cid")

    def work(batches):
        for group in _groups(batches, 4):
            cids, parts, failed, texts = ([r[i] for r in group] for i in range(4, 8))
            sets = [frozenset(shingle_set(t, size).tolist()) for t in texts]
            joined, a, b = Parts(parts), [], []
            for i in range(len(sets)):
                for j in range(len(sets)) if failed[i] else ():
                    if i != j and joined.find(parts[i]) != joined.find(parts[j]) and linked(sets[i], sets[j], percent):
                        joined.join(parts[i], parts[j])
                        a.append(parts[i])
                        b.append(parts[j])
            if a:
                yield {"a": a, "b": b}

    return star, arrow_rows(dealt, "a bigint, b bigint", work)


def _groups(batches, width: int) -> Iterator[list[tuple]]:
    """Rows that follow each other with the same first columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:width] != row[:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


# --- the operator ------------------------------------------------------------


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` of every row of ``doc_id, text``."""
    if percent < PERCENT:
        raise ValueError(f"the lists are laid out for {PERCENT} per cent and more")
    signed = written(signatures(docs, size), "signatures")
    # Ids before nulls; the least one stands for a class and for a component.
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    classes = written(
        signed.filter("digest is not null").groupBy("digest").agg(
            F.min(rep).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.first("bits").alias("bits"),
        ).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    lists = written(_lists(classes), "lists")
    ties = written(_first_ties(lists, classes), "ties")
    families = components(ties).select(F.col("node").alias("cid"), F.col("component").alias("family"))
    across = written(_ties_across(lists, families, classes), "ties-across")
    if not across.isEmpty():
        families = components(ties.unionByName(across)).select(
            F.col("node").alias("cid"), F.col("component").alias("family")
        )
    members = _member_texts(docs, classes, families)
    star, further = _exact_links(members, size, percent)
    further = written(further, "links")
    parts = star
    if not further.isEmpty():
        parts = components(star.unionByName(further)).filter("node != component").select(
            F.col("component").alias("a"), F.col("node").alias("b")
        )
    of_class = classes.select("digest", "cid", "rep").join(
        parts.select(F.col("b").alias("cid"), F.col("a").alias("group")), "cid", "left"
    ).withColumn("group", F.coalesce("group", "cid"))
    least = of_class.groupBy("group").agg(F.min("rep").alias("first"))
    first = written(of_class.join(least, "group").select("digest", "first"), "class-groups")
    has = signed.filter("digest is not null").select("id", "th", "n", "digest").join(first, "digest")
    own = F.col("id").eqNullSafe(F.col("first.id")) & (~F.col("first.no_id") | (F.col("th") == F.col("first.th")))
    grouped = has.select(
        F.col("id").alias("doc_id"), F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"),
        F.col("first.id").alias("component_id"), own.alias("kept"),
    )
    alone = signed.filter("digest is null").select(
        F.col("id").alias("doc_id"), F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return grouped.unionByName(alone)


def keep_firsts(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents without the later ones of each group, with all their columns."""
    found = near_duplicates(docs.select("doc_id", "text"), size, percent).filter(~F.col("kept"))
    gone = written(
        found.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct(), "gone"
    )
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"])
    return docs.join(gone.hint("merge"), same, "left_anti")

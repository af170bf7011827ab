"""Limits on feed entries: per source, and over all sources in registry order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gladwire.session import written

_SALTS = 64
_BLOCK = 512


def limit_per_source(
    entries: DataFrame, limit: int, source: str = "source_id", order: str = "pos"
) -> DataFrame:
    """First ``limit`` entries of each source by ``order``, valid or not.

    Two rounds: each source is first cut within many slices, so a source with a
    third of all entries is ranked by many tasks and the second round sees at
    most ``limit`` entries per slice. ``order`` is unique within a source.
    """
    slice_window = Window.partitionBy(source, "_slice").orderBy(order)
    source_window = Window.partitionBy(source).orderBy(order)
    return (
        entries.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(_SALTS)))
        .withColumn("_rank", F.row_number().over(slice_window))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(source_window))
        .filter(F.col("_rank") <= limit)
        .drop("_slice", "_rank")
    )


def richer_snapshot(copies: DataFrame, is_url_copy: Column) -> DataFrame:
    """Of the copies of each feed the one with most entries; on a tie the URL copy."""
    fields = F.struct(*[c for c in copies.columns if c != "source_id"])
    rank = F.struct(F.coalesce(F.size("entries"), F.lit(0)), is_url_copy)
    chosen = copies.groupBy("source_id").agg(F.max_by(fields, rank).alias("_copy"))
    return chosen.select("source_id", "_copy.*")


def levels(n: int) -> int:
    """How often ``n`` places are put together, a block at a time, until one block is left."""
    return 0 if n <= _BLOCK else 1 + levels(-(-n // _BLOCK))


def sum_before(values: DataFrame, up: int) -> DataFrame:
    """``_at, _before``: the sum of ``_value`` over all earlier places of ``_at, _value``.

    Blocks of places are summed, blocks of blocks, and so on, ``up`` times; no
    task sees more than one block.
    """
    block = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_value").over(block), F.lit(0))
    blocked = values.withColumn("_block", F.floor(F.col("_at") / F.lit(_BLOCK)) if up else F.lit(0))
    within = blocked.select("_at", "_block", inside.alias("_inside"))
    if not up:
        return within.select("_at", F.col("_inside").alias("_before"))
    sums = blocked.groupBy(F.col("_block").alias("_at")).agg(F.sum("_value").alias("_value"))
    earlier = sum_before(sums, up - 1).select(F.col("_at").alias("_block"), F.col("_before").alias("_earlier"))
    return within.join(earlier, "_block").select("_at", (F.col("_inside") + F.col("_earlier")).alias("_before"))


def left_before(maps: DataFrame, limit: int, up: int) -> DataFrame:
    """``_at, _left``: what is left before each place of ``_at, _map, _first``.

    ``_map`` tells, for each number up to ``limit`` left before a place, how many are left after it;
    ``_first`` is known for the first place, and no larger elsewhere. Maps
    compose, so blocks of places become one map each, blocks of blocks as well,
    ``up`` times; then every block is replayed from what is left at its start.
    """
    steps = F.array_sort(F.collect_list(F.struct("_at", "_map")))
    block = F.floor(F.col("_at") / F.lit(_BLOCK)) if up else F.lit(0).cast("long")
    blocks = maps.groupBy(block.alias("_block")).agg(steps.alias("_steps"), F.max("_first").alias("_first"))
    if up:
        whole = F.transform(
            F.sequence(F.lit(0), F.lit(limit)),
            lambda r: F.aggregate("_steps", r, lambda left, s: F.get(s["_map"], left)),
        )
        composed = blocks.select(F.col("_block").alias("_at"), whole.alias("_map"), "_first")
        starts = left_before(composed, limit, up - 1).select(F.col("_at").alias("_block"), F.col("_left").alias("_start"))
        blocks = blocks.join(starts, "_block")
    else:
        blocks = blocks.withColumn("_start", F.col("_first"))

    def replay(state: Column, s: Column) -> Column:
        here = F.array(F.struct(s["_at"].alias("_at"), state["left"].alias("_left")))
        return F.struct(F.get(s["_map"], state["left"]).alias("left"), F.concat(state["seen"], here).alias("seen"))

    begin = F.struct(
        F.col("_start").cast("int").alias("left"), F.array().cast("array<struct<_at:bigint,_left:int>>").alias("seen")
    )
    seen = F.aggregate("_steps", begin, replay, lambda state: state["seen"])
    return blocks.select(F.explode_outer(seen).alias("s")).select("s.*")


def take_per_source(sources: DataFrame, cap: int, limit: int) -> DataFrame:
    """How many leading entries each source may hand over under a global cap.

    ``sources`` has one row per source: ``source_ord`` (from 0) and
    ``flags``, the validity of its first ``limit`` entries. Sources are served
    in order; each hands over up to ``min(limit, cap left)`` entries, of which
    only the valid ones use up the cap.

    While at least ``limit`` is left, a source always uses all its valid
    entries, so the start is a running sum. From then on the cap left is a
    number up to ``limit`` and each source maps it to a smaller one. Sums and maps
    are put together block by block, in as many levels as the number of sources asks for.
    """
    flags = F.slice("flags", 1, limit)
    valid_before = F.transform(
        F.sequence(F.lit(0), F.lit(limit)),
        lambda r: F.size(F.filter(F.slice(flags, F.lit(1), F.greatest(r, F.lit(0))), lambda f: f)),
    )
    served = sources.select(F.col("source_ord").cast("long").alias("_at"), valid_before.alias("_used"))
    last = sources.agg(F.max("source_ord").alias("last")).collect()[0]["last"]
    up = levels((last or 0) + 1)
    before = sum_before(served.select("_at", F.get("_used", F.lit(limit)).cast("long").alias("_value")), up)
    summed = served.join(before, "_at").withColumn("_left", F.lit(cap) - F.col("_before"))
    ample = F.col("_left") >= limit
    start = summed.filter(ample).select(F.col("_at").alias("source_ord"), F.lit(limit).alias("take"))

    # the scarce rest, in order; the first of them still knows the cap left
    after = F.transform("_used", lambda used, left: left - used)
    first = F.greatest(F.col("_left"), F.lit(0)).cast("int")
    rest = summed.filter(~ample).select("_at", after.alias("_map"), first.alias("_first"))
    end = left_before(rest, limit, up).select(F.col("_at").alias("source_ord"), F.col("_left").alias("take"))
    # sources after the point where nothing is left hand over nothing
    return start.unionByName(end).filter(F.col("take") > 0)


def global_cap(
    entries: DataFrame, cap: int, limit: int, valid: Column, order: str = "pos", dense: bool = False
) -> DataFrame:
    """Entries kept under a cap over all sources, invalid ones dropped.

    ``entries`` has ``source_ord`` and ``order`` unique within a source. Where
    ``order`` counts from 0 without gaps, say ``dense``: no ranking is needed.

    The entries are read twice. The first pass writes one row per source, with
    the place and validity of its first entries; from these comes the last
    place each source may hand over. The second pass only compares with it.
    """
    head = entries.select("source_ord", F.col(order).alias("_place"), valid.alias("_valid"))
    first = (
        head.filter(F.col("_place") < limit) if dense
        else limit_per_source(head, limit, "source_ord", "_place")
    )
    steps = F.array_sort(F.collect_list(F.struct("_place", "_valid")))
    heads = written(
        first.groupBy(F.col("source_ord").cast("long").alias("source_ord")).agg(steps.alias("_head")),
        "heads",
    )
    flags = heads.select("source_ord", F.transform("_head", lambda s: s["_valid"]).alias("flags"))
    last = F.element_at("_head", F.least(F.col("take"), F.size("_head")))["_place"]
    cuts = take_per_source(flags, cap, limit).join(heads, "source_ord").select(
        "source_ord", last.alias("_last")
    )
    kept = entries.join(cuts, "source_ord").filter(F.col(order) <= F.col("_last"))
    return kept.filter(valid).drop("_last")

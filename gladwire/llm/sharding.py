"""Contiguous shards of nearly equal bytes, from a global prefix sum.

Rows are ordered by id (then by checksum and size, nulls first) and laid out
in ranges. One total per range, added up in order, gives every range its
offset; a running sum inside the range completes the global prefix sum. The
total is cut at equal targets, and a row belongs to the shard in which its
middle lies. Only ids, sizes and checksums move, never texts.

Defined cases: a null text has size 1 and checksum 0; a null id comes first;
repeated rows are rows of their own, next to each other; an empty table gives
an empty result; with fewer rows than shards some shards stay empty. Shards
differ by at most the size of one row from the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gladwire.llm.common import written

SHARDS = 8
_ORDER = ("doc_id", "text_crc32", "size", "row")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``doc_id, text``."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
    )
    # The layout is written down, so that totals and sums see the same ranges.
    laid = written(
        rows.repartitionByRange(*_ORDER).withColumn("part", F.spark_partition_id()), "ranges"
    )
    offsets = _offsets(laid)
    inside = Window.partitionBy("part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        laid.withColumn("upto", F.sum("size").over(inside))
        .withColumn("rank", F.count(F.lit(1)).over(inside))
        .join(F.broadcast(offsets), "part")
    )
    middle = F.col("bytes_before") + F.col("upto") - F.col("size") / 2
    number = F.least(F.floor(middle * shards / F.col("bytes_all")), F.lit(shards - 1)).cast("int")
    placed = written(
        placed.select(
            "doc_id", "size", "text_crc32", number.alias("shard"),
            (F.col("rows_before") + F.col("rank") - 1).alias("place"),
        ),
        "placed",
    )
    starts = placed.groupBy("shard").agg(F.min("place").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("start")).alias("slot")
    )


def _offsets(laid: DataFrame) -> DataFrame:
    """Bytes and rows before each range: as many rows as the layout has ranges."""
    totals = laid.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    out, bytes_before, rows_before = [], 0, 0
    for t in sorted(totals.collect(), key=lambda t: t["part"]):
        out.append((t["part"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + t["bytes"], rows_before + t["rows"]
    schema = "part int, bytes_before bigint, rows_before bigint"
    return laid.sparkSession.createDataFrame(out, schema).withColumn(
        "bytes_all", F.lit(bytes_before).cast("bigint")
    )

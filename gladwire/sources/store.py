"""Article tables as partitioned Parquet folders under one root.

A keyed table has one row per key and is partitioned by a hash of the key
(``bucket``), so the rows that can meet a batch lie in the partitions that the
batch's keys name. Reads prune to these, and an update or a purge rewrites only
these, by dynamic partition overwrite. New keys are appended.

Every row carries the stream and the batch that wrote it. A batch that is
replayed after a crash drops, by an anti join, the rows it has written already;
its row in ``crawl_metrics`` comes last and tells that nothing is left to do.

Files may be of several schemas: columns that an older file lacks are null,
and narrower numbers are widened.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gladwire import fixed, schemas
from gladwire.functions.dates import format_datetime
from gladwire.operators.merge import collapse, insert_or_ignore
from gladwire.session import read_evolved, remove_folder, scratch

# Partitions of the large tables; a store keeps its number for life. Choose it so that
# a partition of ``crawled_articles`` holds some hundred megabytes.
BUCKETS = 16

# Stream and batch of a row; both null outside of streams.
Origin = tuple[str | None, int | None]

# key of a table, and the columns a later version of a row does not change
KEYS = {
    "articles": ("url", ("id", "created_at", "source_id")),
    "crawled_articles": ("url", ("id", "created_at", "source_id")),
    "sources": ("source_id", ("id", "created_at")),
    "categories": ("name", ("id", "created_at")),
    "thumbnail_cache": ("url", ()),
    "category_cache": ("cache_key", ()),
    "summary_cache": ("cache_key", ()),
    "title_dates": ("title", ()),
    "crawl_metrics": (None, ()),
    "bookmarks": (None, ()),
}
_ONE_BUCKET = ("sources", "categories", "crawl_metrics", "bookmarks")
_TITLED = ("articles", "crawled_articles")
_OWN = [
    T.StructField("_stream", T.StringType()), T.StructField("_batch", T.LongType()), T.StructField("bucket", T.IntegerType()),
]


class ArticleStore:
    """The tables under ``root``, a folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bucket(self, name: str, key: Column | None = None) -> Column:
        """The partition of a row of a table."""
        column = KEYS[name][0]
        if name in _ONE_BUCKET or column is None:
            return F.lit(0)
        return F.pmod(F.xxhash64(F.col(column) if key is None else key), F.lit(self.buckets)).cast("int")

    # --- reading ---

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """All columns, origin and partition included, of the given partitions, or of all."""
        kind = T.StructType(schemas.TABLES[name].fields + _OWN)
        rows = read_evolved(self.spark, self.path(name), kind)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(sorted(buckets)))

    def scan(
        self,
        name: str,
        columns: Sequence[str] | None = None,
        keys: DataFrame | None = None,
        other_than: Origin = (None, None),
    ) -> DataFrame:
        """The table, or some of its columns.

        ``keys`` are the only keys wanted; only the partitions that can hold them are read.
        Rows of the batch ``other_than`` are left out.
        """
        columns = list(columns or schemas.TABLES[name].names)
        rows = self.read(name, None if keys is None else self.touched(name, keys))
        if other_than != (None, None):
            rows = rows.filter(~written_by(other_than))
        if keys is not None:
            rows = rows.join(keys.select(KEYS[name][0]), KEYS[name][0], "left_semi")
        return rows.select(*columns)

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """The partitions that can hold the keys: at most as many numbers as the table has."""
        return [r["bucket"] for r in keys.select(self.bucket(name).alias("bucket")).distinct().collect()]

    def finished(self, origin: Origin) -> bool:
        """Whether a batch of a stream was run to its end."""
        return not self.read("crawl_metrics").filter(written_by(origin)).isEmpty()

    # --- writing ---

    def _ready(self, name: str, rows: DataFrame, origin: Origin = (None, None)) -> DataFrame:
        """Rows in the columns of the table, with partition and origin."""
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.TABLES[name].fields
        ]
        own = [
            (F.col(c) if c in rows.columns else F.lit(given)).cast(kind).alias(c)
            for c, given, kind in (("_stream", origin[0], "string"), ("_batch", origin[1], "long"))
        ]
        return rows.select(*columns, *own).withColumn("bucket", self.bucket(name))

    def _write(self, name: str, ready: DataFrame, mode: str) -> None:
        # rows of a partition meet in few tasks, so that it gets few files; large ones are split
        dealt = ready.hint("rebalance", F.col("bucket"))
        dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path(name))

    def _overwrite(self, name: str, ready: DataFrame, old: Iterable[int] = ()) -> None:
        """Make the rows the whole content of their partitions; partitions of ``old`` without rows go."""
        left = {r["bucket"] for r in ready.select("bucket").distinct().collect()} if old else set()
        self._write(name, ready, "overwrite")
        for bucket in set(old) - left:
            remove_folder(self.spark, f"{self.path(name)}/bucket={bucket}")

    def collapsed(self, name: str, rows: DataFrame, order: str = "seq", last: Column | None = None) -> DataFrame:
        """One row per key, in the columns of the table."""
        key, kept = KEYS[name]
        return self._ready(name, collapse(rows, key, order, kept, last)).select(*schemas.TABLES[name].names)

    def upsert(self, name: str, rows: DataFrame, order: str = "seq", last: Column | None = None) -> None:
        """Insert or update a batch; rewrites the partitions of its keys, and no other."""
        key, kept = KEYS[name]
        with scratch(self._ready(name, self.collapsed(name, rows, order, last)), f"upsert-{name}") as fresh:
            touched = self.touched(name, fresh)
            old = self.read(name, touched).withColumn("_age", F.lit(0))
            both = old.unionByName(fresh.withColumn("_age", F.lit(1))).drop("bucket")
            self._overwrite(name, self._ready(name, collapse(both, key, "_age", kept)))
            self._index(name, fresh)

    def append(self, name: str, rows: DataFrame, origin: Origin = (None, None), index: bool = True) -> None:
        """Add rows whose keys the table does not hold, or to a table without key.

        ``index=False`` leaves out the titles, for rows whose titles another table brings.
        """
        ready = self._ready(name, rows, origin)
        self._write(name, ready, "append")
        if index:
            self._index(name, ready)

    def append_once(
        self, name: str, rows: DataFrame, origin: Origin, buckets: Iterable[int] | None = None, index: bool = True
    ) -> None:
        """``append``, without the rows that the same batch has written before.

        ``buckets`` are the partitions of the rows, where they are known.
        """
        if origin != (None, None):
            key = KEYS[name][0]
            before = self.read(name, buckets).filter(written_by(origin)).select(key)
            rows = rows.join(before, key, "left_anti")
        self.append(name, rows, origin, index)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Make ``rows``, one per key, the whole table."""
        with scratch(self._ready(name, rows), f"replace-{name}") as ready:
            old = [r["bucket"] for r in self.read(name).select("bucket").distinct().collect()]
            self._overwrite(name, ready, old)
            self._index(name, ready)

    def purge(self, name: str, gone: Column) -> None:
        """Remove rows; partitions without such rows stay as they are, file by file."""
        hit = [r["bucket"] for r in self.read(name).filter(gone).select("bucket").distinct().collect()]
        if hit:
            stays = ~F.coalesce(gone, F.lit(False))
            self._overwrite(name, self.read(name, hit).filter(stays), hit)

    def compact(self, name: str) -> None:
        """Write each partition that has several files as few; its rows do not change."""
        files = self.read(name).select("bucket", F.input_file_name().alias("file")).groupBy("bucket")
        many = files.agg(F.count_distinct("file").alias("n")).filter("n > 1").select("bucket").collect()
        if many:
            self._write(name, self.read(name, [r["bucket"] for r in many]), "overwrite")

    def _index(self, name: str, rows: DataFrame) -> None:
        """Add titles with their dates and urls to ``title_dates``, partitioned by the title.

        Entries may be out of date, as urls can get other titles; who looks up goes on to the row.
        """
        if name in _TITLED:
            entries = rows.select("title", format_datetime("published_at").alias("happened"), "url").filter(
                "title is not null and happened is not null"
            )
            self._write("title_dates", self._ready("title_dates", entries), "append")

    # --- seeds ---

    def seed(self, registry_rows: DataFrame | None = None) -> None:
        """Add the default categories and the sources of a registry where they are missing."""
        table = schemas.CATEGORIES
        labels = self.spark.createDataFrame(
            [(i, *row) for i, row in enumerate(fixed.CATEGORY_SEED)],
            "seq long, name string, slug string, description string, icon string, color string",
        )
        self.replace(
            "categories",
            insert_or_ignore(self.scan("categories"), self._stamped(labels, "slug", table), ["name", "slug"]),
        )
        if registry_rows is not None:
            seeds = self._stamped(registry_rows, "source_id", schemas.SOURCES)
            self.replace("sources", insert_or_ignore(self.scan("sources"), seeds, ["source_id"]))

    def _stamped(self, rows: DataFrame, key: str, schema) -> DataFrame:
        stamped = rows.withColumns({"id": F.xxhash64(key), "created_at": F.current_timestamp()})
        return stamped.select(
            "seq",
            *[
                (F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ],
        )


def written_by(origin: Origin) -> Column:
    """Whether a row was written by a batch of a stream."""
    return F.col("_stream").eqNullSafe(F.lit(origin[0])) & F.col("_batch").eqNullSafe(F.lit(origin[1]))

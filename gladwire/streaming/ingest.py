"""Streams of articles: incremental runs, and dedup without a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gladwire.plans.run import RunOptions, run_batch
from gladwire.sources.store import ArticleStore


def ingest_stream(
    store: ArticleStore,
    articles: DataFrame,
    checkpoint: str,
    options: RunOptions = RunOptions(),
    name: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Run every arriving batch of a stream of articles into the store.

    Without ``interval`` the query stops when all that has arrived is run; with
    one, such as ``"30 seconds"``, it goes on and looks for arrivals that often, until it is stopped.

    Batch ids count from 0 in every checkpoint, so they are compared only
    within a stream: ``name``, by default the folder of its checkpoint. Every stored
    row carries the name and the id. A batch that was run to its end is skipped when it is replayed; one
    that died half-way is run again, drops the rows it has stored already and adds the rest. A
    stream that starts anew from another checkpoint runs all its batches; what
    the store knows is dropped by the run itself.
    """
    stream = name or checkpoint

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if not store.finished((stream, batch_id)):
            run_batch(store, batch, options, (stream, batch_id))

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        articles.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def drop_repeats(articles: DataFrame, delay: str = "7 days", arrived: str = "crawled_at") -> DataFrame:
    """First arrival of each url within the delay; the state of older urls is dropped.

    Time is the moment of arrival, which the crawl sets. The date of an
    article is its publisher's: an old one is no late row, and one in the
    future must not move the watermark.
    """
    return articles.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(["url"])


def write_unique(
    articles: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "7 days",
    arrived: str = "crawled_at",
    interval: str | None = None,
) -> StreamingQuery:
    """Append the first arrivals to a folder of Parquet files.

    The urls of the delay are kept in RocksDB on the executors' disks and saved to the
    checkpoint as changes; a query that is stopped or dies goes on from there. As with
    ``ingest_stream``, it stops when all is read, or goes on with an ``interval``.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        drop_repeats(articles, delay, arrived).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Urls kept, bytes of memory and of files they take, as of the last batch; zeros before the first."""
    operators = (query.lastProgress or {}).get("stateOperators", [])
    return {
        "rows": sum(o["numRowsTotal"] for o in operators),
        "memory_bytes": sum(o["memoryUsedBytes"] for o in operators),
        "file_bytes": sum(o["customMetrics"].get("rocksdbSstFileSize", 0) for o in operators),
    }

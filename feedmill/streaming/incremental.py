"""The incremental mode: items arrive as a stream; what was seen is state, the feed is a table of versions (ST1-ST5, ST8).

There is no watermark by default: an address seen once is seen for good, as in a batch run. Where addresses may be
forgotten, ``new_addresses`` takes a delay and keeps state for that long only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedmill.operators import feed, merge
from feedmill.operators.state import SEEN_WINDOW
from feedmill.shared import shared_dir


def landed(spark: SparkSession, path: str, files_at_once: int = 4) -> DataFrame:
    """A folder (or file) of landed Parquet as a stream."""
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a file, too
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(pattern)


def new_addresses(items: DataFrame, delay: str | None = None, time: str = "fetched_at") -> DataFrame:
    """Items whose address their source hasn't had before; with ``delay``, not within that time."""
    if delay:
        return items.withWatermark(time, delay).dropDuplicatesWithinWatermark(["source", "url"])
    return items.dropDuplicates(["source", "url"])


def first_sightings(items: DataFrame, time: str = "fetched_at") -> DataFrame:
    """(id, first_seen): the earliest time each item was met."""
    return items.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(time).alias("first_seen"))


class SeenWindow(StatefulProcessor):
    """Keeps a source's last addresses, ``SEEN_WINDOW`` of them, and passes on those that are not among them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "url string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = [r[0] for r in self.seen.get()] if self.seen.exists() else []
        among = set(known)
        fresh = []
        for pdf in rows:
            for url in pdf.sort_values("ord")["url"]:
                if url is not None and url not in among:
                    among.add(url)
                    fresh.append(url)
        if fresh:
            self.seen.put([(u,) for u in (fresh[::-1] + known)[:SEEN_WINDOW]])
        yield pd.DataFrame({"source": [key[0]] * len(fresh), "url": fresh})

    def close(self) -> None:
        pass


def unseen(items: DataFrame) -> DataFrame:
    """(source, url) of the addresses that are not among their source's last ones. Needs the RocksDB state store."""
    keyed = items.select("source", "url", "ord").groupBy("source")
    return keyed.transformWithStateInPandas(SeenWindow(), outputStructType="source string, url string", outputMode="append", timeMode="none")


class FeedTable:
    """A feed that micro-batches are merged into. Each batch writes the version that carries its number, so a batch that is
    run again after a failure changes nothing."""

    def __init__(self, spark: SparkSession, first_seen: DataFrame, path: str | None = None):
        self.spark, self.first_seen = spark, first_seen
        self.path = path or f"{shared_dir(spark)}/feed-{uuid.uuid4().hex}"

    def version(self, epoch: int) -> str:
        return f"{self.path}/version-{epoch:09d}"

    def upsert(self, batch: DataFrame, epoch: int) -> None:
        before = self.spark.read.parquet(self.version(epoch - 1)) if epoch else batch.limit(0)
        merged = merge.merge(before, batch, self.first_seen).drop("side")
        merged.write.mode("overwrite").parquet(self.version(epoch))
        self.last = epoch

    def items(self) -> DataFrame:
        return feed.built(self.spark.read.parquet(self.version(self.last)))


def finished(stream: DataFrame, mode: str = "append", sink: str | None = None) -> DataFrame:
    """All that a stream of what has landed by now gives, as a table."""
    spark = stream.sparkSession
    path = sink or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/log").outputMode(mode).trigger(availableNow=True).start()
    else:
        write = lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out")
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/log").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def feed_of(items: DataFrame, table: FeedTable) -> DataFrame:
    """The feed after all that has landed by now was merged, a micro-batch at a time."""
    query = items.writeStream.foreachBatch(table.upsert).option("checkpointLocation", f"{table.path}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    return table.items()

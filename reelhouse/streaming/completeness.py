"""Completeness of seat data over sliding windows, from a stream of shows in any order.

A batch leaves the sums of its own windows; sums add up, so no state and no watermark is held and a show that comes months
late counts in its window like any other. A batch run again replaces its own sums. Every so many batches the sums so far
are added up into one table, so that reading the totals doesn't grow with the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse.plans import monitor
from reelhouse.session import children, complete

_COUNTS = ("total_shows", "missing_shows")
_SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, total_shows bigint, missing_shows bigint"


class CompletenessSums:
    def __init__(self, spark: SparkSession, folder: str, length: str = "5 hours", step: str = "1 hour", compact_every: int = 100):
        self.spark, self.folder, self.length, self.step, self.compact_every = spark, folder.rstrip("/"), length, step, compact_every

    def _added(self, before: int | None = None) -> int:
        """Batches that the newest table of added sums holds; one that holds `before` or later doesn't count."""
        known = [int(n.removeprefix("batches=")) for n in children(self.spark, f"{self.folder}/added")]
        known = [n for n in known if (before is None or n <= before) and complete(self.spark, f"{self.folder}/added/batches={n}")]
        return max(known, default=0)

    def _sums(self, before: int | None = None) -> DataFrame:
        first = self._added(before)
        paths = [f"{self.folder}/added/batches={first}"] if first else []
        if before is None:
            numbers = (int(n.removeprefix("batch=")) for n in children(self.spark, f"{self.folder}/partial"))
        else:
            numbers = range(first, before)
        paths += [p for n in numbers if n >= first and complete(self.spark, p := f"{self.folder}/partial/batch={n}")]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths)
        return rows.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in _COUNTS])

    def apply_batch(self, shows: DataFrame, batch_id: int) -> None:
        if batch_id - self._added(batch_id) >= self.compact_every:
            self._sums(batch_id).write.mode("overwrite").parquet(f"{self.folder}/added/batches={batch_id}")
        counted = monitor.sliding_completeness(shows, self.length, self.step)
        bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
        counted.select(*bounds, *_COUNTS).write.mode("overwrite").parquet(f"{self.folder}/partial/batch={batch_id}")

    def totals(self) -> DataFrame:
        """window_start, window_end, total_shows, missing_shows and alert of every window that any show fell into."""
        return self._sums().withColumn("alert", F.col("missing_shows") / F.col("total_shows") >= monitor.THRESHOLD)

    def start(self, shows: DataFrame, interval: str | None = None) -> StreamingQuery:
        """Run the stream: every interval, or once over all that has landed."""
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return shows.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(**trigger).start()

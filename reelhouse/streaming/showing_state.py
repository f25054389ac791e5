"""Current state of the showings as Parquet partitions that a micro-batch can read and replace piece by piece.

Showings lie by bucket of their id and by the day they start. Updates are appended per batch; every so many batches they
are laid over the partitions they touch, which are written anew under the next version. A manifest names the version of
every partition; writing it is what makes a version count, so a run that dies on the way leaves the one before in force.

So a batch reads the partitions of its own shows and the updates since the last compaction, however long the history is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from reelhouse.session import children, complete, remove, written

STATE_FIELDS = ("seats_sold", "screen_id", "scraped_at")
UPDATE_SCHEMA = (
    "id bigint, seats_sold int, screen_id bigint, scraped_at timestamp_ntz, path string, measured_at timestamp_ntz, bucket int, day string, batch_id bigint"
)
NO_DAY = "none"


def day_of(at: Column) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(NO_DAY))


def overlaid(base: DataFrame, updates: DataFrame) -> DataFrame:
    """State rows with the update measured last laid over each."""
    latest = updates.groupBy("id").agg(F.max(F.struct("measured_at", "batch_id", *STATE_FIELDS)).alias("_u"))
    new = {c: F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c)) for c in STATE_FIELDS}
    new["measured_at"] = F.greatest("measured_at", "_u.measured_at")
    return base.join(latest, "id", "left").select(*[new[c].alias(c) if c in new else F.col(c) for c in base.columns])


class ShowingState:
    def __init__(self, spark: SparkSession, folder: str, showings: DataFrame, buckets: int = 64):
        """State of `showings` (id, start_at, seats_sold, screen_id, scraped_at and any others) kept in `folder`.

        The table is laid out when the folder holds no state yet; later shows come in through `add`.
        """
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        kept = [f for f in showings.schema.fields if f.name != "measured_at"]
        at = StructField("measured_at", StructType.fromDDL("m timestamp_ntz")["m"].dataType)
        self.rows_schema = StructType([*kept, at])
        parts = [StructField("bucket", IntegerType()), StructField("day", StringType())]
        self.schema = StructType([*self.rows_schema.fields, StructField("version", IntegerType()), *parts])
        if self.newest() is None:
            self._put(self._placed(showings.withColumn("measured_at", F.lit(None).cast("timestamp_ntz"))), 0, None, -1)

    # ---- layout -----------------------------------------------------------------------------
    def bucket(self, id_: Column) -> Column:
        return F.pmod(F.xxhash64(id_.cast("bigint")), F.lit(self.buckets)).cast("int")

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.rows_schema.names).withColumns({"bucket": self.bucket(F.col("id")), "day": day_of(F.col("start_at"))})

    def newest(self, before: int | None = None) -> tuple[int, int] | None:
        """(version, last batch it holds) of the newest manifest that holds no batch from `before` on."""
        known = [tuple(map(int, n.split("_"))) for n in children(self.spark, f"{self.folder}/manifest")]
        for version, batches in sorted(known, reverse=True):
            if (before is None or batches <= before) and complete(self.spark, f"{self.folder}/manifest/{version}_{batches}"):
                return version, batches - 1
        return None

    def manifest(self, version: int, upto: int) -> DataFrame:
        return self.spark.read.schema("bucket int, day string, version int").parquet(f"{self.folder}/manifest/{version}_{upto + 1}")

    def _put(self, placed: DataFrame, version: int, before: tuple[int, int] | None, upto: int) -> None:
        """Write whole partitions under a version, then the manifest in which they replace the ones before."""
        path = f"{self.folder}/state/version={version}"
        placed.repartition("bucket", "day").write.mode("overwrite").partitionBy("bucket", "day").parquet(path)
        kind = StructType([f for f in self.schema.fields if f.name != "version"])
        new = self.spark.read.schema(kind).parquet(path).select("bucket", "day").distinct().withColumn("version", F.lit(version))
        if before is not None:
            new = self.manifest(*before).join(new, ["bucket", "day"], "left_anti").unionByName(new)
        new.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/{version}_{upto + 1}")

    def _read(self, parts: list) -> DataFrame:
        paths = [f"{self.folder}/state/version={p['version']}/bucket={p['bucket']}/day={p['day']}" for p in parts]
        if not paths:
            return self._none(self.rows_schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/state").parquet(*paths)
        return rows.select(*self.rows_schema.names)

    def _none(self, kind: StructType) -> DataFrame:
        """No rows, which the optimizer sees: joins with them fall away."""
        return self.spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields])

    # ---- reading ----------------------------------------------------------------------------
    def updates(self, after: int = -1, before: int | None = None) -> DataFrame:
        """Appended updates of the batches behind `after` and ahead of `before`."""
        if before is None:
            found = [f"{self.folder}/updates"] if children(self.spark, f"{self.folder}/updates") else []
        else:
            found = [p for n in range(after + 1, before) if complete(self.spark, p := f"{self.folder}/updates/batch_id={n}")]
        if not found:
            return self._none(StructType.fromDDL(UPDATE_SCHEMA))
        rows = self.spark.read.schema(UPDATE_SCHEMA).option("basePath", f"{self.folder}/updates").parquet(*found)
        return rows.where(F.col("batch_id") > after)

    def slice(self, wanted: DataFrame, before: int) -> DataFrame:
        """State, as of the batches ahead of `before`, of the shows in `wanted` (showing_id, measured_at).

        Shows start within a day of being measured, so the partitions around that day are read. Only for shows not
        found there are the other days of their buckets read too. No more than the batch's own (bucket, day) pairs
        come to the driver. What is asked and what is found near are written once; they go with the block around (`scratch`).
        """
        at = self.newest(before)
        asked = wanted.where(F.col("showing_id").isNotNull()).select(F.col("showing_id").alias("id"), F.to_date("measured_at").alias("_at")).distinct()
        asked = written(asked.withColumn("bucket", self.bucket(F.col("id"))), "asked")
        ids = asked.select("id", "bucket").dropDuplicates(["id"])
        days = asked.select("bucket", "_at").distinct().select("bucket", F.explode(F.array(*[day_of(F.date_add("_at", n)) for n in (-1, 0, 1)])).alias("day")).distinct()
        manifest = self.manifest(*at)
        near = manifest.join(days, ["bucket", "day"]).select("bucket", "day", "version").collect()
        held = ids.withColumnRenamed("bucket", "_bucket").join(self._read(near).withColumn("_held", F.lit(True)), "id", "left")
        held = written(held.select("_bucket", "_held", *self.rows_schema.names), "held")
        rows = held.where("_held").select(*self.rows_schema.names)
        missing = held.where("_held is null").select("id", F.col("_bucket").alias("bucket"))
        far = manifest.join(missing.select("bucket").distinct(), "bucket", "left_semi").join(days, ["bucket", "day"], "left_anti").collect()
        if far:
            rows = rows.unionByName(self._read(far).join(missing.select("id"), "id", "left_semi"))
        return overlaid(rows, self.updates(at[1], before).join(ids.select("id"), "id", "left_semi"))

    def current(self) -> DataFrame:
        """The whole table, all updates laid over it. Partitions of older versions are pruned by the manifest."""
        at = self.newest()
        rows = self.spark.read.schema(self.schema).parquet(f"{self.folder}/state").join(self.manifest(*at), ["bucket", "day", "version"], "left_semi")
        return overlaid(rows.select(*self.rows_schema.names), self.updates(at[1])).drop("measured_at")

    # ---- writing ----------------------------------------------------------------------------
    def compact(self, before: int) -> None:
        """Lay the updates ahead of batch `before` over the partitions they touch, and only over those."""
        at = self.newest(before)
        since = self.updates(at[1], before)
        touched = self.manifest(*at).join(since.select("bucket", "day").distinct(), ["bucket", "day"], "left_semi").collect()
        self._put(self._placed(overlaid(self._read(touched), since)), self.newest()[0] + 1, at, before - 1)

    def add(self, showings: DataFrame) -> None:
        """Take in shows that are not held yet; a show keeps the day it was taken in with."""
        at = self.newest()
        new = written(self._placed(showings.withColumn("measured_at", F.lit(None).cast("timestamp_ntz")).dropDuplicates(["id"])), "new-showings")
        touched = self.manifest(*at).join(new.select("bucket", "day").distinct(), ["bucket", "day"], "left_semi").collect()
        held = self._placed(self._read(touched))
        self._put(held.unionByName(new.join(held.select("id"), "id", "left_anti")), at[0] + 1, at, at[1])

    def remove_stale(self, keep: int = 2) -> None:
        """Remove versions that none of the last `keep` manifests names, and older manifests."""
        known = sorted(tuple(map(int, n.split("_"))) for n in children(self.spark, f"{self.folder}/manifest"))
        named = {r["version"] for v, b in known[-keep:] for r in self.manifest(v, b - 1).select("version").distinct().collect()}
        for version, batches in known[:-keep]:
            remove(self.spark, f"{self.folder}/manifest/{version}_{batches}")
        for name in children(self.spark, f"{self.folder}/state"):
            version = name.removeprefix("version=")
            if version.isdigit() and int(version) < known[-1][0] and int(version) not in named:
                remove(self.spark, f"{self.folder}/state/{name}")

"""Keyed merges into a partitioned table: only the partitions that the source's keys lie in are read and rewritten.

The source is evaluated once, into the shared folder; its partition values become literals, so the scan of the target
reads the files of those partitions alone. Target and source rows meet in one tagged union, grouped by key, and the
result replaces the partitions by dynamic overwrite. It is written to the shared folder first, so a run that dies while
partitions are being replaced is finished by running the merge again: merges are idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators import merge
from reelhouse.session import held


class PartitionedTable:
    """A Parquet folder partitioned by one column of its rows, or by a value computed from them."""

    def __init__(self, spark: SparkSession, path: str, partition: str, of: Callable[[DataFrame], Column] | None = None):
        """`of` gives the partition value of any rows that hold the key; without it the column itself is the value."""
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.of = of or (lambda rows: F.col(partition))

    def create(self, rows: DataFrame) -> None:
        self._placed(rows).hint("rebalance", self.partition).write.mode("errorifexists").partitionBy(self.partition).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.partition, self.of(rows))

    def slice(self, values: list) -> DataFrame:
        """The partitions of some values; the filter reaches the scan as a partition filter."""
        found = F.col(self.partition).isin([v for v in values if v is not None])
        if None in values:
            found = found | F.col(self.partition).isNull()
        return self.read().where(found)

    def merge(self, source: DataFrame, keys: list[str], rules: dict[str, merge.Rule], only_if: Column | None = None, insert: bool = True) -> None:
        """Merge `source` (one row per key) by the rules of operators.merge; with `insert`, keys the table lacks come in.

        The partition value must follow from the key columns or be among the source's own. Rows whose key is not in the
        source, and all other partitions, stay untouched.
        """
        with held(self._placed(source), "merge-source") as rows:
            values = [r[0] for r in rows.select(self.partition).distinct().collect()]  # one per partition to rewrite
            if not values:
                return
            with held(tagged_merge(self.slice(values), rows, keys, rules, only_if, insert), "merge-result") as result:
                writer = result.hint("rebalance", self.partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(self.partition).parquet(self.path)


def tagged_merge(
    target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, merge.Rule], only_if: Column | None = None, insert: bool = True
) -> DataFrame:
    """merge.merge (or, without `insert`, merge.update) as one union and one grouping: either side is evaluated once.

    A target row is kept apart by its content, so rows that repeat a key stay as many as they were. Keys with a null
    meet nothing, as in a join.
    """
    names = target.columns
    nothing = F.lit(None)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    own = F.struct(*[F.col(c) for c in names])
    rest = [c for c in source.columns if c not in keys]
    given = F.struct(*[F.col(c) for c in (*keys, *rest)])
    left = target.select(*keys, own.alias("t"), nothing.cast(source.select(given.alias("s")).schema["s"].dataType).alias("s"))
    right = source.select(*keys, nothing.cast(left.schema["t"].dataType).alias("t"), given.alias("s"))
    apart = F.when(null_key, F.monotonically_increasing_id())  # null keys spread out and meet nothing
    both = left.unionByName(right).withColumn("_apart", apart)
    grouped = both.groupBy(*keys, "_apart").agg(F.collect_list("t").alias("_ts"), F.first("s", ignorenulls=True).alias("s"))
    met = F.explode_outer("_ts").alias("t")
    rows = grouped.select("s", met)
    update_it = F.col("t").isNotNull() & F.col("s").isNotNull()
    if only_if is not None:
        update_it = update_it & F.coalesce(only_if, F.lit(False))
    columns = []
    for f in target.schema.fields:
        new = F.col(f"s.{f.name}") if f.name in source.columns else nothing
        inserted = F.when(F.col("t").isNull(), new.cast(f.dataType))
        changed = inserted.when(update_it, rules[f.name](F.col(f"t.{f.name}"), new).cast(f.dataType)) if f.name in rules else inserted
        columns.append(changed.otherwise(F.col(f"t.{f.name}")).alias(f.name))
    kept = rows if insert else rows.where(F.col("t").isNotNull())
    return kept.select(*columns)

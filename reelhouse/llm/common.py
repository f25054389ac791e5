"""What several operators share: row keys, tables written once, running totals and connected components."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.session import written

#: White space of the operators' word rules, as a Java and RE2 character class.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Edges that a task contracts at a time.
EDGES_AT_ONCE = 1 << 20


def text_of(column: str = "text") -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(column: str = "text") -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.lit(17), text_of(column), F.length(text_of(column)))


def chosen_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The whole rows of `docs` named by `chosen` (doc_id, row_key, repeats), in the columns of `docs`.

    A named row that stands several times in `docs` (repeats > 1) comes out once.
    """
    names = docs.columns
    keyed = docs.withColumn("_llm_key", row_key())
    named = chosen.select(F.col("doc_id").alias("_llm_id"), F.col("row_key").alias("_llm_chosen"), "repeats")
    same = keyed["doc_id"].eqNullSafe(F.col("_llm_id")) & (F.col("_llm_key") == F.col("_llm_chosen"))
    several = named.where("repeats > 1")
    if several.isEmpty():
        return keyed.join(named, same, "left_semi").select(*names)
    once = keyed.join(named.where("repeats = 1"), same, "left_semi").select(*names)
    first = keyed.join(several, same, "left_semi").dropDuplicates(["doc_id", "_llm_key"]).select(*names)
    return once.unionByName(first)


def running_total(df: DataFrame, order: list[Column], value: Column, purpose: str, name: str = "before") -> DataFrame:
    """Adds the sum of `value` over all rows that come before a row in the total order.

    Rows are dealt by range and written once, so that the partition they fell into is fixed; each partition then needs
    only the sum of the ones before it. The ordered window over partitions holds one row per partition.
    """
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).withColumn("_value", value)
    dealt = written(dealt, purpose)
    sums = dealt.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    total = local.join(offsets, "_part").withColumn(name, F.col("_local") + F.col("_offset"))
    return total.drop("_part", "_value", "_local", "_offset")


def join_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give the members of each pair the smallest label of all that they reach."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while not np.array_equal(jumped := labels[labels], labels):
            labels[:] = jumped


def _contracted(edges: DataFrame) -> DataFrame:
    """src, dst: fewer edges with the same components; every EDGES_AT_ONCE edges of a task become stars around their smallest nodes."""

    def stars(left: list[np.ndarray], right: list[np.ndarray]) -> pd.DataFrame:
        nodes, ends = np.unique(np.concatenate([*left, *right]), return_inverse=True)
        labels = np.arange(len(nodes))
        join_labels(labels, *np.split(ends, 2))
        moved = np.flatnonzero(labels != np.arange(len(nodes)))
        return pd.DataFrame({"src": nodes[moved], "dst": nodes[labels[moved]]})

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, waiting = [], [], 0
        for rows in batches:
            left.append(rows["src"].to_numpy())
            right.append(rows["dst"].to_numpy())
            waiting += len(rows)
            if waiting >= EDGES_AT_ONCE:
                yield stars(left, right)
                left, right, waiting = [], [], 0
        if waiting:
            yield stars(left, right)

    return edges.mapInPandas(contract, "src long, dst long")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every edge leads from a node to its root: each src has one dst and is none itself."""
    ends = edges.select(F.col("src").alias("node"), "dst").union(edges.select(F.col("dst").alias("node"), F.lit(None).cast("long")))
    of = ends.groupBy("node").agg(F.min("dst").alias("low"), F.max("dst").alias("high"), F.bool_or(F.col("dst").isNull()).alias("below"))
    return of.where("low < high or (below and low is not null)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (src, dst); root is the smallest node reachable.

    Each task first contracts the edges it holds. Then large-star and small-star steps alternate until every edge leads
    from a node to its root. A hub never gathers its neighbours: each step is a minimum (combined before the shuffle) and
    an equi-join, and each round is written to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    current = written(_contracted(edges.where("src <> dst").select("src", "dst")), "edges")
    while not _all_stars(current):
        both = current.union(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        lowest = both.groupBy("src").agg(F.min(F.least("src", "dst")).alias("low"))
        large = both.join(lowest, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        lowest = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(lowest, "src")
        small = lowest.select("src", F.col("low").alias("dst")).union(
            small.where("dst > low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        )
        current = written(small.distinct(), "edges")
    return current.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(current.select("dst", "dst")).distinct()


def all_of(conditions: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)

"""Approximate nearest neighbours over stable projections.

Vectors are projected by a Gaussian matrix to a few dimensions, where a squared distance, divided by the true one, follows
a chi-square law. The projections are indexed by kd-trees: the upper levels, fitted on a bounded sample, cut the table into
cells; every cell (or an even share of a crowded one) has a tree of its own in the task that searches it. A query takes
projected neighbours in rising order and verifies their true distance, until the chi-square test says that whatever is
still unseen is, at the asked confidence, farther than the k-th nearest found.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.session import written

#: Projected dimensions (even), and the confidence of the stopping test: a true neighbour is missed with 1 - CONFIDENCE.
DIMENSIONS, CONFIDENCE = 10, 0.98
SEED = 5
#: Rows that the upper levels are fitted on at most, cells at most, and rows and queries that one task searches.
SAMPLE_ROWS, CELLS, CELL_ROWS, CELL_QUERIES, LEAF_ROWS = 8192, 1024, 4096, 1024, 128
SLACK = 1e-6


def chi_square_quantile(p: float, freedom: int) -> float:
    """Of an even number of degrees of freedom, by bisection of the closed form."""

    def below(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def projection(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, DIMENSIONS))


class Tree:
    """A kd-tree over projected points: boxes of nodes, points in the order of the leaves."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.low, self.high, self.kids, self.span = [], [], [], []
        self._build(points, 0, len(points))
        self.points = points[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, points: np.ndarray, start: int, end: int) -> int:
        here = points[self.order[start:end]]
        low, high, node = here.min(axis=0), here.max(axis=0), len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.span.append((start, end))
        self.kids.append(None)
        axis = int(np.argmax(high - low))
        if end - start > LEAF_ROWS and high[axis] > low[axis]:
            half = (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argpartition(here[:, axis], half)]
            self.kids[node] = (self._build(points, start, start + half), self._build(points, start + half, end))
        return node

    def rising(self, point: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Leaves by their least distance from a point: (squared distance, start, end)."""
        gaps = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        gaps = (gaps * gaps).sum(axis=1)
        queue = [(float(gaps[0]), 0)]
        while queue:
            gap, node = heapq.heappop(queue)
            if self.kids[node] is None:
                yield gap, *self.span[node]
            else:
                for kid in self.kids[node]:
                    heapq.heappush(queue, (float(gaps[kid]), kid))


def _nearest(tree: Tree, vectors: np.ndarray, holders: np.ndarray, query: np.ndarray, point: np.ndarray, bound: float, k: int, quantile: float):
    """Positions (in the tree's order) and distances of the nearest vectors that k rows hold, within the bound.

    holders: rows (k at most) that have a vector. All vectors at the last distance are kept, for ties.
    """
    near, at = np.empty(0), np.empty(0, dtype=np.int64)
    for gap, start, end in tree.rising(point):
        reach = bound * bound * quantile * (1 + SLACK) + SLACK**2
        if gap > reach:  # the test: nothing nearer than the bound projects so far away, at the asked confidence
            break
        away = tree.points[start:end] - point
        seen = start + np.flatnonzero((away * away).sum(axis=1) <= reach)
        if not len(seen):
            continue
        apart = vectors[seen] - query
        found = np.sqrt((apart * apart).sum(axis=1))
        keep = found <= bound
        near, at = np.r_[near, found[keep]], np.r_[at, seen[keep]]
        order = np.argsort(near, kind="stable")
        near, at = near[order], at[order]
        rows = np.cumsum(holders[at])
        if len(rows) and rows[-1] >= k:
            bound = min(bound, float(near[np.searchsorted(rows, k)]))
            last = np.searchsorted(near, bound, side="right")
            near, at = near[:last], at[:last]
    return at, near


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector in double precision, one row per vec_id; of a repeated id the least vector counts."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("vector")).where("vec_id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _cells(sample: np.ndarray, rows: int) -> list[tuple[int, float, int, int]]:
    """Upper levels: (axis, cut, left, right) per node; negative children are cells -1, -2, ..."""
    nodes: list[tuple[int, float, int, int]] = []
    made = [0]
    depth = max(0, min(int(math.log2(CELLS)), math.ceil(math.log2(max(1, rows / CELL_ROWS)))))

    def grow(points: np.ndarray, left: int) -> int:
        if not left or len(points) < 2:
            made[0] -= 1
            return made[0]
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        cut = float(np.median(points[:, axis]))
        mask = points[:, axis] <= cut
        node = len(nodes)
        nodes.append((axis, cut, 0, 0))
        kids = grow(points[mask], left - 1), grow(points[~mask], left - 1)
        nodes[node] = (axis, cut, *kids)
        return node

    if grow(sample, depth) < 0:
        return []
    return nodes


def _cell_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    cells = np.full(len(points), -1)
    if nodes:
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if node < 0:
                cells[at] = node
            elif len(at):
                axis, cut, left, right = nodes[node]
                mask = points[at, axis] <= cut
                stack += [(left, at[mask]), (right, at[~mask])]
    return -cells - 1


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, its k nearest other rows.

    `vectors` has vec_id and embedding. Nearness is the Euclidean distance, in double precision; ties go to the smaller
    vec_id. A row takes no part if its vec_id is missing, or its embedding is missing, empty, zero, or has missing or
    non-finite components; so do vectors of another length than the commonest one (of equally common ones the longest). A
    repeated vec_id counts once. Fewer than k candidates give fewer rows; without any, or of an empty table, none. Other
    columns are not looked at.

    Equal vectors are searched once, with the k + 1 smallest vec_ids that have them: no query can need another.
    """
    spark = vectors.sparkSession
    rows = _valid(vectors)
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], out)
    width, n = widths["width"], widths["n"]
    rows = written(rows.where(F.size("vector") == width), "vectors")
    order = Window.partitionBy("vector").orderBy("vec_id")
    holders = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    distinct = written(holders.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct")
    asking = rows.where(F.col("vec_id") % every == 0)
    queries = written(asking.groupBy("vector").agg(F.min("vec_id").alias("query")), "queries")

    matrix, quantile = projection(width), chi_square_quantile(CONFIDENCE, DIMENSIONS)
    sample = distinct.orderBy(F.xxhash64(F.col("ids")[0])).limit(SAMPLE_ROWS).select("vector").toPandas()["vector"]
    nodes = _cells(np.stack(sample.to_list()) @ matrix, n)

    def placed(table: DataFrame, carried: str) -> DataFrame:
        """Each vector's projection and cell."""

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                points = np.stack(b["vector"].to_list()) @ matrix if len(b) else np.empty((0, DIMENSIONS))
                yield b.assign(point=list(points), cell=_cell_of(points, nodes))

        kept = carried.split()[0]
        return table.select("vector", kept).mapInPandas(place, f"vector array<double>, {carried}, point array<double>, cell int")

    points = written(placed(distinct, "ids array<bigint>"), "points")
    boxes = points.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(F.col("point")[i]).alias(f"low{i}") for i in range(DIMENSIONS)],
        *[F.max(F.col("point")[i]).alias(f"high{i}") for i in range(DIMENSIONS)],
    ).orderBy("cell").toPandas()  # CELLS rows at most
    low, high = (boxes[[f"{side}{i}" for i in range(DIMENSIONS)]].to_numpy() for side in ("low", "high"))
    shares = np.ceil(boxes["n"].to_numpy() / (2 * CELL_ROWS)).astype(int).clip(1)
    cells = boxes["cell"].to_numpy()
    turns = queries.count() // CELL_QUERIES + 1

    share_of = F.element_at(F.create_map(*[F.lit(int(x)) for pair in zip(cells, shares) for x in pair]), F.col("cell"))
    spread = points.withColumn("share", F.pmod(F.xxhash64(F.col("ids")[0]), share_of.cast("long")).cast("int"))
    found_type = "query long, vec_id long, score double"

    def search(blocks: DataFrame, asked: DataFrame, close_only: bool) -> DataFrame:
        """asked: query, vector, point, bound, cell, share, turn."""

        def run(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(block) and len(queries):
                tree = Tree(np.stack(block["point"].to_list()))
                stacked = np.stack(block["vector"].to_list())[tree.order]
                ids = block["ids"].to_numpy()[tree.order]
                counts = np.array([len(x) for x in ids])
                for query, vector, point, bound in zip(queries["query"], queries["vector"], queries["point"], queries["bound"]):
                    at, near = _nearest(tree, stacked, counts, vector, point, bound, k + 1, quantile)
                    pairs = sorted((d, int(i)) for p, d in zip(at, near) for i in ids[p])[: k + 1]
                    if close_only:
                        pairs = pairs[k:]
                    found += [(query, i, d) for d, i in pairs]
            return pd.DataFrame(found, columns=["query", "vec_id", "score"])

        key = ["cell", "share", "turn"]
        many = blocks.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        return many.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(run, found_type)

    turn = F.pmod(F.xxhash64("query"), F.lit(turns)).cast("int")
    asked = written(placed(queries, "query bigint").withColumn("turn", turn), "asked")
    # first each query's own cell, for a bound on the distance of its k-th neighbour
    own = asked.select("query", "vector", "point", F.lit(float("inf")).alias("bound"), "cell", F.lit(0).alias("share"), "turn")
    bounds = search(spread.where("share = 0"), own, close_only=True).select("query", F.col("score").alias("bound"))
    bounded = asked.join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every share of every cell that the reach of a query touches."""
        for b in batches:
            for row in b.itertuples(index=False):
                gaps = np.maximum(np.maximum(low - row.point, row.point - high), 0)
                touched = (gaps * gaps).sum(axis=1) <= row.bound**2 * quantile * (1 + SLACK) + SLACK**2
                cell = np.repeat(cells[touched], shares[touched])
                share = np.concatenate([np.arange(s) for s in shares[touched]]) if touched.any() else cell
                yield pd.DataFrame({"query": row.query, "vector": [row.vector] * len(cell), "point": [row.point] * len(cell), "bound": row.bound, "cell": cell, "share": share, "turn": row.turn})

    visits = bounded.select("query", "vector", "point", "bound", "turn").mapInPandas(visit, "query long, vector array<double>, point array<double>, bound double, cell int, share int, turn int")
    found = search(spread, visits, close_only=False)
    ranked = Window.partitionBy("query").orderBy("score", "vec_id")
    best = written(found.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= k + 1).drop("nth"), "nearest")
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))  # k + 1 each

    answers = asking.join(queries.join(lists, "query").select("vector", "near"), "vector")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    answers = answers.select(F.col("vec_id").alias("query_id"), "near").select("query_id", F.posexplode(others).alias("place", "one"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))

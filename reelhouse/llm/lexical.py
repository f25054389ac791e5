"""Ranked lexical search over posting lists in geometric blocks.

Documents are dealt into shards of a bounded number of rows. In its shard every term's posting list is clustered by
document similarity into blocks, and a block keeps, for each coordinate that some item asks for along with the term, the
largest value any of its documents has there. An item goes through its terms from the rarest on; a document belongs to
the first of its lists. A block is passed over only where the sum of its summary over this and the commoner terms, an
exact upper bound of every score the block can still hold, lies below the item's tenth score so far. Shards are searched
in waves that grow geometrically; scores of earlier waves are the threshold at which the next one starts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.session import written

#: Documents of a block and of a shard at most (fewer where the vocabulary is wide: cells of a shard at most), items of
#: a batch, and by how much the waves grow.
BLOCK_DOCS, SHARD_DOCS, SHARD_CELLS, BATCH_ITEMS, WAVE = 48, 4096, 1 << 24, 1024, 8
#: Dimensions that similarity is measured in.
SKETCH, SEED = 32, 11

#: Bytes that end a term become blanks, A-Z lower case. Letters beyond ASCII have no byte below 0x80.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def document_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """row, doc_id, n (terms with repeats) and, for terms of the vocabulary, their numbers and occurrences."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = terms_of(text or b"")
                count = Counter(map(vocabulary.get, found))
                count.pop(None, None)
                sizes.append(len(found))
                terms.append(list(count))
                times.append(list(count.values()))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, ints), pa.array(times, ints)], ["doc_id", "n", "terms", "times"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(vectors, f"doc_id {kind}, n long, terms array<int>, times array<int>")
    return found.withColumn("row", F.monotonically_increasing_id())


class Asked:
    """A batch of items by term numbers, terms numbered from the rarest (largest weight) on."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, n_docs: int, all_terms: int, block_docs: int):
        self.items = [np.array(sorted(i), np.int64) for i in items]
        self.weights, self.n_docs, self.all_terms, self.block_docs = weights, n_docs, all_terms, block_docs
        beside: dict[int, set] = {}
        for item in self.items:
            for i, t in enumerate(item.tolist()):
                beside.setdefault(t, set()).update(item[i:].tolist())
        self.beside = {t: np.array(sorted(u), np.int64) for t, u in beside.items()}

    def values(self, vectors: pd.DataFrame) -> np.ndarray:
        """What each term adds to a document's score: rows by terms, whole numbers."""
        out = np.zeros((len(vectors), len(self.weights)), np.int64)
        for i, (n, terms, times) in enumerate(zip(vectors["n"], vectors["terms"], vectors["times"], strict=True)):
            if len(terms):
                m = 10 + 90 * int(n) * self.n_docs // self.all_terms
                tf = np.asarray(times, np.int64)
                out[i, terms] = self.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        return out


_BLOCKS = "shard long, term int, docs binary, starts binary, summary binary"


def blocks_of(asked: Asked, vectors: pd.DataFrame) -> pd.DataFrame:
    """Posting lists of one shard: documents in the order of the blocks, where blocks start, and summaries."""
    vectors = vectors.sort_values("row")
    x = asked.values(vectors)
    toward = np.random.default_rng(SEED).standard_normal((x.shape[1], SKETCH), np.float32)
    sketch = (x / max(1, x.max(initial=1))).astype(np.float32) @ toward
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    at, term = np.nonzero(x)
    order = np.argsort(term, kind="stable")
    at, term = at[order], term[order]
    edges = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))
    out = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        docs, t = at[low:high], int(term[low])
        if t not in asked.beside:
            continue
        near = np.zeros(len(docs), np.int64)
        if len(docs) > asked.block_docs:
            near = (sketch[docs] @ sketch[docs[:: asked.block_docs]].T).argmax(axis=1)
            docs, near = docs[o := np.argsort(near, kind="stable")], near[o]
        place = np.arange(len(docs))
        first = np.maximum.accumulate(np.where(np.diff(near, prepend=-1) != 0, place, 0))
        starts = np.flatnonzero((place - first) % asked.block_docs == 0)
        summary = np.maximum.reduceat(x[np.ix_(docs, asked.beside[t])], starts, axis=0)
        out.append((int(vectors["shard"].iloc[0]), t, docs.astype(np.int32).tobytes(), starts.astype(np.int32).tobytes(), summary.tobytes()))
    return pd.DataFrame(out, columns=["shard", "term", "docs", "starts", "summary"])


def searched(asked: Asked, least: np.ndarray, k: int, vectors: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
    """The k best documents of one shard per item, those at or above the threshold."""
    vectors = vectors.sort_values("row")
    x, ids = asked.values(vectors), vectors["doc_id"]
    missing, ids = ids.isna().to_numpy(), ids.fillna(0).to_numpy()
    held = {}
    for t, docs, starts, summary in zip(lists["term"], lists["docs"], lists["starts"], lists["summary"], strict=True):
        held[t] = np.frombuffer(docs, np.int32), np.frombuffer(starts, np.int32), np.frombuffer(summary, np.int64).reshape(-1, len(asked.beside[t]))
    out = []
    for number, item in enumerate(asked.items):
        floor = max(1, int(least[number]))
        seen = np.zeros(len(x), bool)
        docs_found, scores_found = np.empty(0, np.int64), np.empty(0, np.int64)
        for i, t in enumerate(item.tolist()):
            if t not in held:
                continue
            docs, starts, summary = held[t]
            bound = summary[:, np.searchsorted(asked.beside[t], item[i:])].sum(axis=1)
            open_ = bound >= floor
            if open_.any():
                size = np.diff(starts, append=len(docs))
                some = docs[np.repeat(open_, size)]
                some = some[~seen[some]]
                scores = x[np.ix_(some, item[i:])].sum(axis=1)
                good = scores >= floor
                docs_found, scores_found = np.append(docs_found, some[good]), np.append(scores_found, scores[good])
                if len(scores_found) >= k:
                    floor = max(floor, int(np.partition(scores_found, -k)[-k]))
            seen[docs] = True
        best = np.lexsort((ids[docs_found], missing[docs_found], -scores_found))[:k]
        out += [(number, vectors["doc_id"].iloc[d], int(s)) for d, s in zip(docs_found[best].tolist(), scores_found[best].tolist(), strict=True) if s >= floor]
    return pd.DataFrame(out, columns=["number", "doc_id", "score"])


def _search_of(asked: Asked, least: np.ndarray, k: int):
    return lambda vectors, lists: searched(asked, least, k, vectors, lists)


def _search_batch(docs: DataFrame, items: list, k: int) -> DataFrame | None:
    """number, doc_id, score of the best documents of each wave; None where no item has terms."""
    spark = docs.sparkSession
    wanted = [set(terms_of((r["text"] or "").encode())) for r in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    if not vocabulary:
        return None
    vectors = written(document_vectors(docs, vocabulary), "lexical-vectors")
    whole = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.count(F.lit(1)).alias("rows")).first()
    if not whole["docs"]:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term of the items
        df[r["t"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * int(d) + 1))) for d in df]
    rank = sorted(range(len(df)), key=lambda i: (-weight[i], i))  # terms get their numbers anew, from the rarest on
    place = {old: new for new, old in enumerate(rank)}
    asked = Asked([[place[vocabulary[t]] for t in w] for w in wanted], np.array([weight[i] for i in rank], np.int64), whole["docs"], whole["terms"], BLOCK_DOCS)
    renumber = F.lit([place[i] for i in range(len(df))]).cast("array<int>")
    vectors = vectors.withColumn("terms", F.transform("terms", lambda t: F.get(renumber, t)))
    shards = math.ceil(whole["rows"] / min(SHARD_DOCS, max(64, SHARD_CELLS // len(df))))
    vectors = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    lists = written(vectors.groupBy("shard").applyInPandas(lambda v: blocks_of(asked, v), _BLOCKS), "lexical-blocks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    least, found, low, high = np.zeros(len(items), np.int64), None, 0, max(1, min(spark.sparkContext.defaultParallelism, shards // WAVE))
    while low < shards:
        part = F.col("shard").between(low, high - 1)
        run = vectors.where(part).groupBy("shard").cogroup(lists.where(part).groupBy("shard"))
        wave = written(run.applyInPandas(_search_of(asked, least.copy(), k), f"number int, doc_id {kind}, score long"), "lexical-wave")
        found = written(best_of(wave if found is None else found.unionByName(wave), k), "lexical-best")
        low, high = high, min(shards, high * WAVE)
        if low < shards:
            for r in found.groupBy("number").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k).collect():  # one row per item
                least[r["number"]] = r["s"]
    return found


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item, fewer if there are fewer.

    Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case; a missing
    text has none. A term of weight w, that a document of n terms holds tf times, adds
    w * ((1000000000 * tf) div (1000 * tf + 8 * m)), m = 10 + (90 * n * N) div L; w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))
    over the N documents with terms and their L terms. Equal scores go by ascending doc_id, rows without doc_id last. Every row of `docs`
    is a document of its own, repeated ones too; items equal in id and text are searched once. Items without terms and
    empty tables give no row. Other columns are not looked at. Items are read in batches, each against all documents.
    """
    kinds = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    items = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    batches = math.ceil(items.count() / BATCH_ITEMS)
    out = items.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for batch in range(batches):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == batch).collect()
        found = _search_batch(docs, rows, k)
        if found is not None:
            names = items.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"number int, item_id {kinds[0]}")
            ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            out = out.unionByName(ranked.join(names, "number").select("item_id", "rank", "doc_id", "score"))
    return out

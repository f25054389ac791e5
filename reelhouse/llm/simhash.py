"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints at three or fewer differing bits are linked. The upper nodes of the index are masked bit patterns that
fingerprints share: cut into four blocks, two fingerprints with at most three differing bits agree in one block at least,
so each fingerprint goes below four patterns. A pattern shared by many is factored further over the bits it leaves
open. Below a pattern, fingerprints are sorted by Gray rank; runs of them form leaves and runs of leaves form nodes, each
with the bits its members have in common. Pairs of nodes, then of leaves, whose differences in common bits already
exceed the limit are pruned as a whole before any two fingerprints meet.

One fingerprint within three bits finds only the closest copies. `one_of_similar`, which thins a corpus, therefore asks
for more: texts that share one of several MinHash keys of their five-word shingles are candidates, whatever kind of edit
sets them apart, and the exact overlap of the shingle sets tells which of those are similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import chosen_rows, connected, join_labels, row_key, text_of
from reelhouse.session import scratch, written

BITS = 64
HASH_SEED = 42
#: Members below one pattern up to which it isn't factored further; an upper node holds LEAF leaves of LEAF members.
GROUP_ROWS, LEAF = 2048, 16
#: Rows that one task of the search takes at a time, and pairs it compares at a time.
TASK_ROWS, PAIRS_AT_ONCE = 60_000, 2_000_000
#: Shingles whose hash bits are counted at a time.
SHINGLES_AT_ONCE = 65_536
#: MinHash keys of a shingle set, and minima in a key. Two sets with a Jaccard similarity of 0.8 agree in a key with
#: probability 0.8**7, so they share none of 48 keys about once in 80,000, sets at 0.85 once in 100 million; sets at 0.5 share
#: one in 3 of 10 cases.
BANDS, BAND_ROWS = 48, 7
#: Members of a key up to which all are compared with each other at once, and turns in which a larger group meets one of its members.
FEW, TURNS = 8, 3
#: Members, and members apart from the largest component, of a crowded key that one comparison of sketches takes.
BLOCK_ROWS = 1024
#: Standard errors below SIMILAR down to which the sketches leave a pair to the exact comparison: one pair of some 3 million is lost.
ERRORS = 5
#: Pairs of a member apart, best first by sketch, that are compared exactly before all others are.
BEST = 2
#: Words of a shingle.
SHINGLE_WORDS = 5
#: Jaccard similarity from which texts are similar, as a fraction.
SIMILAR = (4, 5)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT, _ODD = np.random.default_rng(5).integers(0, 1 << 32, (2, BANDS * BAND_ROWS, 1), dtype=np.uint64).astype(np.uint32)
_ODD |= np.uint32(1)


def fingerprint(text: str, size: int = 3) -> int:
    """A bit is set where it is set in over half the hashes of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, and just the white space of WORD
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(size))) if len(words) >= size else iter([tuple(words)])
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), HASH_SEED) for s in shingles), dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, row_key, fp (the fingerprint as a signed number) per row; a missing text counts as empty."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            fps = np.array([fingerprint(t, size) for t in rows["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "row_key": rows["row_key"], "fp": fps.view(np.int64)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), text_of().alias("text"))
    return rows.mapInPandas(score, "doc_id long, row_key long, fp long")


def _scattered(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """The set of shingles, as 32 bits of each hash; empty without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, HASH_SEED) for w in words), dtype=np.uint64, count=len(words))
    shingles = hashes[: max(1, len(words) - SHINGLE_WORDS + 1)]
    for i in range(1, min(SHINGLE_WORDS, len(words))):
        shingles = _scattered(shingles * _STEP + hashes[i : i + len(shingles)])
    return np.unique((shingles >> np.uint64(32)).astype(np.uint32)).view(np.int32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of BANDS * BAND_ROWS hashes over a set that isn't empty."""
    shingles = shingles.astype(np.int32, copy=False).view(np.uint32)
    least = np.full(BANDS * BAND_ROWS, (1 << 32) - 1, dtype=np.uint32)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE // 64):
        np.minimum(least, ((shingles[at : at + SHINGLES_AT_ONCE // 64] ^ _SALT) * _ODD).min(axis=1), out=least)
    return least


def minhash_keys(least: np.ndarray) -> np.ndarray:
    """One key a band; keys of different bands differ."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for part in least.reshape(BANDS, BAND_ROWS).T:
        keys = _scattered(keys * _STEP + part)
    return keys.view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    """The middle byte of each minimum: two sets agree in one with their Jaccard similarity, and else once in 256."""
    return (least >> np.uint32(12)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, row_key, fp (see `fingerprints`), shingles (see `shingle_set`) and node, which stands for the shingles, per row."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            fps = np.array([fingerprint(t, size) for t in rows["text"]], dtype=np.uint64)
            sets = [shingle_set(t) for t in rows["text"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "row_key": rows["row_key"], "fp": fps.view(np.int64), "shingles": sets})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), text_of().alias("text"))
    scored = rows.mapInPandas(score, "doc_id long, row_key long, fp long, shingles array<int>")
    return scored.withColumn("node", F.xxhash64("shingles"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def _starts(ids: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])


def _common(codes: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that all members of a run share, and their pattern."""
    firsts = codes[starts]
    mask = ~np.bitwise_or.reduceat(codes ^ firsts[ids], starts)
    return mask, firsts & mask


def _upper_pairs(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i <= j of one group; groups are sorted and small."""
    starts = _starts(groups)
    ends = np.r_[starts[1:], len(groups)]
    n = np.repeat(ends, ends - starts) - np.arange(len(groups))
    left = np.repeat(np.arange(len(groups)), n)
    return left, left + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)


def _below(a: np.ndarray, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the members of pairs of nodes, each once."""
    na, nb = ends[a] - starts[a], ends[b] - starts[b]
    n = na * nb
    pair = np.repeat(np.arange(len(a)), n)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    left, right = starts[a][pair] + nth // nb[pair], starts[b][pair] + nth % nb[pair]
    once = left <= right
    return left[once], right[once]


def linked(codes: np.ndarray, groups: np.ndarray, limit: int) -> np.ndarray:
    """For each code, the position of the first one of its group that it is linked with, over any number of links.

    codes are sorted by (group, Gray rank).
    """
    labels = np.arange(len(codes))
    for left, right, _ in close_pairs(codes, groups, limit):
        join_labels(labels, left, right)
    return labels


def close_pairs(codes: np.ndarray, groups: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (left, right, differing bits) of all pairs of one group within the limit; codes as in `linked`."""
    place = np.arange(len(codes)) - np.repeat(_starts(groups), np.diff(np.r_[_starts(groups), len(codes)]))
    leaf_ids = np.cumsum(np.r_[True, (groups[1:] != groups[:-1]) | (place[1:] % LEAF == 0)]) - 1
    node_ids = np.cumsum(np.r_[True, (groups[1:] != groups[:-1]) | (place[1:] % LEAF**2 == 0)]) - 1
    leaves, nodes = _starts(leaf_ids), _starts(node_ids)
    leaf_mask, leaf_bits = _common(codes, leaves, leaf_ids)
    node_mask, node_bits = _common(codes, nodes, node_ids)
    first_leaf = leaf_ids[nodes]
    last_leaf = np.r_[first_leaf[1:], len(leaves)]
    leaf_end = np.r_[leaves[1:], len(codes)]

    def near(a, b, mask, bits):
        keep = np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b]) <= limit
        return a[keep], b[keep]

    a, b = near(*_upper_pairs(groups[nodes]), node_mask, node_bits)
    a, b = near(*_below(a, b, first_leaf, last_leaf), leaf_mask, leaf_bits)
    step = max(1, PAIRS_AT_ONCE // LEAF**2)
    for at in range(0, len(a), step):
        left, right = _below(a[at : at + step], b[at : at + step], leaves, leaf_end)
        apart = np.bitwise_count(codes[left] ^ codes[right])
        close = (left < right) & (apart <= limit)
        yield left[close], right[close], apart[close]


def _blocks(mask: int, parts: int) -> list[int]:
    """The bits that `mask` leaves open, in `parts` runs, each added to the mask."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[cuts[i] : cuts[i + 1]]) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(distinct: DataFrame, limit: int) -> DataFrame:
    """src, dst: links between the distinct fingerprints `distinct` (fp), enough to connect all within the limit.

    A group of N fingerprints gives at most N links. Patterns with over GROUP_ROWS members are factored by further bits
    until they are small or leave at most 16 bits open (then at most 2**16 distinct members can share one).
    """
    spark = distinct.sparkSession
    shape = "src long, dst long"

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        codes, groups = rows["fp"].to_numpy().view(np.uint64), pd.factorize(pd.MultiIndex.from_frame(rows[["mask", "bits"]]))[0]
        order = np.lexsort((gray_rank(codes), groups))
        codes, groups = codes[order], groups[order]
        labels = linked(codes, groups, limit)
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        return pd.DataFrame({"src": codes[moved].view(np.int64), "dst": codes[labels[moved]].view(np.int64)})

    masks, below, found = [0], distinct.select("fp", F.lit(0).cast("long").alias("above")), []
    while masks:
        children = [(_signed(m), _signed(c)) for m in masks for c in _blocks(m, limit + 1)]
        table = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in _blocks(m, limit + 1)]))])
        keyed = below.select("fp", F.explode(F.element_at(table, F.col("above"))).alias("mask")).withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        counts = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        keyed = written(keyed.join(counts, ["mask", "bits"]), "patterns")
        last = min(BITS - (c % (1 << BITS)).bit_count() for _, c in children) < 16
        small = keyed if last else keyed.where(F.col("n") <= GROUP_ROWS)
        rows = small.count()
        if rows:
            tasks = F.pmod(F.xxhash64("mask", "bits"), F.lit(rows // TASK_ROWS + 1))
            found.append(written(small.withColumn("task", tasks).groupBy("task").applyInPandas(search, shape), "links"))
        below = keyed.where(F.col("n") > GROUP_ROWS).select("fp", F.col("mask").alias("above"))
        masks = [] if last or below.isEmpty() else [r["above"] for r in below.select("above").distinct().collect()]
        masks = [m % (1 << BITS) for m in masks]
    if not found:
        return spark.createDataFrame([], shape)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _classes(docs: DataFrame, limit: int, size: int) -> DataFrame:
    """doc_id, row_key, fp, root (the smallest fingerprint that its own is linked with) per row."""
    rows = written(fingerprints(docs, size), "fingerprints")
    distinct = written(rows.select("fp").distinct(), "distinct")
    roots = connected(links(distinct, limit))
    return rows.join(roots, rows["fp"] == roots["node"], "left").select("doc_id", "row_key", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, limit: int = 3, size: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, itself included; missing ids are reached only if a
    component has no other. A missing text counts as empty; texts without words have fingerprint zero and are linked like
    any other. Copies share a fingerprint and are linked through it, not pairwise. Repeated rows come out as often as
    they stand in the table. Other columns are not looked at.
    """
    rows = written(_classes(docs, limit, size), "classes")
    lowest = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = rows.join(lowest, "root")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, limit: int = 3, size: int = 3) -> DataFrame:
    """The rows of `docs` of which no near-duplicate comes earlier: of each component the smallest doc_id, whole."""
    with scratch(docs.sparkSession):
        best = written(_firsts(_classes(docs, limit, size)), "kept", keep=True)
    return chosen_rows(docs, best)


def _firsts(rows: DataFrame) -> DataFrame:
    """doc_id, row_key, repeats of the first row of each root in `rows` (doc_id, row_key, root)."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "repeats")
    firsts = rows.groupBy("root", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("repeats"))
    best = firsts.groupBy("root").agg(F.min(rank).alias("best"))
    return best.select("best.doc_id", "best.row_key", "best.repeats")


def _keys(rows: DataFrame) -> DataFrame:
    """node, n (shingles of its set), band and key for every key of every row; sets without shingles have none."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for sets in batches:
            sets = sets[sets["shingles"].map(len) > 0]
            keys = [minhash_keys(minima(s)) for s in sets["shingles"]]
            n = sets["shingles"].map(len).to_numpy(dtype=np.int32)
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(sets))
            yield pd.DataFrame({"node": np.repeat(sets["node"].to_numpy(), BANDS), "n": np.repeat(n, BANDS), "band": band, "key": np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)})

    return rows.select("node", "shingles").mapInPandas(spread, "node long, n int, band int, key long")


def similar(rows: DataFrame) -> DataFrame:
    """src, dst: verified pairs of nodes of `rows` (see `signatures`), enough to connect all that share a key and SIMILAR of their shingles.

    Up to FEW nodes of a key are compared pairwise. In a larger group the members meet one of them, turn by turn; nodes
    that are connected need no comparison any more, so a group of N copies costs some N pairs. In a group that still holds
    several components, the members outside the largest one are compared with all others by sketch (`_by_sketch`), and
    only what the sketches can't tell apart from similar is compared in full.
    """
    spark, group = rows.sparkSession, ["key"]
    with scratch(spark):
        spread = written(_keys(rows), "keys")
        shared = spread.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count(F.lit(1)).alias("members")).where("a < z")
        shared = written(shared.select("key", "members"), "groups")
        spread = written(spread.join(shared, group).dropDuplicates(["key", "node"]), "shared", keep=True)
    found = _verified(_pairs(spread.where(F.col("members") <= FEW), group), rows)
    crowded = spread.where(F.col("members") > FEW).select("key", "band", "node", "n")
    for turn in range(TURNS + 2):
        crowded = _apart(crowded, connected(found), group)
        if crowded.isEmpty():
            break
        pairs = _with_one(crowded, group, turn) if turn < TURNS else _by_sketch(crowded, rows, BEST if turn == TURNS else None)
        found = found.union(_verified(pairs, rows))
    return found


def _by_sketch(crowded: DataFrame, rows: DataFrame, best: int | None) -> DataFrame:
    """src, dst: pairs of different components that share a crowded key and may be similar by their sketches, each once.

    Of each key, the members outside its largest component meet all members, in blocks of BLOCK_ROWS. A pair is looked at in
    the first crowded key that both have: equal keys mean equal sketches of that band, and `open` tells the crowded bands
    of a node. With `best`, each member apart gives only that many pairs per block, those with the most alike sketches.
    """
    sizes = written(crowded.groupBy("key", "root").agg(F.count(F.lit(1)).alias("members")), "components")
    main = sizes.groupBy("key").agg(F.max(F.struct("members", "root"))["root"].alias("main"), F.sum("members").alias("members"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_ROWS)).cast("int")
    others = sizes.join(main, "key").groupBy("key", "main").agg(
        blocks(F.max(main["members"])).alias("blocks"), blocks(F.sum(F.when(F.col("root") != F.col("main"), sizes["members"]).otherwise(0))).alias("apart_blocks")
    )
    opened = crowded.groupBy("node").agg(F.first("root").alias("root"), F.first("n").alias("n"), F.bit_or(F.expr("shiftleft(1L, band)")).alias("open"))

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for sets in batches:
            yield pd.DataFrame({"node": sets["node"], "sketch": [sketch(minima(s)) for s in sets["shingles"]]})

    sets = rows.select("node", "shingles").join(opened, "node", "left_semi").mapInPandas(sketched, "node long, sketch binary")
    nodes = written(opened.join(sets.dropDuplicates(["node"]), "node"), "sketches")
    placed = crowded.select("key", "band", "node", "root").join(others, "key").withColumn("at", F.xxhash64(F.lit(7), "node"))
    every = placed.withColumn("block", F.pmod("at", "blocks")).withColumn("apart_block", F.explode(F.sequence(F.lit(0), F.col("apart_blocks") - 1)))
    apart = placed.where("root <> main").withColumn("apart_block", F.pmod("at", "apart_blocks")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = ["key", "band", F.col("block").cast("int").alias("block"), F.col("apart_block").cast("int").alias("apart_block"), "node"]
    dealt = every.select(*place, F.lit(False).alias("apart")).union(apart.select(*place, F.lit(True).alias("apart"))).join(nodes, "node")

    def compare(key: tuple, members: pd.DataFrame) -> pd.DataFrame:
        left, right = members[members["apart"]], members[~members["apart"]]
        src, dst = _maybe_similar(left, right, int(members["band"].iloc[0]), best)
        return pd.DataFrame({"src": np.maximum(src, dst), "dst": np.minimum(src, dst)})

    return dealt.groupBy("key", "block", "apart_block").applyInPandas(compare, "src long, dst long").distinct()


def _maybe_similar(left: pd.DataFrame, right: pd.DataFrame, band: int, best: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs (one of left, one of right) of different roots that share no open band before `band` and whose sketches allow SIMILAR."""
    if not len(left) or not len(right):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    values, grids = BANDS * BAND_ROWS, {}
    for name in ("node", "root", "n", "open"):
        grids[name] = left[name].to_numpy(), right[name].to_numpy()
    a, b = (np.frombuffer(b"".join(side["sketch"]), dtype=np.uint8).reshape(-1, values) for side in (left, right))
    share = SIMILAR[0] / SIMILAR[1]
    least = values * (share - ERRORS * np.sqrt(share * (1 - share) / values))
    src, dst = [], []
    for i in range(len(left)):
        n = grids["n"][1]
        here = (grids["root"][1] != grids["root"][0][i]) & (np.minimum(n, grids["n"][0][i]) >= share * np.maximum(n, grids["n"][0][i]) - 1e-9)
        at = np.flatnonzero(here)
        alike = b[at] == a[i]
        agree = alike.sum(axis=1)
        at, alike, agree = (x[agree >= least] for x in (at, alike, agree))
        same = alike.reshape(-1, BANDS, BAND_ROWS)[:, :band].all(axis=2)
        both = grids["open"][1][at] & grids["open"][0][i]
        first = ~(same & ((both[:, None] >> np.arange(band)) & 1).astype(bool)).any(axis=1)
        at, agree = at[first], agree[first]
        if best is not None and len(at) > best:
            at = at[np.argsort(-agree, kind="stable")[:best]]
        src.append(np.full(len(at), grids["node"][0][i]))
        dst.append(grids["node"][1][at])
    return np.concatenate(src), np.concatenate(dst)


def _apart(members: DataFrame, roots: DataFrame, group: list[str]) -> DataFrame:
    """`members` of groups that aren't connected as a whole, with the root of each."""
    with scratch(members.sparkSession):
        named = members.select(*group, "band", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        named = written(named, "members")
        several = named.groupBy(*group).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return written(named.join(written(several.select(*group), "open"), group), "crowded", keep=True)


def _with_one(members: DataFrame, group: list[str], turn: int) -> DataFrame:
    """src, dst: each node with the member chosen this turn, of the groups that chose alike the one it meets most often."""
    first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), F.col("node").alias("one"), F.col("root").alias("of"), F.col("n").alias("one_n")))
    chosen = written(members.groupBy(*group).agg(first.alias("x")).select(*group, "x.one", "x.of", "x.one_n"), "chosen")
    met = members.join(chosen, group).where("root <> of").where(_sizes_allow(F.col("n"), F.col("one_n")))
    often = met.groupBy("node", "one").agg(F.count(F.lit(1)).alias("times"))
    best = often.groupBy("node").agg(F.max(F.struct("times", "one")).alias("x"))
    return best.select(F.greatest("node", "x.one").alias("src"), F.least("node", "x.one").alias("dst")).distinct()


def _pairs(members: DataFrame, group: list[str]) -> DataFrame:
    """src, dst: all pairs of `members` (node, n) of one group and different roots, if any, src > dst, whose sizes let them be similar; each once."""
    root = F.col("root") if "root" in members.columns else F.col("node")
    a = members.select(*group, F.col("node").alias("src"), F.col("n").alias("src_n"), root.alias("src_root"))
    b = members.select(*group, F.col("node").alias("dst"), F.col("n").alias("dst_n"), root.alias("dst_root"))
    pairs = a.join(b, group).where("src > dst and src_root <> dst_root")
    return pairs.where(_sizes_allow(F.col("src_n"), F.col("dst_n"))).select("src", "dst").distinct()


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * SIMILAR[1] >= F.greatest(a, b) * SIMILAR[0]


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose sets of shingles, from `rows`, are similar."""
    with scratch(rows.sparkSession):
        pairs = written(pairs, "candidates")
        named = pairs.select(F.col("src").alias("node")).union(pairs.select(F.col("dst").alias("node"))).distinct()
        sets = rows.select("node", "shingles").join(named, "node", "left_semi").dropDuplicates(["node"])
        sets = written(sets, "shingles")
        for end in ("src", "dst"):
            pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set")), end)
        both = F.size(F.array_intersect("src_set", "dst_set"))
        either = F.size("src_set") + F.size("dst_set") - both
        return written(pairs.where(both * SIMILAR[1] >= either * SIMILAR[0]).select("src", "dst"), "similar", keep=True)


def one_of_similar(docs: DataFrame, limit: int = 3, size: int = 3) -> DataFrame:
    """The rows of `docs` of which no near-duplicate comes earlier: of each group the smallest doc_id, whole.

    A group holds what `near_duplicates` links, and texts that share 80% or more of their five-word shingles (`similar`). Null and empty texts are copies of each other; missing ids come last; of repeated rows one stays; other
    columns are carried along, and an empty table gives an empty one.
    """
    with scratch(docs.sparkSession):
        signed = written(signatures(docs, size), "signatures")
        near = connected(links(written(signed.select("fp").distinct(), "distinct"), limit)).select(F.col("node").alias("fp"), "root")
        rows = signed.select("doc_id", "row_key", "fp", "node").join(near, "fp", "left")
        rows = written(rows.select("doc_id", "row_key", "node", F.coalesce("root", "fp").alias("near")), "classes")
        lows = rows.groupBy("near").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
        edges = rows.join(lows, "near").where("node <> low").select(F.col("node").alias("src"), F.col("low").alias("dst"))
        roots = connected(edges.union(similar(signed)))
        best = _firsts(rows.join(roots, "node", "left").select("doc_id", "row_key", F.coalesce("root", "node").alias("root")))
        best = written(best, "kept", keep=True)
    return chosen_rows(docs, best)

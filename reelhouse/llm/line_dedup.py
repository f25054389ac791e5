"""Line deduplication with two Bloom filters.

Every document's lines become digests of their keys. A first filter notes what has been seen once, a second what has been
seen in two documents; partial filters of the tasks are merged piece by piece (what two of them have seen once has been
seen twice). Only digests that the second filter suspects are shuffled: they are counted exactly, and where one
occurrence is to stay, the first one is chosen. False alarms of the filter cost a count and change nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelhouse.llm.common import row_key
from reelhouse.session import written

#: Bits per distinct line that the filters are given, the most they may have (the second one is sent to every executor,
#: 32 MB at most), and bits of a piece. Beyond the most, more lines are suspected and counted; results are the same.
BITS_A_LINE, MOST_BITS, PIECE_BITS = 16, 1 << 28, 1 << 16
#: Frequent keys that are sent to every task; more of them are joined to their documents.
SENT_KEYS = 1 << 19

_STRIPPED = b" \t\n\v\f\r"
_DIGEST = 16


def keys_of(lines: list[bytes]) -> list[bytes]:
    """White space stripped at both ends, A-Z in lower case; other letters stay."""
    return [line.strip(_STRIPPED).lower() for line in lines]


def digest_of(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=_DIGEST).digest()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or sum(b & 0xC0 != 0x80 for b in key) >= least)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def line_digests(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, row_key and the digests of a document's distinct keys, one behind the other, and how many there are."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in _texts(batch):
                keys = dict.fromkeys(keys_of(text.split(b"\n")))
                packed.append(b"".join(digest_of(k) for k in keys if _long_enough(k, least_chars)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(packed, pa.binary()), pa.array([len(p) // _DIGEST for p in packed], pa.int64())],
                ["doc_id", "row_key", "digests", "n"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), row_key().alias("row_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digests, f"doc_id {kind}, row_key long, digests binary, n long")


def _hashes(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<u8")[:: _DIGEST // 8]


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of one piece for each hash, as places in the whole filter."""
    piece = (hashes >> np.uint64(40)) % np.uint64(bits // PIECE_BITS)
    mask, wide = np.uint64(PIECE_BITS - 1), np.uint64(PIECE_BITS)
    return piece * wide + (hashes & mask), piece * wide + ((hashes >> np.uint64(16)) & mask)


def _pieces(hashes: np.ndarray, bits: int) -> dict[int, np.ndarray]:
    """The pieces of a filter over some hashes, by number, as bytes."""
    places = np.unique(np.concatenate(_places(hashes, bits)))
    number = (places // np.uint64(PIECE_BITS)).astype(np.int64)
    out = {}
    edges = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(places))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        full = np.zeros(PIECE_BITS, np.uint8)
        full[(places[low:high] % np.uint64(PIECE_BITS)).astype(np.int64)] = 1
        out[int(number[low])] = np.packbits(full)
    return out


_FILTER = "piece long, once binary, twice binary"


def seen_twice(found: DataFrame, bits: int) -> np.ndarray:
    """The second filter: bytes of `bits` bits, set for every digest that stands in two documents or more."""
    none = np.zeros(PIECE_BITS // 8, np.uint8)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            new, count = np.unique(_hashes(batch.column("digests").to_pylist()), return_counts=True)
            hashes, at = np.unique(np.concatenate([hashes, new]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, count]), len(hashes)).astype(np.int64)
        once, twice = _pieces(hashes, bits), _pieces(hashes[times > 1], bits)
        numbers = sorted(once)
        for low in range(0, len(numbers), 256):
            some = numbers[low : low + 256]
            shut = lambda pieces: [zlib.compress(pieces.get(n, none).tobytes(), 1) for n in some]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(shut(once)), pa.array(shut(twice))], ["piece", "once", "twice"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, none, none

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([b""], pa.binary()), pa.array([zlib.compress(twice.tobytes(), 1)])], ["piece", "once", "twice"])

        for batch in batches:
            for number, one, two in zip(*(batch.column(c).to_pylist() for c in ("piece", "once", "twice")), strict=True):
                if number != at:
                    if at is not None:
                        yield done()
                    at, once, twice = number, none.copy(), none.copy()
                one, two = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (one, two))
                twice |= two | (once & one)
                once |= one
        if at is not None:
            yield done()

    pieces = found.mapInArrow(partial, _FILTER).repartition("piece").sortWithinPartitions("piece").mapInArrow(merged, _FILTER)
    whole = np.zeros(bits // 8, np.uint8)
    for row in pieces.select("piece", "twice").toLocalIterator():
        low = row["piece"] * (PIECE_BITS // 8)
        whole[low : low + PIECE_BITS // 8] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return whole


def suspects(found: DataFrame, twice: np.ndarray) -> DataFrame:
    """doc_id, row_key, digest of every line key that the second filter holds, once per document."""
    bits = len(twice) * 8
    sent = found.sparkSession.sparkContext.broadcast(twice)

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            packed = batch.column("digests").to_pylist()
            row = np.repeat(np.arange(len(packed)), [len(p) // _DIGEST for p in packed])
            hashes = _hashes(packed)
            hit = np.ones(len(hashes), bool)
            for place in _places(hashes, bits):
                hit &= (held[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
            digests = np.frombuffer(b"".join(packed), f"V{_DIGEST}")[hit]
            rows = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("row_key").take(rows), pa.array([d.tobytes() for d in digests], pa.binary())], ["doc_id", "row_key", "digest"]
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(suspected, f"doc_id {kind}, row_key long, digest binary")


def _who(doc_id, key):
    return F.xxhash64(doc_id.isNull(), doc_id, key)


def frequent(suspected: DataFrame, least_docs: int) -> DataFrame:
    """digest and first (the row of the first occurrence, by doc_id, rows without one last) of the keys to drop."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    counted = suspected.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")).where(F.col("n") >= least_docs)
    return counted.select("digest", _who(F.col("p.doc_id"), F.col("p.row_key")).alias("first"))


def _rewritten(names: list[str], lists, keep_first: bool):
    """Task code: drop lines; `lists(batch)` yields what to drop per row as {digest: first}, and the row's own mark."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            for text, (drop, own) in zip(_texts(batch), lists(batch), strict=True):
                lines = text.split(b"\n")
                kept, met = lines, set()
                if drop:
                    kept = []
                    for line, key in zip(lines, keys_of(lines), strict=True):
                        first = drop.get(digest_of(key))
                        if first is None or (keep_first and first == own and key not in met):
                            kept.append(line)
                        met.add(key)
                texts.append(b"\n".join(kept))
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = [batch.column(f"_own_{i}") for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                [*(f"_own_{i}" for i in range(len(names))), "_kept", "_n_lines", "_n_dropped"],
            )

    return rewrite


def _cleaned(docs: DataFrame, least_docs: int, least_chars: int, keep_first: bool) -> DataFrame:
    """The columns of `docs` as _own_0, _own_1 ..., and _kept, _n_lines, _n_dropped."""
    found = written(line_digests(docs, least_chars), "line-digests")
    total = found.agg(F.sum("n")).first()[0] or 0
    bits = PIECE_BITS
    while bits < min(MOST_BITS, BITS_A_LINE * total):
        bits *= 2
    suspected = suspects(found, seen_twice(found, bits))
    drop = written(frequent(suspected, least_docs), "frequent-lines")
    names = docs.columns
    text = F.col("text").cast("string").alias("text")
    own = [F.col(f"`{c}`").alias(f"_own_{i}") for i, c in enumerate(names)]
    rows = docs.select(*own, text, _who(F.col("doc_id"), row_key()).alias("_who"), F.col("doc_id").alias("_id"), row_key().alias("_key"))
    kinds = [StructField(f"_own_{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    schema = StructType([*kinds, StructField("_kept", StringType()), StructField("_n_lines", LongType()), StructField("_n_dropped", LongType())])
    if drop.count() <= SENT_KEYS:
        sent = docs.sparkSession.sparkContext.broadcast({bytes(r["digest"]): r["first"] for r in drop.collect()})

        def lists(batch):
            return ((sent.value, who) for who in batch.column("_who").to_pylist())

        return rows.drop("_id", "_key").mapInArrow(_rewritten(names, lists, keep_first), schema)

    named = written(suspected.join(drop, "digest"), "dropped-lines").groupBy(F.col("doc_id").alias("_d"), F.col("row_key").alias("_k"))
    named = named.agg(F.collect_set("digest").alias("_digests"), F.collect_set(F.when(F.col("first") == _who(F.col("doc_id"), F.col("row_key")), F.col("digest"))).alias("_firsts"))

    def lists(batch):
        for who, digests, firsts in zip(*(batch.column(c).to_pylist() for c in ("_who", "_digests", "_firsts")), strict=True):
            firsts = set(firsts or ())
            yield {d: who if d in firsts else ~who for d in digests or ()}, who

    joined = rows.join(named, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left").drop("_id", "_key", "_d", "_k")
    return joined.mapInArrow(_rewritten(names, lists, keep_first), schema)


def without_frequent_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """`docs` with the lines of frequent keys cut out of `text`; the same rows and columns.

    Lines end at \\n. A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
    `least_chars` code points that stand in `least_docs` documents (rows) and more are frequent; all their lines go, or,
    with `keep_first`, all but the first one in the document of the smallest doc_id (rows without one last, then by text).
    A missing or empty text is one empty line. Rows that repeat both doc_id and text count each, and share their fate.
    An empty table gives none.
    """
    names = docs.columns
    cleaned = _cleaned(docs, least_docs, least_chars, keep_first)
    return cleaned.select(*[F.when(F.col(f"_own_{i}").isNotNull() | (F.col("_n_dropped") > 0), F.col("_kept")).alias(c) if c == "text" else F.col(f"_own_{i}").alias(c) for i, c in enumerate(names)])


def line_counts(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept_sha256 for every row of `docs`; rules as above."""
    cleaned = _cleaned(docs.select("doc_id", "text"), least_docs, least_chars, keep_first)
    return cleaned.select(F.col("_own_0").alias("doc_id"), F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.col("_kept"), 256).alias("kept_sha256"))

"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text, and a chunk ends where the hash is the largest within CUT_RADIUS bytes to
either side. So cuts depend on near-by content alone: an insertion moves no cut but those next to it, chunks are more than
CUT_RADIUS bytes long, and a passage is cut alike wherever it stands. Chunks are looked up by digest; runs of
neighbouring chunks that other documents have too are the repeated spans, extended byte by byte to where the passage ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.llm.common import row_key
from reelhouse.session import held, written

#: Bytes that the hash looks back on, reach of a cut, longest chunk (only where content repeats itself), least span.
GEAR_BYTES, CUT_RADIUS, LONGEST, LEAST_WORDS = 8, 20, 1024, 28
#: Least span of text without spaces, in bytes (28 words of six), and bytes a word on average that tell such a text.
LEAST_BYTES, LONG_WORDS = 6 * LEAST_WORDS, 20
#: Bytes of a passage beyond its whole chunks: the chunk next to them, and this.
MARGIN = GEAR_BYTES + CUT_RADIUS
#: Bytes hashed at a time, and texts that are cut at a time.
BLOCK, TEXTS_AT_ONCE = 1 << 22, 512
_GEAR = np.random.default_rng(3).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def gear(data: np.ndarray) -> np.ndarray:
    """Sum over the last GEAR_BYTES bytes b of gear(b), shifted by their distance, modulo 2**32."""
    h, width = _GEAR[data], 1
    while width < GEAR_BYTES:
        older = np.zeros_like(h)
        older[width:] = h[:-width]
        h, width = h + (older << np.uint32(width)), width * 2
    return h * np.uint32(2654435769)  # all bits count in the comparison


def _largest_before(values: np.ndarray, reach: int) -> np.ndarray:
    """Largest of the `reach` values before each one."""
    out, width = np.zeros_like(values), 1
    out[1:] = values[:-1]
    while width < reach:
        step = min(width, reach - width)
        out[step:] = np.maximum(out[step:], out[:-step])
        width += step
    return out


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of a text, in bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    found = []
    margin = GEAR_BYTES + 2 * CUT_RADIUS
    for at in range(0, len(raw), BLOCK):
        start = max(0, at - margin)
        h = gear(raw[start : at + BLOCK + margin])
        top = (h > _largest_before(h, CUT_RADIUS)) & (h >= _largest_before(h[::-1], CUT_RADIUS)[::-1])
        here = np.flatnonzero(top) + start + 1
        found.append(here[(here > at) & (here <= at + BLOCK)])
    ends = np.unique(np.r_[np.concatenate(found) if found else np.empty(0, dtype=np.int64), len(raw)]).astype(np.int64)
    ends = ends[ends > 0]
    gaps = np.diff(np.r_[0, ends])
    if len(gaps) and gaps.max() > LONGEST:
        more = [np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(ends[gaps > LONGEST], gaps[gaps > LONGEST])]
        ends = np.unique(np.r_[ends, np.concatenate(more)])
    return ends


AROUND = ("left", "right", "left_words", "right_words")


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, nth, start, bytes, words, digest of every chunk, and what a passage can have beyond it: left, right
    (bytes), left_words, right_words; rows without doc_id or text have none.

    Words are counted where they end. 64 bits of digest do: a span takes several chunks in a row, so one chance match is none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("nth", pa.int32()), ("start", pa.int64()), ("bytes", pa.int32()), ("words", pa.int32()), ("digest", pa.int64()), *((n, pa.int32()) for n in AROUND)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                ends = cuts(data)
                if not len(ends):
                    continue
                starts = np.r_[0, ends[:-1]]
                space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
                ended = np.r_[0, np.cumsum(~space & np.r_[space[1:], True])]
                digests = np.frombuffer(b"".join([xxhash.xxh3_64_digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), dtype="<i8")
                parts.append((np.full(len(ends), doc_id), np.full(len(ends), key), np.arange(len(ends)), starts, ends - starts, ended[ends] - ended[starts], digests, *_around(starts, ends, ended)))
                held += len(ends)
                if held > 100_000:
                    yield _batch(parts, schema)
                    parts, held = [], 0
            if parts:
                yield _batch(parts, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    return rows.mapInArrow(cut, "doc_id long, row_key long, nth int, start long, bytes int, words int, digest long, " + ", ".join(f"{n} int" for n in AROUND))


def _around(starts: np.ndarray, ends: np.ndarray, ended: np.ndarray) -> list[np.ndarray]:
    before = np.maximum(np.r_[0, starts[:-1]] - MARGIN, 0)
    behind = np.minimum(np.r_[ends[1:], ends[-1]] + MARGIN, ends[-1])
    return [starts - before, behind - ends, ended[starts] - ended[before], ended[behind] - ended[ends] + 1]


def _batch(parts, schema: pa.Schema) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, row_key, start, length (bytes of UTF-8), words, first_doc_id, dropped for every repeated span of `docs` (doc_id, text).

    A span is a run of neighbouring chunks that other documents hold too, extended to either side as far as the bytes agree
    with the first holder (for the first holder, with the last one). It has at least `least_words` words, or LEAST_BYTES bytes
    where words have over LONG_WORDS bytes on average, as in text without spaces; a chunk's first
    holder is the smallest doc_id that has it. Neighbours fall into one span if their first holders agree on whether this
    document is the first. dropped tells spans whose chunks an earlier document holds; first_doc_id is the smallest first
    holder. A word counts where it ends.

    Rows without doc_id or text take no part, neither do repeats within one document. Rows of one doc_id count as one
    document when first holders are named, but spans lie within one text, which row_key tells; exact repeats of a row count once. An empty table has no spans. Other columns are not looked at.
    """
    with held(chunks(docs), "chunks") as all_chunks:
        shared = written(_shared(all_chunks), "shared-chunks")
    spans = written(_runs(shared, least_words), "runs")
    spans = _extended(spans, docs)
    length = F.col("end") - F.col("start")
    spans = spans.where((F.col("words") >= least_words) | ((length >= LEAST_BYTES) & (F.col("words") * LONG_WORDS < length)))
    return spans.select("doc_id", "row_key", "start", length.alias("length"), "words", "first_doc_id", "dropped")


def _shared(found: DataFrame) -> DataFrame:
    """Chunks whose digest several documents hold. Places are compared among these only, so all chunks are shuffled with two ids once, and once whole."""
    several = found.groupBy("digest").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
    return found.join(several.select("digest"), "digest", "left_semi")


def _runs(found: DataFrame, least_words: int) -> DataFrame:
    """Runs of neighbouring shared chunks that can be spans, with what is needed to extend them.

    One shuffle by text serves the repeated rows, the window and the grouping.
    """
    place = F.struct("doc_id", "row_key", "start")
    holders = found.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("z"))
    hits = found.join(holders, "digest").withColumn("dropped", F.col("a.doc_id") < F.col("doc_id")).withColumn("first", F.col("a.doc_id"))
    hits = hits.withColumn("other", F.when(F.col("dropped"), F.col("a")).otherwise(F.col("z"))).drop("a", "z", "digest")
    hits = hits.repartition("doc_id", "row_key").dropDuplicates(["doc_id", "row_key", "nth"])
    order = Window.partitionBy("doc_id", "row_key", "dropped").orderBy("nth")
    runs = hits.withColumn("run", F.col("nth") - F.row_number().over(order))
    spans = runs.groupBy("doc_id", "row_key", "dropped", "run").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("bytes")).alias("end"),
        F.sum("words").alias("words"),
        F.min("first").alias("first_doc_id"),
        F.min(F.struct("nth", "other", "left", "left_words")).alias("head"),
        F.max(F.struct("nth", "other", "right", "right_words", "bytes")).alias("tail"),
    )
    most = F.col("words") + F.col("head.left_words") + F.col("tail.right_words")
    reach = F.col("end") - F.col("start") + F.col("head.left") + F.col("tail.right")
    return spans.where((most >= least_words) | ((reach >= LEAST_BYTES) & (F.col("words") * LONG_WORDS < reach)))


def _extended(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """`spans` with start, end and words moved to where the bytes stop to agree with those of the other holder."""
    spot = lambda doc, key, at, back, room: F.struct(doc.alias("doc_id"), key.alias("row_key"), at.alias("at"), F.lit(back).alias("back"), room.alias("room"))
    own, head, tail = (F.col("doc_id"), F.col("row_key")), F.col("head.other"), F.col("tail.other")
    tail_end = tail["start"] + F.col("tail.bytes")
    ends = {
        "own_left": spot(*own, F.col("start"), True, F.col("head.left")), "other_left": spot(head["doc_id"], head["row_key"], head["start"], True, F.col("head.left")),
        "own_right": spot(*own, F.col("end"), False, F.col("tail.right")), "other_right": spot(tail["doc_id"], tail["row_key"], tail_end, False, F.col("tail.right")),
    }
    asked = spans.select(F.explode(F.array(*ends.values())).alias("x")).select("x.*")
    asked = asked.groupBy("doc_id", "row_key", "at", "back").agg(F.max("room").alias("room"))
    asked = asked.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("at", "back", "room")).alias("asked"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text")).where("text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first in range(0, rows.num_rows, TEXTS_AT_ONCE):
                part = rows.slice(first, TEXTS_AT_ONCE)
                texts, spots = part.column("text"), part.column("asked")
                row = pc.list_parent_indices(spots)
                at, back, room = spots.flatten().flatten()
                near, last, data = [], -1, b""
                for i, where, before, reach in zip(row.to_pylist(), at.to_pylist(), back.to_pylist(), room.to_pylist()):
                    if i != last:
                        last, data = i, texts[i].as_buffer().to_pybytes()
                    near.append(data[max(0, where - reach) : where + 1] if before else data[where : where + reach])
                ids = [part.column(c).take(row) for c in ("doc_id", "row_key")]
                yield pa.RecordBatch.from_arrays([*ids, at, back, pa.array(near, type=pa.binary())], names=["doc_id", "row_key", "at", "back", "near"])

    near = texts.join(written(asked, "asked"), ["doc_id", "row_key"]).mapInArrow(cut, "doc_id long, row_key long, at long, back boolean, near binary")
    near = written(near.dropDuplicates(["doc_id", "row_key", "at", "back"]), "near")
    for name, end in ends.items():
        named = near.select(F.struct("doc_id", "row_key", "at", "back").alias(f"{name}_spot"), F.col("near").alias(name))
        at = F.struct(*[end[c].alias(c) for c in ("doc_id", "row_key", "at", "back")])
        spans = spans.withColumn(f"{name}_at", at)
        spans = spans.join(named, F.col(f"{name}_at") == F.col(f"{name}_spot")).drop(f"{name}_at", f"{name}_spot")

    @F.pandas_udf("left int, right int, words int")
    def grown(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_grown(*x) for x in zip(a, b, c, d)], columns=["left", "right", "words"])

    spans = spans.withColumn("more", grown(*ends))
    return spans.withColumn("start", F.col("start") - F.col("more.left")).withColumn("end", F.col("end") + F.col("more.right")).withColumn("words", F.col("words") + F.col("more.words"))


def _grown(own_left: bytes, other_left: bytes, own_right: bytes, other_right: bytes) -> tuple[int, int, int]:
    """Bytes that agree before and behind a run, in whole characters, and the words that end in them; the first two end with the first byte of the run."""
    own_left, first, other_left = own_left[:-1], own_left[-1:], other_left[:-1]
    left = right = 0
    while left < min(len(own_left), len(other_left)) and own_left[-1 - left] == other_left[-1 - left]:
        left += 1
    while left and own_left[len(own_left) - left] & 0xC0 == 0x80:
        left -= 1
    while right < min(len(own_right), len(other_right)) and own_right[right] == other_right[right]:
        right += 1
    while right and right < len(own_right) and own_right[right] & 0xC0 == 0x80:
        right -= 1
    before, behind = own_left[len(own_left) - left :], own_right[:right]
    words = _endings(before + first) + _endings(behind + (own_right[right : right + 1] or b" "))
    return left, right, words


def _endings(data: bytes) -> int:
    """Words that end before the last byte."""
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    return int(np.sum(~space[:-1] & space[1:]))


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` with the dropped spans cut out of their texts; the first holder keeps them. Other columns stay as they are."""
    names = docs.columns
    gone = spans.where("dropped").groupBy(F.col("doc_id").alias("_llm_id"), F.col("row_key").alias("_llm_row")).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_llm_gone"))
    keyed = docs.withColumn("_llm_key", row_key())
    joined = keyed.join(gone, (keyed["doc_id"] == F.col("_llm_id")) & (F.col("_llm_key") == F.col("_llm_row")), "left")

    @F.pandas_udf("string")
    def rest(texts, gone):
        out = []
        for text, spans in zip(texts, gone):
            if text is None or spans is None or not len(spans):
                out.append(text)
                continue
            data, at, kept = text.encode(), 0, []
            for s in spans:
                kept.append(data[at : s["start"]])
                at = max(at, s["start"] + s["length"])
            out.append(b"".join([*kept, data[at:]]).decode(errors="ignore"))
        return texts.__class__(out, dtype=object)

    return joined.withColumn("text", rest("text", "_llm_gone")).select(*names)

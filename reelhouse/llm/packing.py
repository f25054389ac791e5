"""Hierarchical packing into windows of several lengths.

Documents are routed by length to context tiers, powers of two up to the window. What fills whole windows is cut off
first. Each tier packs its rest: the longest tier opens windows, gaps of long windows are filled from the shorter
tiers, largest fitting document first, and a gap that nothing fits takes the beginning of the next document. Documents
that share no long window are packed into windows of their own tier. The last, short window is cut into windows of exact
tier lengths, which need no padding. Windows are then dealt to step groups of equal tokens and even attention cost.

Packing goes on inside tasks, batch of documents by batch, in one pass over the table: nothing is shuffled, ids never
leave the task that made them, and memory is bounded by the ids of BATCH_IDS and one document.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import text_of
from reelhouse.llm.tokens import encoder

END_ID = 1
#: Ids that are packed together, and windows' tokens in one training step.
BATCH_IDS, STEP_TOKENS = 1 << 20, 1 << 16
#: Texts of an Arrow batch that are Python strings at a time.
TEXTS_AT_ONCE = 64
#: Windows of one task are numbered below this; tasks and their batches above.
TASK_WINDOWS = 1 << 40

Piece = tuple[int, int, int]  # document of the batch, start in it, length


def tiers(window: int, shortest: int = 128) -> list[int]:
    """Window lengths, longest first."""
    found = [window]
    while found[-1] > shortest:
        found.append(found[-1] // 2)
    return found


def pack(lengths: list[int], window: int) -> list[tuple[int, list[Piece]]]:
    """Windows (tier, pieces) for documents of these lengths; every token lies in exactly one piece."""
    sizes = tiers(window)
    done: list[tuple[int, list[Piece]]] = []
    waiting: dict[int, list[Piece]] = defaultdict(list)  # length of the rest: rests, taken from the end
    for doc, n in sorted(enumerate(lengths), key=lambda x: (-x[1], x[0])):
        full = n - n % window
        done += [(window, [(doc, at, window)]) for at in range(0, full, window)]
        if n > full:
            waiting[n - full].append((doc, full, n - full))
    for length in sizes:  # rests of just a tier's length need no other
        done += [(length, [p]) for p in reversed(waiting.pop(length, []))]
    order = sorted(waiting, reverse=True)

    def largest(fits: int) -> Piece | None:
        lo, hi = 0, len(order)  # first length of `order` that fits
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if order[mid] > fits else (lo, mid)
        if lo == len(order):
            return None
        found = waiting[order[lo]]
        piece = found.pop()
        if not found:
            del waiting[order[lo]]
            del order[lo]
        return piece

    def put_back(piece: Piece) -> None:
        if piece[2] not in waiting:
            lo = 0
            while lo < len(order) and order[lo] > piece[2]:
                lo += 1
            order.insert(lo, piece[2])
        waiting[piece[2]].append(piece)

    while order:
        tier = next(t for t in reversed(sizes) if t >= order[0])  # of the longest rest
        size = window if tier * 2 > window or sum(k * len(v) for k, v in waiting.items()) >= window else tier
        pieces, left = [], size
        while left and order:
            piece = largest(left) or largest(window)
            if piece[2] > left:
                put_back((piece[0], piece[1] + left, piece[2] - left))
                piece = (piece[0], piece[1], left)
            pieces.append(piece)
            left -= piece[2]
        if left:
            done += _exact(pieces, tiers(window, 1))
        else:
            done.append((size, pieces))
    return done


def _exact(pieces: list[Piece], sizes: list[int]) -> list[tuple[int, list[Piece]]]:
    """Cut a short window into windows of exact lengths, powers of two."""
    found, queue = [], list(reversed(pieces))
    total = sum(p[2] for p in pieces)
    for size in sizes:
        while total >= size:
            taken, left = [], size
            while left:
                doc, at, n = queue.pop()
                if n > left:
                    queue.append((doc, at + left, n - left))
                    n = left
                taken.append((doc, at, n))
                left -= n
            found.append((size, taken))
            total -= size
    return found


def step_groups(windows: list[tuple[int, list[Piece]]], tokens: int = STEP_TOKENS) -> list[int]:
    """Step of each window. A step holds windows of one tier worth `tokens`; costs are dealt back and forth."""
    steps, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        own.sort(key=lambda i: (-sum(p[2] ** 2 for p in windows[i][1]), i))
        n = -(-len(own) * tier // tokens)
        for place, i in enumerate(own):
            turn, at = divmod(place, n)
            steps[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return steps


def packed(docs: DataFrame, tokenizer: str, window: int = 2048) -> DataFrame:
    """Pieces of every row of `docs` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier (length of the window), padding (of the whole window) and step.

    A document is its ids and the end id, so a missing or empty text is the end id alone. Repeated rows are packed as often as
    they stand in the table; an empty table gives no pieces. A document longer than a batch is packed by itself. Other
    columns are not looked at. sequence_id is unique, not consecutive.
    """

    def windows(batch: list[tuple[int, bytes]], number: int) -> tuple[pa.RecordBatch, int]:
        made = pack([len(ids) // 4 for _, ids in batch], window)
        rows = []
        for i, ((tier, pieces), step) in enumerate(zip(made, step_groups(made))):
            filled = sum(p[2] for p in pieces)
            at = 0
            for doc, start, n in pieces:
                doc_id, ids = batch[doc]
                rows.append((doc_id, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4, number + i, at, tier, tier - filled, number + step))
                at += n
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)], names=columns), number + len(made)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "padding", "step"]
    end = np.array([END_ID], dtype="<u4").tobytes()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, int]]:
        for rows in batches:
            for at in range(0, rows.num_rows, TEXTS_AT_ONCE):
                yield from zip(*(c.to_pylist() for c in rows.slice(at, TEXTS_AT_ONCE).columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, batch, held, number = encoder(tokenizer), [], 0, None
        for doc_id, text, task in texts(batches):
            if number is None:
                number = task * TASK_WINDOWS
            ids = coder.ids(text) + end
            batch.append((doc_id, ids))
            held += len(ids) // 4
            if held >= BATCH_IDS:
                found, number = windows(batch, number)
                batch, held = [], 0
                yield found
        if batch:
            yield windows(batch, number)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.spark_partition_id().alias("task"))
    schema = ", ".join(f"{c} long" for c in columns)
    return rows.mapInArrow(run, schema)

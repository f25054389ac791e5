"""Token ids in files of independent zstandard frames with a seek table.

A file is a run of zstandard frames, each holding whole or cut documents' ids (little-endian, 16 or 32 bits), then a
skippable frame with the document index and, last, the seek table: a skippable frame of entries (compressed size,
decompressed size, low 32 bits of the XXH64 of the frame's content), their number, a descriptor byte and a magic number.
A reader takes the tail of a file, and decompresses only the frames that hold the documents it was asked for, checking
each frame's sum.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import row_key, text_of
from reelhouse.llm.tokens import encoder
from reelhouse.session import shared_folder, written

END_ID = 1
FRAME_BYTES = 1 << 18
# fixed values of the seekable format and of skippable frames
SKIPPABLE_SEEK, SKIPPABLE_OWN = 0x184D2A5E, 0x184D2A50
SEEK_MAGIC, HAS_SUMS = 0x8F92EAB1, 0x80
_INDEX = np.dtype([("doc_id", "<i8"), ("missing", "u1"), ("n_tokens", "<u4")])
_HEAD = struct.Struct("<BQQ")  # bytes per id, documents, ids


class StoreError(Exception):
    """A file that is cut short, or whose content doesn't match its sums."""


class FileWriter:
    """Appends documents to an open binary file; memory holds one frame and the index."""

    def __init__(self, out, wide: bool):
        self.out, self.kind = out, np.dtype("<u4" if wide else "<u2")
        self.pack = zstandard.ZstdCompressor(level=3)
        self.held, self.entries, self.index, self.ids = bytearray(), [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held += ids.astype(self.kind).tobytes()
        self.index.append((doc_id or 0, doc_id is None, len(ids)))
        self.ids += len(ids)
        while len(self.held) >= FRAME_BYTES:
            self._frame(bytes(self.held[:FRAME_BYTES]))
            del self.held[:FRAME_BYTES]

    def _frame(self, content: bytes) -> None:
        packed = self.pack.compress(content)
        self.out.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        index = np.array(self.index, dtype=_INDEX).tobytes()
        packed = self.pack.compress(_HEAD.pack(self.kind.itemsize, len(self.index), self.ids) + index)
        self.out.write(struct.pack("<II", SKIPPABLE_OWN, len(packed) + 8) + packed + struct.pack("<II", len(packed), zlib.crc32(packed)))
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + 9) + table + struct.pack("<IBI", len(self.entries), HAS_SUMS, SEEK_MAGIC))


class FileReader:
    """Random access to the documents of one open, seekable file."""

    def __init__(self, source, size: int):
        self.source = source
        self.unpack = zstandard.ZstdDecompressor()
        if size < 17:
            raise StoreError("too short for a seek table")
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != HAS_SUMS or size < 17 + 12 * n:
            raise StoreError("no seek table")
        table = size - 9 - 12 * n
        sizes = np.frombuffer(self._at(table, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.r_[0, np.cumsum(sizes[:, 0])]
        self.offsets = np.r_[0, np.cumsum(sizes[:, 1])]
        self.sums = sizes[:, 2]
        length, total = struct.unpack("<II", self._at(table - 16, 8))
        packed = self._at(table - 16 - length, length)
        if zlib.crc32(packed) != total:
            raise StoreError("the document index doesn't match its sum")
        head = self.unpack.decompress(packed)
        width, _, self.ids = _HEAD.unpack_from(head)
        self.kind = np.dtype("<u4" if width == 4 else "<u2")
        self.index = np.frombuffer(head, dtype=_INDEX, offset=_HEAD.size)
        self.begins = np.r_[0, np.cumsum(self.index["n_tokens"].astype(np.int64))]
        self.last: tuple[int, bytes] = (-1, b"")
        self.frames_read = 0

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        got = self.source.read(length)
        if len(got) != length:
            raise StoreError("the file is cut short")
        return got

    def _frame(self, k: int) -> bytes:
        if self.last[0] != k:
            content = self.unpack.decompress(self._at(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k])))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k]:
                raise StoreError(f"frame {k} doesn't match its sum")
            self.last = (k, content)
            self.frames_read += 1
        return self.last[1]

    def document(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the index."""
        start, end = (int(x) * self.kind.itemsize for x in self.begins[place : place + 2])
        first = int(np.searchsorted(self.offsets, start, side="right")) - 1
        parts, at = [], start
        while at < end:
            base = int(self.offsets[first])
            parts.append(self._frame(first)[at - base : end - base])
            at = int(self.offsets[first + 1])
            first += 1
        return np.frombuffer(b"".join(parts), dtype=self.kind)


def _files(place: str):
    """File system of a folder and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(place if "://" in place or place.startswith("file:") else f"file://{place}")


def write_store(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write `docs` (doc_id, text) as files in ascending doc_id order; returns file, first (ids before it), n_docs, n_ids.

    A missing doc_id comes last, a missing text is empty; rows of one doc_id follow each other by their text. Every task
    writes one file under a name of its own and then moves it to its place, so a task that runs again only replaces equal content.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = None
        for rows in batches:
            if writer is None:
                system, path = _files(folder)
                system.create_dir(path, recursive=True)
                name = f"part-{int(rows['part'].iloc[0]):06d}.ids.zst"
                trial = f"{path}/.{name}.{uuid.uuid4().hex}"
                coder = encoder(tokenizer)
                out = system.open_output_stream(trial)
                writer = FileWriter(out, wide=coder.size > 1 << 16)
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                ids = np.frombuffer(coder.ids(text), dtype="<u4")
                writer.add(None if pd.isna(doc_id) else int(doc_id), np.append(ids, np.uint32(END_ID)))
        if writer is not None:
            writer.close()
            out.close()
            system.move(trial, f"{path}/{name}")
            yield pd.DataFrame({"file": [name], "n_docs": [len(writer.index)], "n_ids": [writer.ids]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange(order).sortWithinPartitions(order, row_key(), "text")
    files = dealt.withColumn("part", F.spark_partition_id()).mapInPandas(write, "file string, n_docs long, n_ids long")
    return with_first(written(files, "token-files"))


def with_first(files: DataFrame) -> DataFrame:
    """Adds the ids of all files before each one; one row per file."""
    from pyspark.sql.window import Window

    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_store(files: DataFrame, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the stored documents, or of the wanted ones, read from the files.

    Only frames that hold a wanted document are decompressed. `wanted` is a list that the caller holds; for a large set, filter the
    files by their range and join the result.
    """
    picked = None if wanted is None else np.array(sorted(set(wanted)), dtype=np.int64)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for name, first in zip(rows["file"], rows["first"]):
                system, path = _files(folder)
                size = system.get_file_info(f"{path}/{name}").size
                with system.open_input_file(f"{path}/{name}") as source:
                    reader = FileReader(source, size)
                    index = reader.index
                    here = range(len(index)) if picked is None else np.flatnonzero(np.isin(index["doc_id"], picked) & (index["missing"] == 0))
                    found = [(None if index["missing"][k] else int(index["doc_id"][k]), int(first) + int(reader.begins[k]), int(index["n_tokens"][k]), zlib.crc32(reader.document(k).astype("<u4").tobytes())) for k in here]
                yield pd.DataFrame(found, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    spread = files.select("file", "first").repartition(max(1, files.count()), "file")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write `docs` and read every document back: doc_id, start, n_tokens, ids_crc32, from the files.

    A missing or empty text is the end id alone. Repeated rows are stored as often as they stand in the table; an empty
    table gives no files and no rows. Other columns are not looked at.
    """
    folder = folder or new_folder(docs.sparkSession)
    return read_store(write_store(docs, folder, tokenizer), folder)


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, f"token-store-{uuid.uuid4().hex}")

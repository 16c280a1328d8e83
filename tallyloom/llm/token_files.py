"""Token ids in seekable files: independent zstandard frames, a document index and a trailing seek table.

A file is, in this order:

- for each document one zstandard frame with its ids as little-endian unsigned
  32-bit integers (several frames for a document of more than `FRAME_IDS` ids),
  each with its content size and content checksum;
- a skippable frame (0x184D2A5D) with the index: the number of documents, then
  arrays of document ids (int64), of flags (1: the id is NULL) and of frame counts;
- the seek table of the public seekable format (skippable frame 0x184D2A5E, one
  12-byte entry for each frame: compressed size, size, low 32 bits of XXH64;
  then the number of frames, a descriptor byte and 0x8F92EAB1).

Any zstandard tool can decompress such a file; a reader that wants some
documents reads the two tail frames and then those documents' bytes only.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, slices, written
from tallyloom.llm.encoding import encoder
from tallyloom.sources.locations import work_folder

FRAME_IDS = 1 << 20
INDEX_MAGIC, SEEK_MAGIC, SEEKABLE_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
#: Text bytes that one file should hold.
FILE_TEXT_BYTES = 64 << 20
READ_BYTES = 8 << 20
#: Text bytes encoded at a time.
SLICE_BYTES = 4 << 20
LEVEL = 3

_MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_frames", pa.int64()), ("n_bytes", pa.int64())])
MANIFEST = "part int, file string, n_docs long, n_ids long, n_frames long, n_bytes long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it, for a local path or a URI of any store that Arrow knows."""
    return pafs.FileSystem.from_uri(uri)


def _low32(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class SeekableWriter:
    """Appends documents to an open binary stream."""

    def __init__(self, out, level: int = LEVEL, frame_ids: int = FRAME_IDS):
        self.out, self.frame_bytes = out, 4 * frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.sizes: list[tuple[int, int, int]] = []
        self.docs: list[int] = []
        self.nulls: list[int] = []
        self.frames: list[int] = []
        self.n_ids = self.n_bytes = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        parts = [ids[i : i + self.frame_bytes] for i in range(0, len(ids), self.frame_bytes)] or [b""]
        for part in parts:
            packed = self.zstd.compress(part)
            self._put(packed)
            self.sizes.append((len(packed), len(part), _low32(part)))
        self.docs.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.frames.append(len(parts))
        self.n_ids += len(ids) // 4

    def finish(self) -> None:
        index = struct.pack("<Q", len(self.docs)) + np.array(self.docs, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes() + np.array(self.frames, "<u4").tobytes()
        self._put(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = np.array([*self.sizes, (len(index) + 8, 0, _low32(b""))], "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.sizes) + 1, 0x80, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SEEK_MAGIC, len(entries) + len(footer)) + entries + footer)


class FileIndex(NamedTuple):
    """For each document: id (with a mask of NULLs), byte range, first id and number of ids; frames in file order."""

    doc_ids: np.ndarray
    nulls: np.ndarray
    first_frame: np.ndarray
    n_frames: np.ndarray
    frames: np.ndarray
    frame_at: np.ndarray


def read_index(f, size: int) -> FileIndex:
    """Read the seek table and the index; no document is read. Damage raises ValueError."""
    n, descriptor, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC or descriptor != 0x80:
        raise ValueError("no seek table at the end of the file")
    length = 12 * n + 9
    head = struct.unpack("<II", f.read_at(8, size - length - 8))
    if head != (SEEK_MAGIC, length):
        raise ValueError("the seek table is damaged")
    frames = np.frombuffer(f.read_at(12 * n, size - length), "<u4").reshape(n, 3).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(frames[:, 0])])
    if at[-1] != size - length - 8:
        raise ValueError("the frames don't add up to the file")
    raw = f.read_at(int(frames[-1, 0]), int(at[-2]))
    if struct.unpack_from("<II", raw) != (INDEX_MAGIC, len(raw) - 8):
        raise ValueError("the index is damaged")
    (docs,) = struct.unpack_from("<Q", raw, 8)
    ids = np.frombuffer(raw, "<i8", docs, 16)
    nulls = np.frombuffer(raw, "u1", docs, 16 + 8 * docs).astype(bool)
    count = np.frombuffer(raw, "<u4", docs, 16 + 9 * docs).astype(np.int64)
    first = np.cumsum(count) - count
    return FileIndex(ids, nulls, first, count, frames[:-1], at[:-1])


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Encode every text, append `end_id`, write seekable files in ascending key order; return the manifest.

    `vocabulary` is the path of a `tokenizers` file that every executor has.
    Keys are whole numbers or NULL (NULLs first); repeated keys are documents
    of their own, ordered by a digest of the text. NULL and empty texts have the
    end id only. One range of keys makes one file, sized by the text bytes; a
    file's name has its task attempt, and only files in the manifest count, so
    lost or repeated tasks leave nothing wrong. The manifest is a written table
    with one row for each file.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "token-files")
    rows = docs.select(col(key).cast("bigint").alias("k"), col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_TEXT_BYTES))
    tie = F.md5(F.coalesce(F.col("t"), F.lit("")).cast("binary"))
    rows = rows.withColumn("tie", tie).repartitionByRange(parts, F.col("k").asc_nulls_first(), "tie")
    rows = rows.sortWithinPartitions(F.col("k").asc_nulls_first(), "tie").select("k", "t")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, name = task.partitionId(), f"part-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        enc, out = encoder(vocabulary), None
        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for texts in slices(batch.column(1), SLICE_BYTES):
                if out is None:
                    store, path = filesystem(folder)
                    store.create_dir(path, recursive=True)
                    out = SeekableWriter(store.open_output_stream(f"{path}/{name}", compression=None))
                for ids in enc.encode(texts.to_pylist()):
                    out.add(keys[at], ids + end)
                    at += 1
        if out is not None:
            out.finish()
            out.out.close()
            row = [part, f"{folder}/{name}", len(out.docs), out.n_ids, len(out.sizes), out.n_bytes]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _MANIFEST_ARROW.types, strict=True)], schema=_MANIFEST_ARROW)

    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


INDEX = "doc_id long, part int, file string, start long, n_tokens long, frame long, offset long, sizes array<long>, checksums array<long>"


def document_index(manifest: DataFrame) -> DataFrame:
    """One row for each document from the files' tails: where it is and how long; no document is read.

    `start` counts the ids of all documents before it, over the files in order.
    The index is a written table: a job that reads documents by it needs one Python
    worker a task, and no more workers stay with their caches.
    """
    # One row per file of about 64 MB of text.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = manifest.withColumn("base", F.sum("n_ids").over(before) - F.col("n_ids"))
    n = max(1, manifest.count())
    files = files.select("part", "file", "base", "n_bytes").repartition(n, "file")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                store, path = filesystem(f["file"])
                with store.open_input_file(path) as source:
                    x = read_index(source, f["n_bytes"])
                ids = np.concatenate([[0], np.cumsum(x.frames[:, 1] // 4)])
                for i in range(0, len(x.doc_ids), 4096):
                    a, c = x.first_frame[i : i + 4096], x.n_frames[i : i + 4096]
                    lo, hi = int(a[0]), int(a[-1] + c[-1])
                    cut = pa.array(np.append(a - lo, hi - lo), pa.int32())
                    m = len(a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(x.doc_ids[i : i + 4096], mask=x.nulls[i : i + 4096]),
                            pa.array([f["part"]] * m, pa.int32()),
                            pa.array([f["file"]] * m),
                            pa.array(ids[a] + f["base"]),
                            pa.array(ids[a + c] - ids[a]),
                            pa.array(a),
                            pa.array(x.frame_at[a]),
                            pa.ListArray.from_arrays(cut, pa.array(x.frames[lo:hi, 0])),
                            pa.ListArray.from_arrays(cut, pa.array(x.frames[lo:hi, 2])),
                        ],
                        ["doc_id", "part", "file", "start", "n_tokens", "frame", "offset", "sizes", "checksums"],
                    )

    return written(files.mapInArrow(index, INDEX), "token-index")


def _frames(data: bytes, sizes: list[int], checksums: list[int]) -> bytes:
    """The ids in one document's frames, each checked against its checksums."""
    zstd, out, at = zstandard.ZstdDecompressor(), [], 0
    for size, checksum in zip(sizes, checksums, strict=True):
        part = zstd.decompress(data[at : at + size])
        if _low32(part) != checksum:
            raise ValueError("a frame fails its checksum")
        out.append(part)
        at += size
    return b"".join(out)


def read_documents(index: DataFrame, digest_only: bool = False) -> DataFrame:
    """Decompress the documents in `index`, or in any selection of its rows, and no others.

    Adds `ids` (array of long), or with `digest_only` the CRC-32 of their bytes
    as `ids_crc32`. Neighbouring documents are read together. A frame that fails
    its checksum ends the job.
    """
    added = "ids_crc32 long" if digest_only else "ids array<long>"
    kept = [f.name for f in index.schema.fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, object] | None = None
        for batch in batches:
            rows = batch.select(["file", "offset", "sizes", "checksums"]).to_pylist()
            ends = [r["offset"] + sum(r["sizes"]) for r in rows]
            i = 0
            while i < len(rows):
                j = i + 1
                while j < len(rows) and rows[j]["file"] == rows[i]["file"] and rows[j]["offset"] == ends[j - 1] and ends[j] - rows[i]["offset"] <= READ_BYTES:
                    j += 1
                if opened is None or opened[0] != rows[i]["file"]:
                    store, path = filesystem(rows[i]["file"])
                    opened = rows[i]["file"], store.open_input_file(path)
                base = rows[i]["offset"]
                data = opened[1].read_at(ends[j - 1] - base, base)
                found = [_frames(data[r["offset"] - base : e - base], r["sizes"], r["checksums"]) for r, e in zip(rows[i:j], ends[i:j], strict=True)]
                if digest_only:
                    last = pa.array([zlib.crc32(x) for x in found], pa.int64())
                else:
                    values = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
                    last = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in found)]), pa.int32()), pa.array(values))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, last], [*kept, added.split()[0]])
                i = j

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(read, f"{fields}, {added}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path)

"""Count the tokens of documents in flat token files that have no index.

A flat file is nothing but ids, each document followed by the end-of-document
id. Files are cut into blocks that any task can scan alone; documents that
cross block boundaries are stitched by a prefix scan over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, slices, written
from tallyloom.llm.encoding import encoder
from tallyloom.llm.token_files import filesystem
from tallyloom.sources.locations import work_folder

#: Ids of one block.
BLOCK_IDS = 1 << 22
_NAMES = pa.schema([("part", pa.int32()), ("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64())])
NAMES = "part int, file string, ordinal long, doc_id long, n_bytes long"
_FOUND = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("rank", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("stop", pa.int64())])
FOUND = "part int, block long, rank long, start long, `end` long, stop long"


def write_flat_files(docs: DataFrame, vocabulary: str, end_id: int, dtype: str = "<u2", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One flat file for each task that reads `docs`, without a shuffle.

    Returns (part, file, ordinal, doc_id, n_bytes): a row for each document in
    file order, and a row with ordinal -1 and the file's size. A special token's
    string in a text is ordinary text, so the end id stands for ends alone. NULL
    and empty texts are an end id. Only files named in the table count.
    """
    folder = work_folder(docs.sparkSession, "flat-files")
    rows = docs.select(col(key).cast("bigint").alias("k"), col(text).alias("t"))
    end = np.array([end_id], dtype).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, name = task.partitionId(), f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        enc, out, n, size = encoder(vocabulary, np.dtype(dtype).itemsize, True), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, path = filesystem(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(filesystem(name)[1], compression=None)
            for texts in slices(batch.column(1), 1 << 20):
                data = end.join([*enc.encode(texts.to_pylist()), b""])
                out.write(data)
                size += len(data)
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([part] * m, pa.int32()), pa.array([name] * m), pa.array(range(n, n + m)), batch.column(0), pa.nulls(m, pa.int64())], schema=_NAMES)
            n += m
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "ordinal": -1, "doc_id": None, "n_bytes": size}], schema=_NAMES)

    return written(rows.mapInArrow(write, NAMES), "flat-names")


def scan_blocks(files: DataFrame, end_id: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Search every block of `files` (part, file, n_bytes) for the end id.

    A row for each end found: its block, its rank in the block, the position
    where its document starts (NULL for the first of a block, whose start may be
    in an earlier block) and the position of the end id; and a row with rank -1
    for each block, with the block's first position as `start`, its last end id
    as `end` (NULL: none) and the position after the block as `stop`.
    """
    width = np.dtype(dtype).itemsize
    total = F.col("n_bytes") / width
    blocks = files.where("n_bytes > 0").select("part", "file", F.floor(total).cast("bigint").alias("ids"))
    blocks = blocks.select("part", "file", "ids", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("ids") - 1) / block_ids))).alias("block"))
    n = max(1, blocks.count())
    blocks = blocks.repartition(n, "part", "block")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                first = b["block"] * block_ids
                store, path = filesystem(b["file"])
                with store.open_input_file(path) as source:
                    ids = np.frombuffer(source.read_at(min(block_ids, b["ids"] - first) * width, first * width), dtype)
                ends = np.flatnonzero(ids == end_id) + first
                last, m = (int(ends[-1]) if len(ends) else None), len(ends)
                yield pa.RecordBatch.from_pylist([{"part": b["part"], "block": b["block"], "rank": -1, "start": first, "end": last, "stop": first + len(ids)}], schema=_FOUND)
                if m:
                    starts = np.concatenate([[0], ends[:-1] + 1])
                    unknown = np.arange(m) == 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b["part"]] * m, pa.int32()), pa.array([b["block"]] * m, pa.int64()), pa.array(np.arange(m)), pa.array(starts, mask=unknown), pa.array(ends), pa.nulls(m, pa.int64())],
                        schema=_FOUND,
                    )

    return blocks.mapInArrow(scan, FOUND)


def document_lengths(found: DataFrame) -> DataFrame:
    """(part, ordinal, start, n_tokens, complete) for each document; `n_tokens` leaves out the end id.

    The prefix scan runs over one row for each block of a file: documents in the
    blocks before, and the last end before the block. Ids after a file's last
    end are a document with `complete` false; a file without ids has none.
    `found` is read more than once: pass a written table.
    """
    blocks = found.where("rank = -1").select("part", "block", F.col("end").alias("last_end"), "stop")
    counts = found.where("rank >= 0").groupBy("part", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.join(counts, ["part", "block"], "left")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("part")
    blocks = blocks.select(
        "part",
        "block",
        "last_end",
        "stop",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        (F.coalesce(F.last("last_end", ignorenulls=True).over(before), F.lit(-1)) + 1).alias("open_start"),
        F.max("block").over(whole).alias("final"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    ended = found.where("rank >= 0").join(blocks.select("part", "block", "docs_before", "open_start"), ["part", "block"])
    start = F.coalesce("start", "open_start")
    ended = ended.select("part", (F.col("docs_before") + F.col("rank")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("complete"))
    tail_start = F.coalesce(F.col("last_end") + 1, "open_start")
    tails = blocks.where(F.col("block") == F.col("final")).select(
        "part", (F.col("docs_before") + F.col("n")).alias("ordinal"), tail_start.alias("start"), (F.col("stop") - tail_start).alias("n_tokens"), F.lit(False).alias("complete")
    )
    return ended.unionAll(tails.where("n_tokens > 0"))

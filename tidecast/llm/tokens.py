"""Token counts per document out of flat token files.

A flat file is token ids in two or four little-endian bytes each, one document after
another, each closed by the end-of-document id; there is no index. Files are read in
blocks that know nothing of documents. Each block is searched at once for the closing
id; a running sum over block summaries then says where the block lies in its file, how
many documents closed before it, and where the open one began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import codec, description_of, public_vocabulary
from .common import query, table, written

#: The free id behind the public vocabulary's 50,256 tokens.
END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 1 << 19


def flat_blocks(
    docs: DataFrame, ranks_path: str, pattern: str, end: int = END_OF_DOCUMENT, block: int = BLOCK_TOKENS
) -> DataFrame:
    """(file, block, data, ids): documents encoded into flat files, one per task, cut
    into blocks of ``block`` tokens wherever that falls.

    ids lists the documents whose closing id lies in the block; it is what the writer
    knows, and no part of the file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(description_of(ranks_path))
    kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        file = TaskContext.get().partitionId()
        held, size, ids, number = [], 0, [], 0

        def cut(data: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            ends = int((data == end).sum())
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([data.tobytes()], pa.binary()),
                    pa.array([ids[:ends]], pa.list_(pa.int64())),
                ],
                names=["file", "block", "data", "ids"],
            )
            del ids[:ends]
            number += 1
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                coded = coder.encode(text.as_py())
                held.append(np.array([*coded, end], kind))
                ids.append(doc_id.as_py())
                size += len(held[-1])
                if size >= block:
                    flat = np.concatenate(held)
                    whole = size - size % block
                    for start in range(0, whole, block):
                        yield cut(flat[start : start + block])
                    held, size = [flat[whole:]], size - whole
        if size:
            yield cut(np.concatenate(held))

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "file int, block int, data binary, ids array<bigint>")


def file_blocks(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data) of the flat files below ``path``, read by Spark.

    ``file`` is the file's name. A file is read in one piece and cut in its task, so
    files should stay below 2 GB.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    step = block * width
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(step).cast("long"))
    cut = files.select("path", "content", F.posexplode(starts).alias("block", "start"))
    return cut.select(
        F.col("path").alias("file"),
        "block",
        F.expr(f"substring(content, cast(start as int) + 1, {step})").alias("data"),
    )


def separators(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: int = 2) -> DataFrame:
    """(file, block, n_tokens, ends) per block: where in the block the closing ids are."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for data in batch.column(2):
                flat = np.frombuffer(data.as_buffer() or b"", kind)
                sizes.append(len(flat))
                ends.append(np.flatnonzero(flat == end).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(ends, pa.list_(pa.int32())),
                ],
                names=["file", "block", "n_tokens", "ends"],
            )

    file = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", "block", "data").mapInArrow(
        run, f"file {file}, block int, n_tokens bigint, ends array<int>"
    )


def document_spans(found: DataFrame) -> DataFrame:
    """(file, block, nth, document, start, n_tokens, closed) per document.

    ``found`` are the ``separators`` of all blocks. document counts from 0 in its file;
    start is its first token there, n_tokens excludes the closing id. block and nth say
    where it closed. Tokens behind a file's last closing id are one document with
    closed false. Empty documents have 0 tokens; an empty file has none.
    """
    sums = found.select(
        "file",
        "block",
        "n_tokens",
        F.size("ends").cast("long").alias("n_ends"),
        F.get("ends", F.size("ends") - 1).cast("long").alias("last"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    sums = sums.withColumns({
        "before": F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)),
        "open": F.coalesce(F.max(F.col("base") + F.col("last")).over(earlier) + 1, F.lit(0)),
    })
    # Only summaries are ordered; the places join them by block.
    where = sums.select(F.col("file").alias("f"), F.col("block").alias("b"), "base", "before", "open")
    blocks = found.select("file", "block", "ends").join(
        where, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))
    )
    each = blocks.select("file", "block", "base", "before", "open", "ends", F.posexplode("ends").alias("nth", "end"))
    previous = F.get("ends", F.col("nth") - 1)
    start = F.coalesce(F.col("base") + previous + 1, F.col("open"))
    closed = each.select(
        "file",
        "block",
        "nth",
        (F.col("before") + F.col("nth")).alias("document"),
        start.alias("start"),
        (F.col("base") + F.col("end") - start).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    whole = sums.groupBy("file").agg(
        F.sum("n_tokens").alias("size"),
        F.sum("n_ends").alias("document"),
        F.coalesce(F.max(F.col("base") + F.col("last")) + 1, F.lit(0)).alias("start"),
    )
    tail = whole.where(F.col("size") > F.col("start")).select(
        "file",
        F.lit(None).cast("int").alias("block"),
        F.lit(None).cast("int").alias("nth"),
        "document",
        "start",
        (F.col("size") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(tail)


@query("op3_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, found again in flat files written from all of them."""
    path, pattern = public_vocabulary()
    blocks = flat_blocks(table(spark, folder, "documents"), path, pattern)
    # A few long rows: small row groups, so that readers need not hold many blocks.
    stored = written(blocks, "flat-tokens", "zstd")
    found = written(separators(stored), "separators")
    spans = document_spans(found)
    names = stored.select(
        F.col("file").alias("f"), F.col("block").alias("b"), F.posexplode("ids").alias("n", "doc_id")
    )
    same = (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.col("nth") == F.col("n"))
    return spans.join(names, same, "left").select(
        "doc_id", "n_tokens", "file", "document", "start", "closed"
    )

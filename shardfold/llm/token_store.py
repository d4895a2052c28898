"""Token ids in a binary file format with shuffled planes.

Documents are encoded in ascending id order.  Each shard is a stretch of that
order; its rows ("segments") hold whole documents.  The ids of a segment are
cut into blocks of ``BLOCK`` ids, each block is transposed into byte planes
(first the lowest byte of every id, and so on), and each plane is compressed
with zstandard on its own.  High planes hold almost only zeros and vanish.

Files of a store (Parquet as the container, written by Spark's own committer,
so a lost task leaves nothing half written and needs no file access of its
own on the executors):

* ``segments``: shard, segment, first (ids of the shard before it), doc_ids,
  doc_lens, n_ids, plane_ends (the chunk index: where each plane of each block
  ends in ``payload``) and payload;
* ``shards``: shard and start (ids of all shards before it), one row each.

Work per document is local to its segment; the only shuffle deals the texts
out by ranges of (id, text hash), so equal ids don't gather in one task.
Running sums are taken within a shard while it is written, and over one row
per shard afterwards.

Defined cases: null text is empty and stores the end id alone; null ids come
first; repeated rows and ties are stored each, ordered by (id, text); an empty
table gives an empty store; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare_python, sized_slices
from .token_counts import library

BLOCK = 1 << 14
#: ids of a segment before the next document starts another one
SEGMENT = 1 << 17
#: UTF-8 bytes of texts encoded together (a longer single text stands alone)
SLICE_BYTES = 1 << 22
PLANES = 4
LEVEL = 1

SEGMENTS = ("shard int, segment bigint, first bigint, doc_ids array<bigint>, doc_lens array<bigint>, "
            "n_ids bigint, plane_ends array<bigint>, payload binary")


def pack(ids: np.ndarray) -> tuple[list[int], bytes]:
    """(plane ends, payload) of unsigned 32-bit ids."""
    import zstandard

    press = zstandard.ZstdCompressor(level=LEVEL)
    planes, ends, at = [], [], 0
    for k in range(0, len(ids), BLOCK):
        for plane in np.ascontiguousarray(ids[k:k + BLOCK].astype("<u4").view(np.uint8).reshape(-1, PLANES).T):
            planes.append(press.compress(plane.tobytes()))
            at += len(planes[-1])
            ends.append(at)
    return ends, b"".join(planes)


def unpack(n_ids: int, ends: list[int], payload: bytes) -> np.ndarray:
    """The ids that :func:`pack` was given."""
    import zstandard

    un = zstandard.ZstdDecompressor()
    out, at, view = np.empty(n_ids, "<u4"), 0, memoryview(payload)
    for block in range(0, len(ends), PLANES):
        n = min(BLOCK, n_ids - block // PLANES * BLOCK)
        planes = np.empty((PLANES, n), np.uint8)
        for p, end in enumerate(ends[block:block + PLANES]):
            planes[p] = np.frombuffer(un.decompress(view[at:end], max_output_size=n), np.uint8)
            at = end
        first = block // PLANES * BLOCK
        out[first:first + n] = np.ascontiguousarray(planes.T).reshape(-1).view("<u4")
    return out


def _segments(it: Iterator[pa.RecordBatch], path: str, end_id: int | None) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    lib, shard = library(path, True), TaskContext.get().partitionId()
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_lens", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("plane_ends", pa.list_(pa.int64())), ("payload", pa.binary())])
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()
    segment = first = held = 0
    names, lens, parts = [], [], []

    def full():
        ends, payload = pack(np.frombuffer(b"".join(parts), "<u4"))
        row = [shard, segment, first, names, lens, held, ends, payload]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    for batch in it:
        # some megabytes of texts at a time: the larger the slice, the fewer of its pieces are different
        ids_col, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
        sizes = pa.compute.binary_length(texts).to_pylist()
        for a, b in sized_slices(sizes, SLICE_BYTES):
            for name, ids in zip(ids_col[a:b], lib.ids(texts.slice(a, b - a))):
                names.append(name)
                parts.append(ids + end)
                lens.append(len(parts[-1]) // 4)
                held += lens[-1]
                if held >= SEGMENT:
                    yield full()
                    segment, first, held = segment + 1, first + held, 0
                    names, lens, parts = [], [], []
    if names:
        yield full()


def write_store(docs: DataFrame, folder: str, path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` with the tokenizer file ``path`` and write a store to ``folder``."""
    spark = docs.sparkSession
    prepare_python(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = (rows.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
             .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text"))
    dealt.mapInArrow(lambda it: _segments(it, path, end_id), SEGMENTS).write.option("compression", "uncompressed").parquet(f"{folder}/segments")
    sums = _read(spark, folder, "segments", SEGMENTS).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # over one row per shard
    sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(f"{folder}/shards")


def _read(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{part}")


def _located(spark: SparkSession, folder: str) -> DataFrame:
    shards = _read(spark, folder, "shards", "shard int, start bigint")
    return _read(spark, folder, "segments", SEGMENTS).join(shards, "shard").withColumn("first", F.col("first") + F.col("start")).drop("start", "shard", "segment")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids: the documents of a store."""
    prepare_python(spark)

    def batches(it):
        for d in _documents(it):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in d], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], ["doc_id", "start", "ids"])

    return _located(spark, folder).mapInArrow(batches, "doc_id bigint, start bigint, ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids' crc32, read back from a store."""
    prepare_python(spark)

    def batches(it):
        for d in _documents(it):
            rows = [(i, s, len(x), zlib.crc32(x)) for i, s, x in d]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _located(spark, folder).mapInArrow(batches, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _documents(it: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Per segment its documents: id, start, ids."""
    for batch in it:
        for row in range(batch.num_rows):
            s = {n: batch.column(k)[row].as_py() for k, n in enumerate(batch.schema.names)}
            ids = unpack(s["n_ids"], s["plane_ends"], s["payload"])
            ends = np.cumsum(s["doc_lens"])
            yield [(i, s["first"] + int(e) - n, ids[e - n:e]) for i, n, e in zip(s["doc_ids"], s["doc_lens"], ends)]

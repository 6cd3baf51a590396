"""Token ids as flat binary files with 64-bit document offsets.

Layout of a folder: per shard three files of little-endian numbers,
``*.ids`` (all ids of the shard's documents in order; 16 bits when the
vocabulary fits, else 32), ``*.off`` (``n_docs + 1`` 64-bit offsets into the
ids, from 0) and ``*.doc`` (64-bit document ids; null ids come first and are
counted in the manifest), and a Parquet ``manifest`` with one row per shard.
Shards are contiguous ranges of ``(doc_id, text hash)``; the place of a shard
in the whole collection is the prefix sum of the shards before it.

Every attempt of a task writes files of its own name and only a task that
Spark commits gets its names into the manifest, so retried, speculative and
lost tasks do no harm.

Defined cases: a null or empty text is a document that holds the end id alone;
repeated rows are separate documents; null ids sort first; an empty table has
an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from larkspur.llm.common import Shared, vocabulary_bytes
from larkspur.llm.words import TextEncoder

_MANIFEST = "shard int, stem string, n_docs long, n_null long, n_tokens long, width int"
_ROWS_OUT = 4096


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, shards: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode every text, append ``end_id``, write the files under ``folder``; gives the manifest.

    ``folder`` is a URI all executors can write to.  ``shards`` defaults to
    ``spark.sql.shuffle.partitions``.  A task streams its range, holding one
    Arrow batch of texts and the offsets of its documents.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Shared(vocabulary_bytes(tokenizer_file), TextEncoder))
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.value.made()
        width = 2 if max(end_id, encoder.tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
        store, root = fs.FileSystem.from_uri(folder)
        end = np.array([end_id], f"<u{width}").tobytes()
        lengths, doc_ids, nulls, out, stem = [], [], 0, None, ""
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                stem = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(f"{root}/{stem}.ids")
            nulls += batch.column(0).null_count
            doc_ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            for text in batch.column(1):
                ids = encoder.encode(text.as_py())
                out.write(ids.astype(f"<u{width}").tobytes() + end)
                lengths.append(len(ids) + 1)
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8")
        for kind, numbers in (("off", offsets), ("doc", np.concatenate(doc_ids))):
            with store.open_output_stream(f"{root}/{stem}.{kind}") as side:
                side.write(numbers.tobytes())
        row = {"shard": [TaskContext.get().partitionId()], "stem": [stem], "n_docs": [len(lengths)], "n_null": [nulls], "n_tokens": [int(offsets[-1])], "width": [width]}
        yield pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("stem", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]))

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = slim.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in file order: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (binary, little-endian 32 bits), read from memory-mapped files (ranged reads where the store is not a local folder)."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def numbers(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
        if isinstance(store, fs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        return np.frombuffer(store.open_input_file(path).read(), dtype)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for shard in (row for batch in batches for row in batch.to_pylist()):
            stem = f"{root}/{shard['stem']}"
            offsets, doc_ids = numbers(store, stem + ".off", "<i8"), numbers(store, stem + ".doc", "<i8")
            width = shard["width"]
            flat = np.memmap(stem + ".ids", f"<u{width}", "r") if isinstance(store, fs.LocalFileSystem) else store.open_input_file(stem + ".ids")
            for at in range(0, shard["n_docs"], _ROWS_OUT):
                to = min(at + _ROWS_OUT, shard["n_docs"])
                first, last = int(offsets[at]), int(offsets[to])
                part = flat[first:last] if isinstance(flat, np.ndarray) else np.frombuffer(flat.read_at((last - first) * width, first * width), f"<u{width}")
                wide = np.ascontiguousarray(part, "<u4").tobytes()
                starts = np.asarray(offsets[at : to + 1])
                cuts = ((starts - first) * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids[at:to], pa.int64(), mask=np.arange(at, to) < shard["n_null"]),
                        pa.array(starts[:-1] + shard["base"], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array([wide[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    spread = placed.select("shard", "stem", "n_docs", "n_null", "width", "base").repartitionByRange(n, "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")

"""Exact de-duplication through an extendible-hash index on shared files.

A key is the 64-bit hash of a text. The directory maps key prefixes to buckets: it starts with one bucket
and doubles whenever an overfull bucket needs a bit more than the directory has. A bucket is a key range,
and one owner task processes it: equal keys chain, and texts in a chain are told apart by their bytes. Map
tasks fold the copies they see before anything is shuffled, so a text that fills a third of the table
reaches its owner as one entry per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stage_table

BUCKET_ROWS = 500
MAX_DEPTH = 16


@dataclass(frozen=True)
class Directory:
    """``slots[p]`` is the bucket of the keys whose first ``depth`` bits are ``p``."""

    depth: int
    slots: np.ndarray

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        if self.depth == 0:
            return np.zeros(len(keys), np.int32)
        return self.slots[keys.astype(np.uint64) >> np.uint64(64 - self.depth)]


def grow(cells: np.ndarray, bucket_rows: int) -> Directory:
    """Split buckets until none is overfull. ``cells`` holds the rows per prefix of the longest depth.

    A bucket that is overfull at the longest depth stays so; its owner reads it as a chain.
    """
    longest = len(cells).bit_length() - 1
    sums = np.concatenate([[0], np.cumsum(cells)])
    depth, slots = 0, np.zeros(1, np.int32)
    first, local = [0], [0]  # prefix and local depth of each bucket
    todo = [0]
    while todo:
        b = todo.pop()
        width = 1 << (longest - local[b])
        if local[b] == longest or sums[(first[b] + 1) * width] - sums[first[b] * width] <= bucket_rows:
            continue
        if local[b] == depth:
            depth, slots = depth + 1, np.repeat(slots, 2)
        local[b] += 1
        first[b] *= 2
        first.append(first[b] + 1)
        local.append(local[b])
        new, span = len(first) - 1, 1 << (depth - local[b])
        slots[first[new] * span:(first[new] + 1) * span] = new
        todo += [b, new]
    return Directory(depth, slots)


def build_directory(keys: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> Directory:
    """The directory for a frame of ``key`` rows. At most ``2 ** max_depth`` counts reach the driver."""
    cell = F.shiftrightunsigned("key", 64 - max_depth) if max_depth else F.lit(0).cast("long")
    cells = np.zeros(1 << max_depth, np.int64)
    for row in keys.groupBy(cell.alias("cell")).count().toLocalIterator():
        cells[row["cell"]] = row["count"]
    return grow(cells, bucket_rows)


def _fold(directory: Directory):
    """Copies within a batch become one entry: largest id, copies, bucket."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(["key", "text"], use_threads=False).aggregate(
                [("doc_id", "max"), ("doc_id", "count"), ([], "count_all")])
            keys = t["key"].to_numpy()
            out = pa.table({"bucket": directory.bucket(keys).astype(np.int32), "key": t["key"], "text": t["text"],
                            "keep_id": t["doc_id_max"], "copies": t["count_all"]})
            yield from out.combine_chunks().to_batches()
    return fold


def build_index(docs: DataFrame, key: Column | None = None, bucket_rows: int = BUCKET_ROWS,
                max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per distinct text of ``docs(doc_id, text)``: bucket, key, text_sha256, keep_id, copies.

    The rows are Parquet files below ``spark.checkpoint.dir``; each bucket was written by its owner task.
    ``key`` replaces the hash of the text. Two texts with one SHA-256 would raise.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "key", F.xxhash64("text") if key is None else key)
    directory = build_directory(keyed.select("key"), bucket_rows, max_depth)
    folded = keyed.mapInArrow(_fold(directory), "bucket int, key long, text string, keep_id long, copies long")
    # Partitioned by bucket, both groupings below run inside the owner task without another exchange.
    chained = folded.repartition("bucket").groupBy("bucket", "key", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("copies").alias("copies"))
    entries = chained.groupBy("bucket", "key", F.sha2("text", 256).alias("text_sha256")).agg(
        F.max("keep_id").alias("keep_id"), F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("texts"))
    checked = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share one SHA-256"))).otherwise(
        F.col("copies"))
    return stage_table(entries.select("bucket", "key", "text_sha256", "keep_id", checked.alias("copies")), "exact")


def mark_duplicates(docs: DataFrame, index: DataFrame, key: Column | None = None) -> DataFrame:
    """``docs(doc_id, text)`` against the index: doc_id, keep_id, group_size, kept, text_sha256.

    One row per input row. Of equal texts the largest ``doc_id`` stays; a null id is smaller than any
    other. Of repeated rows (one id, one text) exactly one can stay. Null texts count as empty. Other
    columns are not read. An empty table gives no rows.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("doc_id", (F.xxhash64("text") if key is None else key).alias("key"),
                     F.sha2("text", 256).alias("text_sha256"))
    counted = own.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).cast("int").alias("rows"))
    found = counted.join(index.select("key", "text_sha256", "keep_id", "copies"), ["key", "text_sha256"])
    return found.select("doc_id", "keep_id", "copies", "text_sha256",
                        F.explode(F.sequence(F.lit(1), "rows")).alias("nth")).select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """Index ``docs`` and mark its duplicates; see ``build_index`` and ``mark_duplicates``."""
    return mark_duplicates(docs, build_index(docs, **options), options.get("key"))

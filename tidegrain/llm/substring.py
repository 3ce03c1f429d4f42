"""Removal of long passages repeated across documents: a count-min prefilter, then exact grouping of the windows it lets through.

Pass 1. A window of ``size`` words is filed under its least k-word hash, so a document files some 8 % as many keys as it has windows,
each once. Every partition counts its keys in a sketch of DEPTH rows; the sketches are added up. A cell holds at least the
number of documents with a window that falls on it, so the estimate (the least cell of a window) is never below the true count.
Pass 2. Only windows estimated to be in two or more documents are shuffled, grouped by a 128-bit hash of their words, and each is
removed from every document but that with the smallest id.

Documents with exactly the same text are reduced to the one with the smallest id before both passes, as all windows of the others are
covered. The merged sketch is one bit a cell, DEPTH * 2**width_bits / 8 bytes in all (16 MB by default), whatever the corpus;
a corpus too large for its width lets more windows through to the exact pass and loses none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import WordHashes, map_slices, mix, slices, small, texts_of, written

DEPTH, WIDTH_BITS, CHUNK_BITS = 2, 26, 20
#: Odd multipliers of the sketch rows and of the two window hashes.
ROWS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Words of the hashes whose least one files a window.
GRAM = 25

HASHES = WordHashes()
ONE = np.ones(1, np.uint64)


def rolling(x: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every run of ``size`` values, by prefix sums modulo 2^64."""
    n = len(x)
    powers = np.cumprod(np.concatenate([ONE, np.full(n, base, np.uint64)]))
    inverse = np.cumprod(np.concatenate([ONE, np.full(n, pow(base, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([ONE - ONE, np.cumsum(x * powers[:n])])
    return mix((sums[size:] - sums[:-size]) * inverse[: n - size + 1])


def window_keys(x: np.ndarray, size: int) -> np.ndarray:
    """The sketch key of every window: the least hash of its runs of GRAM words."""
    least = rolling(x, min(GRAM, size), BASES[0])
    span, have = size - min(GRAM, size) + 1, 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return least if have == span else np.minimum(least[: len(least) - (span - have)], least[span - have :])


def cells(keys: np.ndarray, width_bits: int) -> np.ndarray:
    """Cells of the keys, one row per sketch row."""
    return (keys * ROWS[:DEPTH, None]) >> np.uint64(64 - width_bits)


def sketch(docs: DataFrame, size: int, width_bits: int) -> np.ndarray:
    """Merged sketch of all partitions as bits: set where the count is two or more."""
    chunk = 1 << min(CHUNK_BITS, width_bits)
    per_row = (1 << width_bits) // chunk

    def flush(keys: list[np.ndarray]):
        at = cells(np.concatenate(keys), width_bits) + (np.arange(DEPTH, dtype=np.uint64) << np.uint64(width_bits))[:, None]
        at, counts = np.unique(at.ravel(), return_counts=True)
        number = at // np.uint64(chunk)
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        blobs = [
            ((at[a:b] % np.uint64(chunk)).astype(np.uint32).tobytes(), np.minimum(counts[a:b], 255).astype(np.uint8).tobytes())
            for a, b in zip(starts, np.append(starts[1:], len(at)))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(number[starts].astype(np.int64)), pa.array([c for c, _ in blobs], pa.binary()), pa.array([n for _, n in blobs], pa.binary())], ["chunk", "cell", "n"])

    def count(batches):
        held, n = [], 0
        for part in slices(batches, "text"):
            for text in texts_of(part.column("text")):
                words = text.split()
                if len(words) >= size:
                    held.append(np.unique(window_keys(HASHES.of(words), size)))
                    n += len(held[-1])
            if n > 1_000_000:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    def merge(batches):
        number, total = None, np.zeros(chunk, np.uint8)

        def full():
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], ["chunk", "bits"])

        for batch in batches:
            for c, cell, n in zip(*(batch.column(k).to_pylist() for k in ("chunk", "cell", "n"))):
                if c != number:
                    if number is not None:
                        yield full()
                    number, total = c, np.zeros(chunk, np.uint8)
                at, add = np.frombuffer(cell, np.uint32), np.frombuffer(n, np.uint8)
                total[at] = np.minimum(total[at].astype(np.uint16) + add, 255)
        if number is not None:
            yield full()

    parts = docs.select("text").mapInArrow(count, "chunk long, cell binary, n binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk long, bits binary")
    bits = np.zeros((DEPTH * per_row, chunk // 8), np.uint8)
    for row in merged.toLocalIterator():
        bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(DEPTH, -1)


def estimated_repeated(keys: np.ndarray, bits: np.ndarray, width_bits: int) -> np.ndarray:
    """Windows whose estimate is two or more."""
    at = cells(keys, width_bits)
    hit = np.ones(len(keys), bool)
    for d in range(DEPTH):
        hit &= (bits[d, at[d] >> np.uint64(3)] >> (7 - (at[d] & np.uint64(7))).astype(np.uint8) & 1).astype(bool)
    return hit


def repeated_windows(docs: DataFrame, size: int, width_bits: int) -> DataFrame:
    """(doc_id, text_key, pos): windows whose words also start in a document with a smaller doc_id."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch(docs, size, width_bits))

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys, out = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), []
        for doc_id, key, text in zip(ids, keys, texts_of(batch.column("text"))):
            words = text.split()
            if len(words) < size:
                continue
            x = HASHES.of(words)
            pos = np.flatnonzero(estimated_repeated(window_keys(x, size), shared.value, width_bits))
            if len(pos):
                out.append((np.full(len(pos), doc_id), np.full(len(pos), key), pos, *(rolling(x, size, b)[pos].view(np.int64) for b in BASES)))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["doc_id", "text_key", "pos", "h1", "h2"])

    found = map_slices(docs.where("doc_id IS NOT NULL"), build, "doc_id long, text_key long, pos long, h1 long, h2 long")
    found = written(found, "windows")
    first = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = written(first.where("first_id < last_id").drop("last_id"), "first-windows")  # read back, so that the join can be split where a window is hot
    return found.join(first, ["h1", "h2"]).where("first_id < doc_id").select("doc_id", "text_key", "pos")


def remove_repeated(docs: DataFrame, size: int = 50, width_bits: int = WIDTH_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every word inside a window of ``size`` words that a smaller doc_id also has goes.

    Words are split at ASCII white space and compared as they are. ``kept`` holds the words left, joined by one space. Windows are
    judged on the input. Null, empty and short texts keep all their words. A null doc_id is no smaller than any and has none
    smaller: such rows keep all. Rows with equal ids do not remove from each other, so repeated rows come out alike. Other columns are
    not read.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha"))
    copies = docs.where("doc_id IS NOT NULL").groupBy("text_sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    copies = small(written(copies.where("least < most").select(F.col("text_sha").alias("copy_sha"), "least"), "copies"))
    marked = docs.join(copies, F.col("text_sha") == F.col("copy_sha"), "left").withColumn("is_copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    marked = marked.select("doc_id", "text", "text_key", "is_copy")
    gone = repeated_windows(marked.where("NOT is_copy").drop("is_copy"), size, width_bits)
    gone = gone.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("starts"))
    rows = marked.join(gone.withColumnsRenamed({"doc_id": "in_id", "text_key": "in_key"}), (F.col("doc_id") == F.col("in_id")) & (F.col("text_key") == F.col("in_key")), "left")

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, removed, kept = [], [], []
        for text, copy, starts in zip(texts_of(batch.column("text")), batch.column("is_copy").to_pylist(), batch.column("starts")):
            words = text.split()
            keep = np.ones(len(words), bool)
            if copy and len(words) >= size:
                keep[:] = False
            elif starts.is_valid:
                pos = starts.values.to_numpy()
                edge = np.zeros(len(words) + 1, np.int64)
                edge[pos] += 1
                np.subtract.at(edge, pos + size, 1)
                keep = np.cumsum(edge[:-1]) == 0
            total.append(len(words))
            removed.append(len(words) - int(keep.sum()))
            kept.append(b" ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep)]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"])

    return map_slices(rows.select("doc_id", "text", "is_copy", "starts"), build, "doc_id long, n_words long, n_removed long, kept string")


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

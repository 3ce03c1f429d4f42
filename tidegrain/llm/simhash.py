"""Near-duplicate documents by 64-bit SimHash, found through the anchors of a covering code.

The code is the direct sum of two binary Golay codes (23 bits, covering radius 3), a Hamming code (15 bits, radius 1) and three
free bits: 64 bits, 2^38 anchors, covering radius R = 7. Every 64-bit word has one nearest anchor in each block. Two fingerprints
within the threshold t have a word halfway, at most ceil(t / 2) from each, and the anchor that covers this word lies within
R + ceil(t / 2) of both. So a fingerprint is copied to the anchors that cover a word at most ceil(t / 2) away from it, some 19
for t = 2 (all of them inside R + t), and two linked fingerprints always meet at an anchor, where their full distance is taken.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrain.llm.common import free_name, map_slices, small, texts_of, written
from tidegrain.llm.components import connected_components

#: Fixed values: (bits, generator polynomial, errors corrected) of the Golay and the Hamming code.
GOLAY, HAMMING = (23, 0b110001110101, 3), (15, 0b10011, 1)
#: The blocks of the fingerprint from bit 0 up; the remaining three bits are free.
BLOCKS = (GOLAY, GOLAY, HAMMING)
#: Fingerprints of one anchor that are compared in one piece; more are split into pairs of pieces.
PIECE = 4096


def fingerprint(words: list[bytes], shingle: int) -> int:
    """SimHash of the XXH64 (seed 42) of the word shingles: a bit is set if it is set in over half of them; no words give 0."""
    if not words:
        return 0
    ends = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
    joined = b" ".join(words)
    spans = zip(ends, ends[shingle:]) if len(words) > shingle else [(0, len(joined) + 1)]
    hashes = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], 42) for a, b in spans], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, name: str = "fp", shingle: int = 3) -> DataFrame:
    """The columns of ``docs`` and, as ``name``, the fingerprint of every whole text as a signed long."""
    at = docs.columns.index("text")

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t.lower().split(), shingle) for t in texts_of(batch.column(at))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(values, np.uint64).view(np.int64))], [*batch.schema.names, name])

    return map_slices(docs, build, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


@cache
def _tables(code: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the 256 values of each byte of a block, and the error pattern of each syndrome."""
    bits, generator, radius = code
    degree = generator.bit_length() - 1

    def remainder(x: int) -> int:
        for i in range(bits - 1, degree - 1, -1):
            if x >> i & 1:
                x ^= generator << (i - degree)
        return x

    single = [remainder(1 << i) for i in range(bits)]
    by_byte = np.zeros(((bits + 7) // 8, 256), np.uint64)
    for i, s in enumerate(single):
        values = np.arange(256)
        by_byte[i // 8, (values >> (i % 8) & 1) == 1] ^= np.uint64(s)
    errors = np.zeros(1 << degree, np.uint64)
    for n in range(1, radius + 1):
        for flips in combinations(range(bits), n):
            s = 0
            for i in flips:
                s ^= single[i]
            errors[s] = sum(1 << i for i in flips)
    return by_byte, errors


def covering(x: np.ndarray) -> np.ndarray:
    """The anchor that covers each 64-bit word: the nearest code word of every block, the free bits as they are."""
    out, at = x.copy(), 0
    for code in BLOCKS:
        by_byte, errors = _tables(code)
        block = (x >> np.uint64(at)) & np.uint64((1 << code[0]) - 1)
        syndrome = np.zeros_like(block)
        for k, row in enumerate(by_byte):
            syndrome ^= row[(block >> np.uint64(8 * k)) & np.uint64(255)]
        out ^= errors[syndrome] << np.uint64(at)
        at += code[0]
    return out


def anchors(fps: DataFrame, threshold: int) -> DataFrame:
    """(anchor, fp): every anchor that covers a word at most ceil(threshold / 2) away from the fingerprint."""
    flips = np.array([sum(1 << i for i in c) for n in range((threshold + 1) // 2 + 1) for c in combinations(range(64), n)], np.uint64)

    def run(batches):
        for batch in batches:
            fp = np.asarray(batch.column("fp")).view(np.uint64)
            step = max(1, 500_000 // len(flips))
            for i in range(0, len(fp), step):
                x = fp[i : i + step]
                near = np.sort(covering((x[:, None] ^ flips).ravel()).reshape(len(x), -1), axis=1)
                first = np.ones(near.shape, bool)
                first[:, 1:] = near[:, 1:] != near[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(near[first].view(np.int64)), pa.array(np.repeat(x, first.sum(axis=1)).view(np.int64))], ["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


def forest(x: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that join the values of ``x`` within ``threshold`` bits: a spanning forest, not all pairs."""
    links, left = [], x
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            node = todo.pop()
            near = np.bitwise_count(left ^ node) <= threshold
            if near.any():
                found = left[near]
                links += [(int(node), int(v)) for v in found]
                todo += list(found)
                left = left[~near]
    return links


def _compare(rows: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Links inside each group of ``keys``; groups are read one after another from sorted partitions and hold two pieces at most."""

    def links(group: np.ndarray) -> list[tuple[int, int]]:
        if len(group) == 2:
            return [(int(group[0]), int(group[1]))] if (int(group[0]) ^ int(group[1])).bit_count() <= threshold else []
        return forest(group, threshold)

    def run(batches):
        held_key, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([np.asarray(batch.column(k)) for k in keys])
            fp = np.asarray(batch.column("fp")).view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)]))
            ends = np.append(starts[1:], len(fp))
            out: list[tuple[int, int]] = []
            if held_key is not None:
                if (ids[:, 0] == held_key).all():
                    held = np.concatenate([held, fp[: ends[0]]])
                    starts, ends = starts[1:], ends[1:]
                if len(starts):
                    out += links(held) if len(held) > 1 else []
                    held_key = None
            if len(starts):
                done = np.flatnonzero((ends - starts)[:-1] > 1)
                for i in done:
                    out += links(fp[starts[i] : ends[i]])
                held_key, held = ids[:, starts[-1]], fp[starts[-1] :]
            if out:
                pairs = np.array(out, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])
        if len(held) > 1 and (out := links(held)):
            pairs = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long")


def links(fps: DataFrame, threshold: int = 2, piece: int = PIECE) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that join all within ``threshold`` differing bits.

    An anchor with more than ``piece`` fingerprints is hot: its fingerprints are dealt to pieces and every two pieces are compared
    in a task of their own, so no task holds more than two pieces and none is left out.
    """
    near = written(anchors(fps, threshold), "anchors")
    sizes = near.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > piece)
    hot = written(sizes.select("anchor", F.ceil(F.col("n") / piece).cast("long").alias("pieces")), "hot-anchors")
    marked = near.join(small(hot), "anchor", "left")
    plain = _compare(marked.where("pieces IS NULL").select("anchor", "fp"), ["anchor"], threshold)
    if hot.isEmpty():
        return plain.distinct()
    own = marked.where("pieces IS NOT NULL").withColumn("own", F.pmod(F.xxhash64("fp"), "pieces"))
    dealt = own.select("anchor", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other"))
    dealt = dealt.select("anchor", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    return plain.unionByName(_compare(dealt, ["anchor", "a", "b"], threshold)).distinct()


def grouped(docs: DataFrame, threshold: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of all documents, and (fp, root, component_id) of the distinct fingerprints; root is the group's least fingerprint."""
    rows = written(with_fingerprints(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"), "fingerprints")
    return labelled(rows, lambda classes: links(classes, threshold))


def labelled(rows: DataFrame, find_links: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (doc_id, fp), and (fp, root, component_id) of the distinct fp, joined by the links (u, v) that ``find_links`` makes of them."""
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = written(connected_components(find_links(classes)), "roots")
    linked = roots.join(classes, roots["node"] == classes["fp"]).select("fp", "root", "least")
    linked = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("fp").alias("linked_fp"), "root", "component_id")
    classes = classes.join(linked, F.col("fp") == F.col("linked_fp"), "left")
    alone = F.col("linked_fp").isNull()
    classes = classes.select("fp", F.coalesce("root", "fp").alias("root"), F.when(alone, F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return rows, written(classes, "components")  # read back, so that a join with all rows can be split where a fingerprint is hot


def near_duplicates(docs: DataFrame, threshold: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document.

    A-Z is lower-cased, words are split at ASCII white space, shingles count with repeats; a text of fewer words than a shingle is
    one shingle. Null, empty and blank texts have fingerprint zero, which links like any other. component_id is the smallest
    doc_id reachable through links of at most ``threshold`` bits; null ids count as documents but never as the smallest, so
    component_id is null only if the component has no id. Repeated rows give repeated results. Other columns are not read.
    """
    rows, classes = grouped(docs, threshold, shingle)
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, threshold: int = 2, shingle: int = 3) -> DataFrame:
    """The documents with one left of each group, that with the smallest doc_id; of rows that share it, the first by fingerprint and text."""
    return kept(docs, *grouped(docs, threshold, shingle), lambda df, name: with_fingerprints(df, name, shingle))


def kept(docs: DataFrame, rows: DataFrame, classes: DataFrame, mark: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One document of each group that ``labelled`` made; ``mark`` adds their fp to documents under the given name."""
    fp, root = free_name("keep_fp", docs.columns), free_name("keep_root", docs.columns)
    found = written(rows.join(classes, "fp").select("doc_id", "fp", "root", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays")), "groups")
    marked = mark(docs, fp)

    def same(other: DataFrame):
        return marked["doc_id"].eqNullSafe(other["other_id"]) & (marked[fp] == other["other_fp"])

    ids = [F.col("doc_id").alias("other_id"), F.col("fp").alias("other_fp")]
    gone = written(found.where("NOT stays").select(*ids).distinct(), "dropped")
    stay = marked.join(small(gone), same(gone), "left_anti")
    tied = written(found.where("stays").groupBy("root").agg(F.count("*").alias("n")).where("n > 1"), "tied-groups")
    if tied.isEmpty():
        return stay.select(*docs.columns)
    rivals = written(found.where("stays").join(tied, "root").select(*ids, F.col("root").alias(root)).distinct(), "tied-rows")
    order = Window.partitionBy(root).orderBy(fp, "text")
    number = free_name("keep_no", docs.columns)
    first = marked.join(small(rivals), same(rivals)).withColumn(number, F.row_number().over(order)).where(F.col(number) == 1)
    return stay.join(small(rivals), same(rivals), "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))

"""Deleted interpolation: bigram, unigram and uniform estimates mixed by how often the context was seen, weights learned by EM.

The corpus is read in blocks of rows. Each block asks for the n-grams it holds, once each, as sorted 64-bit hashes together with its own
counts; the requests are grouped by hash range, added up, and every block gets the corpus counts of its n-grams back. So
what is shuffled is a few bytes per distinct n-gram of a block, and documents never move. An n-gram that occurs once, in
a training document, needs no answer, and neither does one that never occurs there: whoever meets it knows.

For the weights, a part of the training documents (the tuning part) is deleted from the counts; their tokens are then scored with
what is left, and expectation-maximisation finds, per bucket of the context's count, the weights under which they are most likely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.llm.common import mix, new_folder, slices, storage, written

#: Rows of a file that form a block, and tokens after which a block sends a part of its request.
BLOCK_ROWS, REQUEST_TOKENS = 4096, 2_000_000
#: Context counts are bucketed by powers of two; estimates of the tuning tokens are summed up in cells of 1/8 octave.
BUCKETS, STEPS, OCTAVES, EM_ROUNDS = 25, 8, 48, 30
#: Hashes of the end token and of the start of a text, strings that no word can be.
END, START = (np.array([xxhash.xxh64_intdigest(b)], np.uint64) for b in (b" ", b"  "))
#: A-Z lower-cased and white space, by byte; masks for the first bytes of eight; words over LONG bytes are hashed singly.
FOLD, BLANK = (np.frombuffer(x, t) for x, t in ((bytes(range(256)).lower(), np.uint8), (bytes(not bytes([b]).strip() for b in range(256)), bool)))
HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG, GOLDEN = 64, np.uint64(0x9E3779B97F4A7C15)
REQUEST = "n int, bucket int, block long, keys binary, total binary, tuning binary, held binary"
ANSWER = "n int, bucket int, keys binary, total binary, tuning binary, types long, tokens long, tuning_tokens long, block long"


CODEC = pa.Codec("zstd", 1)


def pack(values: np.ndarray) -> bytes:
    """64-bit values as compressed planes of their bytes: the high planes of small values are zeros and take no space."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + CODEC.compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(CODEC.decompress(data[8:], 8 * n, asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order. np.unique, asked for nothing else, takes a hash table, which is many times slower here than the sort."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(len(values[:1]), bool), values[1:] != values[:-1]])]


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, for all ranges at once: eight bytes a round, with the length as the seed."""
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    size = stop - start
    out = size.astype(np.uint64) * GOLDEN
    todo = np.flatnonzero(size <= LONG)
    for at in range(0, LONG, 8):
        todo = todo[size[todo] > at]
        out[todo] = mix((out[todo] + np.uint64(at)) ^ (eights[start[todo] + at] & HEAD[np.minimum(size[todo] - at, 8)]))
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : stop[i]])
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens (of each text the start mark, the lower-cased words, the end token), and where the texts start and end in them."""
    binary = pc.fill_null(column.cast(pa.large_binary()), b"")
    cut = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = FOLD[np.frombuffer(binary.buffers()[2] or b"", np.uint8)[cut[0] : cut[-1]]]
    cut = cut - cut[0]
    word, inside = ~BLANK[data], np.ones(len(data) + 1, bool)
    inside[cut] = False  # no word goes on from one text to the next
    joined = word[1:] & word[:-1] & inside[1:-1]
    start = np.flatnonzero(word & ~np.concatenate([[False], joined])[: len(data)])
    stop = np.flatnonzero(word & ~np.concatenate([joined, [False]])[: len(data)]) + 1
    words = np.diff(np.searchsorted(start, cut))
    first = np.concatenate([[0], np.cumsum(words + 2)])
    x = np.empty(first[-1], np.uint64)
    x[first[:-1]], x[first[1:] - 1] = START, END
    x[np.arange(len(start)) + np.repeat(2 * np.arange(len(words)) + 1, words)] = word_hashes(data, start, stop)
    return x, first


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the unigram and of the bigram that end at each token of the texts, start marks left out, and where the texts start and end in them."""
    x, first = tokens(column)
    kept = np.ones(len(x), bool)
    kept[first[:-1]] = False
    bigrams = np.concatenate([x[:1], mix(x[:-1] * GOLDEN + mix(x[1:] + np.uint64(1)))])
    return mix(x[kept]), bigrams[kept], first - np.arange(len(first))


class Places:
    """Finds values in a sorted array of distinct evenly spread 64-bit values: a table over the top bits says where to start."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(2**64 - 1))  # a value above all others ends the search
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits))])

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each wanted value and whether it is there; the position of an absent one is any."""
        at = self.starts[(wanted >> self.shift).astype(np.int64)]
        found = self.keys[at]
        todo = np.flatnonzero(found < wanted)
        while len(todo):
            at[todo] += 1
            found[todo] = self.keys[at[todo]]
            todo = todo[found[todo] < wanted[todo]]
        hit = (found == wanted) & (at < len(self.keys) - 1)
        return np.where(hit, at, 0), hit


def blocks(spark: SparkSession, folder: str, training: Column, tuning: Column) -> DataFrame:
    """(doc_id, text, role, block): role 0 is not trained on, 1 is training, 2 is the tuning part of training."""
    role = F.when(training, F.when(tuning, 2).otherwise(1)).otherwise(0)
    block = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS))
    return spark.read.parquet(folder).select("doc_id", "text", role.alias("role"), block.alias("block"))


def by_block(batches, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices whose rows all belong to one block."""
    for part in slices(batches, "text", most_bytes):
        block = part.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for a, b in zip(edges, edges[1:]):
            yield part.slice(a, b - a)


def requests(docs: DataFrame, bits: int) -> DataFrame:
    """What every block asks for: its distinct n-grams by hash range, with its own counts."""

    def packed(block: int, n: int, roles: np.ndarray, hashes: np.ndarray):
        own = [np.unique(hashes[roles == role], return_counts=True) for role in range(3)]
        keys = distinct(np.concatenate([k for k, _ in own]))
        total, tuning, held = (np.zeros(len(keys), np.uint64) for _ in range(3))
        for out, role in ((held, 0), (total, 1), (total, 2), (tuning, 2)):
            out[np.searchsorted(keys, own[role][0])] += own[role][1].astype(np.uint64)
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rows = []
        for a, b in zip(starts, np.append(starts[1:], len(keys))):
            rows.append((n, int(bucket[a]), block, pack(np.diff(keys[a:b], prepend=np.zeros(1, np.uint64))), pack(total[a:b]), pack(tuning[a:b]), np.packbits(held[a:b] > 0).tobytes()))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["n", "bucket", "block", "keys", "total", "tuning", "held"])

    def run(batches):
        held, size, current = [], 0, None

        def sent():
            roles, *hashes = (np.concatenate(c) for c in zip(*held))
            yield from (packed(current, n, roles, hashes[n - 1]) for n in (1, 2))

        for part in by_block(batches):
            block = part.column("block")[0].as_py()
            if held and (block != current or size > REQUEST_TOKENS):
                yield from sent()
                held, size = [], 0
            current = block
            one, two, first = ngrams(part.column("text"))
            held.append((np.repeat(part.column("role").to_numpy().astype(np.int8), np.diff(first)), one, two))
            size += len(one)
        if held:
            yield from sent()

    return docs.select("text", "role", "block").mapInArrow(run, REQUEST)


def answers(asked: DataFrame) -> DataFrame:
    """Corpus counts for every block and the totals; left out are n-grams with the count zero, or one that no text outside training asks for."""

    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [np.cumsum(unpack(r["keys"]), dtype=np.uint64) for r in rows]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        total, tuning = np.zeros(len(found), np.uint64), np.zeros(len(found), np.uint64)
        edges = np.cumsum([0, *(len(k) for k in keys)])
        for r, a, b in zip(rows, edges, edges[1:]):  # keys are distinct within a row
            total[at[a:b]] += unpack(r["total"])
            tuning[at[a:b]] += unpack(r["tuning"])
        out = [{
            "n": rows[0]["n"], "bucket": rows[0]["bucket"], "keys": b"", "total": b"", "tuning": b"", "types": int((total > 0).sum()), "tokens": int(total.sum()),
            "tuning_tokens": int(tuning.sum()), "block": None}]
        for r, k, a, b in zip(rows, keys, edges, edges[1:]):
            asked_outside = np.unpackbits(np.frombuffer(r["held"], np.uint8), count=b - a).astype(bool)
            wanted = (total[at[a:b]] > 1) | (total[at[a:b]] == 1) & asked_outside
            where = at[a:b][wanted]
            out.append({
                "n": r["n"], "bucket": r["bucket"], "keys": pack(np.diff(k[wanted], prepend=np.zeros(1, np.uint64))), "total": pack(total[where]), "tuning": pack(tuning[where]),
                "types": 0, "tokens": 0, "tuning_tokens": 0, "block": r["block"]})
        schema = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("total", pa.binary()), ("tuning", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64()), ("tuning_tokens", pa.int64()), ("block", pa.int64())])
        return pa.Table.from_pylist(out, schema)

    return asked.groupBy("n", "bucket").applyInArrow(merge, ANSWER)


class Counts:
    """The answers to one block, read from the shared storage."""

    def __init__(self, folder: str, block: int):
        fs, base = storage(f"{folder.rstrip('/')}/block={block}")
        files = [f for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if f.base_name.endswith(".parquet")]
        rows = [r for f in files for r in pq.ParquetFile(fs.open_input_file(f.path)).read(columns=["n", "bucket", "keys", "total", "tuning"]).to_pylist()]
        rows.sort(key=lambda r: r["bucket"])  # so the keys are nearly in order
        self.by_n = {}
        for n in (1, 2):
            mine = [r for r in rows if r["n"] == n]
            none = [np.zeros(0, np.uint64)]
            keys = np.concatenate(none + [np.cumsum(unpack(r["keys"]), dtype=np.uint64) for r in mine])
            counts = [np.concatenate(none + [unpack(r[c]) for r in mine]).astype(float) for c in ("total", "tuning")]
            if not (keys[1:] > keys[:-1]).all():  # a block that asked in parts
                keys, first = np.unique(keys, return_index=True)
                counts = [c[first] for c in counts]
            self.by_n[n] = (Places(keys), *(np.append(c, 0.0) for c in counts))

    def of(self, n: int, wanted: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Total and tuning counts. Without an answer the n-gram occurs once, in the training document at hand, or never if it is no training document."""
        places, total, deleted = self.by_n[n]
        at, hit = places.of(wanted)
        return np.where(hit, total[at], roles > 0), np.where(hit, deleted[at], roles == 2)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one bucket per power of two."""
    return np.where(context > 0, np.minimum(np.frexp(np.maximum(context, 1))[1], BUCKETS - 1), 0)


def estimates(column: pa.Array, counts: Counts, roles: np.ndarray, texts: tuple[float, float], size: tuple[float, float], deleted: bool):
    """(unigram counts, unigram and bigram estimates, context counts) of all texts' tokens, with or without the tuning part, and where the texts start and end in them.

    roles: one per text; texts: training and tuning documents, the counts of the start context; size: training and tuning tokens.
    """
    one, two, first = ngrams(column)
    roles = np.repeat(roles, np.diff(first))
    c1, d1 = counts.of(1, one, roles)
    c2, d2 = counts.of(2, two, roles)
    n, opening = size[0], texts[0]
    if deleted:
        c1, c2, n, opening = c1 - d1, c2 - d2, size[0] - size[1], texts[0] - texts[1]
    context = np.concatenate([c1[:1], c1[:-1]])
    context[first[:-1]] = opening
    return c1, c1 / max(n, 1), np.where(context > 0, c2 / np.maximum(context, 1), 0), context, first


def tuning_cells(docs: DataFrame, folder: str, texts: tuple[float, float], size: tuple[float, float]) -> DataFrame:
    """(cell, n): tuning tokens by context bucket, unigram and bigram estimate."""

    def quantised(f):
        return np.where(f > 0, np.clip(np.round(-np.log2(np.maximum(f, 1e-30)) * STEPS) + 1, 1, OCTAVES * STEPS), 0).astype(np.int64)

    def run(batches):
        loaded, counts = None, None
        for part in by_block(batches):
            block = part.column("block")[0].as_py()
            if block != loaded:
                loaded, counts = block, Counts(folder, block)
            _, f1, f2, context, _ = estimates(part.column("text"), counts, np.full(part.num_rows, 2), texts, size, True)
            cells = (bucket_of(context) * (OCTAVES * STEPS + 1) + quantised(f1)) * (OCTAVES * STEPS + 1) + quantised(f2)
            found, n = np.unique(cells, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["cell", "n"])

    return docs.where("role = 2").select("text", "block").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cell: np.ndarray, n: np.ndarray, uniform: float, trained: bool) -> np.ndarray:
    """Weights (bucket, [uniform, unigram, bigram]) by EM over the tuning cells; a bucket without tokens takes the pooled weights.

    The cells are a bounded grid, so the rounds need no pass over documents. Each weight set starts from one pseudo-token.
    """
    base = OCTAVES * STEPS + 1
    q2, rest = cell % base, cell // base
    bucket = rest // base
    value = lambda q: np.where(q > 0, 2.0 ** (-(q - 1) / STEPS), 0.0)
    f = np.stack([np.full(len(cell), uniform), value(rest % base), value(q2)], axis=1)
    open_ = np.array([1.0, float(trained), float(trained)])

    def em(group: np.ndarray, groups: int, prior: np.ndarray) -> np.ndarray:
        w = np.tile(prior / prior.sum(axis=-1, keepdims=True), (groups, 1)) if prior.ndim == 1 else prior.copy()
        start = w.copy()
        for _ in range(EM_ROUNDS):
            joint = w[group] * f
            joint *= (n / np.maximum(joint.sum(axis=1), 1e-300))[:, None]
            sums = np.stack([np.bincount(group, joint[:, k], groups) for k in range(3)], axis=1) + start
            w = sums / sums.sum(axis=1, keepdims=True)
        return w

    pooled = em(np.zeros(len(cell), np.int64), 1, open_)
    weights = em(bucket.astype(np.int64), BUCKETS, np.tile(pooled, (BUCKETS, 1)))
    weights[0, 2] = 0  # a context never seen has no bigram estimate
    return weights / weights.sum(axis=1, keepdims=True)


def score(spark: SparkSession, folder: str, training: Column, tuning: Column, bucket_bits: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per document of the Parquet ``folder``.

    Learned from the rows where ``training`` holds; ``tuning`` marks those of them whose counts are deleted to learn the weights. Texts
    are lower-cased in A-Z, split at ASCII white space and closed by an end token; null counts as empty. base_score is the add-one
    unigram log10 probability, score the model's; both sum over the tokens. n_known counts tokens seen in training. Without training
    documents every token has the uniform probability 1 / 1. Without tuning documents the weights are equal. Other columns are not
    read; repeated rows are documents of their own. ``bucket_bits`` is the logarithm of the number of hash ranges, by default four
    for every shuffle partition.
    """
    bits = bucket_bits or max(2, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    docs = blocks(spark, folder, training, tuning)
    place = new_folder(spark, "ngram-counts")
    answers(requests(docs, bits)).repartition("block").write.partitionBy("block").option("compression", "none").parquet(place)  # the blobs are compressed
    totals = spark.read.schema(ANSWER).parquet(place).where("block IS NULL AND n = 1")
    row = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", "tuning_tokens"))).first()
    parts = spark.read.parquet(folder).select(training.alias("a"), tuning.alias("b")).where("a").agg(F.count("*").alias("n"), F.count_if("b").alias("d")).first()
    types, texts, size = row["types"], (float(parts["n"]), float(parts["d"])), (float(row["tokens"]), float(row["tuning_tokens"]))
    cells = written(tuning_cells(docs, place, texts, size), "tuning-cells").toPandas()
    uniform = 1 / (types + 1)
    weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(float), uniform, types > 0)

    def run(batches):
        loaded, counts = None, None
        for part in by_block(batches, 1 << 20):
            block = part.column("block")[0].as_py()
            if block != loaded:
                loaded, counts = block, Counts(place, block)
            c1, f1, f2, context, first = estimates(part.column("text"), counts, part.column("role").to_numpy(), texts, size, False)
            w = weights[bucket_of(context)]
            p = w[:, 0] * uniform + w[:, 1] * f1 + w[:, 2] * f2
            n = np.diff(first)
            known, base, model = (np.add.reduceat(v, first[:-1]) for v in ((c1 > 0).astype(np.int64), np.log10((c1 + 1) / (size[0] + types + 1)), np.log10(p)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), int(size[0])), pa.int64()), pa.array(base, pa.float64()), pa.array(model, pa.float64())],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")

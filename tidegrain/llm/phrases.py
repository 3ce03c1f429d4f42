"""Collocations: phrases counted in HAT-tries that spill sorted runs, and scored by their weakest cut.

Words that occur often enough to be part of a phrase get numbers; all others end a window. First all pairs of neighbouring words are
counted. Then every position gives one window of up to ``longest`` words, which ends before a pair that is too rare to be part of a
phrase; the frequent pairs are known by a filter of bits that never misses one. A task counts its pairs and its windows in a HAT-trie: a
shallow trie over word numbers whose leaves are hash containers of the rest of the window. A container that grows too large bursts into
one per next word; a trie that grows too large spills its largest subtrees as sorted runs. Runs of windows are ranged over partitions by
prefix and merged there; in the merged order all windows that begin with a phrase are neighbours, so the counts of all prefixes come out
of one scan. A phrase that lies on the border of two pieces of the scan is summed up afterwards with its other part. Counts are exact:
words are compared as words, never as hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import UPPER, mix, slices, small, texts_of, written
from tidegrain.operators.ranking import global_row_number

#: A-Z lower-cased, the marks that end a piece as line feeds, the tab as a space.
FOLD = bytes.maketrans(UPPER.encode() + b".,;:!?\x0b\x0c\x0d\t", UPPER.lower().encode() + b"\n" * 9 + b" ")
#: Words that are broadcast with their numbers, the most frequent first; the rest is looked up by a join.
MOST_WORDS = 500_000
#: Entries of a container before it bursts, and of a task's trie before it spills; distinct words a task counts before it hands them on.
BURST, ENTRIES, COUNTED = 4096, 600_000, 300_000
#: Bits of the filter for a frequent pair, and in all (32 MB); more pairs let more windows pass that are counted in vain.
PAIR_BITS, MOST_BITS = 16, 28
#: Rows with arrays of word numbers that may be broadcast.
BROADCAST_PHRASES = 200_000
#: Bytes of text handled together; a longer text is cut between words.
SLICE = 2 << 20
KEYS = ["k1", "k2", "k3"]


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """The folded texts of each language, a line feed between two."""
    langs, texts = batch.column("lang").to_pylist(), texts_of(batch.column("text"))
    for lang in dict.fromkeys(langs):
        yield lang, b"\n".join(t for t, x in zip(texts, langs) if x == lang).translate(FOLD)


def segments(data: bytes, most: int = SLICE) -> Iterator[bytes]:
    """``data`` cut between words into parts of some ``most`` bytes."""
    start = 0
    while start < len(data):
        stop = start + most
        if stop < len(data):
            ends = [i for i in (data.find(b" ", stop), data.find(b"\n", stop)) if i >= 0]
            stop = min(ends, default=len(data))
        yield data[start:stop]
        start = stop


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all documents; the row without a word holds all words of the language."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush():
            for lang, found in counts.items():
                names = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), names, pa.array(found.values(), pa.int64())], ["lang", "word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([found.total()])], ["lang", "word", "n"])
            counts.clear()

        for batch in slices(batches, "text", SLICE):
            for lang, data in by_language(batch):
                for part in segments(data):
                    counts.setdefault(lang, Counter()).update(part.split())
                    if sum(map(len, counts.values())) > COUNTED:
                        yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class HatTrie:
    """Counts of windows of word numbers (rows of ``longest`` columns, filled up with 0).

    ``root`` maps a first word to a container, or after a burst to containers by second word. Keys of containers are the rest of the
    window as big-endian bytes, so that their order is the order of the windows.
    """

    def __init__(self, longest: int, burst: int = BURST, entries: int = ENTRIES):
        self.longest, self.burst, self.entries = longest, burst, entries
        self.root: dict[int, Counter | dict[int, Counter]] = {}
        self.size = 0

    def _texts(self, rows: np.ndarray, skip: int) -> np.ndarray:
        rest = np.ascontiguousarray(rows[:, skip:], ">i4")
        return rest.view(f"S{4 * (self.longest - skip)}")[:, 0]

    def _count(self, node: Counter, keys: list[bytes]) -> int:
        before = len(node)
        node.update(keys)
        self.size += len(node) - before
        return len(node)

    def add(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        after_one, after_two = self._texts(rows, 1), self._texts(rows, 2) if self.longest > 2 else None
        new = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        for word, a, b in zip(rows[new, 0].tolist(), new.tolist(), [*new[1:].tolist(), len(rows)]):
            node = self.root.get(word)
            if node is None:
                node = self.root[word] = Counter()
            if isinstance(node, Counter):
                if self._count(node, after_one[a:b].tolist()) > self.burst and after_two is not None:
                    children: dict[int, Counter] = {}
                    for key, n in node.items():
                        children.setdefault(int.from_bytes(key[:4].ljust(4, b"\0"), "big"), Counter())[key[4:]] = n
                    self.root[word] = children
                continue
            cuts = a + np.flatnonzero(np.concatenate([[True], rows[a + 1 : b, 1] != rows[a : b - 1, 1]]))
            for second, c, d in zip(rows[cuts, 1].tolist(), cuts.tolist(), [*cuts[1:].tolist(), b]):
                self._count(node.setdefault(second, Counter()), after_two[c:d].tolist())

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out the largest subtrees until ``keep`` entries are left: windows and counts as one sorted run."""
        trees = [(len(node), word, 0) for word, node in self.root.items() if isinstance(node, Counter)]
        trees += [(len(child), word, second) for word, node in self.root.items() if not isinstance(node, Counter) for second, child in node.items()]
        keys, firsts, counts = [], [], []
        for n, word, second in sorted(trees, reverse=True):
            if self.size <= keep:
                break
            if second:
                tree, head = self.root[word].pop(second), second.to_bytes(4, "big")
                if not self.root[word]:
                    del self.root[word]
                keys += [head + key for key in tree]
            else:
                tree = self.root.pop(word)
                keys += tree
            firsts.append((word, n))
            counts += tree.values()
            self.size -= n
        if keys:
            rest = np.array(keys, f"S{4 * (self.longest - 1)}").view(">i4").reshape(len(keys), -1)
            first = np.repeat(*map(np.array, zip(*firsts)))
            rows = np.column_stack([first, rest]).astype(np.int64)
            by = np.lexsort(rows.T[::-1])
            yield rows[by], np.array(counts, np.int64)[by]


class PairFilter:
    """A set of pairs of word numbers, packed into one key each; it holds all that were put in, and few others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(64 * len(bits) - 1)

    @staticmethod
    def places(keys: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Two bits of the filter for each key."""
        h = mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return h & mask, (h >> np.uint64(32)) & mask

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys, self.mask):
            out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out

    @classmethod
    def of(cls, pairs: DataFrame) -> PairFilter:
        """The filter of the keys ``k1``, of a size set by their number up to 2^MOST_BITS bits; tasks hand on the words of it they touch."""
        size = min(MOST_BITS, max(6, int(pairs.count() * PAIR_BITS).bit_length()))
        mask = np.uint64((1 << size) - 1)

        def run(batches):
            for batch in batches:
                at = np.concatenate(cls.places(batch.column("k1").to_numpy(), mask))
                at = np.unique(at)
                word, start = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
                if len(word):
                    bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start)
                    yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"])

        found = pairs.select("k1").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros(1 << (size - 6), np.uint64)
        bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return cls(bits)


def windows(ids: np.ndarray, stop: int, longest: int, frequent: PairFilter | None = None) -> np.ndarray:
    """The windows that begin before ``stop``; 0 in ``ids`` ends a window, and so does a pair that is not ``frequent``.

    Without a filter all windows of two or more words, with it those of three or more.
    """
    ids = np.concatenate([ids, np.zeros(longest - 1, ids.dtype)]).astype(np.int64)
    links = (ids[:-1] > 0) & (ids[1:] > 0)
    if frequent is not None:
        at = np.flatnonzero(links)
        links[at] = frequent.holds(ids[at] << 32 | ids[at + 1])
    goes_on = np.lib.stride_tricks.sliding_window_view(links, longest - 1)[:stop]
    first = np.flatnonzero(goes_on[:, : 1 if frequent is None else 2].all(axis=1))
    rows = np.lib.stride_tricks.sliding_window_view(ids, longest)[first]  # a copy
    rows[:, 1:] *= np.logical_and.accumulate(goes_on[first], axis=1)
    return rows


def _packed(rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = np.pad(rows, ((0, 0), (0, 6 - rows.shape[1])))
    keys = [rows[:, i] << 32 | rows[:, i + 1] for i in (0, 2, 4)]
    for a in range(0, len(rows), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)]) for x in (*keys, counts)], [*KEYS, "n"])


class Numbers(dict):
    """Numbers of the known words of a language; others are ``unknown``. Line feeds are 0, and empty words, to be left out, -1."""

    def __init__(self, words: dict[bytes, int], unknown: int):
        super().__init__(words)
        self.unknown = unknown
        self.update({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        return self.unknown

    def of(self, data: bytes) -> tuple[np.ndarray, list[bytes]]:
        """Numbers of the words and breaks of folded text, and the words themselves."""
        words = data.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return ids, words


def _counted(parts: Iterator[tuple[np.ndarray, bool]], longest: int, frequent: PairFilter | None, burst: int, entries: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the windows of arrays of numbers; the flag tells whether a window may go on into the next array."""
    trie, tail = HatTrie(longest, burst, entries), np.zeros(0, np.int32)
    for ids, goes_on in parts:
        ids = np.concatenate([tail, ids])
        stop = max(0, len(ids) - longest + 1) if goes_on else len(ids)
        for a in range(0, stop, entries):
            trie.add(windows(ids[a : a + entries + longest - 1], min(entries, stop - a), longest, frequent))
            if trie.size > entries:
                for run in trie.spill(entries // 2):
                    yield from _packed(*run)
        tail = ids[stop:]
    for run in trie.spill(0):
        yield from _packed(*run)


def _from_texts(known: dict[str, dict[bytes, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bool]]:
    tables: dict[str, Numbers] = {}
    for batch in slices(batches, "text", SLICE):
        for lang, data in by_language(batch):
            if lang not in tables:
                tables[lang] = Numbers(known.get(lang, {}), 0)
            for part in segments(data):
                ids, _ = tables[lang].of(part)
                yield ids[ids >= 0], True
            yield np.zeros(1, np.int32), False


def _from_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bool]]:
    for batch in batches:
        for ids, found in zip(batch.column("ids"), batch.column("found").to_pylist()):
            ids = ids.values.to_numpy(zero_copy_only=False).astype(np.int32)
            at = np.flatnonzero(ids == -2)
            ids[at] = 0
            for x in found or []:
                ids[at[x["pos"]]] = x["id"]
            yield ids, True
            yield np.zeros(1, np.int32), False


class Corpus:
    """The documents with their words numbered, to be counted more than once.

    ``vocabulary`` (lang, word, n, id) is a written table numbered by falling n. Its first ``most_words`` words are broadcast; if
    there are more, the places of the others in the texts are numbered by a join on the word, and the numbers written.
    """

    def __init__(self, docs: DataFrame, vocabulary: DataFrame, most_words: int = MOST_WORDS):
        known: dict[str, dict[bytes, int]] = {}
        frequent = vocabulary.where(F.col("id") <= most_words).select("lang", "word", "id").toArrow()
        for lang, word, number in zip(*(frequent.column(c).to_pylist() for c in ("lang", "word", "id"))):
            known.setdefault(lang, {})[word.encode()] = number
        shared = docs.sparkSession.sparkContext.broadcast(known)
        rest = vocabulary.where(F.col("id") > most_words).select("lang", "word", F.col("id").cast("int").alias("id"))
        if rest.isEmpty():
            self.rows, self.parts = docs, lambda batches: _from_texts(shared.value, batches)
            return

        def looked_up(batches):
            for batch in slices(batches, "text", SLICE):
                out = []
                for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
                    ids, words = Numbers(shared.value.get(lang, {}), -2).of(text.translate(FOLD))
                    out.append((ids[ids != -1], [words[k] for k in np.flatnonzero(ids == -2)]))
                others = pa.array([[w.decode() for w in words] for _, words in out], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("lang"), pa.array([i for i, _ in out], pa.list_(pa.int32())), others], ["row", "lang", "ids", "others"])

        rows = docs.select(F.monotonically_increasing_id().alias("row"), "lang", "text").mapInArrow(looked_up, "row long, lang string, ids array<int>, others array<string>")
        rows = written(rows, "phrase-numbers")
        places = rows.select("row", "lang", F.posexplode("others").alias("pos", "word")).join(rest, ["lang", "word"])
        found = places.groupBy("row").agg(F.collect_list(F.struct("pos", "id")).alias("found"))
        self.rows, self.parts = written(rows.select("row", "ids").join(found, "row", "left").select("ids", "found"), "phrase-rows"), _from_numbers

    def runs(self, longest: int, burst: int, entries: int, frequent: PairFilter | None = None) -> DataFrame:
        """(k1, k2, k3, n): the sorted runs of all tasks, two word numbers in a key; without a filter pairs, in k1 alone."""
        parts, keys = self.parts, KEYS if frequent else KEYS[:1]
        shared = self.rows.sparkSession.sparkContext.broadcast(frequent)

        def run(batches):
            for batch in _counted(parts(batches), longest, shared.value, burst, entries):
                yield batch.select([*keys, "n"])

        return self.rows.mapInArrow(run, ", ".join(f"{k} long" for k in (*keys, "n")))


def prefix_counts(runs: DataFrame, longest: int, least: int) -> DataFrame:
    """(k1, k2, k3, a): all phrases of three to ``longest`` words that begin ``least`` or more windows, the missing words 0."""

    def run(batches):
        for batch in batches:
            k1, k2, k3, n = (batch.column(c).to_numpy() for c in (*KEYS, "n"))
            if not len(n):
                continue
            # the first and the last phrase of each length may go on in the neighbouring batches: they are handed on in any case
            for size in range(3, longest + 1):
                keys = [k1, k2 >> 32 << 32 if size == 3 else k2, (k3 >> 32 << 32 if size == 5 else k3) * (size > 4)]
                start = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
                total = np.add.reduceat(n, start)
                # a phrase of this size has a word at its last place
                last = keys[(size - 1) // 2][start] & 0xFFFFFFFF if size % 2 == 0 else keys[(size - 1) // 2][start]
                keep = total >= least
                keep[[0, -1]] = True
                keep &= last > 0
                at = start[keep]
                yield pa.RecordBatch.from_arrays([pa.array(k[at]) for k in keys] + [pa.array(total[keep])], [*KEYS, "a"])

    merged = runs.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    found = merged.mapInArrow(run, "k1 long, k2 long, k3 long, a long").groupBy(*KEYS).agg(F.sum("a").alias("a"))
    return found.where(F.col("a") >= least)


def _numbers() -> Column:
    """The array of word numbers of packed keys."""
    parts = [p for k in KEYS for p in (F.shiftright(k, 32).cast("int"), F.col(k).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))]
    return F.array_remove(F.array(*parts), 0)


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, inside: int = 100, most_words: int = MOST_WORDS, burst: int = BURST, entries: int = ENTRIES
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    A-Z is lower-cased; texts are split at ``.,;:!?`` and line ends into pieces, those at blanks and tabs into words. All is per lang (null:
    ``und``). n counts all words, a the occurrences of a phrase of 2 to ``longest`` words (6 at most), overlaps included, if ``least`` or
    more. A cut into the first words (l occurrences) and the rest (r) scores floor(1000 a n / (l r)); the lowest-scoring cut counts, the
    shortest first part on a tie. A phrase goes that lies in a longer one with at least ``inside`` percent of its occurrences; one word more
    is enough to look at, as every phrase between the two occurs at least as often as the longer one. Order: score, then a (both falling),
    then phrase by its UTF-8 bytes. Null, empty and blank texts have no words; repeated rows count each; columns other than lang and text
    are not read; without phrases there are no rows.
    """
    if not 2 <= longest <= 6:
        raise ValueError("phrases have 2 to 6 words")
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = written(word_counts(docs), "phrase-words")
    totals = counts.where("word IS NULL").select("lang", F.col("n").alias("n_all"))
    frequent = counts.where("word IS NOT NULL").where(F.col("n") >= least)
    vocabulary = global_row_number(frequent, [F.col("n").desc(), F.col("lang"), F.col("word")], "id").select("lang", "word", "n", F.col("id").cast("int").alias("id"))
    vocabulary = written(vocabulary, "phrase-vocabulary")
    corpus, none = Corpus(docs, vocabulary, most_words), F.lit(0).cast("long")
    pairs = written(corpus.runs(2, burst, entries).groupBy("k1").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "phrase-pairs")
    found = pairs.select("k1", none.alias("k2"), none.alias("k3"), "a")
    if longest > 2:
        runs = written(corpus.runs(longest, burst, entries, PairFilter.of(pairs)), "phrase-runs")
        found = found.unionByName(prefix_counts(runs, longest, least))
    phrases = written(found.select(_numbers().alias("w"), "a"), "phrases")

    # one row per language
    known = vocabulary.join(F.broadcast(totals), "lang").select(F.col("id").alias("first"), "lang", F.col("n_all").alias("n"))
    size = F.size("w")
    longer = phrases.where(size > 2).select("a", F.explode(F.array(F.slice("w", F.lit(1), size - 1), F.slice("w", F.lit(2), size - 1))).alias("w"))
    longer = longer.groupBy("w").agg(F.max("a").alias("most"))
    kept = phrases.join(longer, "w", "left").where(f"most IS NULL OR 100 * most < {inside} * a").drop("most")
    kept = kept.withColumn("first", F.element_at("w", 1)).join(small(known), "first").drop("first")

    parts = small(written(phrases.unionByName(vocabulary.select(F.array("id").alias("w"), F.col("n").alias("a"))), "phrase-parts"), BROADCAST_PHRASES)
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.withColumn("left", F.slice("w", F.lit(1), F.col("k"))).withColumn("right", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")))
    cuts = cuts.join(parts.select(F.col("w").alias("left"), F.col("a").alias("l")), "left").join(parts.select(F.col("w").alias("right"), F.col("a").alias("r")), "right")
    score = F.expr("CAST(1000 * a AS DECIMAL(18)) * CAST(n AS DECIMAL(18)) div (CAST(l AS DECIMAL(18)) * CAST(r AS DECIMAL(18)))")
    best = cuts.groupBy("w", "lang", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = best.select("w", "lang", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc()]
    # all phrases that tie with the last one go on to be ordered by their words
    scored = written(scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place"), "phrase-scores")

    spelled = scored.select("w", F.posexplode("w").alias("at", "id")).join(small(vocabulary.select("id", "word")), "id")
    spelled = spelled.groupBy("w").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = scored.join(spelled, "w")
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

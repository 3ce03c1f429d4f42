"""Runs of repeated words (maximal repetitions) by internal pattern matching.

The words of a slice of documents form one sequence, with a mark of its own behind every document. Prefix doubling gives the suffix
array and the interval that the block of 2^k words at a position has in it. A run of period q holds, in its first part, a block of
b = 2^k words that begins at a multiple of b, for the largest b with 2b - 1 <= max(q, 6); the block occurs again q words later, in a window
of 2b places (six for b = 2). A wavelet matrix over the suffix array answers where the next occurrence at or behind a place is. Each
occurrence is a candidate period; more than two that overlap by half form an arithmetic progression, whose difference is the block's own
period, and only those of its terms go on that the two runs of that period leave possible. Candidates are extended both ways by the
ranks of the doubling; a stretch at least twice its period is a run, and of the periods found for a stretch the smallest is its own.

Runs of one document lie in one task; memory grows with a slice's words times the logarithm of its longest document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import slices, texts_of, words_of

#: Bytes of text handled together; a longer text is handled alone.
SLICE = 1 << 20
#: Behind any place.
NONE = 1 << 60
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Suffixes:
    """Suffix array of ``s`` up to blocks of ``most`` words, and the ranks of all blocks of 2^k words.

    ``ranks[k][i]`` is the first place in the suffix array of the suffixes that begin with the 2^k words at i. ``s`` begins and
    ends with values that occur once.
    """

    def __init__(self, s: np.ndarray, most: int):
        n = len(s)
        self.order = np.argsort(s, kind="stable")
        rank = np.empty(n, np.int32)
        rank[self.order] = self._firsts(s[self.order], np.arange(n))
        self.ranks, width = [rank], 1
        while width < most:
            open_ = np.bincount(rank, minlength=n)[rank[self.order]] > 1
            slots = np.flatnonzero(open_)
            if not len(slots):
                break
            at = self.order[slots]
            behind = at + width
            keys = rank[at].astype(np.int64) * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
            by = np.argsort(keys, kind="stable")
            self.order[slots] = at[by]
            rank = rank.copy()
            rank[at[by]] = self._firsts(keys[by], slots)
            self.ranks.append(rank)
            width *= 2

    @staticmethod
    def _firsts(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """For sorted keys at the given slots: the slot where the run of equal keys begins."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        return slots[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from the places i and j on (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, todo = self.ranks[k], np.arange(len(i))
            while len(todo):
                todo = todo[rank[i[todo] + out[todo]] == rank[j[todo] + out[todo]]]
                out[todo] += 1 << k
                if k < len(self.ranks) - 1:
                    break
        return out

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words that end just before the places i and j (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, todo = self.ranks[k], np.arange(len(i))
            while len(todo):
                a, b = i[todo] - out[todo] - (1 << k), j[todo] - out[todo] - (1 << k)
                todo = todo[(a >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])]
                out[todo] += 1 << k
                if k < len(self.ranks) - 1:
                    break
        return out


class WaveletMatrix:
    """Range successor over a permutation of 0..n-1."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(self.n - 1).bit_length()) - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before, int(before[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Smallest value of at least x at the places [low, high) each, or NONE."""
        out = np.full(len(x), NONE, np.int64)
        todo = np.flatnonzero(x < self.n)
        left, right, goal = low[todo], high[todo], x[todo]
        less = np.zeros(len(todo), np.int64)
        for bit, before, zeros in self.levels:
            a, b, one = before[left], before[right], (goal >> bit) & 1 == 1
            less += np.where(one, b - a, 0)
            left, right = np.where(one, zeros + left - a, a), np.where(one, zeros + right - b, b)
        some = less < high[todo] - low[todo]
        todo, rest = todo[some], less[some]
        left, right, value = low[todo], high[todo], np.zeros(len(todo), np.int64)
        for bit, before, zeros in self.levels:
            a, b = before[left], before[right]
            one = rest >= b - a
            rest = rest - np.where(one, b - a, 0)
            value |= one.astype(np.int64) << bit
            left, right = np.where(one, zeros + left - a, a), np.where(one, zeros + right - b, b)
        out[todo] = value
        return out


def _progressions(words: Suffixes, j: np.ndarray, p: np.ndarray, d: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences p, p + d, ... (up to ``last``) of the blocks at j: the pairs (place, occurrence) that may have a period, and the last terms.

    The block lies in a run of period d, and so do all terms. If both are the same run, its period is d and no other. Else the
    stretch of period q = p_i - j ends where the nearer of the two runs ends, unless their ends agree.
    """
    end_1, begin_1 = j + d + words.ahead(j, j + d), j - words.behind(j, j + d)
    end_2, begin_2 = p + d + words.ahead(p, p + d), p - words.behind(p, p + d)
    terms = np.minimum((end_2 - width - p) // d, (last - p) // d) + 1
    apart = np.flatnonzero(begin_1 != begin_2)
    of = np.repeat(apart, terms[apart])
    step = (np.arange(len(of)) - np.repeat(np.cumsum(terms[apart]) - terms[apart], terms[apart])) * d[of]
    right_1, right_2 = (end_1 - j)[of], (end_2 - p)[of] - step
    left_1, left_2 = (j - begin_1)[of], (p - begin_2)[of] + step
    fits = np.minimum(left_1, left_2) + np.minimum(right_1, right_2) >= (p - j)[of] + step
    may = fits | (right_1 == right_2) | (left_1 == left_2)
    return j[of[may]], (p[of] + step)[may], p + (terms - 1) * d


def candidates(words: Suffixes, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (j, p), p - j a candidate period, for all runs of documents of up to ``longest`` words."""
    matrix, n, found = WaveletMatrix(words.order), len(words.order), []
    for k in range(1, len(words.ranks)):
        width = 1 << k
        first, last = (1, 6) if width == 2 else (2 * width - 1, 4 * width - 2)
        if 2 * first > longest:
            break
        rank = words.ranks[k]
        j = np.arange(0, n, width)
        low = rank[j].astype(np.int64)
        high = low + np.bincount(rank, minlength=n)[low]
        again = np.flatnonzero(high - low > 1)
        j, low, high = j[again], low[again], high[again]
        p = matrix.successor(low, high, j + first)
        while len(j):
            near = np.flatnonzero(p <= j + last)
            j, low, high, p = j[near], low[near], high[near], p[near]
            following = matrix.successor(low, high, p + 1)
            # blocks of two words look for the periods up to six themselves
            overlap = (following <= j + last) & (2 * (following - p) <= width) & (width > 2)
            found.append((j[~overlap], p[~overlap]))
            at = np.flatnonzero(overlap)
            if len(at):
                a, b, end = _progressions(words, j[at], p[at], following[at] - p[at], j[at] + last, width)
                found.append((a, b))
                following[at] = matrix.successor(low[at], high[at], end + 1)
            p = following
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(a for a, _ in found)]), np.concatenate([none, *(b for _, b in found)])


def runs_of(docs: list[np.ndarray], least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs of ``least`` or more words, by document, start and period.

    ``docs`` are arrays of word numbers from 0 on. ``least`` must be 12 or more, as the blocks are chosen for that.
    """
    sizes = np.array([len(d) for d in docs], np.int64)
    longest = int(sizes.max(initial=0))
    if longest < least:
        return (np.zeros(0, np.int64),) * 4
    top = max(int(d.max(initial=0)) for d in docs) + 2
    parts = [np.array([top - 1])]
    for i, d in enumerate(docs):
        parts += [d, np.array([top + i])]
    s = np.concatenate(parts).astype(np.int64)
    begin = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    words = Suffixes(s, max(2, longest // 4))
    j, p = candidates(words, longest)
    left, right, period = words.behind(j, p), words.ahead(j, p), p - j
    good = (left + right >= period) & (left + right + period >= least)
    start, end, period = (j - left)[good], (p + right)[good], period[good]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    own = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[: len(start)]  # the smallest period of each stretch
    start, end, period = start[own], end[own], period[own]
    doc = np.searchsorted(begin, start, "right") - 1
    by = np.lexsort((period, start))
    return doc[by], (start - begin[doc])[by], (end - start)[by], period[by]


class Numbers(dict):
    """Words numbered in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _build(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    numbers = Numbers()
    texts = [t.split() for t in texts_of(batch.column("text"))]
    docs = [np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in texts]
    doc, start, length, period = runs_of(docs, least)
    bounds = np.searchsorted(doc, np.arange(len(docs) + 1))
    collapsed = []
    for i, words in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        if a < b:
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start[a:b] + period[a:b], 1)
            np.add.at(change, start[a:b] + length[a:b], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        collapsed.append(b" ".join(words))
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are split at ASCII white space and numbered from 0. A run is a stretch with smallest period q, of ``least`` words and 2q or
    more, that no neighbouring word extends; runs are sorted by start, then period. ``collapsed`` is the text, words joined by one space,
    without the words that a run holds behind its first q. Null, empty and blank texts have no words, no runs and an empty
    text. Rows with the same id or text are treated each on its own; columns other than doc_id and text are not read.
    """
    if least < 12:
        raise ValueError("runs of fewer than 12 words may lie between the blocks that are searched")

    def run(batches):
        for part in slices(batches, "text", SLICE):
            yield _build(part, least)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by its id's crc32 h, ends in a repetition.

    With g = floor(h / 10) and n words, the words from a = g mod n on repeat those of the first p = 1 + floor((n - a) / (3 + g mod 8)). A
    null id counts as the empty string; other texts stay as they are.
    """
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    words = words_of(F.col("text"))
    n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
    a = g % F.greatest(n, F.lit(1))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), F.greatest(n - a, F.lit(0)).cast("int"))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Count of runs, the longest (smallest start, then period, on a tie), and digests of all runs and of the collapsed text."""
    def text(r: Column) -> Column:
        return F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))

    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", text), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))

"""Secret scan: known patterns, and strings of a credential's format by grammar inference.

Patterns find assignments, access keys and hexadecimal strings. Their values are the labelled credentials: a bounded sample of the distinct
values of each kind (those with the least hashes) makes a prefix tree, whose states are merged where Hoeffding's bound finds their
statistics compatible (as in ALERGIA), which gives a probabilistic automaton of the kind. Another is learned the same way from
unlabelled strings. Then every candidate, a run of credential characters outside the patterns' finds, is scored by its log-likelihood under
each kind's automaton and under the one of unlabelled strings; a kind is added where the first is better by a margin and not below
what the kind's own labelled strings reach.

The sample is the only bound: patterns, candidates and scores cover all texts whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import slices, texts_of, written
from tidegrain.operators.ranking import first_per_key

#: The kinds and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
CREDENTIAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
HEX = b"0123456789abcdef"
#: Characters of a run's ends that are punctuation of the text around it.
TRIM = b"./_=+-"
#: Learned strings: distinct ones of each kind, and the characters of one that is learned from.
SAMPLE, LONGEST = 1000, 256
#: Shortest candidate; significance of the merging test; smoothing count; nats by which a kind must be better than unlabelled text.
SHORTEST, ALPHA, SMOOTH, MARGIN = 16, 0.05, 0.5, 5.0
SYMBOLS = len(CREDENTIAL)
CODE = np.full(256, -1, np.int16)
CODE[np.frombuffer(CREDENTIAL, np.uint8)] = np.arange(SYMBOLS)
#: Classes by which states are compared besides single characters: digits, a-f, g-z, A-F, G-Z, others.
CLASS = np.array([0 if c in b"0123456789" else 1 if c in b"abcdef" else 2 if 97 <= c <= 122 else 3 if c in b"ABCDEF" else 4 if 65 <= c <= 90 else 5 for c in CREDENTIAL])


def long_runs(data: np.ndarray, members: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``members`` of ``least`` bytes or more."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    inside = table[data]
    full, width = inside, 1  # full[i]: the bytes i .. i + width - 1 are members
    while width < least and len(full):
        step = min(width, least - width)
        full, width = full[: max(0, len(full) - step)] & full[step:], width + step
    at = np.flatnonzero(full)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + least


def base_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, start, end, start of the value) of the patterns' finds in ``data``, by start, then kind; texts are parted by line feeds."""
    found = []
    low, end = data.lower(), 0
    for start in sorted(m.start() for word in KEYWORDS for m in re.finditer(word, low)):
        if start >= end and (m := ASSIGN.match(data, start)):
            end = m.end()
            if end - m.start(2) >= LEAST["assign"]:
                found.append((0, start, end, m.start(2)))
    found += [(1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST["access"]]
    found += [(2, a, b, a) for a, b in zip(*long_runs(np.frombuffer(data, np.uint8), HEX, LEAST["hex"]))]
    rows = np.array(found, np.int64).reshape(-1, 4)
    rows = rows[np.lexsort((rows[:, 0], rows[:, 1]))]
    return tuple(rows.T)


def candidates(data: bytes, starts: np.ndarray, ends: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of credential characters that touch none of the given spans, their outer punctuation cut off."""
    bytes_ = np.frombuffer(data, np.uint8)
    a, b = long_runs(bytes_, CREDENTIAL, shortest)
    order = np.argsort(ends)
    # spans that end behind a run's start, less those that also start at or behind its end
    touched = (len(ends) - np.searchsorted(ends[order], a, "right")) - (len(starts) - np.searchsorted(np.sort(starts), b, "left"))
    a, b = a[touched == 0], b[touched == 0]
    trimmed = [(int(x) + len(run) - len(run.lstrip(TRIM)), int(x) + len(run.rstrip(TRIM))) for x, run in ((x, data[x:y]) for x, y in zip(a, b))]
    rows = np.array([(x, y) for x, y in trimmed if y - x >= shortest], np.int64).reshape(-1, 2)
    return rows[:, 0], rows[:, 1]


class Sample:
    """The ``most`` distinct strings with the least hashes seen so far."""

    def __init__(self, most: int):
        self.most, self.kept = most, {}
        self.limit = 1 << 64

    def add(self, value: bytes) -> None:
        h = xxhash.xxh64_intdigest(value)
        if h < self.limit and len(value) <= LONGEST:
            self.kept[value] = h
            if len(self.kept) > 2 * self.most:
                self.cut()

    def cut(self) -> dict[bytes, int]:
        self.kept = dict(sorted(self.kept.items(), key=lambda x: (x[1], x[0]))[: self.most])
        if len(self.kept) == self.most:
            self.limit = max(self.kept.values()) + 1
        return self.kept


def labelled_sample(docs: DataFrame, sample: int = SAMPLE, shortest: int = SHORTEST) -> dict[str, list[bytes]]:
    """Distinct values by kind, and unlabelled candidates under ``text``: of each the ``sample`` with the least hashes of all documents."""

    def run(batches):
        seen = {kind: Sample(sample) for kind in (*KINDS, "text")}
        for batch in slices(batches, "text"):
            data = b"\n".join(texts_of(batch.column("text")))
            kind, start, end, value = base_spans(data)
            for k, a, b in zip(kind.tolist(), value.tolist(), end.tolist()):
                seen[KINDS[k]].add(data[a:b])
            for a, b in zip(*candidates(data, start, end, shortest)):
                seen["text"].add(data[a:b])
        rows = [(kind, value.decode(), h - (1 << 63)) for kind, s in seen.items() for value, h in s.cut().items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["kind", "value", "hash"])

    rows = docs.select("text").mapInArrow(run, "kind string, value string, hash long").distinct()
    least = written(first_per_key(rows, ["kind"], [F.col("hash").asc(), F.col("value").asc()], sample), "credential-sample")
    out: dict[str, list[bytes]] = {kind: [] for kind in (*KINDS, "text")}
    for row in least.orderBy("kind", "hash", "value").collect():  # at most ``sample`` strings of 256 characters for each of four kinds
        out[row["kind"]].append(row["value"].encode())
    return out


@dataclass
class Automaton:
    """A probabilistic automaton: next states (or -1) and log probabilities by state and symbol, and those of ending in a state."""

    states: np.ndarray
    logs: np.ndarray
    ends: np.ndarray

    def scores(self, strings: list[bytes]) -> np.ndarray:
        """Log-likelihood of each string. A symbol not seen in a state has the smoothed probability and leaves the state as it is."""
        out, order = np.zeros(len(strings)), np.argsort([-len(s) for s in strings], kind="stable")
        sizes = np.array([len(strings[i]) for i in order], np.int64)
        data = CODE[np.frombuffer(b"".join(strings[i] for i in order), np.uint8)]
        begin = np.cumsum(sizes) - sizes
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
        for k in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -k, "left"))  # the strings longer than k come first
            symbol = data[begin[:n] + k]
            total[:n] += self.logs[state[:n], symbol]
            following = self.states[state[:n], symbol]
            state[:n] = np.where(following >= 0, following, state[:n])
        out[order] = total + self.ends[state]
        return out


def infer(strings: list[bytes], alpha: float = ALPHA) -> Automaton:
    """Merge statistically compatible states of the prefix tree of ``strings`` (characters of CREDENTIAL only).

    States are taken in the order of their visits, ties by their place in the tree. A state is compared with each kept one: the
    shares of ending, of each character and of each class of characters must differ by no more than Hoeffding's bound, and so on for the
    states behind both. It is merged into the first compatible one, or kept.
    """
    children: list[dict[int, int]] = [{}]
    counts: list[dict[int, int]] = [{}]
    stops = [0]
    for s in strings:
        at = 0
        for c in CODE[np.frombuffer(s, np.uint8)].tolist():
            counts[at][c] = counts[at].get(c, 0) + 1
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                counts.append({})
                stops.append(0)
            at = children[at][c]
        stops[at] += 1
    root = np.sqrt(0.5 * np.log(2 / alpha))

    def visits(q: int) -> int:
        return stops[q] + sum(counts[q].values())

    def classes(q: int) -> list[int]:
        out = [0] * 6
        for c, n in counts[q].items():
            out[CLASS[c]] += n
        return out

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            n, m = visits(x), visits(y)
            if not n or not m:
                continue
            bound = root * (n**-0.5 + m**-0.5)
            if bound >= 1:  # no difference of shares can be larger, here or, as visits only fall in a tree, behind y
                continue
            if abs(stops[x] / n - stops[y] / m) > bound or any(abs(p / n - q / m) > bound for p, q in zip(classes(x), classes(y))):
                return False
            for c in counts[x].keys() | counts[y].keys():
                if abs(counts[x].get(c, 0) / n - counts[y].get(c, 0) / m) > bound:
                    return False
            todo += [(children[x][c], children[y][c]) for c in children[x].keys() & children[y].keys()]
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to the automaton from a on."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            stops[x] += stops[y]
            for c, n in counts[y].items():
                counts[x][c] = counts[x].get(c, 0) + n
            for c, q in children[y].items():
                if c in children[x]:
                    todo.append((children[x][c], q))
                else:
                    children[x][c] = q

    kept, known = [0], {0}
    while True:
        border = [(-counts[p][c], kept.index(p), c, p, q) for p in kept for c, q in children[p].items() if q not in known]
        if not border:
            break
        _, _, c, p, q = min(border)
        into = next((r for r in kept if compatible(r, q)), None)
        if into is None:
            kept.append(q)
            known.add(q)
        else:
            children[p][c] = into
            fold(into, q)
    number = {q: i for i, q in enumerate(kept)}
    states, shares, ends = np.full((len(kept), SYMBOLS), -1, np.int32), np.full((len(kept), SYMBOLS), SMOOTH), np.full(len(kept), SMOOTH)
    for q, i in number.items():
        ends[i] += stops[q]
        for c, n in counts[q].items():
            shares[i, c] += n
            states[i, c] = number[children[q][c]]
    total = shares.sum(axis=1) + ends
    return Automaton(states, np.log(shares / total[:, None]), np.log(ends / total))


@dataclass
class Model:
    """Automata of the kinds that had labelled strings, the least score per character of each, and the automaton of unlabelled strings."""

    kinds: dict[str, tuple[Automaton, float]]
    text: Automaton

    def judge(self, strings: list[bytes], margin: float = MARGIN) -> tuple[np.ndarray, np.ndarray]:
        """Index in KINDS of the kind with the best score (-1: unlabelled text is as likely), and that score."""
        sizes = np.array([len(s) + 1 for s in strings])
        plain = self.text.scores(strings)
        best, which = np.full(len(strings), -np.inf), np.full(len(strings), -1)
        for kind, (automaton, least) in self.kinds.items():
            score = automaton.scores(strings)
            good = (score > best) & (score >= plain + margin) & (score / sizes >= least)
            best[good], which[good] = score[good], KINDS.index(kind)
        return which, best


def learn(sample: dict[str, list[bytes]], lowest: float = 0.01) -> Model:
    """The model of a labelled sample; a kind accepts no less per character than the ``lowest`` share of its own strings has."""
    kinds = {}
    for kind in KINDS:
        if sample[kind]:
            automaton = infer(sample[kind])
            own = automaton.scores(sample[kind]) / np.array([len(s) + 1 for s in sample[kind]])
            kinds[kind] = automaton, float(np.quantile(own, lowest, method="lower"))
    return Model(kinds, infer(sample["text"]))


def _scan(batch: pa.RecordBatch, model: Model, shortest: int, margin: float) -> Iterator[pa.RecordBatch]:
    texts = texts_of(batch.column("text"))
    data = b"\n".join(texts)
    kind, start, end, value = base_spans(data)
    a, b = candidates(data, start, end, shortest)
    like, score = model.judge([data[x:y] for x, y in zip(a, b)], margin)
    hit = like >= 0
    kind = np.concatenate([kind, like[hit] + len(KINDS)])
    value = np.concatenate([value, a[hit]])
    start, end = np.concatenate([start, a[hit]]), np.concatenate([end, b[hit]])
    scores = np.concatenate([np.full(len(start) - hit.sum(), np.nan), score[hit]])
    by = np.lexsort((kind, start))
    kind, start, end, value, scores = kind[by], start[by], end[by], value[by], scores[by]
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    doc = np.searchsorted(bounds, start, "right") - 1
    # code points: bytes that don't go on with a character
    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    names = np.array([*KINDS, *(f"like_{k}" for k in KINDS)], object)
    fields = {
        "kind": pa.array(names[kind.astype(int)], pa.string()), "start": pa.array(points[start] - points[bounds[doc]]), "end": pa.array(points[end] - points[bounds[doc]]),
        "value": pa.array([data[x:y].decode() for x, y in zip(value, end)], pa.string()), "score": pa.array(scores, pa.float64(), mask=np.isnan(scores))}
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, sample: int = SAMPLE, shortest: int = SHORTEST, margin: float = MARGIN) -> DataFrame:
    """(doc_id, spans), one row per row of ``docs``; a span has kind, start, end (code points, end exclusive), value and score.

    ``assign``, ``access`` and ``hex`` are the patterns' finds, leftmost and non-overlapping per kind; the value of an assignment is what is
    assigned. ``like_assign``, ``like_access`` and ``like_hex`` are candidates of ``shortest`` or more characters with such a value's format, and have
    a score, the log-likelihood. Spans are sorted by start, then kind in this order. The model is learned from these ``docs``: up to
    ``sample`` distinct values of a kind, of 256 characters at most; without labelled values nothing is added. Null and empty texts have
    no spans; repeated rows are scanned each; columns other than doc_id and text are not read.
    """
    model = learn(labelled_sample(docs, sample, shortest))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text"):
            yield from _scan(batch, shared.value, shortest, margin)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string,score:double>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the patterns' finds, the digest of their spans, and all spans as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return found.select("doc_id", *map(of, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

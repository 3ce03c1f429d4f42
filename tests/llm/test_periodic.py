import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegrain.llm import periodic
from tidegrain.llm.queries import QUERIES


def brute(w, least=12):
    """Runs by comparing every word with the one q before, for every q."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, 2 * q):
                best.setdefault((start, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_planted(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_row(doc_id, text):
    w = brute_planted(doc_id, text)
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), s, n, q, None if q is None else 1000 * n // q, hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def found(docs):
    doc, start, length, period = periodic.runs_of([np.array(d, np.int64) for d in docs])
    out = [[] for _ in docs]
    for d, s, n, q in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
        out[d].append((s, n, q))
    return out


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=7)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4))
def test_equal_to_brute_force(parts):
    docs = [[x for cycle, times in p for x in cycle * times] for p in parts]
    assert found(docs) == [brute(d) for d in docs]


def test_random_words_of_small_alphabets():
    rng = random.Random(3)
    for size in (1, 2, 3):
        docs = [[rng.randrange(size) for _ in range(rng.randrange(160))] for _ in range(30)]
        assert found(docs) == [brute(d) for d in docs]


def test_nested_and_touching_runs():
    ab, ba = [0, 1], [1, 0]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    inner = [0, 1, 0, 1, 0, 1, 0, 1, 2, 3, 4] * 5
    docs = [ab * 20 + ba * 20, [0] * 200, fib[-1], inner * 3, (ab * 9 + [5]) * 6, list(range(50)) * 2 + [7] * 12, [1] * 11, [], ab * 20, ab * 20]
    assert found(docs) == [brute(d) for d in docs]


def test_long_text_of_one_word():
    assert found([[4] * 200_000]) == [[(0, 200_000, 1)]]
    cycle = list(range(5000))
    assert found([cycle * 7 + [9, 9]]) == [[(0, 35_000, 5000)]]


def test_successor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        matrix = periodic.WaveletMatrix(values)
        low, high, x = rng.integers(0, n, 300), rng.integers(0, n + 1, 300), rng.integers(0, n + 3, 300)
        high = np.maximum(low, high)
        want = [min((v for v in values[a:b] if v >= c), default=periodic.NONE) for a, b, c in zip(low, high, x)]
        assert matrix.successor(low, high, x).tolist() == want


def rows():
    rng = random.Random(9)
    vocab = [f"w{i}é" for i in range(60)]
    out = [(i, rng.choice([" ", "\n", " \t"]).join(rng.choices(vocab[: rng.choice([2, 5, 60])], k=rng.choice([0, 1, 11, 12, 40, 300])))) for i in range(160)]
    return out + [(200, None), (201, ""), (202, " \t\x0b\r\n "), (None, "a b " * 30), (None, None), (203, "x " * 4000), (203, "x " * 4000), (204, "u\xa0v " * 20), (-5, "a b c " * 9)]


def test_query_on_a_small_table(spark, tmp_path):
    docs = rows()
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in docs if i is not None)
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], "doc_id long, text string, runs string, n_words int, best string").repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((brute_row(*r) for r in docs), key=repr)


def test_operator_keeps_texts(spark):
    df = spark.createDataFrame([(1, "p q r s t u v w x y z " * 2 + "end"), (2, "no run here")], "doc_id long, text string")
    a, b = sorted(periodic.periodic_runs(df).collect())
    assert [tuple(r) for r in a["runs"]] == [(0, 22, 11)] and a["collapsed"] == "p q r s t u v w x y z end" and a["n_words"] == 23
    assert (b["runs"], b["collapsed"]) == ([], "no run here")


def test_empty_table(spark):
    assert periodic.digests(periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string"))).collect() == []

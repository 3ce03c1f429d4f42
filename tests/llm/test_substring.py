import hashlib
import random

import numpy as np

from tidegrain.llm import substring


def brute(rows, size):
    first = {}
    words = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - size + 1):
                if first[tuple(w[k : k + size])] < i:
                    gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(rng, size):
    vocab = [f"w{i}ü" for i in range(400)]
    some = lambda n: rng.choices(vocab, k=n)
    passages = [some(size + rng.randrange(30)) for _ in range(6)]
    rows = []
    for i in range(60):
        w = some(rng.choice([0, 3, size - 1, size, 3 * size]))
        for _ in range(rng.randrange(3)):
            w += rng.choice(passages) + some(rng.randrange(9))
        rows.append((i * 7 % 61, rng.choice([" ", "  ", "\n"]).join(w)))
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(200, None), (201, ""), (202, " \t "), (None, rows[3][1]), (None, None)]
    rows += [(300, "same words here " * 60), (301, "same words here " * 50), (302, "same words here " * 60)]
    rows += [(400, rows[5][1]), (400, rows[5][1]), (400, rows[6][1] + " x"), (0, "z " * 30_000), (500, "z " * 30_000 + "end")]
    return rows


def test_window_keys_are_window_minima():
    x = np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64)
    for size in (1, 5, 8, 9, 13, 50):
        grams = substring.rolling(x, min(substring.GRAM, size), substring.BASES[0])
        span = size - min(substring.GRAM, size) + 1
        assert (substring.window_keys(x, size) == [grams[i : i + span].min() for i in range(300 - size + 1)]).all()
    assert (substring.rolling(np.tile(x[:60], 2), 50, substring.BASES[1])[:11] == substring.rolling(np.tile(x[:60], 2), 50, substring.BASES[1])[60:]).all()


def test_equal_to_brute_force(spark):
    for seed, size, bits in ((1, 50, 26), (2, 12, 26), (3, 12, 6)):
        rows = corpus(random.Random(seed), size)
        df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, pos long, starts string").repartition(5)
        got = sorted((tuple(r) for r in substring.digests(substring.remove_repeated(df, size, bits)).collect()), key=repr)
        assert got == brute(rows, size)


def test_empty_table(spark):
    assert substring.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).collect() == []

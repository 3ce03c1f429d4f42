import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidegrain.llm import phrases


def brute(rows, least, longest, top, inside):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(w[i : i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= inside * counts[q := p[i : i + m]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((lang, " ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], s))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def corpus(seed, docs=90):
    rng = random.Random(seed)
    vocab = [f"{c}{i}" for i in range(12) for c in ("A", "bé", "c\x01", "d!e", "\xa0f")]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    fixed = [rng.choices(vocab, k=rng.randrange(2, 8)) for _ in range(8)]
    out = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(25)):
            parts += [" ".join(rng.choices(vocab, weights, k=rng.randrange(6)) + rng.choice(fixed)), rng.choice([" ", "  ", "\t", ".", "; ", "\r\n", "\x0b", "!?"])]
        out.append((rng.choice(["x", "x", "x", "y", None, "und", ""]), "".join(parts)))
    return out + [("x", None), ("x", ""), (None, " \t . "), ("x", "aa " * 2000), ("y", "Aa bb, " * 300), ("z", "one"), out[0], out[0], out[0]]


@pytest.mark.parametrize("least, longest, top, inside, most_words, burst, entries", [
    (10, 5, 40, 100, 500_000, 4096, 300_000), (5, 5, 2000, 80, 500_000, 5, 60), (8, 5, 30, 100, 9, 4096, 300_000), (6, 3, 2000, 100, 0, 8, 100), (6, 2, 25, 100, 500_000, 8, 100), (6, 6, 25, 100, 20, 8, 100)])
def test_equal_to_brute_force(spark, least, longest, top, inside, most_words, burst, entries):
    rows = corpus(least)
    df = spark.createDataFrame([(g, t, 1, "w") for g, t in rows], "lang string, text string, id int, word string").repartition(4)
    got = phrases.collocations(df, least, longest, top, inside, most_words, burst, entries)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, longest, top, inside)
    assert len(want) > 20 and sorted(tuple(r) for r in got.collect()) == want


def test_small_batches_do_not_change_counts(spark):
    """Phrases on the borders of scanned batches are summed up with their other parts."""
    rows = corpus(3)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(tuple(r) for r in phrases.collocations(df, 10, 5, 2000, 100).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == brute(rows, 10, 5, 2000, 100)


def test_trie_bursts_and_spills():
    rng = np.random.default_rng(2)
    trie, want, got = phrases.HatTrie(5, burst=20, entries=200), Counter(), Counter()
    for _ in range(30):
        ids = rng.integers(0, 9, 400).astype(np.int32)
        rows = phrases.windows(ids, 390, 5)
        want.update(map(tuple, rows.tolist()))
        trie.add(rows)
        assert trie.size == sum(len(c) if isinstance(c, Counter) else sum(map(len, c.values())) for c in trie.root.values())
        if trie.size > trie.entries:
            for keys, counts in trie.spill(trie.entries // 2):
                assert keys.tolist() == sorted(keys.tolist()) and trie.size <= trie.entries // 2
                got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist())))
    assert any(not isinstance(c, Counter) for c in trie.root.values())
    for keys, counts in trie.spill(0):
        got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist())))
    assert got == want and not trie.root and trie.size == 0


def test_pair_filter_ends_windows(spark):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(1, 40, (200, 2))})
    keep = phrases.PairFilter.of(spark.createDataFrame([(a << 32 | b,) for a, b in pairs], "k1 long").repartition(3))
    assert keep.holds(np.array([a << 32 | b for a, b in pairs])).all()
    others = np.array([a << 32 | b for a in range(40, 140) for b in range(1, 100)])
    assert keep.holds(others).mean() < 0.05
    ids = rng.integers(0, 40, 900).astype(np.int32)
    want = []
    for i in range(890):
        w = [int(ids[i])]
        while len(w) < 4 and ids[i + len(w)] and w[-1] and keep.holds(np.array([w[-1] << 32 | int(ids[i + len(w)])]))[0]:
            w.append(int(ids[i + len(w)]))
        if len(w) > 2:
            want.append(w + [0] * (4 - len(w)))
    assert phrases.windows(ids, 890, 4, keep).tolist() == want and want
    assert not phrases.PairFilter.of(spark.createDataFrame([], "k1 long")).holds(others).any()


def test_long_texts_are_cut_between_words(monkeypatch):
    data = b"one two  three\nfour five six\n\nseven"
    for most in (1, 4, 9, 100):
        parts = list(phrases.segments(data, most))
        assert b"".join(parts) == data and [w for p in parts for w in p.split()] == data.split()


def test_exact_score_beyond_64_bits(spark):
    one = spark.range(1).selectExpr("400000000000L AS a", "30000000000000L AS n", "500000000000L AS l", "400000000001L AS r")
    got = one.selectExpr("CAST(1000 * a AS DECIMAL(18)) * CAST(n AS DECIMAL(18)) div (CAST(l AS DECIMAL(18)) * CAST(r AS DECIMAL(18))) AS s").first()["s"]
    assert got == 1000 * 400000000000 * 30000000000000 // (500000000000 * 400000000001)


def test_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []

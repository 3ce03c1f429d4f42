import math
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegrain.llm import interpolation as lm
from tidegrain.llm.common import crc_mod

SCHEMA = "doc_id long, text string, role string, block string"


def fixture(seed=1):
    rng = random.Random(seed)
    follow = {w: rng.choices("abcdefghij", k=2) for w in "abcdefghij"}
    rows = []
    for i in range(150):
        w, out = rng.choice("abcdefghij"), []
        for _ in range(rng.choice([0, 1, 5, 60])):
            out.append(w.upper() if rng.random() < 0.2 else w)
            w = rng.choice(follow.get(w, "abc")) if rng.random() < 0.9 else f"é{rng.randrange(500)}"
        rows.append((i, rng.choice([" ", "\n ", "\t"]).join(out)))
    return rows + [(900, None), (901, ""), (902, " \x0b"), (None, "a b"), (7, "a b c"), (7, "a b c"), (903, "a b " * 20_000), (904, "never seen words é here")]


def crc(i, n):
    import zlib

    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def words(t):
    return [w.lower().decode() for w in (t or "").encode().split()] + [None]


def brute(rows, weights):
    train = [words(t) for i, t in rows if crc(i, 7) != 2]
    uni, bi = Counter(w for d in train for w in d), Counter(p for d in train for p in zip(["<s>", *d], d))
    context = uni | {"<s>": len(train)}
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, t in rows:
        d, base, score = words(t), 0.0, 0.0
        for a, b in zip(["<s>", *d], d):
            base += math.log10((uni[b] + 1) / (n + v + 1))
            c = context.get(a, 0)
            w = weights[min(c.bit_length(), lm.BUCKETS - 1)]
            score += math.log10(w[0] / (v + 1) + w[1] * uni[b] / n + (w[2] * bi[a, b] / c if c else 0))
        out.append((i, len(d), sum(uni[w] > 0 for w in d), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def brute_cells(rows):
    train = [(words(t), crc(i, 7) == 6) for i, t in rows if crc(i, 7) != 2]
    uni, bi = Counter(w for d, x in train if not x for w in d), Counter(p for d, x in train if not x for p in zip(["<s>", *d], d))
    texts, n = sum(not x for _, x in train), sum(uni.values())
    out = Counter()
    for d, x in train:
        for a, b in zip(["<s>", *d], d) if x else ():
            c = texts if a == "<s>" else uni[a]
            out[min(c.bit_length(), lm.BUCKETS - 1), uni[b] / n, bi[a, b] / c if c else 0.0] += 1
    return out


@pytest.mark.parametrize("rows_per_block,request_tokens,bits", [(4096, 2_000_000, 2), (7, 50, 4)])
def test_equal_to_brute_force(spark, tmp_path, monkeypatch, rows_per_block, request_tokens, bits):
    monkeypatch.setattr(lm, "BLOCK_ROWS", rows_per_block)
    seen = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: seen.update(args=a, weights=learn(*a)) or seen["weights"])
    spark.createDataFrame([(i, t, "r", "b") for i, t in fixture()], SCHEMA).repartition(3).write.parquet(str(tmp_path / "in"))
    got = lm.score(spark, str(tmp_path / "in"), crc_mod("doc_id", 7) != 2, crc_mod("doc_id", 7) == 6, bits).collect()
    assert sorted(((*r[:4], round(r[4], 6), round(r[5], 6)) for r in got), key=repr) == brute(fixture(), seen["weights"])
    cell, n = seen["args"][:2]
    want = Counter()
    for (bucket, f1, f2), k in brute_cells(fixture()).items():
        q = [0 if not f else round(-math.log2(f) * lm.STEPS) + 1 for f in (f1, f2)]
        want[(bucket * (lm.OCTAVES * lm.STEPS + 1) + q[0]) * (lm.OCTAVES * lm.STEPS + 1) + q[1]] += k
    assert dict(zip(cell.tolist(), n.tolist())) == want


def test_em_raises_the_likelihood_and_weights_add_up():
    rng = np.random.default_rng(1)
    base = lm.OCTAVES * lm.STEPS + 1
    cell = np.unique((rng.integers(0, 9, 400) * base + rng.integers(0, 90, 400)) * base + rng.integers(0, 60, 400))
    n = rng.integers(1, 50, len(cell)).astype(float)

    def fit(rounds, monkey=pytest.MonkeyPatch):
        with monkey.context() as m:
            m.setattr(lm, "EM_ROUNDS", rounds)
            w = lm.learn_weights(cell, n, 1e-3, True)
        f = np.stack([np.full(len(cell), 1e-3), *(np.where(q > 0, 2.0 ** (-(q - 1) / lm.STEPS), 0) for q in (cell // base % base, cell % base))], axis=1)
        seen = cell // base // base > 0
        return w, (n * np.log((w[cell // base // base] * f).sum(axis=1)))[seen].sum()

    fits = [fit(k)[1] for k in (1, 3, 10, 30)]
    assert fits == sorted(fits)
    w, _ = fit(30)
    assert np.allclose(w.sum(axis=1), 1) and (w[:, 0] > 0).all() and w[0, 2] == 0


def test_packing():
    x = np.array([0, 1, 255, 256, 2**64 - 1], np.uint64)
    assert (lm.unpack(lm.pack(x)) == x).all() and len(lm.unpack(b"")) == 0


def test_beats_the_base_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.001/documents.parquet"
    rows = lm.score(spark, folder, crc_mod("doc_id", 7) != 2, crc_mod("doc_id", 7) == 6).collect()
    held = [r for r in rows if crc(r["doc_id"], 7) == 2]
    assert len(held) > 10 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_empty_and_untrained_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none"))
    assert lm.score(spark, str(tmp_path / "none"), F.lit(True), F.lit(False)).collect() == []
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "few"))
    assert {tuple(r)[1:] for r in lm.score(spark, str(tmp_path / "few"), F.lit(False), F.lit(False)).collect()} == {(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)}
    got = lm.score(spark, str(tmp_path / "few"), F.lit(True), F.lit(False)).collect()
    assert all(math.isfinite(r["score"]) and r["n_known"] == r["n_tokens"] for r in got)


def test_tokens_of_a_slice_are_those_of_each_text():
    long = "x" * (lm.LONG - 1)
    parts = ["a", "A", "a\0", "\0", "ab", "é", "É", "12345678", "123456789", "1234567812345678", long, long + "y", long + "yz", long + "zz", "\x1c", "\x85", " ", "\x0b\x0c", "\t\n\r "]
    rng = random.Random(3)
    texts = ["a", "b", None, "", " ", "a", *("".join(rng.choices(parts, k=rng.randrange(9))) + " " * rng.randrange(2) + "".join(rng.choices(parts, k=3)) for _ in range(300))]
    column = pa.array(texts).slice(1)
    x, first = lm.tokens(column)
    seen = {}
    for text, a, b in zip(column.to_pylist(), first, first[1:]):
        marks = ["<s>", *words(text)]
        assert b - a == len(marks)
        assert [seen.setdefault(w, h) for w, h in zip(marks, x[a:b].tolist())] == x[a:b].tolist()
    assert len(set(seen.values())) == len(seen) > 300
    one, two, at = lm.ngrams(column)
    for n, a, b, c, d in zip(range(len(column)), first, first[1:], at, at[1:]):
        alone = lm.ngrams(column.slice(n, 1))
        assert d - c == b - a - 1 and (one[c:d] == alone[0]).all() and (two[c:d] == alone[1]).all()
    assert [len(v) for v in lm.ngrams(pa.array([], pa.string()))] == [0, 0, 1] and [len(v) for v in lm.ngrams(pa.array([None], pa.string()))] == [1, 1, 2]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_places(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, n, np.uint64, endpoint=False) if n != 2 else np.array([0, 2**64 - 1], np.uint64))
    wanted = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), rng.integers(0, 2**64, 99, np.uint64, endpoint=False), np.array([0, 2**64 - 1], np.uint64)])
    at, hit = lm.Places(keys).of(wanted)
    assert (hit == np.isin(wanted, keys)).all() and (keys[at[hit]] == wanted[hit]).all()


def test_requests_cost_a_few_times_the_splitting():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.1, 500) % 1_000_000) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "role": pa.array(np.arange(2000) % 3, pa.int32()), "block": pa.array(np.full(2000, 5))})

    class Table:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            return run

    def least(work):
        spent = []
        for _ in range(3):
            start = time.process_time()
            work()
            spent.append(time.process_time() - start)
        return min(spent)

    run = lm.requests(Table(), 4)
    cost, split = least(lambda: list(run([batch]))), least(lambda: [t.encode().lower().split() for t in texts])
    assert cost < 11 * split, (cost, split)  # some 5 times; 22 with a look-up per word and distinct values by a hash table

import hashlib
import random
import re

from tidegrain.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, size):
    wins = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + size]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, ids = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[x]
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def fixture(seed, short):
    rng = random.Random(seed)
    vocab = [f"w{i}É" for i in range(60)] + ["the", "of", "42"]
    some = lambda n: rng.choices(vocab, k=n)
    items = [(i, " ".join(some(rng.choice([13, 14, 30])))) for i in range(12)]
    items += [(50, items[0][1]), (None, items[1][1].upper()), (51, ""), (52, None), (53, " ".join(["the"] * 20))]
    if short:
        items += [(60, "Solo"), (61, "two words"), (62, "three short words"), (63, " ".join(some(9)))]
    docs = []
    for i in range(50):
        w = some(rng.choice([0, 5, 40, 300]))
        for _ in range(rng.randrange(3)):
            x = (rng.choice(items)[1] or "").split()
            w += x[rng.randrange(3) :] + some(rng.randrange(4))
        docs.append((i, rng.choice([" ", ", ", "-", "\n"]).join(w)))
    docs += [(100, None), (101, ""), (102, "!!!"), (None, items[2][1]), (None, items[3][1]), (7, items[4][1]), (7, items[4][1]), (103, "the " * 500), (104, "x " * 40_000 + items[5][1])]
    return docs, items


def test_equal_to_brute_force(spark):
    for seed, short, size in ((1, False, 13), (2, True, 13), (3, True, 4)):
        docs, items = fixture(seed, short)
        d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, pos int").repartition(4)
        b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, window string")
        got = sorted((tuple(r) for r in contamination.digests(contamination.decontaminate(d, b, size)).collect()), key=repr)
        assert got == brute(docs, items, size)


def test_passes_over_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(contamination, "SHINGLES_AT_ONCE", 40)
    docs, items = fixture(4, True)
    got = contamination.digests(contamination.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, 13)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert contamination.decontaminate(d.limit(0), b).collect() == []
    assert [tuple(r) for r in contamination.decontaminate(d, b.limit(0)).drop("text_key").collect()] == [(1, 2, 0, 0, [], False)]


def test_no_python_in_the_plan(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert "Python" not in contamination.decontaminate(d, b)._jdf.queryExecution().executedPlan().toString()


def test_keep_clean(spark):
    docs, items = fixture(5, True)
    d, b = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, dirty_key int"), spark.createDataFrame(items, "item_id long, text string")
    kept = contamination.keep_clean(d, b)
    assert kept.schema == d.schema
    dirty = [r[5] for x in docs for r in brute([x], items, 13)]
    assert any(dirty) and sorted(map(repr, kept.collect())) == sorted(repr(r) for r, bad in zip(d.collect(), dirty) if not bad)

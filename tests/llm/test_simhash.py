import random

import numpy as np
import xxhash

from tidegrain.llm import simhash
from tidegrain.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, near):
    """{key: smallest reachable} by plain search; items: {key: value}."""
    left, out = set(items), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            k = todo.pop()
            seen.add(k)
            hits = {o for o in left if near(items[k], items[o])}
            left -= hits
            todo += hits
        out |= {k: min(seen) for k in seen}
    return out


def test_code_covers_every_word():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    a = simhash.covering(x)
    assert np.bitwise_count(a ^ x).max() <= 7
    assert (simhash.covering(a) == a).all()


def test_pairs_within_threshold_share_an_anchor(spark):
    rng = random.Random(2)
    for t in (1, 2, 3):
        for _ in range(20):
            a = rng.getrandbits(64)
            b = a
            for i in rng.sample(range(64), t):
                b ^= 1 << i
            signed = [int(np.array([v], np.uint64).view(np.int64)[0]) for v in (a, b)]
            if _ == 0:
                rows = simhash.anchors(spark.createDataFrame([(v,) for v in signed], "fp long"), t).collect()
                sets = [{r["anchor"] for r in rows if r["fp"] == v} for v in signed]
                assert sets[0] & sets[1]


def test_forest_joins_all_and_is_a_forest():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(5)]
    values = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(30)})
    links = simhash.forest(np.array(values, np.uint64), 2)
    want = brute_components({v: v for v in values}, lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(links) == len(values) - len(set(want.values()))
    assert all((a ^ b).bit_count() <= 2 for a, b in links)


def test_links_with_split_anchors_lose_none(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    values = {base}
    while len(values) < 120:
        v = rng.choice(sorted(values))
        values.add(v ^ 1 << rng.randrange(64))
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = {int(np.array([v], np.uint64).view(np.int64)[0]): v for v in values}
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = brute_components(signed, lambda a, b: (a ^ b).bit_count() <= 2)
    for piece in (4096, 8):
        rows = connected_components(simhash.links(fps, 2, piece)).collect()
        got = {r["node"]: r["root"] for r in rows}
        assert {k: got.get(k, k) for k in signed} == want


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4), (5, 4), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"W{i}é" for i in range(300)]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 40, 400]))) for _ in range(25)]
    texts += [t + " tail" for t in texts[:8]] + [t.upper() for t in texts[:4]] + ["", None, " \t\n", "x" * 50_000, "a b", "A  B"]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "lonely row"), (5_000, texts[0]), (5_000, texts[0])]
    df = spark.createDataFrame([(i, t, "x", t) for i, t in rows], "doc_id long, text string, fp string, component_id string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=repr)
    prints = {k: brute_fingerprint(t) for k, (i, t) in enumerate(rows)}
    comp = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for k, c in comp.items():
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    assert got == sorted(((i, f"{prints[k]:016x}", least.get(comp[k])) for k, (i, t) in enumerate(rows)), key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_one_of_each_group(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:6])] + [(3, texts[3]), (3, texts[4]), (None, texts[5]), (None, "nobody"), (None, "Nobody"), (200, None), (201, "")]
    df = spark.createDataFrame([(i, t, 7, "s") for i, t in rows], "doc_id long, text string, keep_fp int, keep_root string")
    kept = simhash.keep_one(df)
    assert kept.schema == df.schema
    prints = {k: brute_fingerprint(t) for k, (i, t) in enumerate(rows)}
    comp = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    want = {}
    for k, c in comp.items():
        want[c] = min(want.get(c, (True, 0)), (rows[k][0] is None, rows[k][0] or 0))
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(repr, got)) == sorted(repr(None if none else i) for none, i in want.values())

import random

from pyspark.sql import functions as F

from tidegrain.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, first string, target string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, s, "a", "b", "c") for i, t, s in rows], SCHEMA).repartition(parts)


def fixture(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "Z", "é", None])
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(["w"] * rng.choice([0, 1, 7, 50, 300])), source))
    return rows + [(900, None, "a"), (901, "", "only-empty"), (None, "x y z", "b"), (None, "x y z", "b"), (7, "a b", "c"), (902, "long " * 20_000, "long"), (903, "tiny", "tiny")]


def brute_targets(rows, weights=(5, 2, 1), most=3):
    """Share by weight; what is above the limit is shared again by weight among the rest."""
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    got, left, open_ = dict.fromkeys(order, 0.0), float(sum(size.values())), [s for s in order if size[s]]
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        share, left = left, 0.0
        for s in list(open_):
            got[s] += share * w[s] / total
        for s in list(open_):
            if got[s] >= most * size[s]:
                left += got[s] - most * size[s]
                got[s] = float(most * size[s])
                open_.remove(s)
    return size, got


def test_targets_and_words_taken(spark):
    for seed, block in ((1, 64), (2, 7), (3, 4096)):
        rows = fixture(seed)
        out = mixing.shares(frame(spark, rows), block=block).collect()
        size, target = brute_targets(rows)
        assert sorted((r["doc_id"], r["size"]) for r in out if r["doc_id"] is not None) == sorted((i, len((t or "").split())) for i, t, _ in rows if i is not None)
        assert sum(r["doc_id"] is None for r in out) == 2
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
        by = {}
        for r in out:
            by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
        for (n, t), taken in by.items():
            near = [s for s in size if size[s] == n and abs(target[s] - t) < 1e-6 * max(1, t)]
            assert near and abs(sum(taken) - t * len(near)) <= len(near)
        again = mixing.shares(frame(spark, rows[::-1], 7), block=block).collect()
        assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_schedule_is_even_and_takes_blocks_in_turn(spark):
    rows = [(i, "w " * 40, f"s{i % 3}") for i in range(900)]
    placed, sources, mixture = mixing.mixed(frame(spark, rows), block=40)
    slots = [r["sid"] for r in mixing.schedule(sources, 40).orderBy("slot").collect()]
    quota = {r["sid"]: r["quota"] / 36_000 for r in sources.collect()}
    for n in (50, 200, 500, 900):
        for s, q in quota.items():
            assert abs(slots[:n].count(s) - q * n) <= 4
    per_slot = mixture.groupBy("slot").agg(F.sum("words").alias("n")).collect()
    assert sum(r["n"] for r in per_slot) == sum(r["quota"] for r in sources.collect())
    assert sum(r["n"] != 40 for r in per_slot) <= 3
    words = mixture.groupBy("sid", "pass", "doc_id").agg(F.sum("words").alias("n")).agg(F.max("n")).first()[0]
    assert words <= 40


def test_slot_chunks_do_not_change_ranks(spark, monkeypatch):
    rows = fixture(4)
    want = sorted(map(repr, mixing.shares(frame(spark, rows), block=5).collect()))
    monkeypatch.setattr(mixing, "SLOT_CHUNK", 16)
    assert sorted(map(repr, mixing.shares(frame(spark, rows), block=5).collect())) == want


def test_draw_repeats_documents(spark):
    rows = fixture(5)
    docs = frame(spark, rows)
    drawn = mixing.draw(docs, block=16)
    assert drawn.schema == docs.schema
    full = mixing.mixed(docs, block=16)[2].where("offset = 0").count()
    got = drawn.collect()
    assert len(got) == full
    texts = {}
    for i, t, s in rows:
        texts.setdefault((i, s), set()).add(t)
    assert all(r["text"] in texts[(r["doc_id"], r["source"])] for r in got)
    most = {}
    for r in got:
        k = (r["doc_id"], r["source"], r["text"])
        most[k] = most.get(k, 0) + 1
    assert all(n <= 3 * sum((i, s, t) == k for i, t, s in rows) for k, n in most.items())


def test_empty_tables(spark):
    docs = frame(spark, fixture()).limit(0)
    assert mixing.shares(docs).collect() == [] and mixing.draw(docs).collect() == []
    blank = frame(spark, [(1, None, "a"), (2, " ", None)])
    assert sorted((r["doc_id"], r["size"], r["taken"], r["target"]) for r in mixing.shares(blank).collect()) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
    assert mixing.draw(blank).collect() == []


def test_draw_with_clashing_column_names(spark):
    rows = fixture(5)
    docs = frame(spark, rows)
    extra = docs
    for name in ("mix_words", "mix_time", "mix_no", "copies", "first", "n", "mix_id", "sid", "size"):
        extra = extra.withColumn(name, F.lit(name))
    drawn = mixing.draw(extra, block=16)
    assert drawn.schema == extra.schema
    key = ["doc_id", "text", "source"]
    assert sorted(map(repr, drawn.select(*key).collect())) == sorted(map(repr, mixing.draw(docs, block=16).select(*key).collect()))
    assert drawn.where("copies <> 'copies' OR mix_time <> 'mix_time'").count() == 0

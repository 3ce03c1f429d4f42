import hashlib
import os
import random

from pyspark.sql import functions as F

from tidegrain.llm import exact_stream

SCHEMA = "doc_id long, text string, digest string, file string"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for text, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        flags = [i == best for i in ids]
        flags = [f and k == flags.index(True) for k, f in enumerate(flags)]
        out += [(i, best, len(ids), f, hashlib.sha256(text.encode()).hexdigest()) for i, f in zip(ids, flags)]
    return sorted(out, key=repr)


def rows():
    rng = random.Random(7)
    texts = ["", None, "A", "a", "É", "é", "x y", "X Y", "x  y", "İ", "i̇", "long " * 30_000, "LONG " * 30_000, "hot"]
    return [(i, rng.choice(texts)) for i in range(80)] + [(i, "hot") for i in range(200, 300)] + [(5, "twin"), (5, "twin"), (5, "Twin"), (None, "twin"), (None, "nobody"), (None, "NOBODY")]


def save(spark, path, data, files=4):
    spark.createDataFrame([(i, t, "d", "f") for i, t in data], SCHEMA).repartition(files).write.parquet(path)


def test_equal_to_brute_force_in_several_batches(spark, tmp_path):
    save(spark, str(tmp_path / "in"), rows())
    for at_once in (None, 1):
        got = sorted((tuple(r) for r in exact_stream.deduplicate(spark, str(tmp_path / "in"), files_at_once=at_once).collect()), key=repr)
        assert got == brute(rows())


def test_colliding_digests_are_separated_by_bytes(spark, tmp_path):
    save(spark, str(tmp_path / "in"), rows())
    for weak in (lambda t: F.lit("same"), lambda t: F.substring(F.sha2(t, 256), 1, 1)):
        got = sorted((tuple(r) for r in exact_stream.deduplicate(spark, str(tmp_path / "in"), weak).collect()), key=repr)
        assert got == brute(rows())


def test_state_grows_with_new_files(spark, tmp_path):
    folder, state = str(tmp_path / "in"), f"file://{tmp_path}/state"
    first, second = rows()[:60], rows()[60:]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(folder)
    assert sorted(map(repr, map(tuple, exact_stream.deduplicate(spark, folder, checkpoint=state).collect()))) == sorted(map(repr, brute(first)))
    spark.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(folder)
    assert sorted(map(repr, map(tuple, exact_stream.deduplicate(spark, folder, checkpoint=state).collect()))) == sorted(map(repr, brute(first + second)))


def test_new_files_with_old_modification_times_are_read(spark, tmp_path):
    folder, state = tmp_path / "in", f"file://{tmp_path}/state"
    first, second = rows()[:60], rows()[60:]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(str(folder))
    exact_stream.deduplicate(spark, str(folder), checkpoint=state).count()
    seen = set(folder.glob("*.parquet"))
    spark.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(str(folder))
    for path in set(folder.glob("*.parquet")) - seen:
        os.utime(path, (1_000_000_000, 1_000_000_000))
    got = exact_stream.deduplicate(spark, str(folder), checkpoint=state).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(first + second)))


def test_single_file_and_empty_table(spark, tmp_path):
    save(spark, str(tmp_path / "in"), rows(), 1)
    (part,) = (tmp_path / "in").glob("*.parquet")
    assert sorted((tuple(r) for r in exact_stream.deduplicate(spark, str(part)).collect()), key=repr) == brute(rows())
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "empty"))
    assert exact_stream.deduplicate(spark, str(tmp_path / "empty")).collect() == []

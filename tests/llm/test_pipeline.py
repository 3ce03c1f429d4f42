import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import test_contamination  # noqa: E402
import test_simhash  # noqa: E402
from tidegrain.llm import mixing  # noqa: E402
from tidegrain.llm.queries import TOKENIZER  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, read from Parquet."""
    base, docs, out = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(base / name))
        after = spark.read.parquet(str(base / name))
        out[name] = (docs, after)
        docs = after
    return out


def test_columns_are_kept(steps):
    for name, (before, after) in list(steps.items())[:-1]:
        assert [(f.name, f.dataType) for f in before.schema] == [(f.name, f.dataType) for f in after.schema], name


def test_language_stage_keeps_documents_with_letters(steps):
    before, after = steps["language_id"]
    kept = {r["doc_id"] for r in after.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in before.collect()}
    assert all(any(c.isalpha() for c in texts[i]) for i in kept)
    assert len(kept) >= 0.95 * sum(any(c.isalpha() for c in t) for t in texts.values())


def test_near_dedup_stage(steps):
    before, after = steps["simhash_near_dedup"]
    prints = {r["doc_id"]: test_simhash.brute_fingerprint(r["text"]) for r in before.collect()}
    comp = test_simhash.brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(comp.values()))


def test_decontamination_stage(spark, steps):
    before, after = steps["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    judged = test_contamination.brute([(r["doc_id"], r["text"]) for r in before.collect()], items, 13)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r[0] for r in judged if not r[5])


def test_mixing_stage(steps):
    before, after = steps["mix_sources"]
    starts = mixing.mixed(before)[2].where("offset = 0").groupBy("doc_id").count().collect()
    assert Counter(r["doc_id"] for r in after.collect()) == {r["doc_id"]: r["count"] for r in starts}
    size = {r["doc_id"]: (r["source"], len((r["text"] or "").split())) for r in before.collect()}
    target = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(before)).collect()}
    got = Counter()
    for r in after.collect():
        got[r["source"]] += size[r["doc_id"]][1]
    largest = max(n for _, n in size.values())
    assert all(abs(got[s] - t) <= 2 * largest for s, t in target.items())


def test_token_stage(spark, steps):
    before, after = steps["token_output"]
    tokenizer, at = Tokenizer.from_file(TOKENIZER), 0
    rows = sorted(after.collect(), key=lambda r: r["start"])
    want = sorted(((r["doc_id"], r["text"] or "") for r in before.collect()), key=lambda x: x[0])
    assert [r["doc_id"] for r in rows] == [i for i, _ in want]
    for r, (_, text) in zip(rows, want):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_run_gives_the_same_rows(spark, steps):
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(steps["token_output"][1].collect())

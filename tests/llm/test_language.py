import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrain.llm import language
from tidegrain.llm.common import crc_mod

WORDS = {"aa": "kato mira solun peka", "bb": "drixt vorgh quzz thrum", "cc": "éloïse çavà ünde ärger"}
SCHEMA = "doc_id long, text string, lang string, lang_pred string, lang_score int"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", ",", "."]) for _ in range(n))


def fixture():
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.choice([1, 5, 80])), lang) for i, lang in enumerate(rng.choices(sorted(WORDS), k=150))]
    return rows + [(500, None, "aa"), (501, "", "bb"), (502, "123 !!! 45", "cc"), (503, "×÷€", None), (None, prose(rng, "bb", 9), None), (504, prose(rng, "aa", 30_000), None),
                   (505, prose(rng, "aa", 70) + " " + prose(rng, "bb", 30), None), (506, prose(rng, "cc", 3), None), (506, prose(rng, "cc", 3), None)]


def brute_em(texts, langs, model, text):
    """Proportions over all languages by plain loops."""
    words = []
    data = [0] + [int(language.FOLD[b]) for b in text.encode()] + [0]
    word = []
    for c in data:
        if c:
            word.append(c)
        elif word:
            logs = np.zeros(len(langs))
            padded = [0, 0, *word, 0]
            for a, b, d in zip(padded, padded[1:], padded[2:]):
                gram = (d | b << 8 | (a if b else 0) << 16) * 0x9E3779B1 % 2**32 >> 16
                logs += model[gram]
            words.append(np.exp(np.maximum(logs - logs.max(), -80)))
            word = []
    share = np.full(len(langs), 1 / len(langs))
    for _ in range(language.ROUNDS):
        share = np.mean([w * share / (w * share).sum() for w in words], axis=0)
    return share


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in fixture()], SCHEMA).repartition(3)
    return docs, *language.learn(docs, crc_mod("doc_id", 3) != 1)


def test_counts_cover_all_training_rows(spark, learned):
    docs, langs, model = learned
    assert langs == ["aa", "bb", "cc"]
    rows = docs.where(crc_mod("doc_id", 3) != 1).where("lang = 'bb'").select("text").collect()
    cells, _, _ = language.trigrams([(r["text"] or "").encode() for r in rows])
    n = np.bincount(cells, minlength=1 << 16) + language.ALPHA
    assert np.allclose(model[:, 1], np.log(n / n.sum()), atol=1e-5)


def test_full_mixture_equals_plain_loops(learned):
    _, langs, model = learned
    texts = [t for _, t, _ in fixture() if t and language.has_letter(t)][:40]
    cells, first, bounds = language.trigrams([t.encode() for t in texts])
    logs = np.add.reduceat(model[cells], first, axis=0).astype(float)
    like = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -80))
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    share, _ = language._em(like, doc, bounds[:-1], bounds[1:], np.ones((len(texts), 3), bool))
    for k, t in enumerate(texts):
        assert np.allclose(share[k], brute_em(texts, langs, model, t), atol=1e-4)


def test_predictions_and_language_sets(spark, learned):
    docs, langs, model = learned
    rows = language.identify(docs, crc_mod("doc_id", 3) != 1).collect()
    assert len(rows) == len(fixture())
    got = {r["doc_id"]: r for r in rows}
    for i, _, lang in fixture()[:150]:
        assert got[i]["lang_pred"] == lang and got[i]["score"] > 0.99
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (500, 501, 502, 503))
    assert got[None]["lang_pred"] == "bb" and got[504]["lang_shares"] == {"aa": 1.0}
    assert set(got[505]["lang_shares"]) == {"aa", "bb"} and abs(got[505]["score"] - 0.7) < 0.02
    kept = language.keep_identified(docs, crc_mod("doc_id", 3) != 1)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == set(got) - {500, 501, 502, 503}


def test_empty_and_unlearnable_tables(spark, learned):
    docs = learned[0]
    assert language.identify(docs.limit(0), F.lit(True)).collect() == []
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs, F.lit(False)).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = crc_mod("doc_id", 3) == 1
    rows = language.identify(docs, ~held).join(docs.where(held).select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97


def test_numerals_are_no_letters(spark, learned):
    _, langs, model = learned
    docs = spark.createDataFrame([(1, "½ ²"), (2, "①"), (3, "Ⅷ 12"), (4, "½ ñ")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, langs, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] != "und"


def test_the_best_nested_set_is_chosen():
    """Every nested set is compared, also behind one that is worse than its predecessor."""
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list(a), 6)) for a in rng.choice(["abcd", "efgh", "ijkl"], n)).encode() for n in (3, 9, 40, 200)]
    model = np.full((1 << language.CELL_BITS, 3), language.ALPHA)
    for k, a in enumerate(("abcd", "efgh", "ijkl")):
        cells, _, _ = language.trigrams([" ".join("".join(rng.choice(list(a), 6)) for _ in range(3000)).encode()])
        np.add.at(model[:, k], cells, 1)
    model = np.log(model / model.sum(axis=0)).astype(np.float32)
    got = language.proportions(texts, model)
    cells, first, bounds = language.trigrams(texts)
    for d, text in enumerate(texts):
        logs = np.add.reduceat(model[cells], first, axis=0).astype(float)[bounds[d] : bounds[d + 1]]
        like = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -80))
        one, n = np.zeros(len(like), int), len(like)
        ends = (np.array([0]), np.array([n]))
        order = np.argsort(-language._em(like, one, *ends, np.ones((1, 3), bool))[0][0], kind="stable")
        values = []
        for k in range(1, 4):
            share, fit = language._em(like, one, *ends, np.isin(np.arange(3), order[:k])[None])
            values.append((fit[0] - language.PENALTY * np.log(n + 1) * (k - 1), share[0]))
        assert np.allclose(got[d], max(values, key=lambda v: v[0])[1], atol=1e-6)

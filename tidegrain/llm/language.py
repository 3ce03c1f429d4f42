"""Languages of a document as a mixture: expectation-maximisation over n-gram likelihoods, the language set chosen by a penalty.

A language is a distribution over byte trigrams of lower-cased letters (with the blank at word ends), hashed to 2^16 cells and counted
over all training documents. A word's likelihood under a language is the product over its trigrams. A document's proportions
maximise the likelihood of its words under the mixture; of the nested sets (most frequent language, the two most frequent, ...)
the one with the best likelihood less a penalty per further language is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrain.llm.common import free_name, release, slices, texts_of, written

CELL_BITS = 16
#: Smoothing count per cell, EM rounds, and the penalty per further language as a multiple of log(words).
ALPHA, ROUNDS, PENALTY = 0.1, 12, 4.0
#: Bytes that count as letters: a-z, A-Z (as a-z) and all of multi-byte characters; the others are blanks (0).
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the trigrams of all words, the position of each word's first trigram, and the first word of each text (and the end)."""
    data = np.concatenate([FOLD[np.frombuffer(b"\x00".join([b"", b"", *texts, b""]), np.uint8)], np.zeros(1, np.uint8)])
    bounds = np.cumsum([2, *(len(t) + 1 for t in texts)])
    letter = data > 0
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    # trigrams end at a letter or at the blank behind a word
    ends = np.flatnonzero(letter[:-1] | np.concatenate([[False], letter[:-2]]))
    code = data.astype(np.uint32)
    grams = code[ends] | code[ends - 1] << np.uint32(8) | np.where(code[ends - 1] > 0, code[ends - 2], 0).astype(np.uint32) << np.uint32(16)
    cells = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)).astype(np.int64)
    return cells, np.searchsorted(ends, starts), np.searchsorted(starts, bounds)


def has_letter(text: str) -> bool:
    """Whether a text has a letter of any script; fractions, circled digits and Roman number signs are numerals, not letters."""
    return any(map(str.isalpha, text))


def learn(docs: DataFrame, training: Column) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and the log probabilities (cell, language), from all training rows with a language.

    The model holds 2^16 floats a language, whatever the corpus.
    """

    def run(batches):
        release()
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", 2 << 20):
            langs = batch.column("lang").to_pylist()
            texts = texts_of(batch.column("text"))
            for lang in dict.fromkeys(langs):
                cells, _, _ = trigrams([t for t, x in zip(texts, langs) if x == lang])
                counts[lang] = counts.get(lang, 0) + np.bincount(cells, minlength=1 << CELL_BITS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "cell", "n"])
            if not len(at):
                yield pa.RecordBatch.from_pydict({"lang": [lang], "cell": [0], "n": [0]})

    rows = docs.where(training & F.col("lang").isNotNull()).select("text", "lang")
    counts = rows.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = written(counts, "language-model").toPandas()
    langs = sorted(set(table["lang"]), key=str.encode)
    model = np.full((1 << CELL_BITS, len(langs)), ALPHA)
    np.add.at(model, (table["cell"].to_numpy(np.int64), table["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)), table["n"].to_numpy(float))
    return langs, np.log(model / model.sum(axis=0)).astype(np.float32)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows [start, end) of each span; an empty span gives zero."""
    if not len(values):
        return np.zeros((len(starts), *values.shape[1:]))
    out = np.add.reduceat(values, np.minimum(starts, len(values) - 1), axis=0)
    out[starts >= ends] = 0
    return out


def _em(likelihood: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each document over its ``allowed`` languages, and the log-likelihood of its words under them."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    words = np.maximum(ends - starts, 1)[:, None]
    for _ in range(ROUNDS):
        joint = likelihood * share[doc]
        joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
        share = np.where(allowed, _sums(joint, starts, ends) / words, 0)
        share = np.where(share.sum(axis=1, keepdims=True) > 0, share, allowed / allowed.sum(axis=1, keepdims=True))
    fit = np.log(np.maximum((likelihood * share[doc]).sum(axis=1), 1e-300))
    return share, _sums(fit, starts, ends)


def proportions(texts: list[bytes], model: np.ndarray) -> np.ndarray:
    """(document, language) proportions under the chosen language set; without words all zero."""
    cells, first, bounds = trigrams(texts)
    out = np.zeros((len(texts), model.shape[1]))
    if not len(first) or not model.shape[1]:
        return out
    logs = np.add.reduceat(model[cells], first, axis=0).astype(float)
    likelihood = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -80))
    starts, ends = bounds[:-1], bounds[1:]
    doc = np.repeat(np.arange(len(texts)), ends - starts)
    everything, _ = _em(likelihood, doc, starts, ends, np.ones_like(out, dtype=bool))
    rank = np.argsort(np.argsort(-everything, axis=1, kind="stable"), axis=1, kind="stable")
    best = np.full(len(texts), -np.inf)
    todo = np.flatnonzero(ends > starts)
    for n in range(1, model.shape[1] + 1):
        pick = np.concatenate([np.arange(starts[d], ends[d]) for d in todo]) if len(todo) < len(texts) else np.arange(len(doc))
        sizes = (ends - starts)[todo]
        to = np.cumsum(sizes)
        share, fit = _em(likelihood[pick], np.repeat(np.arange(len(todo)), sizes), to - sizes, to, rank[todo] < n)
        value = fit - PENALTY * np.log(sizes + 1) * (n - 1)
        better = value > best[todo]
        best[todo[better]] = value[better]
        out[todo[better]] = share[better]
        # a next language can only be worth its penalty in documents where the full mixture gives it some weight; a set that
        # is no better than the one before doesn't end the search
        todo = todo[(np.where(rank[todo] == n, everything[todo], 0).sum(axis=1) * (ends - starts)[todo]) > 0.5] if n < model.shape[1] else todo[:0]
        if not len(todo):
            break
    return out


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, names: tuple[str, str, str] = ("lang_pred", "lang_score", "lang_shares")) -> DataFrame:
    """The columns of ``docs`` and, under ``names``, prediction, its proportion and all proportions above zero (by language)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.MapType(T.StringType(), T.DoubleType()))))])
    at = docs.columns.index("text")

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        shares = proportions([(t or "").encode() for t in texts], shared.value)
        pred, score, parts = [], [], []
        for text, row in zip(texts, shares):
            if text and row.any() and has_letter(text):
                k = int(row.argmax())
                pred.append(langs[k])
                score.append(min(1.0, float(row[k])))
                parts.append([(langs[i], float(row[i])) for i in np.flatnonzero(row > 1e-6)])
            else:
                pred.append("und")
                score.append(0.0)
                parts.append([])
        new = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(parts, pa.map_(pa.string(), pa.float64()))]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    def run(batches):
        release()
        for part in slices(batches, "text", max(64 << 10, (4 << 20) // max(1, len(langs)))):
            yield build(part)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, training: Column) -> DataFrame:
    """(doc_id, lang_pred, score, lang_shares), one row per document; learned from the rows where ``training`` holds and lang is set.

    score is the proportion of lang_pred. Null texts, texts without a letter (numerals are none), and any text if nothing was learned, are ``und`` with
    score 0. Language, source and id are no inputs of a prediction. Rows with equal texts are predicted alike.
    """
    langs, model = learn(docs, training)
    return predict(docs.select("doc_id", "text"), langs, model).select("doc_id", "lang_pred", F.col("lang_score").alias("score"), "lang_shares")


def keep_identified(docs: DataFrame, training: Column, least: float = 0.0) -> DataFrame:
    """The documents whose prediction isn't ``und`` and has a proportion of ``least`` or more; by default mixtures without a majority stay."""
    langs, model = learn(docs, training)
    names = tuple(free_name(n, docs.columns) for n in ("lang_pred", "lang_score", "lang_shares"))
    found = predict(docs, langs, model, names)
    return found.where((F.col(names[0]) != "und") & (F.col(names[1]) >= least)).select(*docs.columns)

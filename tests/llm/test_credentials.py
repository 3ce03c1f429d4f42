import hashlib
import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from tidegrain.llm import credentials
from tidegrain.llm.queries import QUERIES

HEX, UPPER = "0123456789abcdef", string.ascii_uppercase + string.digits
SHAPES = {"assign": lambda r: "".join(r.choices(HEX, k=18)), "access": lambda r: "AKIA" + "".join(r.choices(UPPER, k=16)), "hex": lambda r: "".join(r.choices(HEX, k=40))}


def brute_base(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(credentials.KINDS[k], a, b) for a, k, b in sorted(out)]


def brute_score(automaton, s):
    state, total = 0, 0.0
    for c in s.encode():
        k = credentials.CREDENTIAL.index(c)
        total += automaton.logs[state, k]
        state = automaton.states[state, k] if automaton.states[state, k] >= 0 else state
    return total + automaton.ends[state]


def brute_spans(text, model):
    text = text or ""
    out = [(a, credentials.KINDS.index(k), b, k) for k, a, b in brute_base(text)]
    taken = [(a, b) for a, _, b, _ in out]
    for m in re.finditer("[A-Za-z0-9+/_.=-]{16,}", text):
        a, b = m.start(), m.end()
        if any(x < b and a < y for x, y in taken):
            continue
        while a < b and text[a] in "./_=+-":
            a += 1
        while a < b and text[b - 1] in "./_=+-":
            b -= 1
        if b - a < 16:
            continue
        s, best = text[a:b], (-math.inf, None)
        for kind, (automaton, least) in model.kinds.items():
            score = brute_score(automaton, s)
            if score > best[0] and score >= brute_score(model.text, s) + credentials.MARGIN and score / (len(s) + 1) >= least:
                best = score, kind
        if best[1]:
            out.append((a, 3 + credentials.KINDS.index(best[1]), b, "like_" + best[1]))
    return [(k, a, b) for a, _, b, k in sorted(out)]


def word(rng, least=2, most=24):
    return "".join(rng.choice(["th", "en", "ou", "ß", "tion", "er", "ie", "st", "an", "de"]) for _ in range(rng.randrange(least, most) // 2 + 1))


def texts(seed=1, n=220):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        parts = [word(rng) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            kind = rng.choice(list(SHAPES))
            s = SHAPES[kind](rng)
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([f"password={s}", f'Token : "{s}"', f"API_key='{s}'", s, s + ".", f"PassWD = {s[:5]}", "".join(rng.choices("0123456789", k=16))]))
        out.append(" ".join(parts))
    return out + ["ſecret=abcdef12 toKen=abcdef12", "secret: token: abcdef", "token=token=x", "token=ab", "api__key=abcdefg", "passwordpassword=abcdef", "password=" + "ab" * 9 + "é" + "0" * 24,
                  "AKIA" * 5, "AKIA" + "Z" * 15, "xAKIA" + "7" * 16 + "a", "f" * 23, "f" * 24, "éé" + "0f" * 15_000, "secret" + " " * 9000 + "=" + " " * 9000 + "'zzzzzz", "=" * 40, "token=\nabcdefgh"]


def test_base_spans_equal_the_patterns():
    for t in texts():
        kind, start, end, _ = credentials.base_spans(t.encode())
        at = {len(t[:i].encode()): i for i in range(len(t) + 1)}
        assert [(credentials.KINDS[k], at[a], at[b]) for k, a, b in zip(kind.tolist(), start.tolist(), end.tolist())] == brute_base(t)


def test_query_on_a_small_table(spark, tmp_path):
    docs = [(i, t) for i, t in enumerate(texts())] + [(900, None), (901, ""), (None, "secret=abcdef"), (902, "secret=abcdef"), (902, "secret=abcdef")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, spans string, n_hex int").repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    model = credentials.learn(credentials.labelled_sample(df))
    want = []
    for i, t in docs:
        spans = brute_spans(t, model)
        n, base = Counter(k for k, _, _ in spans), ",".join(f"{k}:{a}:{b}" for k, a, b in spans if not k.startswith("like"))
        want.append((i, n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
    got = QUERIES["op12_secret_scan"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == sorted(want, key=repr)
    assert sum("like_" in r[5] for r in rows) > 20


def test_automata_learn_formats():
    rng = random.Random(4)
    for kind, shape in SHAPES.items():
        automaton = credentials.infer([shape(rng).encode() for _ in range(600)])
        assert len(automaton.states) < 40
        good, bad = ([s.encode() for s in x] for x in ([shape(rng) for _ in range(100)], [word(rng, 16, 24).replace("ß", "s") for _ in range(100)]))
        good, bad = (automaton.scores(x) / np.array([len(s) + 1 for s in x]) for x in (good, bad))
        assert good.min() > bad.max() + 0.5, kind
    access = credentials.infer([SHAPES["access"](rng).encode() for _ in range(600)])
    first = np.argmax(access.logs[0])
    assert credentials.CREDENTIAL[first] == ord("A") and credentials.CREDENTIAL[np.argmax(access.logs[access.states[0, first]])] == ord("K")


def test_shares_of_a_state_sum_up_to_one():
    rng = random.Random(5)
    automaton = credentials.infer([SHAPES["hex"](rng)[: rng.randrange(1, 20)].encode() for _ in range(300)])
    assert np.allclose(np.exp(automaton.logs).sum(axis=1) + np.exp(automaton.ends), 1)
    assert credentials.infer([]).scores([b"", b"abc"]).shape == (2,)


def test_held_out_formats_and_clean_words(spark):
    """Values without a keyword are found by format, and words and digits are left alone."""
    rng = random.Random(7)
    train = [f"password={SHAPES['assign'](rng)} {word(rng)} key {SHAPES['access'](rng)} {word(rng, 16, 30)} {SHAPES['hex'](rng)} {''.join(rng.choices('0123456789', k=16))}" for _ in range(400)]
    model = credentials.learn(credentials.labelled_sample(spark.createDataFrame([(t,) for t in train], "text string")))
    hits = credentials.KINDS.index("assign") == model.judge([SHAPES["assign"](rng).encode() for _ in range(300)])[0]
    assert hits.mean() > 0.9
    clean = [word(rng, 16, 40).replace("ß", "ss").encode() for _ in range(500)] + ["".join(rng.choices("0123456789", k=16)).encode() for _ in range(300)]
    assert (model.judge([c for c in clean if len(c) >= 16])[0] >= 0).mean() < 0.01


@pytest.mark.parametrize("least", [1, 2, 3, 7, 16, 24])
def test_long_runs(least):
    rng = random.Random(least)
    data = "".join(rng.choice("ab ") for _ in range(500)) + "a" * 40 + " " + "b" * 24
    a, b = credentials.long_runs(np.frombuffer(data.encode(), np.uint8), b"ab", least)
    assert [(m.start(), m.end()) for m in re.finditer("[ab]+", data) if m.end() - m.start() >= least] == list(zip(a.tolist(), b.tolist()))
    assert credentials.long_runs(np.frombuffer(b"a", np.uint8), b"a", 9)[0].tolist() == []


def test_tables_without_labels(spark):
    assert credentials.find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "0123456789abcdefABC plain"), (2, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["spans"]) for r in credentials.find_secrets(df).collect()) == [(1, []), (2, [])]

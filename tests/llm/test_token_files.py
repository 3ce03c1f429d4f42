import random
import struct
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegrain.llm import common, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a\n\nb c", "it's we'll  'd", "été naïve", "x y z", "a  b", "a\x1c b", "a \x1fb", "1 22 333!!", "<|endoftext|>",
       "a <|endoftext|> b", "日本 語", "😀 😀", "tab\tx y", "end. ", " \n ", "a\x85 b", "​ a", "x" * 300 + " y", "don't won 't", "Hest*** the&&& l,'s x-'ll", "a_b-c\"d"]


def fixture():
    rng = random.Random(1)
    pieces = ODD + ["the", " of", ", ", ". ", "\n", "Wörter", "99"]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(80)] + [None, "long text " * 40_000]
    return [(i * 37 % 211, t) for i, t in enumerate(texts)] + [(3, "twin"), (3, "twin"), (None, "no id")]


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    return {(i, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens") / "out")
    token_files.write(spark.createDataFrame([(i, t, 1, "x") for i, t in fixture()], "doc_id long, text string, part int, ids string").repartition(5), folder, PATH)
    return folder


def test_cutting_at_spaces_changes_no_ids():
    encode, tokenizer = token_files.Encoder(PATH, 500), Tokenizer.from_file(PATH)
    rng = random.Random(2)
    for _ in range(2):
        texts = ODD + ["".join(rng.choices([" ", " ", "\n", "a", "'s", "B", "9", "!", ".", "é", "²", "ª", "\t", " ", "日", "x" * 70, "&&", "-", "'", "n'", "\"", "_", "ß,%"], k=30)) for _ in range(2000)]
        for t in texts:
            assert list(struct.unpack(f"<{len(encode(t)) // 4}i", encode(t))) == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_lists_of_a_slice_are_the_librarys():
    import pyarrow as pa

    encode, tokenizer, rng = token_files.Encoder(PATH, 500, 300), Tokenizer.from_file(PATH), random.Random(4)
    some = [" ", " ", "\n", "\n\n", "a", "'s", "B", "9", "!", ".", ", ", ". ", ") ", "é", "²", "e\u0301, ", "\u2167, ", "Ⓐ. ", "\t", "\x1c", "\x85", "\u3000", "日", "x" * 70, "&&", "-", "n'", "\"", "_", "ß,%"]
    texts = ODD + [None, "\0", "a\0 b", "a\n\nb c", "a\n\n\nb"] + ["".join(rng.choices(some, k=rng.choice([3, 6, 30]))) for _ in range(4000)]
    found = encode.lists(pa.array(["cut off", *texts])[1:]).to_pylist()
    assert len(found) == len(texts)
    for t, ids in zip(texts, found):
        assert ids == tokenizer.encode(t or "", add_special_tokens=False).ids + [0], repr(t)
    assert encode.lists(pa.array([], pa.string())).to_pylist() == []


def test_words_that_never_come_back_push_no_others_out():
    import pyarrow as pa

    encode, seen = token_files.Encoder(PATH), []
    common = [f"{a}{b}" for a in "bcdfghklmnprst" for b in "aeiou"]
    plain = encode.bpe
    encode.kept.limit, encode.kept.most_new = 100, 200
    encode.bpe = lambda word: seen.append(word) or plain(word)
    for i in range(60):
        rare = ["".join("abcdefghij"[int(c)] for c in f"{i:02}{j:04}") for j in range(60)]
        encode.lists(pa.array([" ".join(["The", *common, *rare]), ", ".join(["The", *rare])]))
    assert all(seen.count(encode.blank + w) == 1 for w in common)
    assert len(seen) == len(set(seen)) == 1 + len(common) + 60 * 60  # marks behind words make no new ones
    assert len(encode.kept) <= 100 and len(encode.kept.new) <= 200


def test_round_trip(spark, saved):
    want = brute(fixture())
    rows = token_files.read(spark, saved).collect()
    assert len(rows) == len(fixture())
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids"] in [v for (i, _), v in want.items() if i == r["doc_id"]]
        at += r["n_tokens"]
    assert at == sum(len(want[k]) for k in fixture())
    sums = {r["start"]: r["ids_crc32"] for r in token_files.checksums(token_files.read(spark, saved)).collect()}
    assert sums == {r["start"]: zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"])) for r in rows}


def test_encodings_and_page_index(saved):
    import glob

    group = max((pq.ParquetFile(f).metadata for f in glob.glob(saved + "/*.parquet")), key=lambda m: m.num_rows).row_group(0)
    columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids"].encodings
    assert all("DELTA_BINARY_PACKED" in columns[c].encodings for c in ("doc_id", "local_start", "n_tokens"))
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())


def test_selective_reads(spark, saved):
    plan = token_files.read(spark, saved).select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
    some = token_files.read(spark, saved, F.col("doc_id").between(10, 20))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,10)" in some._jdf.queryExecution().executedPlan().toString()
    everything = sorted(token_files.read(spark, saved).collect(), key=lambda r: r["start"])
    assert sorted(some.collect(), key=lambda r: r["start"]) == [r for r in everything if r["doc_id"] is not None and 10 <= r["doc_id"] <= 20]
    stream = [x for r in everything for x in r["ids"]]
    for a, b in ((0, 5), (17, 400), (len(stream) - 3, len(stream) + 9), (5, 5)):
        got = sorted(token_files.tokens_between(spark, saved, a, b).collect(), key=lambda r: r["start"])
        assert [x for r in got for x in r["ids"]] == stream[a:b]


def test_empty_table(spark):
    assert token_files.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_rows_go_to_python_in_bounded_pieces(spark):
    rng, n = random.Random(3), token_files.PIECE
    ids = [[rng.randrange(50_000) for _ in range(k)] for k in (1, n - 1, n, n + 1, 2 * n, 7 * n + 3, 40 * n, 0, 2)] + [None]
    rows = spark.createDataFrame([(i, 10 * i, len(x or []), x) for i, x in enumerate(ids)] + [(None, 5, 1, [7])], "doc_id long, start long, n_tokens long, ids array<int>").coalesce(1)
    sums = token_files.checksums(rows)
    given = sums._jdf.queryExecution().analyzed().children().head()  # what mapInArrow gets
    given = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, given), spark)
    assert given.agg(F.max(F.size("ids"))).first()[0] <= n
    want = sorted(((i, 10 * i, len(x or []), zlib.crc32(struct.pack(f"<{len(x or [])}I", *(x or [])))) for i, x in enumerate(ids)), key=repr) + [(None, 5, 1, zlib.crc32(struct.pack("<I", 7)))]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("3", "1", old):  # pieces of a row in several batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            assert sorted((tuple(r) for r in token_files.checksums(rows).collect()), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_other_operators_let_the_encoder_go():
    import weakref

    import pyarrow as pa

    class Plan:
        """Runs mapInArrow in this process, as a worker that has encoded before."""

        def mapInArrow(self, run, schema):
            return list(run([pa.RecordBatch.from_pydict({"text": ["a b"]})]))

    common.release()
    kept = weakref.ref(token_files.encoder(PATH))
    assert kept() is token_files.encoder(PATH)
    assert len(common.map_slices(Plan(), lambda batch: batch, "text string")) == 1
    assert kept() is None

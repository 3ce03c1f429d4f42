"""Token ids in Parquet, written in document order and read selectively.

A row per document: doc_id, part, local_start and n_tokens are delta-encoded, ids is a list column with a dictionary; row groups
and pages are kept small enough that a reader of a few documents, or of the metadata columns only, skips the rest by the
footers' statistics and the page index. Rows are range-partitioned and sorted by doc_id, so file order is document order. local_start
counts the ids before the row in its part; the parts' totals, one row per part, turn it into the position among all ids.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import kept, new_folder, release, slices

#: Row groups of at most 32 MB; pages of at most 64 kB or 500 rows.
LAYOUT = {
    "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(32 << 20), "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "500",
    "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#part": "false",
    "parquet.enable.dictionary#local_start": "false", "parquet.enable.dictionary#n_tokens": "false"}
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
END = 0
#: Ids of a row that goes to Python: batches of 10,000 rows hold 10 MB, however long the documents are.
PIECE = 256


def byte_alphabet() -> dict[int, int]:
    """The character by which byte-level BPE writes each byte: printable ones stand for themselves, the rest follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """Byte-level BPE of the tokenizers library, with the ids of words kept.

    The tokenizer's pattern always begins a new piece at a single space between two characters that aren't white space, on both sides of
    one or two line breaks between such characters, and between letters or digits and the punctuation behind them. So texts are cut
    there and the parts are encoded one by one, once for all texts of a slice; a part of letters is one piece and goes to the library's
    BPE model directly.
    """

    CUT = re.compile(r"(?<=\S)(?= \S)")
    #: Punctuation that is one piece behind letters, however much of it there is; an apostrophe may begin a piece of its own.
    TAIL, LONGEST = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", 64
    #: First character of a part without a space before it, and of the stand-ins for the end id and for texts that aren't cut.
    BARE, OTHER = "\0", "\0\0"
    #: Texts that aren't cut among others: empty, with BARE, or with white space other than single spaces, one or two line breaks.
    BLANK = r"\t\x0B-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
    ODD, LARGE = rf"^$|\x00|\n\n\n|[{BLANK}][\n{BLANK}]|\n[{BLANK}]|^[\n{BLANK}]|[\n{BLANK}]$", 64 << 20
    #: Marks cut off words when a space follows, but for texts where one doesn't stand behind a letter or digit.
    MARKS, STUCK = ".,;:!?", r"[^\pL\pN][.,;:!?] "

    class Kept(dict):
        """Ids of parts as little-endian bytes; None where a text must not be cut at a part's ends.

        Most words never come back, so new ones are set aside, at most ``most_new`` of them, and those met again are kept, at most
        ``limit``. Parts with line breaks hardly ever repeat and aren't kept.
        """

        def __init__(self, encoder: "Encoder", limit: int, most_new: int):
            super().__init__()
            self.encoder, self.limit, self.new, self.most_new = encoder, limit, {}, most_new

        def __missing__(self, key: str) -> bytes | None:
            value = self.new.pop(key, None)
            if value is not None:
                to, most = self, self.limit
            else:
                value, to, most = self.encoder.part(key), self.new, self.most_new
                if value is None or len(key) > Encoder.LONGEST or "\n" in key:
                    return value
            if len(to) >= most:
                to.clear()
            to[key] = value
            return value

    def __init__(self, path: str, limit: int = 270_000, most_new: int = 130_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        model = self.tokenizer.model
        model._resize_cache(0)  # its words would be kept twice
        self.bpe, self.blank = model.tokenize, chr(self.alphabet[0x20])
        self.line = self.direct("\n")
        self.kept = self.Kept(self, limit, most_new)

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def part(self, key: str) -> bytes | None:
        """Ids of a part, with a space before it unless it begins with BARE; None if a text must not be cut at its ends."""
        lead = key[:1] if key[:1] == self.BARE else ""
        part = key[len(lead):]
        if part.isalpha():
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
            return array("i", [t.id for t in self.bpe(letters if lead else self.blank + letters)]).tobytes()
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        if "\n" in part:  # a single line break between other characters is a piece of its own
            first, *rest = part.split("\n")
            if not first[-1].isspace() and all(x and not x[0].isspace() and not x[-1].isspace() for x in rest):
                return self.kept[lead + first] + b"".join(self.line + self.kept[self.BARE + x] for x in rest)
        stem = part.rstrip(self.TAIL)
        if stem != part and stem.isalpha():
            return self.kept[lead + stem] + self.kept[self.BARE + part[len(stem):]]
        return self.direct(part if lead else " " + part)

    def loose(self, part: str) -> bytes:
        """Ids of a part as CUT leaves it, white space at its ends included."""
        ids = self.kept[part[1:] if part[:1] == " " else self.BARE + part]
        return self.direct(part) if ids is None else ids

    def __call__(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if self.BARE in text or any(s in text for s in self.special):
            return self.direct(text)
        return b"".join(map(self.loose, self.CUT.split(text)))

    def lists(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every whole text (null: empty) with the end id behind them."""
        texts = texts.fill_null("")
        other = pc.or_(pc.match_substring_regex(texts, self.ODD), pc.greater(pc.binary_length(texts), self.LARGE))
        for special in self.special:
            other = pc.or_(other, pc.match_substring(texts, special))
        uncut = {f"{self.OTHER}{i}": self(texts[i].as_py()) for i in np.flatnonzero(other.to_numpy(zero_copy_only=False))}
        plain = pc.binary_join_element_wise(self.BARE, pc.if_else(other, "", texts), "")
        plain = cut = pc.replace_substring(plain, "\n", " \0\n \0")
        for mark in self.MARKS:
            cut = pc.replace_substring(cut, mark + " ", f" \0{mark} ")
        cut = pc.if_else(pc.match_substring_regex(plain, self.STUCK), plain, cut)
        cut = pc.replace_with_mask(cut, other, pa.array(list(uncut), pa.string()))
        words = pc.split_pattern(pc.binary_join_element_wise(cut, self.OTHER, " "), " ")
        found = words.values.dictionary_encode()
        # between two line breaks there is an empty part
        known = uncut | {self.OTHER: END.to_bytes(4, "little"), "\0\n": self.line, self.BARE: b""}
        kept = self.kept
        ids = [known[w] if w in known else kept[w] for w in found.dictionary.to_numpy(zero_copy_only=False).tolist()]
        ends = np.cumsum([0, *map(len, ids)]) // 4
        parts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        parts = parts.take(found.indices)
        return pa.ListArray.from_arrays(parts.offsets.take(words.offsets), parts.values)


def encoder(path: str) -> Encoder:
    return kept(f"encoder {path}", lambda: Encoder(path))


def write(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Encode every whole text (null: empty), append the end id and write the rows in ascending doc_id order.

    ``tokenizer`` is the path of the tokenizer file, the same on every executor. Null ids come first; rows that share an id follow each
    other in an order fixed by their texts.
    """

    def run(batches):
        encode, total = encoder(tokenizer), 0
        for batch in slices(batches, "text", 2 << 20):
            lists = encode.lists(batch.column("text"))
            counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(total + ends - counts), pa.array(counts), lists], ["doc_id", "part", "local_start", "n_tokens", "ids"])
            total += int(ends[-1])

    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, SCHEMA).write.options(**LAYOUT).parquet(folder)


def read(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before. ``where`` is pushed to the files.

    Only the columns a plan uses are read: without ids, the metadata columns alone. The parts' totals come from n_tokens alone.
    """
    rows = spark.read.schema(SCHEMA).parquet(folder)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select(F.col("part").alias("base_part"), F.coalesce(before, F.lit(0).cast("long")).alias("base"))
    if where is not None:
        rows = rows.where(where)
    # one row per part: bounded by the number of partitions written
    return rows.join(F.broadcast(bases), F.col("part") == F.col("base_part")).select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def tokens_between(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """(doc_id, start, ids): the ids at positions [start, stop) of the whole stream, cut out of the documents they lie in."""
    rows = read(spark, folder).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    low = F.greatest(F.lit(start).cast("long") - F.col("start"), F.lit(0).cast("long"))
    length = F.least(F.col("n_tokens"), F.lit(stop).cast("long") - F.col("start")) - low
    return rows.select("doc_id", (F.col("start") + low).alias("start"), F.slice("ids", (low + 1).cast("int"), length.cast("int")).alias("ids"))


def pieces(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, last, ids): every row cut into rows of at most PIECE ids, in order; ``last`` marks the end of a row.

    A row without ids has one empty piece.
    """
    n = F.greatest(F.size("ids"), F.lit(1))
    cut = rows.select("doc_id", "start", "n_tokens", "ids", F.explode(F.sequence(F.lit(0), n - 1, F.lit(PIECE))).alias("at"))
    return cut.select("doc_id", "start", "n_tokens", (F.col("at") + PIECE >= n).alias("last"), F.slice("ids", F.col("at") + 1, F.lit(PIECE)).alias("ids"))


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows with ids. They go to Python in pieces, a checksum carried from one to the next."""

    def run(batches):
        release()  # the encoder, when the files are written
        crc = 0  # of the row that goes on in the next batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column("ids")
            flat, at = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4"), lists.offsets.to_numpy()
            ends, begin, done = np.flatnonzero(batch.column("last").to_numpy(zero_copy_only=False)), at[0], []
            for end in at[ends + 1]:
                done.append(zlib.crc32(flat[begin:end], crc))
                begin, crc = end, 0
            crc = zlib.crc32(flat[begin:at[-1]], crc)
            whole = [batch.column(c).take(pa.array(ends)) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*whole, pa.array(done, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return pieces(rows).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, written to token files and read back from them.

    Null and empty texts hold the end id alone; the crc32 is unsigned, over the ids as little-endian unsigned 32-bit integers. Columns
    other than doc_id and text are not read; no documents give files without rows.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    write(docs, folder, tokenizer)
    return checksums(read(spark, folder))

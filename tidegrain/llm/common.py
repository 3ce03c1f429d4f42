"""Helpers shared by the operators: written intermediate tables, checked broadcasts, word splitting and hashing."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrain.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space that separates words: the class [\x20\x09-\x0D], which is also what bytes.split() splits on.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of at most some 60 bytes that may be broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name in the storage that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location that every executor reaches (a URI, or a plain path)."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and outlives lost executors."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a written table after counting its rows; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Text of one byte per character takes the plain ``lower``, which then does the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column, space: str = SPACE) -> Column:
    """Words between runs of ``space``; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), space), "")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty string."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % n


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores as it takes to differ from all ``taken`` names."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


class WordHashes(dict):
    """XXH64 by word, kept for at most ``limit`` words at a time."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEPT: dict[str, object] = {}


def kept(key: str, build: Callable[[], object]):
    """What a Python worker keeps from task to task. It keeps the value of one key only: operators that share workers don't add up."""
    if key not in _KEPT:
        release()
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Let go what the worker kept; for tasks that don't need it, as workers live on."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()  # an encoder and its words refer to each other


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold ``most_bytes`` at most, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(text)).to_pylist()], np.int64)
        start = 0
        while start < batch.num_rows:
            stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_slices(df: DataFrame, build: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType, text: str = "text") -> DataFrame:
    """``mapInArrow`` with bounded slices: ``build`` sees a few megabytes of text at a time."""

    def run(batches):
        release()
        for part in slices(batches, text):
            yield build(part)

    return df.mapInArrow(run, schema)

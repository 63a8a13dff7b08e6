"""Helpers of the text operators: word hashing in numpy, blocks of documents, written tables.

Words are maximal runs of bytes other than space and 0x09-0x0D. A word's hash
is a polynomial over a random table of its bytes, taken from prefix sums
modulo 2**64 and then mixed, so a whole block of documents is hashed by a few
vector operations. Hash sequences (n-grams, windows) are hashed the same way.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.session import scratch_path

U64 = np.uint64
#: Bytes of text that a task holds in one block (a longer document is a block of its own).
BLOCK_BYTES = 2 << 20
#: Bytes hashed at a time inside a block.
HASH_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE, _WORD_BASE = 0x5851F42D4C957F2D, 0xDA942042E4DD58B5


@functools.lru_cache(maxsize=8)
def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, U64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for 0 <= i <= n."""
    return _power_table(base, 1 << max(12, int(n).bit_length()))


def join_texts(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer of all texts, a line feed after each, and where each begins (with the end)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return (_LOWER[buf] if lower else buf), offsets


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in the buffer."""
    space = np.ones(len(buf) + 2, np.int8)
    space[1:-1] = _IS_SPACE[buf]
    edges = np.flatnonzero(np.diff(space))
    return edges[0::2], edges[1::2]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and don't overlap."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + HASH_BYTES, "right")))
        stop = int(ends[j - 1])
        up, down = powers(_BASE, stop - at)
        sums = np.zeros(stop - at + 1, U64)
        np.cumsum(_BYTE[buf[at:stop]] * up[: stop - at], out=sums[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the number of words before each text (with the total)."""
    buf, offsets = join_texts(texts, lower)
    starts, ends = word_bounds(buf)
    return hash_spans(buf, starts, ends), np.searchsorted(starts, offsets)


def hash_windows(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` values (the i-th begins at i)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = powers(_WORD_BASE, len(words))
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n] + U64(width))


def inside(bounds: np.ndarray, width: int) -> np.ndarray:
    """Of the windows over concatenated texts: which lie in one text. ``bounds``: words before each text."""
    total = int(bounds[-1])
    ok = np.ones(max(0, total - width + 1), bool)
    for back in range(1, width):
        cut = bounds[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return ok


def per_text(bounds: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as compressed byte planes (the high planes nearly vanish)."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, a null as an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows again in blocks of about ``limit`` bytes of text, each with its texts."""
    for batch in batches:
        first = 0
        while first < batch.num_rows:
            texts, held = [], 0
            for x in batch.column(text)[first:].cast(pa.binary()):
                value = x.as_py() or b""
                if texts and held + len(value) > limit:
                    break
                texts.append(value)
                held += len(value)
            yield batch.slice(first, len(texts)), texts
            first += len(texts)


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, and drop an execution's shuffle files when it ends."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)), ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")):
        spark.conf.set(key, value)


class Scratch:
    """Written tables of one operator call, in the shared folder of ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, f"llm-{name}")
        bounded_batches(spark)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write the table and return a frame that reads it (lineage ends here)."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


CHUNK_SCHEMA = "chunk_id long, n_words long, data binary"


def pack_chunks(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch, **more: F.Column) -> DataFrame:
    """Documents as written chunks of about BLOCK_BYTES of text: compressed Arrow batches of (id, text, and what ``more`` names).

    A chunk is the unit that asks for statistics of its words and gets the
    answers back, so its make-up must not change: the table is written once.
    """

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch, texts in blocks(batches):
            yield pa.RecordBatch.from_pydict(
                {"chunk_id": [(part << 32) | seq], "n_words": [sum(len(t.split()) for t in texts)], "data": [write_batch(batch)]},
                schema=pa.schema([("chunk_id", pa.int64()), ("n_words", pa.int64()), ("data", pa.binary())]),
            )
            seq += 1

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *[c.alias(k) for k, c in more.items()])
    return scratch.save(rows.mapInArrow(run, CHUNK_SCHEMA), "chunks")


def write_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_batch(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def cut_sorted(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of ascending 64-bit hashes ends; a bucket is an equal share of the hash range."""
    width = (1 << 64) // buckets + 1
    edges = np.array([min(width * (b + 1), (1 << 64) - 1) for b in range(buckets - 1)], U64)
    return np.concatenate((np.searchsorted(values, edges), [len(values)]))


def buckets_for(total: int, each: int) -> int:
    """Enough buckets that none holds much more than ``each`` values."""
    return max(1, -(-int(total) // each))

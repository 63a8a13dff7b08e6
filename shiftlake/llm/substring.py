"""Substring dedup: repeated fixed-length word windows become maximal removal intervals.

Method: Rabin-Karp hashes of every window of ``width`` words are counted in
Spark. Documents are packed into chunks; each chunk sends its distinct window
hashes, in byte-packed sorted arrays, to hash buckets (so a passage in a third
of all documents is one value per chunk, not one per document). A bucket finds
the hashes that several chunks hold and answers each chunk; the chunk adds
those that repeat inside it and merges the repeated windows into intervals.

Scale: the number of buckets follows the number of windows (BUCKET_WINDOWS
each), chunks hold BLOCK_BYTES of text, so no task grows with the data or with
a hot passage. Shuffled are some six bytes a window and the chunks once.

Windows count as equal when their 64-bit hashes are: with w distinct windows
about w**2 / 2**65 pairs of different windows collide (1e-3 pairs at 2e8).

Defined cases: a null text is an empty one; documents shorter than the window
keep all words; repeated rows are documents of their own (their windows start
elsewhere, so each is removed); an empty table gives no rows; other columns of
the input are left out; null ids are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.llm.common import (
    Scratch, buckets_for, cut_sorted, hash_windows, hash_words, inside, pack_chunks, pack_sorted, per_text, read_batch,
    text_bytes, unpack_sorted,
)

WIDTH = 35
#: Window hashes that one bucket holds, about.
BUCKET_WINDOWS = 2_000_000

PART = "bucket int, chunk_id long, data binary"


def _windows(data: bytes, width: int):
    batch = read_batch(data)
    texts = text_bytes(batch.column("text"))
    words, bounds = hash_words(texts)
    ok = inside(bounds, width)
    return batch, texts, bounds, np.flatnonzero(ok), hash_windows(words, width)[ok]


def _send(width: int, buckets: int):
    def run(batches):
        for batch in batches:
            for chunk, data in zip(batch.column("chunk_id").to_pylist(), batch.column("data").to_pylist(), strict=True):
                found = np.unique(_windows(data, width)[4])
                ends = cut_sorted(found, buckets)
                at = [(b, lo, hi) for b, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if hi > lo]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b for b, _, _ in at], pa.int32()),
                    "chunk_id": pa.array([chunk] * len(at), pa.int64()),
                    "data": pa.array([pack_sorted(found[lo:hi]) for _, lo, hi in at], pa.binary()),
                })

    return run


def _answer(table: pa.Table) -> pa.Table:
    chunks = table.column("chunk_id").to_pylist()
    values = [unpack_sorted(x) for x in table.column("data").to_pylist()]
    whole = np.sort(np.concatenate(values))
    repeated = np.unique(whole[1:][whole[1:] == whole[:-1]])
    out = []
    for chunk, own in zip(chunks, values, strict=True):
        both = np.intersect1d(own, repeated, assume_unique=True)
        if len(both):
            out.append((chunk, pack_sorted(both)))
    return pa.table({"chunk_id": pa.array([c for c, _ in out], pa.int64()), "data": pa.array([d for _, d in out], pa.binary())})


def _cut(width: int, schema: pa.Schema):
    def run(chunk: pa.Table, flags: pa.Table) -> pa.Table:
        shared = np.sort(np.concatenate([np.empty(0, np.uint64), *(unpack_sorted(x) for x in flags.column("data").to_pylist())]))
        out = []
        for data in chunk.column("data").to_pylist():
            batch, texts, bounds, at, hashes = _windows(data, width)
            order = np.sort(hashes)
            hit = np.isin(hashes, np.concatenate((shared, order[1:][order[1:] == order[:-1]])))
            cover = np.zeros(int(bounds[-1]) + 1, np.int64)
            np.add.at(cover, at[hit], 1)
            np.add.at(cover, at[hit] + width, -1)
            gone = np.cumsum(cover)[:-1] > 0
            kept, removed = [], []
            for k, text in enumerate(texts):
                mask = gone[bounds[k] : bounds[k + 1]]
                words = text.split()
                if mask.any():
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                    removed.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[0::2], edges[1::2], strict=True)])
                    words = [words[i] for i in np.flatnonzero(~mask)]
                else:
                    removed.append([])
                kept.append(b" ".join(words).decode())
            lost = np.bincount(per_text(bounds)[gone], minlength=len(texts))
            out.append(pa.Table.from_pydict({
                "id": batch.column("id"), "n_words": np.diff(bounds).astype(np.int64), "n_removed": lost.astype(np.int64),
                "removed": removed, "kept_text": kept,
            }, schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: id, n_words, n_removed, removed (word intervals, end exclusive), kept_text.

    A word goes if a window of ``width`` words covers it whose word sequence
    also starts anywhere else in the documents, the same document included.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    chunks = pack_chunks(docs, id_col, text_col, scratch)
    buckets = buckets_for(chunks.agg(F.sum("n_words")).first()[0] or 0, BUCKET_WINDOWS)
    sent = chunks.select("chunk_id", "data").mapInArrow(_send(width, buckets), PART)
    flags = scratch.save(sent.groupBy("bucket").applyInArrow(_answer, "chunk_id long, data binary"), "flags")
    kind = docs.schema[id_col].dataType
    rows = T.StructType([
        T.StructField(id_col, kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept_text", T.StringType()),
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType([T.StructField("id", kind), *rows.fields[1:]]))
    named = to_arrow_schema(rows)
    cut = _cut(width, arrow)
    return (
        chunks.select("chunk_id", "data").groupBy("chunk_id").cogroup(flags.groupBy("chunk_id"))
        .applyInArrow(lambda chunk, own: cut(chunk, own).rename_columns(named.names), rows)
    )

"""LM scoring: an interpolated modified Kneser-Ney bigram model counted in Spark.

Method: documents are packed into chunks. A chunk sends its distinct bigrams
(64-bit hashes, with training counts) to hash buckets; a bucket adds up the
counts and answers each chunk for its bigrams, and names one chunk the owner
of each bigram type. Owners know the words of their types, so each chunk sends
per-word statistics (count, context total, types with count 1, 2, 3 and more,
4, continuation types) to word buckets, which add them up and answer. The model
lives in the buckets as sorted hash arrays; a chunk gets the sorted arrays of
its own words and bigrams, reads them in place from the Arrow buffers (no copy
on a local disk), and scores its documents:

    p(w | v) = max(c(vw) - D, 0) / c(v.) + g(v) * p(w)
    p(w) = max(N(.w) - d, 0) / N(..) + g * 1 / (V + 1)

with three discounts each, from the numbers of types of count 1 to 4. V + 1
leaves one place for all unknown words, so p sums to 1.

Scale: one value per distinct bigram of a chunk is shuffled (some seven bytes),
so frequent bigrams are added up before the shuffle; buckets and chunks have a
fixed size, their number follows the data. Only eleven sums reach the driver.

Defined cases: a null or empty text is its end token alone; repeated rows are
scored, and counted, each; without training rows every word has the uniform
probability; null ids are kept; an empty table gives no rows; other columns of
the input are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.llm.common import (
    U64, Scratch, buckets_for, cut_sorted, hash_words, mix, pack, pack_chunks, pack_sorted, read_batch, text_bytes, unpack,
    unpack_sorted,
)

#: Bigrams, or words, that one bucket holds, about.
BUCKET_KEYS = 2_000_000
BEGIN, END = U64(0x6A09E667F3BCC908), U64(0xBB67AE8584CAA73B)
STATS = ("c", "ctx", "n1", "n2", "n3p", "n3", "n4", "cont")
SUMS = ("tokens", "known", "n1", "n2", "n3", "n4", "types", "m1", "m2", "m3", "m4")
SENT = "bucket int, chunk_id long, keys binary, vals binary"
ANSWER = "chunk_id long, kind int, bucket int, data binary, " + ", ".join(f"{s} long" for s in SUMS)


class Chunk:
    """A chunk's tokens (an end after each document), their predecessors, and its distinct words and bigrams."""

    def __init__(self, data: bytes):
        self.batch = read_batch(data)
        words, bounds = hash_words(text_bytes(self.batch.column("text")), lower=True)
        n = len(bounds) - 1
        self.bounds = bounds + np.arange(n + 1)
        self.tokens = np.insert(words, bounds[1:], END)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.bounds[:-1]] = BEGIN
        train = np.array(self.batch.column("train").to_pylist(), bool)
        self.train = np.repeat(train, np.diff(self.bounds))
        pairs = mix(self.before * U64(0x9E3779B97F4A7C15) + mix(self.tokens))
        self.pairs, self.first, self.pair_of = np.unique(pairs, return_index=True, return_inverse=True)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words (begin included), the place of each token and of each token's predecessor."""
        values, where = np.unique(np.append(self.tokens, BEGIN), return_inverse=True)
        word_of = where[:-1]
        before_of = np.empty_like(word_of)
        before_of[1:] = word_of[:-1]
        before_of[self.bounds[:-1]] = where[-1]
        return values, word_of, before_of


def _parts(chunk_id: int, keys: np.ndarray, vals: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket: its share of the ascending keys and their values."""
    ends = cut_sorted(keys, buckets)
    at = [(b, lo, hi) for b, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if hi > lo]
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([b for b, _, _ in at], pa.int32()), "chunk_id": pa.array([chunk_id] * len(at), pa.int64()),
        "keys": pa.array([pack_sorted(keys[lo:hi]) for _, lo, hi in at], pa.binary()),
        "vals": pa.array([pack(vals[..., lo:hi]) for _, lo, hi in at], pa.binary()),
    })


def _send_pairs(buckets: int):
    def run(batches):
        for batch in batches:
            for chunk_id, data in zip(batch.column("chunk_id").to_pylist(), batch.column("data").to_pylist(), strict=True):
                c = Chunk(data)
                counts = np.bincount(c.pair_of, weights=c.train, minlength=len(c.pairs)).astype("<u4")
                yield _parts(chunk_id, c.pairs, counts, buckets)

    return run


def _answers(table: pa.Table, kind: int, data: list[bytes], sums: dict[str, int]) -> pa.Table:
    """One row for each chunk that asked; the first one carries the bucket's sums."""
    n = table.num_rows
    columns = {"chunk_id": table.column("chunk_id"), "kind": pa.array([kind] * n, pa.int32()), "bucket": table.column("bucket"), "data": pa.array(data, pa.binary())}
    return pa.table(columns | {s: pa.array([int(sums.get(s, 0))] + [0] * (n - 1), pa.int64()) for s in SUMS})


def _add_up(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each asker's keys, all distinct keys, and for each asked key its place among them."""
    keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    values, where = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, values, where


def _count_pairs(table: pa.Table) -> pa.Table:
    keys, values, where = _add_up(table)
    total = np.bincount(where, weights=np.concatenate([unpack(x, "<u4") for x in table.column("vals").to_pylist()]), minlength=len(values)).astype(np.int64)
    first = np.zeros(len(where), bool)
    first[np.unique(where, return_index=True)[1]] = True
    said = ((total[where] << 1) | first).astype("<u8")
    sums = {f"n{k}": (total == k).sum() for k in (1, 2, 3, 4)}
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return _answers(table, 0, [pack(x) for x in np.split(said, cuts)], sums)


def _joined(table: pa.Table, kind: int, rows: int = 0) -> np.ndarray:
    """All buckets' answers of one kind, in bucket order: values in the order of the chunk's ascending keys."""
    own = sorted((b, d) for k, b, d in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "data")), strict=True) if k == kind)
    parts = [unpack(d, "<u8").reshape((rows, -1) if rows else (-1,)) for _, d in own]
    return np.concatenate(parts, axis=-1) if parts else np.empty((rows, 0) if rows else 0, U64)


def _send_words(buckets: int):
    def run(chunk: pa.Table, said: pa.Table) -> pa.Table:
        out = []
        for chunk_id, data in zip(chunk.column("chunk_id").to_pylist(), chunk.column("data").to_pylist(), strict=True):
            c = Chunk(data)
            values, word_of, before_of = c.words()
            n, answer = len(values), _joined(said, 0)
            total, own = answer >> U64(1), (answer & U64(1)).astype(bool)
            types = c.first[own & (total > 0)]  # a token position for each bigram type that this chunk owns
            count, v, w = total[own & (total > 0)], before_of[types], word_of[types]
            per = lambda at, mask=None: np.bincount(at if mask is None else at[mask], minlength=n)
            stats = np.array([
                per(word_of, c.train), per(before_of, c.train), per(v, count == 1), per(v, count == 2), per(v, count >= 3), per(v, count == 3),
                per(v, count == 4), per(w),
            ]).astype("<u8")
            out.append(pa.Table.from_batches([_parts(chunk_id, values, stats, buckets)]))
        return pa.concat_tables(out)

    return run


def _count_words(table: pa.Table) -> pa.Table:
    keys, values, where = _add_up(table)
    stats = np.concatenate([unpack(x, "<u8").reshape(len(STATS), -1) for x in table.column("vals").to_pylist()], axis=1)
    total = np.array([np.bincount(where, weights=row, minlength=len(values)) for row in stats]).astype("<u8")
    c, cont = total[0], total[STATS.index("cont")]
    sums = {"tokens": c.sum(), "known": (c > 0).sum(), "types": cont.sum()} | {f"m{k}": (cont == k).sum() for k in (1, 2, 3, 4)}
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return _answers(table, 1, [pack(x) for x in np.split(total[:, where], cuts, axis=1)], sums)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, 3 and more."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [k - (k + 1) * y * (b / a if a else 0.5) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *[min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), raw, strict=True)]])


def _score(sums: dict[str, int], schema: pa.Schema):
    high = discounts(*(sums[f"n{k}"] for k in (1, 2, 3, 4)))
    low = discounts(*(sums[f"m{k}"] for k in (1, 2, 3, 4)))
    n, v = sums["tokens"], sums["known"]
    rest = sums["known"] - sums["m1"] - sums["m2"]  # words with three and more predecessors
    spare = (low[1] * sums["m1"] + low[2] * sums["m2"] + low[3] * rest) / sums["types"] if sums["types"] else 1.0

    def run(chunk: pa.Table, said: pa.Table) -> pa.Table:
        out = []
        for data in chunk.column("data").to_pylist():
            c = Chunk(data)
            _, word_of, before_of = c.words()
            count, ctx, n1, n2, n3p, _, _, cont = _joined(said, 1, len(STATS)).astype(np.float64)
            together = (_joined(said, 0) >> U64(1)).astype(np.float64)[c.pair_of]
            p = np.maximum(cont - low[np.minimum(cont, 3).astype(int)], 0) / max(sums["types"], 1) + spare / (v + 1)
            gamma = (high[1] * n1 + high[2] * n2 + high[3] * n3p) / np.maximum(ctx, 1)
            seen = ctx[before_of]
            p = np.where(seen > 0, np.maximum(together - high[np.minimum(together, 3).astype(int)], 0) / np.maximum(seen, 1) + gamma[before_of] * p[word_of], p[word_of])
            base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))[word_of]
            at = c.bounds[:-1]
            out.append(pa.Table.from_arrays([
                c.batch.column("id"), c.batch.column("train"), pa.array(np.diff(c.bounds)), pa.array(np.add.reduceat((count > 0)[word_of].astype(np.int64), at)),
                pa.array([n] * len(at), pa.int64()), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(p), at)),
            ], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def score_documents(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, trained_on, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``train``: which rows of ``docs`` the model is learned from. Scores are
    log10 probabilities; ``base_score`` is that of the add-one-half unigram.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    scratch = Scratch(docs.sparkSession, "lm")
    chunks = pack_chunks(docs, id_col, text_col, scratch, train=F.coalesce(train, F.lit(False)))
    buckets = buckets_for(chunks.agg(F.sum("n_words")).first()[0] or 0, BUCKET_KEYS)
    whole = chunks.select("chunk_id", "data")
    pairs = scratch.save(whole.mapInArrow(_send_pairs(buckets), SENT).groupBy("bucket").applyInArrow(_count_pairs, ANSWER), "pairs")
    sent = whole.groupBy("chunk_id").cogroup(pairs.groupBy("chunk_id")).applyInArrow(_send_words(buckets), SENT)
    words = scratch.save(sent.groupBy("bucket").applyInArrow(_count_words, ANSWER), "words")
    said = pairs.union(words)
    sums = said.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS]).first().asDict()
    rows = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("trained_on", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    return whole.groupBy("chunk_id").cogroup(said.groupBy("chunk_id")).applyInArrow(_score(sums, to_arrow_schema(rows)), rows)

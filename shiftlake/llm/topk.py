"""Exact top-k by inner product over a bit-sliced index.

Method: a block of vectors is held as bit slices: for each component, its
value shifted right to at most SLICES bits, one bitmap over the block's rows
per bit. A query's components are rounded to a few bits and written as signed
digits; for each digit the component's slices are added, shifted, to a
bit-sliced sum by bitmap logic (one sum for positive, one for negative digits;
their difference is the coarse score). The k-th coarse score is found from the
most significant slice downward. Rows within twice the error bound of it (by
Cauchy-Schwarz from the norms of what shifting and rounding left out) are the
boundary; their integer inner products are computed exactly.

Scale: index rows and queries are dealt out in blocks (BLOCK_ROWS by
QUERY_ROWS), each pair of blocks one group, so the stated query set meets all
rows without a cross join and a group's size is fixed. A block gives its top k
per query; the last top k is a window over those, limited before the shuffle.

Defined cases: vectors that are null or hold null, NaN or infinite components
and rows with a null id take no part; shorter vectors count as zero-filled; a
repeated (id, vector) row counts once; rows that share an id are never each
other's result; ties go to the smaller id; fewer than k others give all of
them; empty tables give no rows; other columns of the input are left out.
Components beyond 2**26 in size may overflow the 64-bit score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftlake.llm.common import Scratch

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
SLICES = 6
QUERY_BITS = 5


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _add(acc: list[np.ndarray], slices: np.ndarray, shift: int) -> None:
    """acc += slices << shift, by ripple carry over bitmaps."""
    carry = None
    for j in range(shift, len(acc)):
        a = acc[j]
        b = slices[j - shift] if j - shift < len(slices) else None
        if b is None and carry is None:
            return
        if b is None or carry is None:
            b = carry if b is None else b
            acc[j], carry = a ^ b, a & b
        else:
            x = a ^ b
            acc[j], carry = x ^ carry, (a & b) | (x & carry)


def _digits(q: int) -> list[tuple[int, int]]:
    """Signed digits (position, +1 or -1), no two neighbours set."""
    out, at = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((at, d))
            q -= d
        q >>= 1
        at += 1
    return out


class SlicedBlock:
    """Bit slices of the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, self.dims = vectors.shape
        self.words = -(-n // 64)
        low, high = (int(self.vectors.min()), int(self.vectors.max())) if vectors.size else (0, 0)
        self.shift = max(0, (high - low).bit_length() - SLICES)
        coarse = self.vectors >> self.shift
        self.low = int(coarse.min()) if vectors.size else 0
        digits = coarse - self.low
        bits = max(1, int(digits.max()).bit_length()) if vectors.size else 1
        self.slices = np.array([[self._bitmap((digits[:, d] >> b) & 1) for b in range(bits)] for d in range(self.dims)], np.uint64)
        half = (1 << self.shift) / 2 - 0.5
        rest = self.vectors - (coarse << self.shift) - half
        self.rest_norm = float(np.sqrt((rest * rest).sum(axis=1)).max(initial=0))
        self.norm = float(np.sqrt((coarse.astype(float) ** 2).sum(axis=1)).max(initial=0))
        self.valid = self._bitmap(np.ones(n, np.uint8))

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 64, np.uint8)
        out[: len(bits)] = bits
        return np.packbits(out, bitorder="little").view(np.uint64)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows other than ``own``."""
        q_shift = max(0, int(np.abs(query).max(initial=0)).bit_length() - QUERY_BITS)
        coarse = (query + (1 << q_shift >> 1)) >> q_shift
        rest = query - (coarse << q_shift)
        width = max(1, int(np.abs(coarse).sum() * ((1 << self.slices.shape[1]) - 1) * 2).bit_length() + 2) if self.dims else 2
        zero = np.zeros(self.words, np.uint64)
        plus, minus = [zero] * width, [zero] * width
        for d in np.flatnonzero(coarse):
            for at, sign in _digits(int(coarse[d])):
                _add(plus if sign > 0 else minus, self.slices[d], at)
        # plus + ~minus + 1, with the sign slice turned so that larger is more
        total, carry = [], ~zero
        for p, m in zip(plus, minus, strict=True):
            m = ~m
            x = p ^ m
            total.append(x ^ carry)
            carry = (p & m) | (x & carry)
        total[-1] = ~total[-1]
        # from the most significant slice downward: the k-th largest value
        alive = self.valid.copy()
        for row in range(*np.searchsorted(self.ids, [own, own + 1])):
            alive[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        if _ones(alive) > k:
            sure, edge, value = 0, alive, 0
            for j in range(width - 1, -1, -1):
                ones = edge & total[j]
                n = _ones(ones)
                if sure + n >= k:
                    edge, value = ones, value | 1 << j
                else:
                    sure, edge = sure + n, edge & ~total[j]
            error = (1 << self.shift) * float(np.sqrt((rest.astype(float) ** 2).sum())) * self.norm + float(np.sqrt((query.astype(float) ** 2).sum())) * self.rest_norm
            least = value - int(2 * error * (1 + 1e-9) / (1 << self.shift + q_shift)) - 2
            if least > 0:
                more, equal = zero, alive
                for j in range(width - 1, -1, -1):
                    if least >> j & 1:
                        equal = equal & total[j]
                    else:
                        more, equal = more | (equal & total[j]), equal & ~total[j]
                alive = more | equal
        rows = np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        cells = []
        if rows.num_rows and queries.num_rows:
            dims = max((len(v) for t in (rows, queries) for v in t.column("v")), default=0)
            block = SlicedBlock(rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), dims))
            for own, query in zip(queries.column("vec_id").to_pylist(), _matrix(queries.column("v"), dims), strict=True):
                ids, scores = block.top(own, query, k)
                cells.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(c) if cells else np.empty(0, np.int64) for c in (zip(*cells, strict=True) if cells else [[]] * 3)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.select("vec_id", F.when(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.col("x")).alias("x"))
    return rows.where("x is not null").select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v")).distinct()


def top_inner_products(
    vectors: DataFrame, is_query: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.save(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    n_rows, n_queries = max(1, -(-total // block_rows)), max(1, -(-asked // query_rows))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("b", deal(n_rows)).withColumn("q", every(n_queries)).groupBy("b", "q")
    right = rows.where(is_query).withColumn("q", deal(n_queries)).withColumn("b", every(n_rows)).groupBy("b", "q")
    found = left.cogroup(right).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

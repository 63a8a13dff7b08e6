"""Hard-negative mining by Fagin's threshold algorithm.

Method: a block of vectors holds, for every dimension, the list of its rows in
the order of that component. An anchor takes the lists in step, each from the
end that the sign of the anchor's component names (sorted access), and
scores every new row by its whole integer inner product (random access). The
threshold is the inner product of the anchor with the values at the current depth;
no row not yet met can score more. The scan of a block stops once the
threshold falls strictly below the k-th score of every window of the anchor, or below
the window itself; at equality it goes on, as a tie may have a smaller id.

Two scans: the first finds an anchor's positives (its best rows of the same
label), the second, for each positive's score window, the best rows of other
labels in it.

Scale: rows are dealt to blocks of about BLOCK_ROWS by a hash of the whole
row, so a vector or label that a third of the rows share spreads over all;
each block's lists are built and written once. Anchors go in rounds of about
ROUND_ANCHORS (the bound of what is broadcast and of what returns to the
driver: as many positives each); in a round every task passes all anchors over
its blocks in turn and carries each window's k-th score from block to block. A
round's result is written, so a lost executor costs its tasks only.

Defined cases: rows with a null id, label or vector, or with a null, NaN or
infinite component take no part; shorter vectors count as zero-filled; a
repeated (id, label, vector) row counts once; rows that share an id are never each
other's result, and each is an anchor or a positive for itself; ties go to the
smaller id; an anchor without positives, and a positive without rows in its
window (always so if its score is negative), give no rows; empty tables give no rows; other columns of the
input are left out. Inner products beyond 2**53 aren't exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftlake.llm.common import Scratch

BLOCK_ROWS = 8192
ROUND_ANCHORS = 4096
#: Depth of the first sorted access; each further one goes twice as deep.
FIRST_DEPTH = 32

BLOCK_SCHEMA = "n int, dims int, ids binary, labels binary, vectors binary, lists binary"
_NONE = np.iinfo(np.int64).min


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _build(dims: int):
    def run(rows: pa.Table) -> pa.Table:
        v = _matrix(rows.column("v"), dims)
        lists = np.ascontiguousarray(np.argsort(v, axis=0, kind="stable").T.astype(np.uint32))
        whole = {"ids": rows.column("vec_id").to_numpy(), "labels": rows.column("label").to_numpy(), "vectors": v, "lists": lists}
        cells = {"n": pa.array([len(v)], pa.int32()), "dims": pa.array([dims], pa.int32())}
        return pa.table(cells | {k: pa.array([x.tobytes()], pa.binary()) for k, x in whole.items()})

    return run


class Lists:
    """One block: its rows, and per dimension the order of the rows by that component."""

    def __init__(self, row: dict, exact: type):
        n, dims = row["n"], row["dims"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        v = np.frombuffer(row["vectors"], np.int64).reshape(n, dims)
        self.order = np.frombuffer(row["lists"], np.uint32).reshape(dims, n)
        self.v, self.n = v.astype(exact), n
        self.depths = [min(n, FIRST_DEPTH << s) for s in range(64) if s == 0 or FIRST_DEPTH << (s - 1) < n]
        at = np.array(self.depths) - 1
        each = np.arange(dims)[:, None]
        self.low, self.high = v[self.order[:, at], each].astype(float), v[self.order[:, n - 1 - at], each].astype(float)

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For each anchor, the most that a row met at no depth so far can score, by depth."""
        a = anchors.astype(float)
        return np.maximum(a, 0) @ self.high + np.minimum(a, 0) @ self.low

    def scan(self, anchor: np.ndarray, thresholds: np.ndarray, take, floor) -> None:
        """Sorted and random access down the lists; ``take`` gets new rows and their scores, ``floor`` tells what the threshold must fall below."""
        up, down = np.flatnonzero(anchor >= 0), np.flatnonzero(anchor < 0)
        mine, seen, start = anchor.astype(self.v.dtype), np.zeros(self.n, bool), 0
        for depth, threshold in zip(self.depths, thresholds, strict=True):
            met = np.zeros(self.n, bool)
            met[self.order[up, self.n - depth : self.n - start]] = True
            met[self.order[down, start:depth]] = True
            met &= ~seen
            rows = np.flatnonzero(met)
            if len(rows):
                take(rows, (self.v[rows] @ mine).astype(np.int64))
            seen |= met
            start = depth
            if threshold < floor() or seen.all():
                return


class Best:
    """The k best (score, id) of each window, best first."""

    def __init__(self, windows: int, k: int):
        self.score, self.id, self.k = np.full((windows, k), _NONE), np.zeros((windows, k), np.int64), k

    def add(self, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        last = self.score[w, -1]
        held = scores >= last
        scores, ids = np.concatenate((self.score[w], scores[held])), np.concatenate((self.id[w], ids[held]))
        best = np.lexsort((ids, ~scores))[: self.k]  # ~x falls as x rises, and has no overflow at an empty place
        self.score[w], self.id[w] = scores[best], ids[best]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, at = np.nonzero(self.score != _NONE)
        return w, self.id[w, at], self.score[w, at]


@dataclass
class Round:
    """Anchors of one round; ``windows``: of each anchor, (positive id, positive score) in order of rank."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    windows: list[list[tuple[int, int]]] | None = None


def _blocks(batches, exact: type):
    for batch in batches:
        for row in batch.to_pylist():
            yield Lists(row, exact)


def _positives(sent, exact: type, k: int):
    def run(batches):
        asked: Round = sent.value
        best = Best(len(asked.ids), k)
        for block in _blocks(batches, exact):
            bounds = block.thresholds(asked.vectors)
            for a, (own, label, anchor) in enumerate(zip(asked.ids, asked.labels, asked.vectors, strict=True)):
                fits = (block.labels == label) & (block.ids != own)

                def take(rows, scores, a=a, fits=fits):
                    held = fits[rows]
                    best.add(a, scores[held], block.ids[rows[held]])

                block.scan(anchor, bounds[a], take, lambda a=a: best.score[a, -1])
        a, ids, scores = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(ids), pa.array(scores)], names=["a", "id", "score"])

    return run


def _negatives(sent, exact: type, k: int, low: int, high: int):
    def run(batches):
        asked: Round = sent.value
        flat = [(a, p, s) for a, own in enumerate(asked.windows) for p, s in own]
        first = np.concatenate(([0], np.cumsum([len(x) for x in asked.windows])))
        best = Best(len(flat), k)
        least = np.array([-(-low * s // 100) for _, _, s in flat], np.int64)
        most = np.array([high * s // 100 for _, _, s in flat], np.int64)
        for block in _blocks(batches, exact):
            bounds = block.thresholds(asked.vectors)
            for a, (own, label, anchor) in enumerate(zip(asked.ids, asked.labels, asked.vectors, strict=True)):
                mine = [w for w in range(first[a], first[a + 1]) if least[w] <= most[w]]
                if not mine:
                    continue
                fits = (block.labels != label) & (block.ids != own)

                def take(rows, scores, mine=mine, fits=fits):
                    held = fits[rows] & (scores >= least[mine].min())
                    ids, scores = block.ids[rows[held]], scores[held]
                    for w in mine:
                        inside = (scores >= least[w]) & (scores <= most[w])
                        if inside.any():
                            best.add(w, scores[inside], ids[inside])

                block.scan(anchor, bounds[a], take, lambda mine=mine: np.maximum(best.score[mine, -1], least[mine]).min())
        w, ids, scores = best.rows()
        a = np.array([x[0] for x in flat], np.int64)[w]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (w, asked.ids[a], np.array([x[1] for x in flat], np.int64)[w], ids, np.array([x[2] for x in flat], np.int64)[w], scores)],
            names=["w", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"],
        )

    return run


def grid_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, each once; v: floor(scale * component)."""
    c = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), c.alias("c"))
    rows = rows.where("vec_id is not null and label is not null and c is not null")
    rows = rows.where(F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("vec_id", "label", F.transform("c", lambda v: F.floor(v * scale).cast("long")).alias("v")).distinct()


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    block_rows: int = BLOCK_ROWS, round_anchors: int = ROUND_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``vec_id``. For each of an
    anchor's best ``positives`` rows of its label, the best ``negatives`` rows of other
    labels whose score lies from ``low`` to ``high`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = scratch.save(grid_rows(vectors, id_col, vector_col, label_col, scale), "rows")
    biggest = F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, x: F.greatest(s, F.abs(x))))
    total, asked, dims, most = rows.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.max(F.size("v")), biggest).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    dims = max(1, dims or 0)
    if not asked:
        return spark.createDataFrame([], schema)
    # the narrowest type in which every partial sum of products is a whole number
    reach = dims * (most or 0) ** 2
    exact = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n)).cast("int")
    dealt = rows.withColumn("b", deal(-(-total // block_rows)))
    blocks = scratch.save(dealt.groupBy("b").applyInArrow(_build(dims), BLOCK_SCHEMA), "blocks")
    rounds = -(-asked // round_anchors)
    anchors = scratch.save(rows.where(is_anchor).withColumn("r", deal(rounds)), "anchors")
    scratch.drop("rows")
    done = []
    for r in range(rounds):
        own = anchors.where(F.col("r") == r).orderBy("vec_id", "label", "v").toArrow()
        if not own.num_rows:
            continue
        sent = Round(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), _matrix(own.column("v"), dims))
        first = spark.sparkContext.broadcast(sent)
        best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "id"))
        found = blocks.mapInArrow(_positives(first, exact, positives), "a long, id long, score long").withColumn("p", best).where(F.col("p") <= positives)
        windows: list[list[tuple[int, int]]] = [[] for _ in range(own.num_rows)]
        for x in found.orderBy("a", "p").collect():
            windows[x.a].append((x.id, x.score))
        first.destroy()
        second = spark.sparkContext.broadcast(Round(sent.ids, sent.labels, sent.vectors, windows))
        columns = "w long, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
        found = blocks.mapInArrow(_negatives(second, exact, negatives, low, high), columns)
        best = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("negative_score"), "negative_id"))
        found = found.withColumn("rank", best).where(F.col("rank") <= negatives)
        done.append(f"round-{r}")
        scratch.save(found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), done[-1])
        second.destroy()
    scratch.drop("blocks", "anchors")
    return spark.read.schema(schema).parquet(*[f"{scratch.root}/{name}" for name in done])

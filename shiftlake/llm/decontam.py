"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

Method: test items are partitioned by their number of shingles: the first size
class reaches up to u shingles, each next one up to twice as many. For a class
with at most u shingles every document is cut into cells of u/2 shingles; a
window is three cells in a row, so an occurrence of an item lies whole in some
window and its Jaccard similarity to the window is bounded from below, however
long the document is. The window's MinHash coordinates are compared with those
of the class's items; one equal coordinate makes the pair (document, item) a
candidate, and exact containment of the item's shingles in the document's full
shingle set decides. The number of coordinates follows from the bound: a pair
at the threshold is missed with probability MISS at most. Minima of a larger
class's cells are taken from those of the class before, so a coordinate is
computed once for each shingle.

Scale: one map over the documents, no shuffle. The items are the stated query
set; they are taken in blocks of BLOCK_ITEMS (documents are read once for each
block), so what a task holds and what is sent to it is bounded at any number
of items. Links are rows (document, item); copies of a document aren't paired.

Defined cases: a null text is empty; items without words match nothing; an
item of fewer words than a shingle is one shingle of its whole sequence and is
looked for as such; repeated rows and items are matched each; null ids are
kept; empty tables give no rows; other columns of the input are left out.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.llm.common import U64, blocks, bounded_batches, hash_windows, hash_words, inside, mix, per_text, text_bytes

BLOCK_ITEMS = 20_000
MISS = 1e-6


@dataclass
class SizeClass:
    """Items of at most 2 * cell shingles."""

    cell: int
    items: np.ndarray       # numbers of the items
    signatures: np.ndarray  # items x coordinates


@dataclass
class ItemIndex:
    """Items of one shingle width; each class's cell is twice the one before."""

    width: int
    coordinates: int
    classes: list[SizeClass]


def _coordinate(grams: np.ndarray, k: int) -> np.ndarray:
    """Values of the k-th hash function of shingles (their upper 32 bits, permuted)."""
    a, b = (0x9E3779B9 * (2 * k + 1)) & 0xFFFFFFFF, (0x85EBCA6B * (2 * k + 3)) & 0xFFFFFFFF | 1
    return (grams ^ np.uint32(a)) * np.uint32(b)


def _short(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(32)).astype(np.uint32)


def item_indexes(texts: list[bytes], width: int, percent: int) -> tuple[list[ItemIndex], list[np.ndarray]]:
    """Indexes by shingle width, and each item's distinct shingles (ascending)."""
    words, bounds = hash_words(texts, lower=True)
    sets, by_width = [], {}
    for k in range(len(texts)):
        own = words[bounds[k] : bounds[k + 1]]
        w = min(width, len(own))
        sets.append(np.unique(hash_windows(own, w)) if w else np.empty(0, U64))
        if w:
            by_width.setdefault(w, []).append(k)
    indexes, share = [], percent / 100
    for w, members in sorted(by_width.items()):
        least, most = min(len(sets[k]) for k in members), max(len(sets[k]) for k in members)
        cell, cells, n = -(-least // 2), [], 1
        while not cells or 2 * cells[-1] < most:
            smallest = cell + 1 if cells else least
            similar = share * smallest / (3 * cell + (1 - share) * smallest)
            n = max(n, math.ceil(math.log(MISS) / math.log1p(-min(similar, 0.999))))
            cells.append(cell)
            cell *= 2
        signed = {k: [_coordinate(_short(sets[k]), c).min() for c in range(n)] for k in members}
        classes = []
        for j, cell in enumerate(cells):
            own = [k for k in members if (j == 0 or len(sets[k]) > cell) and len(sets[k]) <= 2 * cell]
            classes.append(SizeClass(cell, np.array(own, np.int64), np.array([signed[k] for k in own], np.uint32).reshape(len(own), n)))
        indexes.append(ItemIndex(w, n, classes))
    return indexes, sets


def _candidates(grams: np.ndarray, bounds: np.ndarray, index: ItemIndex) -> np.ndarray:
    """Pairs document * 2**32 + item that share a coordinate in some window. ``bounds``: grams before each document."""
    counts = np.diff(bounds)
    out, layers, finer = [np.empty(0, np.int64)], [], None
    for cls in index.classes:
        cells = -(-counts // cls.cell)
        doc = np.repeat(np.arange(len(counts)), cells)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(cells) - cells, cells)
        if finer is None:  # row t: the t-th shingle of each cell (of a short last cell its last one again)
            size = np.minimum(cls.cell, counts[doc] - nth * cls.cell)
            parts = bounds[doc] + nth * cls.cell + np.minimum(np.arange(cls.cell)[:, None], size - 1)
        else:  # a cell is two cells of the class before
            first = (np.cumsum(finer) - finer)[doc] + 2 * nth
            parts = np.stack((first, np.minimum(first + 1, np.cumsum(finer)[doc] - 1)))
        finer = cells
        one = np.append(doc[1:], -1) == doc
        two = np.append(doc[2:], [-1, -1])[: len(doc)] == doc
        here = np.arange(len(doc))
        layers.append((cls, parts, doc, here + one, here + np.where(two, 2, one)))
    if not len(grams):
        return out[0]
    first = _short(grams)[layers[0][1]]
    for k in range(index.coordinates):
        least = None
        for cls, parts, doc, one, two in layers:
            least = _coordinate(first, k).min(axis=0) if least is None else np.minimum(least[parts[0]], least[parts[1]])
            if not len(cls.items):
                continue
            values, reverse = np.unique(cls.signatures[:, k], return_inverse=True)
            window = np.minimum(np.minimum(least, least[one]), least[two])
            held = np.zeros(1 << 16, bool)  # upper halves of the items' values: most windows end here
            held[values >> np.uint32(16)] = True
            near = np.flatnonzero(held[window >> np.uint32(16)])
            at = np.minimum(np.searchsorted(values, window[near]), len(values) - 1)
            same = values[at] == window[near]
            hit, at = near[same], at[same]
            for p in np.unique((doc[hit].astype(np.int64) << 32) | at).tolist():  # a value may belong to several items
                out.append((p >> 32 << 32) | cls.items[reverse == (p & 0xFFFFFFFF)])
    return np.unique(np.concatenate(out))


@dataclass
class ItemBlock:
    """A bounded block of test items, ready to be looked for in texts."""

    indexes: list[ItemIndex]
    sets: list[np.ndarray]
    ids: list
    percent: int

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int]]:
        """(number of the text, number of the item, common shingles) of all contained items."""
        words, bounds = hash_words(texts, lower=True)
        rows = []
        for index in self.indexes:
            ok = inside(bounds, index.width)
            grams = hash_windows(words, index.width)[ok]
            before = np.searchsorted(per_text(bounds)[: len(ok)][ok], np.arange(len(texts) + 1))
            doc, own = -1, None
            for pair in _candidates(grams, before, index).tolist():
                if pair >> 32 != doc:
                    doc = pair >> 32
                    own = np.unique(grams[before[doc] : before[doc + 1]])
                item = pair & 0xFFFFFFFF
                common = len(np.intersect1d(own, self.sets[item], assume_unique=True))
                if 100 * common >= self.percent * len(self.sets[item]):
                    rows.append((doc, item, common))
        return rows


def item_blocks(items: DataFrame, item_id: str, item_text: str, width: int, percent: int, block_items: int) -> Iterator[ItemBlock]:
    """All items in blocks of about ``block_items`` (dealt by a hash)."""
    query = items.select(F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("text"))
    n_blocks = max(1, -(-query.count() // block_items))
    for b in range(n_blocks):
        held = query.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == b).toArrow()
        indexes, sets = item_indexes(text_bytes(held.column("text").combine_chunks()), width, percent)
        yield ItemBlock(indexes, sets, held.column("id").to_pylist(), percent)


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = 5, percent: int = 80, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Rows (document id, item id, n_shingles of the item, n_common): the document holds ``percent`` of the item's shingles."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(docs.sparkSession)
    rows = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(item_id if item_id != id_col else f"item_{item_id}", items.schema[item_id].dataType),
        T.StructField("n_shingles", T.LongType()), T.StructField("n_common", T.LongType()),
    ])
    schema = to_arrow_schema(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def search(block: ItemBlock):
        def run(batches):
            for batch, own in blocks(batches):
                if found := block.find(own):
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array([d for d, _, _ in found])), pa.array([block.ids[i] for _, i, _ in found], schema.field(1).type),
                        pa.array([len(block.sets[i]) for _, i, _ in found], pa.int64()), pa.array([n for _, _, n in found], pa.int64()),
                    ], schema=schema)

        return texts.mapInArrow(run, rows)

    return functools.reduce(DataFrame.union, [search(b) for b in item_blocks(items, item_id, item_text, width, percent, block_items)])


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = 5, percent: int = 80, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The documents (all columns) that hold no test item."""
    bounded_batches(docs.sparkSession)

    def holds(block: ItemBlock) -> F.Column:
        def run(column: pa.Array) -> pa.Array:
            out = [np.empty(0, bool)]
            for _, own in blocks([pa.RecordBatch.from_arrays([column], names=["text"])]):
                hit = np.zeros(len(own), bool)
                hit[[d for d, _, _ in block.find(own)]] = True
                out.append(hit)
            return pa.array(np.concatenate(out))

        return F.arrow_udf(run, "boolean")(F.col(text_col).cast("string"))

    for block in item_blocks(items, item_id, item_text, width, percent, block_items):
        docs = docs.where(~holds(block))
    return docs

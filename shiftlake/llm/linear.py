"""Hashed word n-gram features and follow-the-regularised-leader logistic regression.

Tokens are runs of letters (ASCII lower-cased; bytes from 0x80 count as
letters), of digits, or of other visible bytes. Features are hashed 1- and
2-grams of tokens and, on request, 1- to 3-grams of token shapes (case of a
letter run, digits, the very run of other bytes). Everything is computed for a
block of documents at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.common import U64, blocks, bounded_batches, hash_spans, hash_windows, inside, join_texts, mix, per_text, _LOWER

BITS = 20

_CLASS = np.full(256, 3, np.int8)  # other visible bytes
_CLASS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
_CLASS[48:58] = 2
_CLASS[list(range(33))] = 0
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, shape hashes, and the number of tokens before each text (with the total)."""
    raw, offsets = join_texts(texts)
    kind = np.concatenate((np.zeros(1, np.int8), _CLASS[raw], np.zeros(1, np.int8)))
    cut = np.flatnonzero(kind[1:] != kind[:-1])
    full = kind[cut[:-1] + 1] > 0 if len(cut) > 1 else np.zeros(0, bool)
    starts, ends = cut[:-1][full], cut[1:][full]
    hashes = hash_spans(_LOWER[raw], starts, ends)
    caps = np.concatenate(([0], np.cumsum(_UPPER[raw])))
    upper, size, kinds = caps[ends] - caps[starts], ends - starts, _CLASS[raw[starts]]
    case = np.where(upper == 0, 0, np.where(upper == size, np.where(size == 1, 1, 2), np.where((upper == 1) & _UPPER[raw[starts]], 1, 3)))
    shapes = np.where(kinds == 3, hashes, (kinds.astype(U64) << U64(8)) + case.astype(U64))
    return hashes, mix(shapes + U64(0x51ED270B)), np.searchsorted(starts, offsets)


def features(hashes: np.ndarray, shapes: np.ndarray | None, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature number) of every n-gram occurrence."""
    doc = per_text(bounds)
    parts = [(doc, hashes)]
    streams = [(hashes, 2)] if shapes is None else [(hashes, 2), (shapes, 1), (shapes, 2), (shapes, 3)]
    for stream, n in streams:
        ok = inside(bounds, n)
        parts.append((doc[: len(ok)][ok], hash_windows(stream, n)[ok]))
    return np.concatenate([d for d, _ in parts]), np.concatenate([(h >> U64(64 - BITS)).astype(np.int32) for _, h in parts])


@dataclass
class Example:
    """A labelled text; ``swapped`` holds the features that an identity swap adds and takes away."""

    label: float
    index: np.ndarray
    value: np.ndarray
    swapped: tuple[np.ndarray, np.ndarray] | None = None


@dataclass
class Ftrl:
    """FTRL-proximal logistic regression (per-coordinate rates, L1 and L2)."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 0.5
    epochs: int = 4
    parity: float = 0.0
    z: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))
    n: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def _step(self, index: np.ndarray, grad: np.ndarray, w: np.ndarray) -> None:
        n = self.n[index]
        self.z[index] += grad - (np.sqrt(n + grad * grad) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + grad * grad

    def fit(self, rows: list[Example]) -> Ftrl:
        bias = np.array([1 << BITS])
        for epoch in range(self.epochs):
            for k in np.random.default_rng(epoch).permutation(len(rows)):
                row = rows[k]
                index, value = np.concatenate((row.index, bias)), np.append(row.value, 1.0)
                w = self.weights(index)
                self._step(index, (sigmoid(w @ value) - row.label) * value, w)
                if row.swapped is not None and self.parity:
                    index, value = row.swapped
                    w = self.weights(index)
                    # gradient of parity * (change of the logit) ** 2
                    self._step(index, 2 * self.parity * (w @ value) * value, w)
        return self

    def model(self) -> tuple[np.ndarray, float]:
        """All weights, and the bias."""
        w = self.weights(np.arange(len(self.z)))
        return w[:-1].astype(np.float32), float(w[-1])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, train: F.Column, max_rows: int) -> DataFrame:
    """(id, text, label) of about ``max_rows`` labelled documents that ``train`` admits, chosen by a hash of the id.

    ``train`` is a condition on the column ``id``. Null labels and ids teach
    nothing, nor does a document that is labelled both ways.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label")).where("id is not null and label is not null")
    known = known.where(train).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top")).where("label = top").drop("top")
    total = known.count()
    chosen = known if total <= max_rows else known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / total))
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # bounded by max_rows; of several texts with one id, that of the smallest hash
    one = text.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("x"))
    return one.select("id", "x.text", "x.label")


def fit_in_task(rows: DataFrame, columns: list[str], example: Callable[..., Example], **settings) -> tuple[np.ndarray, float]:
    """Weights and bias of an ``Ftrl`` fitted to feature rows (id, label, ``columns`` of lists) in one task, in the order of ids.

    The rows are a sample whose size ``sample_labelled`` bounds; ``example`` takes
    a label and the columns' arrays. The driver gets the weights alone.
    """

    def run(batches):
        held = []
        for batch in batches:
            lists = [batch.column(c) for c in columns]
            for k, (own, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                held.append((own, example(label, *[np.array(x[k].values.to_numpy()) for x in lists])))
        held.sort(key=lambda x: x[0])
        weights, bias = Ftrl(**settings).fit([x for _, x in held]).model()
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "bias": [bias]}, schema=pa.schema([("weights", pa.binary()), ("bias", pa.float64())]))

    found = rows.repartition(1).mapInArrow(run, "weights binary, bias double").first()
    return (np.frombuffer(found.weights, np.float32), found.bias) if found else Ftrl().model()


def score_column(text: F.Column, scorer) -> F.Column:
    """Score of a text column; ``scorer``: list of texts (bytes) -> scores. Texts are taken in bounded blocks."""

    def run(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        return pa.array(np.concatenate([np.empty(0), *(scorer(texts) for _, texts in blocks([batch]))]), pa.float64())

    return F.arrow_udf(run, "double")(text.cast("string"))

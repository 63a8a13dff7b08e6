"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL, scored as sparse dot products.

The value of a feature is its share among the text's n-gram occurrences times
SCALE, so a score doesn't depend on a text's length and is a mean of weights.

Scale: one map over the documents for the sample of at most about
MAX_ROWS labelled texts (the bound on what one task trains on), one for the
scores; no shuffle of other texts. The model is a fixed 4 MB array.

Defined cases: null, empty and token-less texts get the score of the bias
alone; repeated rows are scored each; of several texts with one labelled id, that of
the smallest hash teaches; without labelled rows every score is
0.5; empty tables give no rows; other columns of the input are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.common import blocks, bounded_batches
from shiftlake.llm.linear import BITS, Example, features, fit_in_task, sample_labelled, score_column, sigmoid, tokens

#: Labelled texts that training takes, about.
MAX_ROWS = 6000
SCALE = 24.0


def _rows(batches):
    for batch, texts in blocks(batches):
        hashes, shapes, bounds = tokens(texts)
        doc, index = features(hashes, shapes, bounds)
        code, count = np.unique((doc.astype(np.int64) << BITS) | index, return_counts=True)
        at = np.searchsorted(code >> BITS, np.arange(len(texts) + 1))
        size = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        value = (count / size[code >> BITS]).astype(np.float32)
        offsets = pa.array(at.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(offsets, pa.array((code & ((1 << BITS) - 1)).astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(value))],
            names=["id", "label", "index", "value"],
        )


def train_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    train: F.Column | None = None, max_rows: int = MAX_ROWS,
) -> tuple[np.ndarray, float]:
    """Weights and bias learned from labelled rows whose ``id`` fulfils ``train``."""
    bounded_batches(docs.sparkSession)
    sample = sample_labelled(docs, labels, label, id_col, text_col, F.lit(True) if train is None else train, max_rows)
    rows = sample.mapInArrow(_rows, f"id {docs.schema[id_col].dataType.simpleString()}, label double, index array<int>, value array<float>")
    example = lambda y, index, value: Example(y, index, value * np.float32(SCALE))
    return fit_in_task(rows, ["index", "value"], example, alpha=0.5, l1=0.02, l2=0.02, epochs=6)


def quality_score(text: F.Column, model: tuple[np.ndarray, float]) -> F.Column:
    """The probability that the label is 1, for a text column."""
    weights, bias = model

    def scorer(texts: list[bytes]) -> np.ndarray:
        hashes, shapes, bounds = tokens(texts)
        doc, index = features(hashes, shapes, bounds)
        size = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        return sigmoid(bias + SCALE * np.bincount(doc, weights=weights[index], minlength=len(texts)) / size)

    return score_column(text, scorer)

"""Toxicity: logistic regression whose scores must not change when identity terms are swapped.

Features are the distinct hashed 1- and 2-grams of a text. In every labelled
text that holds identity terms, each is swapped for the next term of its group
(ring order); besides the log loss, training penalises the square of the change
of the logit (PARITY times). So a neutral mention of a group doesn't raise the
score, whatever the labelled rows say about how often groups are abused.

Scale: as the quality classifier; MAX_ROWS bounds the labelled sample.

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

MAX_ROWS = 12000
PARITY = 1.0
#: Terms that are exchanged within their group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("africans", "europeans", "asians", "americans"),
    ("immigrants", "refugees", "foreigners", "natives"), ("immigrant", "refugee", "foreigner", "native"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("disabled", "deaf", "blind"), ("elderly", "young", "old"),
)


def _ring(groups) -> tuple[np.ndarray, np.ndarray]:
    terms = [t for g in groups for t in g]
    after = [g[(k + 1) % len(g)] for g in groups for k in range(len(g))]
    one, two = (tokens([t.encode() for t in x])[0] for x in (terms, after))
    order = np.argsort(one)
    return one[order], two[order]


def _rows(groups):
    def run(batches):
        terms, after = _ring(groups)
        mask = (1 << BITS) - 1
        for batch, texts in blocks(batches):
            hashes, _, bounds = tokens(texts)
            at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            held = terms[at] == hashes
            real, other = (
                np.unique((doc.astype(np.int64) << BITS) | index)
                for doc, index in (features(h, None, bounds) for h in (hashes, np.where(held, after[at], hashes)))
            )
            lists = []
            for code in (real, np.setdiff1d(real, other), np.setdiff1d(other, real)):
                cut = np.searchsorted(code >> BITS, np.arange(len(texts) + 1)).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(cut, (code & mask).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *lists], names=["id", "label", "index", "only", "swapped"])

    return run


def train_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    train: F.Column | None = None, max_rows: int = MAX_ROWS, groups=IDENTITY_GROUPS, parity: float = PARITY,
) -> tuple[np.ndarray, float]:
    """Weights and bias learned from labelled rows whose ``id`` fulfils ``train``."""
    bounded_batches(docs.sparkSession)
    sample = sample_labelled(docs, labels, label, id_col, text_col, F.lit(True) if train is None else train, max_rows)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, label double, index array<int>, only array<int>, swapped array<int>"

    def example(y: float, index: np.ndarray, only: np.ndarray, swapped: np.ndarray) -> Example:
        change = (np.concatenate((only, swapped)), np.concatenate((np.ones(len(only)), -np.ones(len(swapped))))) if len(only) + len(swapped) else None
        return Example(y, index, np.ones(len(index), np.float32), change)

    return fit_in_task(sample.mapInArrow(_rows(groups), schema), ["index", "only", "swapped"], example, alpha=0.5, l1=6.0, l2=0.05, epochs=6, parity=parity)


def toxicity_score(text: F.Column, model: tuple[np.ndarray, float]) -> F.Column:
    """The probability that the label is 1, for a text column."""
    weights, bias = model

    def scorer(texts: list[bytes]) -> np.ndarray:
        hashes, _, bounds = tokens(texts)
        doc, index = features(hashes, None, bounds)
        weighty = weights[index] != 0
        code = np.unique((doc[weighty].astype(np.int64) << BITS) | index[weighty])
        return sigmoid(bias + np.bincount(code >> BITS, weights=weights[code & ((1 << BITS) - 1)], minlength=len(texts)))

    return score_column(text, scorer)

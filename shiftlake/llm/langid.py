"""Language ID: language-bitmask n-gram filters.

Method: byte n-grams (GRAM bytes; ASCII lower-cased, everything but letters a
space, runs of spaces one) are counted per language in Spark. A language's
n-grams are those that make up at least LEAST_SHARE of its training n-grams.
One Bloom filter holds them all in bit slices: every slot is a bitmask of
languages, and the AND of an n-gram's slots is the set of languages that may
contain it. A text's count of n-grams per language is corrected for the
filter's false positives, hits = (count - n * f) / (1 - f) with f the rate of
that language's slice, and the language with the most wins.

Scale: counts are aggregated in each task before the shuffle; one language has
at most 1 / LEAST_SHARE n-grams, so what is collected and sent to the tasks is
bounded for any corpus. Prediction is one map over the documents.

Defined cases: a null or letter-less text is ``und`` with score 0, as is every
text when nothing was learned; a text none of whose n-grams is known gets the
language with the most training n-grams and score 0; ties go to the smaller
name; repeated rows are predicted each; empty tables give no rows; other
columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.llm.common import U64, _LOWER, blocks, bounded_batches, join_texts, mix, per_text

GRAM = 5
LEAST_SHARE = 1e-5
HASHES = 3
SLOTS_PER_GRAM = 16
#: Distinct (language, n-gram) counts that a task holds before it passes them on.
HELD = 2_000_000

_KEEP = np.full(256, 32, np.uint8)
_KEEP[65:91] = _LOWER[65:91]
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of all texts, and where each text's begin (with the total)."""
    raw, offsets = join_texts(texts)
    buf = _KEEP[raw]
    gap = buf == 32
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    # a text begins and ends in a space; the shortest, " x ", is filled up to one n-gram
    first = np.zeros(len(buf), bool)
    first[offsets[:-1]] = True
    fill = np.where(first, GRAM - 2, 0) + keep
    out = np.repeat(np.where(first & ~gap, np.uint8(32), buf), fill)
    at = np.concatenate(([0], np.cumsum(fill)))
    last = at[offsets[:-1]] + fill[offsets[:-1]] - 1
    out[last] = buf[offsets[:-1]]
    bounds = at[offsets]
    code = np.zeros(max(0, len(out) - GRAM + 1), U64)
    for k in range(GRAM):
        code = (code << U64(8)) | out[k : len(out) - GRAM + 1 + k].astype(U64)
    ends = bounds[1:] - GRAM + 1
    starts = np.maximum(bounds[:-1], np.minimum(bounds[:-1] + GRAM - 3, ends - 1))  # one leading space, if the text is long enough
    ends = np.maximum(ends, starts)
    use = np.zeros(len(code) + 1, np.int32)
    np.add.at(use, starts, 1)
    np.add.at(use, ends, -1)
    mask = np.cumsum(use)[: len(code)] > 0
    return code[mask], np.concatenate(([0], np.cumsum(ends - starts)))


def _count(batches):
    names: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        keys = np.concatenate([k for k, _ in held])
        values, where = np.unique(keys, return_inverse=True)
        return values, np.bincount(where, weights=np.concatenate([c for _, c in held])).astype(np.int64)

    def out(keys, counts):
        labels = np.array(list(names), object)
        for lo in range(0, len(keys), 1 << 18):
            part = keys[lo : lo + (1 << 18)]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(labels[(part >> U64(8 * GRAM)).astype(int)], pa.string()),
                "gram": pa.array((part & U64((1 << 8 * GRAM) - 1)).astype(np.int64)), "n": pa.array(counts[lo : lo + (1 << 18)]),
            })

    for batch, texts in blocks(batches):
        code, bounds = grams(texts)
        lang = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], U64)
        held.append(np.unique((lang[per_text(bounds)] << U64(8 * GRAM)) | code, return_counts=True))
        if sum(len(k) for k, _ in held) > HELD:
            held = [merged()]
            if len(held[0][0]) > HELD // 2:
                yield from out(*held[0])
                held = []
    if held:
        yield from out(*merged())


@dataclass
class LanguageFilter:
    """Bit-sliced Bloom filter: slot -> bitmask of languages (one word for 64 of them)."""

    languages: list[str]
    slots: np.ndarray    # slots x words
    false: np.ndarray    # false-positive rate per language
    most: int            # the language with the most training n-grams

    def masks(self, codes: np.ndarray) -> np.ndarray:
        one, two = mix(codes + U64(1)), mix(codes ^ U64(0xA5A5A5A5A5A5A5A5)) | U64(1)
        out, last = None, U64(len(self.slots) - 1)
        for k in range(HASHES):
            got = self.slots[((one + U64(k) * two) >> U64(20)) & last]
            out = got if out is None else out & got
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        codes, bounds = grams(texts)
        n, doc = np.diff(bounds), per_text(bounds)
        found = self.masks(codes)
        width = 8 * self.slots.dtype.itemsize
        hits = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            bit = (found[:, k // width] >> found.dtype.type(k % width)) & found.dtype.type(1)
            hits[:, k] = np.maximum(np.bincount(doc, weights=bit, minlength=len(texts)) - n * self.false[k], 0) / (1 - self.false[k])
        best, total = hits.argmax(axis=1), hits.sum(axis=1)
        best[total == 0] = self.most
        share = hits.max(axis=1) / np.where(total > 0, total, 1)
        named = [self.languages[k] if has_letter(t) else "und" for k, t in zip(best, texts, strict=True)]
        return named, np.where([x == "und" for x in named], 0.0, np.minimum(share, 1.0))


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def build_filter(counts: DataFrame) -> LanguageFilter | None:
    """From (lang, gram, n) rows; None if there are none."""
    totals = {r["lang"]: r["t"] for r in counts.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    least = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(max(2, int(LEAST_SHARE * v))))])
    kept = counts.where(F.col("n") >= least[F.col("lang")]).select("lang", "gram").toArrow()
    lang = np.searchsorted(languages, kept.column("lang").to_pylist())
    codes = kept.column("gram").to_numpy().astype(U64)
    sizes = np.bincount(lang, minlength=len(languages))
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if len(languages) <= 8 * t().itemsize), np.uint64)
    width = 8 * kind().itemsize
    slots = 1 << max(10, int(SLOTS_PER_GRAM * max(1, sizes.max()) - 1).bit_length())
    out = LanguageFilter(languages, np.zeros((slots, -(-len(languages) // width)), kind), np.zeros(len(languages)), languages.index(max(languages, key=totals.get)))
    one, two = mix(codes + U64(1)), mix(codes ^ U64(0xA5A5A5A5A5A5A5A5)) | U64(1)
    for k in range(HASHES):
        at = ((one + U64(k) * two) >> U64(20)) & U64(slots - 1)
        np.bitwise_or.at(out.slots, (at, lang // width), (np.ones(1, kind)[0] << (lang % width).astype(kind)))
    for k in range(len(languages)):
        out.false[k] = float(((out.slots[:, k // width] >> kind(k % width)) & kind(1)).mean()) ** HASHES
    return out


def train_languages(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageFilter | None:
    """A filter learned from all rows with a language and a text."""
    from shiftlake.llm.common import Scratch

    scratch = Scratch(docs.sparkSession, "langid")
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = scratch.save(counted, "counts")
    out = build_filter(counts)
    scratch.drop("counts")
    return out


def predict_languages(docs: DataFrame, model: LanguageFilter | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch, texts in blocks(batches):
            named, score = model.predict(texts) if model else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(named, pa.string()), pa.array(score, pa.float64())], names=[id_col, "lang_pred", "score"])

    rows = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, rows)

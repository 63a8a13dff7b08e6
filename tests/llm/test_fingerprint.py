"""Fingerprints against a plain Python version, and their likeness against exact generalised Jaccard similarity."""

import collections
import hashlib
import math
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shiftlake.llm import fingerprint
from shiftlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    (900, None), (901, ""), (902, " \t\n"), (903, "x"), (904, "X"), (905, "été \U0001f600 naïve   end"), (906, "w" * 5000),
    (907, " ".join(f"t{k % 97}" for k in range(30000))), (908, "a b c d"), (908, "a b c d"), (908, "other text"), (None, "no id"), (None, None),
]


def weights(text):
    return collections.Counter(w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w)


def jaccard(a, b):
    every = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in every) / sum(max(a[k], b[k]) for k in every) if every else 1.0


def digest(parts):
    """Spark's xxhash64 of the values: strings, longs and ints."""
    h = 42
    for x in parts:
        h = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else struct.pack("<q" if isinstance(x, np.int64) else "<i", x), seed=h)
    return h


def plain(text, size):
    out = []
    for k in range(size):
        best = None
        for word, n in weights(text).items():
            term = np.array([digest([word])], np.uint64).view(np.int64)[0]
            of_r, of_c = digest([term, 2 * k]), digest([term, 2 * k + 1])
            u = [[((h >> 21 * i & 0x1FFFFF) + 0.5) / 2**21 for i in range(3)] for h in (of_r, of_c)]
            r, c = -math.log(u[0][0] * u[0][1]), -math.log(u[1][0] * u[1][1])
            t = math.floor(math.log(n) / r + u[0][2])
            a = math.log(c) - r * (t - u[0][2] + 1)
            found = (math.floor((a + 128) * 2**23), (of_c >> 32 ^ of_r ^ t * 2654435761) & 0xFFFFFFFF)
            best = found if best is None or found < best else best
        out.append(f"{best[1]:08x}" if best else "0" * 8)
    return "".join(out)


@pytest.fixture(scope="module")
def rows(spark):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return real + [(300, real[0][1])] + ODD


@pytest.fixture(scope="module")
def found(spark, rows):
    """Extra columns have names that the operator uses itself."""
    table = spark.createDataFrame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, n_chars int, fingerprint string, no_id boolean")
    return fingerprint.fingerprint_edits(table.repartition(5)).collect()


def text_hash(text):
    return np.array([digest([text or ""])], np.uint64).view(np.int64)[0]


def test_edits_and_likeness(rows, found):
    order = sorted({(i is None, i or 0, text_hash(t), t or "") for i, t in rows})
    follows = {order[k][:3]: order[(k + 1) % len(order)][3] for k in range(len(order))}
    by_text = {}
    assert sum(r.n_rows for r in found) == len(rows) and len(found) == len(order)
    texts = {(i, len(t or "")): t or "" for i, t in rows}
    for r in found:
        by_text.setdefault(texts[r.doc_id, r.n_chars], r.fingerprint)
    errors = []
    for r in found:
        text = texts[r.doc_id, r.n_chars]
        following = follows[r.doc_id is None, r.doc_id or 0, text_hash(text)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == by_text[text]
        cut = lambda f: [f[k : k + 8] for k in range(0, len(f), 8)]
        same = lambda a, b: np.mean([x == y for x, y in zip(cut(a), cut(b), strict=True)])
        assert r.near_edited == same(r.fingerprint, r.edited_fingerprint) and r.near_next == same(r.fingerprint, by_text[following])
        errors += [r.near_edited - jaccard(weights(text), weights(edited)), r.near_next - jaccard(weights(text), weights(following))]
    assert abs(np.mean(errors)) < 0.01 and np.mean(np.abs(errors)) < 0.06 and np.max(np.abs(errors)) < 0.4


def test_samples_match_plain_python(rows, found):
    texts = {(i, len(t or "")): t or "" for i, t in rows}
    short = [r for r in found if len(weights(texts[r.doc_id, r.n_chars])) < 60][:25]
    assert len(short) >= 15
    for r in short:
        assert r.fingerprint == plain(texts[r.doc_id, r.n_chars], 32)


def test_weights_count(spark):
    """The collision rate is that of the weights, not of the sets of words."""
    a, b = "x " * 30 + "y " * 10, "x " * 10 + "y " * 30
    table = spark.createDataFrame([(k, (t + f"z{k} ") * 1) for k, t in ((0, a), (1, b))], "doc_id long, text string")
    one, two = (r.fingerprint for r in fingerprint.fingerprints(table, size=128).orderBy("doc_id").collect())
    near = np.mean([one[k : k + 8] == two[k : k + 8] for k in range(0, 1024, 8)])
    assert abs(near - 20 / 62) < 0.15


def test_little(spark):
    schema = "doc_id long, text string"
    assert fingerprint.fingerprint_edits(spark.createDataFrame([], schema)).collect() == []
    one = fingerprint.fingerprint_edits(spark.createDataFrame([(5, "a b c")], schema)).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in one] == [(5, 5, hashlib.sha256(b"a ba ").hexdigest(), 1.0)]


def test_native_and_registered(spark):
    out = QUERIES["op12_fingerprints"](spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                                "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}
    found = out.agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n"), F.count("*").alias("c")).first()
    assert found.c == spark.read.parquet(f"{SF}/documents.parquet").count() and found.e > found.n

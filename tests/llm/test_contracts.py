"""Registered queries with their folds and cuts, and the pipeline's stages, against plain Python over whole texts."""

import collections
import math
import re
import zlib

import corpus_pipeline as P
import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlake.llm import linear, pii, quality, toxicity
from shiftlake.llm.common import U64, hash_spans, hash_windows, mix
from shiftlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(rb"([A-Za-z\x80-\xff]+)|([0-9]+)|([!-/:-@\[-`{-~\x7f]+)")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def one_hash(token):
    return hash_spans(np.frombuffer(token, np.uint8), np.array([0]), np.array([len(token)]))[0]


def shape(match):
    token, letters, digits = match[0], match[1], match[2]
    if not letters and not digits:
        return one_hash(token)
    upper = sum(65 <= b <= 90 for b in token)
    case = 0 if not upper else (1 if len(token) == 1 else 2) if upper == len(token) else 1 if upper == 1 and 65 <= token[0] <= 90 else 3
    return U64(((1 if letters else 2) << 8) + case)


def grams(text, shapes):
    """Feature numbers of a text's n-grams, one by one."""
    found = list(TOKEN.finditer(text.encode()))
    tokens = [one_hash(m[0].translate(LOWER)) for m in found]
    out = list(tokens)
    out += [hash_windows(np.array(tokens[k : k + 2], U64), 2)[0] for k in range(len(tokens) - 1)]
    if shapes:
        marks = [mix(np.array([shape(m) + U64(0x51ED270B)], U64))[0] for m in found]
        out += [hash_windows(np.array(marks[k : k + n], U64), n)[0] for n in (1, 2, 3) for k in range(len(marks) - n + 1)]
    return [int(h) >> 64 - linear.BITS for h in out]


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_quality(text, model):
    weights, bias = model
    count = collections.Counter(grams(text, True))
    return sigmoid(bias + quality.SCALE * sum(float(weights[i]) * n for i, n in count.items()) / max(1, sum(count.values())))


def test_op6_is_a_dot_product_of_shares(spark, texts):
    model = quality.train_quality(documents(spark), labels(spark), train=F.crc32(F.col("id").cast("string")) % 4 != 2)
    got = QUERIES["op6_quality"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.7)
        assert r.score == pytest.approx(plain_quality(texts[r.doc_id], model), abs=1e-6)


def test_op5_is_a_sum_over_distinct_grams(spark, texts):
    weights, bias = toxicity.train_toxicity(documents(spark), labels(spark), train=F.crc32(F.col("id").cast("string")) % 5 != 0)
    got = QUERIES["op5_toxicity"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5)
        assert r.score == pytest.approx(sigmoid(bias + sum(float(weights[i]) for i in set(grams(texts[r.doc_id], False)))), abs=1e-6)


def test_models_do_not_hang_on_the_order_of_rows_or_of_equal_ids(spark):
    rows = [(k % 60, f"w{k % 7} v{k % 5} {'good' if k % 60 % 2 else 'bad'} {k // 60}") for k in range(120)]  # each id twice, with different texts
    marks = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    models = [quality.train_quality(spark.createDataFrame(own, "doc_id long, text string").repartition(n), marks) for own, n in ((rows, 1), (rows[::-1], 3))]
    assert (models[0][0] == models[1][0]).all() and models[0][1] == models[1][1]


@pytest.mark.parametrize("name, n, rest, columns", [
    ("op1_language_id", 3, 1, {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op8_lm_score", 5, 1, {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}),
])
def test_folds_and_types(spark, texts, name, n, rest, columns):
    out = QUERIES[name](spark, SF)
    assert {k: v for k, v in out.dtypes if k in columns} == columns
    got = out.collect()
    assert sorted(r.doc_id for r in got) == sorted(texts) and all(r.held_out == (fold(r.doc_id, n) == rest) for r in got)
    if name == "op1_language_id":
        known = {r.lang for r in documents(spark).select("lang").distinct().collect()}
        assert all(0 <= r.score <= 1 and (r.lang_pred in known) != (r.lang_pred == "und") for r in got)
        assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id])) for r in got)


def shingles(text, width=5):
    w = WORDS.findall(text.translate(LOW))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_stages_keep_what_plain_python_keeps(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in docs.collect()}

    model = quality.train_quality(docs, labels(spark))
    good = P.quality(spark, docs, SF)
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert kept == {k for k, r in rows.items() if plain_quality(r.text or "", model) >= P.LEAST_QUALITY}

    sets, parent = {k: shingles(rows[k].text or "") for k in kept}, {k: k for k in kept}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in kept:
        for b in kept:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    single = P.near_dedup(spark, good, SF)
    kept = {r.doc_id for r in single.select("doc_id").collect()}
    assert kept == {k for k in sets if root(k) == k}

    items = [t.translate(LOW) for t in (r.text or "" for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
    asked = [(min(5, len(WORDS.findall(t))), t) for t in items if WORDS.findall(t)]
    clean = P.decontamination(spark, single, SF)

    def leaks(text):
        by_width = {k: shingles(text, k) if len(WORDS.findall(text)) >= k else set() for k in {k for k, _ in asked}}
        return any(100 * len(shingles(t, k) & by_width[k]) >= 80 * len(shingles(t, k)) for k, t in asked)

    left = {r.doc_id: r for r in clean.collect()}
    assert set(left) == {k for k in kept if not leaks(rows[k].text or "")}
    assert all(r == rows[k] for k, r in left.items())

    spans = {r.doc_id: r.pii for r in pii.find_pii(clean).collect()}
    for r in P.pii(spark, clean, SF).collect():
        text, out, at = rows[r.doc_id].text or "", [], 0
        for s in spans[r.doc_id]:
            if s.start >= at:
                out += [text[at : s.start], f"[{s.name.upper()}]"]
            at = max(at, s.end)
        want = "".join([*out, text[at:]])
        assert (r.text or "") == want and r.n_chars == len(want) and (r.lang, r.source) == (rows[r.doc_id].lang, rows[r.doc_id].source)


def test_redaction_keeps_columns_of_any_name(spark):
    rows = [(1, "mail bob@example.org now", "a", 5, "x"), (2, None, "b", None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string, pii_proposed int, row string")
    got = pii.redacted(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "mail [EMAIL] now", "a", 5, "x"), (2, None, "b", None, "y")]


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "one"), (1, "one"), (1, "two"), (None, "three")]])
def test_stages_on_little(spark, rows):
    """Empty tables, null and empty texts, repeated and null ids: no stage fails, and columns of any name stay."""
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "q") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"], name
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert len({r.doc_id for r in packed}) <= len(rows)

"""Each operator against brute force on a small table with nulls, empty, long and repeated texts."""

import collections
import hashlib
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shiftlake.llm import decontam, langid, lm, near_dup, packing, pii, quality, substring, topk, toxicity
from shiftlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, data string"
ODD = [
    None, "", " \t\n", "x", "X y", "a b c d e", "a b c d e", "été \U0001f600 naïve   end", "w" * 5000, "1" * 3000 + " a.b.c " * 50,
    " ".join(f"t{k % 97}" for k in range(3000)), " ".join(f"T{k}" for k in range(60)), " ".join(f"t{k}" for k in range(60)) + " tail",
    "mail bo.b@x.org, ip 1.2.3.4 256.1.1.1, +1 (234) 567-8901; 4111 1111 1111 1111", "A@b.c_x@d.e <|endoftext|> 1.2.3.4.5.6.7.8",
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(10_000 + k, t, "en" if k % 2 else None, None, None) for k, t in enumerate(ODD)], real.schema)
    # extra columns whose names the operators use themselves
    return real.union(odd).withColumn("score", F.lit(1.0)).withColumn("id", F.lit("x")).withColumn("data", F.lit("y")).repartition(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text, lower=True):
    return WORDS.findall(text.translate(LOW) if lower else text)


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, texts, empty, width):
    sets, parent = {k: shingles(t, width) for k, t in texts.items()}, {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = near_dup.near_duplicates(docs, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {k: (len(sets[k]), root(k), root(k) == k) for k in ids}
    assert len(got) == len(ids)
    if width == 5:
        assert near_dup.near_duplicates(empty).count() == 0


def test_near_duplicates_chain_null_ids_and_repeated_rows(spark):
    base = [f"w{k}" for k in range(60)]
    chain = [" ".join(base[: 60 - 3 * k] + [f"n{k}x{j}" for j in range(3 * k)]) for k in range(6)]  # neighbours alike, ends not
    rows = [(k + 1, t) for k, t in enumerate(chain)] + [(1, chain[0]), (None, chain[0]), (9, "other words here")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert len(got) == len(rows)
    sets = {k: shingles(t, 2) for k, t in rows if k}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    parent = {k: k for k in sets}
    for _ in sets:
        for a, b in linked:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert all(r.component_id == parent[r.doc_id] for r in got if r.doc_id)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_near_copies_with_many_outliers_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for k in range(150):
        t = list(base)
        for at in rng.choice(80, rng.integers(1, 9), replace=False):
            t[at] = f"e{rng.integers(10**6)}"
        rows.append((k, " ".join(t)))
    sets, parent = {k: shingles(t, 2) for k, t in rows}, list(range(150))
    changed = True
    links = [(a, b) for a in range(150) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(parent))
    assert len(set(parent)) > 1


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    text = lambda name, tail="": " ".join(f"{name}{k}" for k in range(60)) + tail
    x, y, b = text("x"), text("y"), text("b")
    rows = [(3, x), (5, x + " near"), (5, b), (6, y), (5, y + " near"), (8, b + " near"), (9, text("q")), (9, text("q", " near")), (7, x + "  near"), (7, text("z"))]
    schema = "doc_id long, text string"
    got = {(r.doc_id, t): (r.component_id, r.kept) for r in near_dup.judged_texts(spark.createDataFrame(rows, schema)).collect()
           for i, t in rows if i == r.doc_id and spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).first()[0] == r.text_key}
    nine = [got.pop((9, t)) for t in (text("q"), text("q", " near"))]
    assert got == {
        (3, x): (3, True), (5, x + " near"): (3, False), (5, b): (5, True), (6, y): (5, False), (5, y + " near"): (5, True),
        (8, b + " near"): (5, False), (7, x + "  near"): (3, False), (7, text("z")): (7, True),
    }
    assert [c for c, _ in nine] == [9, 9] and sorted(k for _, k in nine) == [False, True]
    assert near_dup.near_duplicates(spark.createDataFrame(rows, schema)).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_substring(docs, texts, empty):
    for width in (35, 3):
        count = collections.Counter(tuple(w[i : i + width]) for w in (words(t, False) for t in texts.values()) for i in range(len(w) - width + 1))
        got = {r.doc_id: r for r in substring.remove_repeated_windows(docs, width=width).collect()}
        assert got.keys() == texts.keys()
        for k, t in texts.items():
            w = words(t, False)
            gone = [False] * len(w)
            for i in range(len(w) - width + 1):
                if count[tuple(w[i : i + width])] > 1:
                    gone[i : i + width] = [True] * width
            assert (got[k].n_words, got[k].n_removed) == (len(w), sum(gone))
            assert got[k].kept_text == " ".join(x for x, g in zip(w, gone, strict=True) if not g)
            assert [i for s in got[k].removed for i in range(s.start, s.end)] == [i for i, g in enumerate(gone) if g]
            assert all(a.end < b.start for a, b in zip(got[k].removed, got[k].removed[1:], strict=False))
    assert substring.remove_repeated_windows(empty).count() == 0


def test_language_model(docs, texts, empty):
    train = F.col("doc_id") % 3 != 1
    got = {r.doc_id: r for r in lm.score_documents(docs, train).collect()}
    tokens = {k: [*words(t), "\n"] for k, t in texts.items()}
    uni, bi = collections.Counter(), collections.Counter()
    for k, t in tokens.items():
        if k % 3 != 1:
            uni.update(t)
            bi.update(zip(["<s>", *t[:-1]], t, strict=True))
    n, v, types = sum(uni.values()), len(uni), len(bi)
    preds, ctx, by = collections.Counter(w for _, w in bi), collections.Counter(), collections.defaultdict(lambda: [0] * 4)
    for (a, _), c in bi.items():
        ctx[a] += c
        by[a][min(c, 3)] += 1
    high, low = (lm.discounts(*(sum(x == k for x in c.values()) for k in (1, 2, 3, 4))) for c in (bi, preds))
    spare = sum(low[min(c, 3)] for c in preds.values()) / types
    one = lambda w: max(preds[w] - low[min(preds[w], 3)], 0) / types + spare / (v + 1)

    def two(a, w):
        if not ctx[a]:
            return one(w)
        return max(bi[a, w] - high[min(bi[a, w], 3)], 0) / ctx[a] + sum(high[k] * by[a][k] for k in (1, 2, 3)) / ctx[a] * one(w)

    for k, t in tokens.items():
        r = got[k]
        assert (r.trained_on, r.n_tokens, r.n_known, r.train_tokens) == (k % 3 != 1, len(t), sum(uni[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert r.score == pytest.approx(sum(math.log10(two(a, w)) for a, w in zip(["<s>", *t[:-1]], t, strict=True)))
    assert sum(two("the", w) for w in uni) + spare / (v + 1) * sum(high[k] * by["the"][k] for k in (1, 2, 3)) / max(ctx["the"], 1) == pytest.approx(1, abs=1e-6)
    assert lm.score_documents(empty, F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) for r in lm.score_documents(docs.limit(5), F.lit(False)).collect())


def test_decontamination(spark, docs, texts, empty):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    edited = " ".join(f"t{k}" for k in range(20)) + " changed " + " ".join(f"t{k}" for k in range(21, 60))
    items = items.union(spark.createDataFrame([(900, "a b c d e"), (901, None), (902, ""), (903, "x"), (904, "A B C D E"), (905, edited)], items.schema))
    held = {r.item_id: r.text or "" for r in items.collect()}
    expected = set()
    for i, t in held.items():
        w = words(t)
        if not w:
            continue
        width, own = min(5, len(w)), shingles(t, min(5, len(w)))
        for k, d in texts.items():
            n = len(own & shingles(d, width)) if len(words(d)) >= width else 0
            if 100 * n >= 80 * len(own):
                expected.add((k, i, len(own), n))
    assert any(n < m for _, _, m, n in expected)
    for block in (20_000, 7):
        assert {tuple(r) for r in decontam.contained_items(docs, items, block_items=block).collect()} == expected
    kept = decontam.decontaminate(docs, items)
    assert {r.doc_id for r in kept.collect()} == texts.keys() - {e[0] for e in expected} and kept.columns == docs.columns
    assert decontam.contained_items(empty, items).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).count() == len(texts)


def test_items_of_one_shingle_have_coordinates_for_the_miss_bound():
    for text in (b"x", b"a b c d", b"a b c d e"):
        (index,), _ = decontam.item_indexes([text], 5, 80)
        assert (1 - 1 / 3) ** index.coordinates <= decontam.MISS  # one shingle in a window of three


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def _base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == 3 or _luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_pii(docs, texts, empty):
    found = pii.find_pii(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [(s.start, s.kind, s.end) for s in r.pii if s.base] == _base(texts[r.doc_id])
        assert all(0 <= s.score <= 1 for s in r.pii)
    got = {r.doc_id: r.text for r in pii.redact(pii.find_pii(docs)).collect()}
    assert got[10_000] is None and got[10_013] == "mail [EMAIL], ip [IP] 256.1.1.1, [PHONE]; [CARD]"
    for k, t in texts.items():
        if not _base(t):
            assert (got[k] or "") == t or "[" in got[k]
    assert pii.redact(pii.find_pii(empty)).count() == 0


def test_pii_adds_supported_spans_only(spark):
    rows = [(k, f"number {k}. call me, phone 555-234-{1000 + k} or key AKIA{k:02d}ABCDEFGHIJ1234 now") for k in range(30)]
    rows += [(99, "part 123-45-67890 and 12-345-6789 and tokens: none")]
    spans = {r.doc_id: [r.text[s.start : s.end] for s in r.pii] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[99] == [] and all("555-234" in spans[k][0] and spans[k][1].startswith("AKIA") for k in range(30))


def test_pii_secrets_with_blanks_quotes_and_any_length(spark):
    long = "".join(hashlib.sha256(bytes([k])).hexdigest() for k in range(5))[:300]
    secrets = [
        f'token = "{long[:40]}"', f'TOKEN = "{long[:40].upper()}"', f"token={long}", f"sk-{long}", f"ghs_{long}",
        f"'api_key': '{long[40:80]}'", f"password:\t{long[:9]}", f'secret="{long}"',
    ]
    rows = [(k, f"some words {x} and more, token: classification") for k, x in enumerate(secrets)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(pii.find_pii(table)).collect()}
    for k, x in enumerate(secrets):
        quote = x[-1] if x[-1] in "\"'" else ""
        ahead = "'" if x[0] == "'" else ""
        assert got[k] == f"some words {ahead}[SECRET]{quote} and more, token: classification"


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path).collect()
    ids = {k: [*model.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        own = struct.unpack(f"<{r.length}I", r.ids)
        assert list(own) == ids[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for k, own in ids.items():
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at
            at += length
        assert at == len(own)
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.pack_documents(empty, path).count() == 0


def test_packer_keeps_few_windows_open():
    packer, rng = packing.Packer(64), np.random.default_rng(1)
    total = 0
    for k in range(20_000):
        n = int(rng.integers(33, 64))  # no two fit together
        total += n
        packer.add(k, b"\0\0\0\0" * n)
        assert packer.count <= packing.OPEN_WINDOWS and packer.level.sum() == packer.count
    packer.refill(last=True)
    sizes = [sum(len(p[2]) for p in w) // 4 for w in packer.done]
    assert sum(sizes) == total and all(s & (s - 1) == 0 for s in sizes) and sum(s != 64 for s in sizes) <= 6


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(700)]
    rows += [(700, rows[3][1]), (701, rows[3][1]), (702, None), (703, [1.0, None]), (704, [float("nan")] * 8), (705, [float("inf")] * 8), (None, [1.0] * 8), (3, rows[3][1]), (800, [1e4] * 8), (801, [0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = {(k, tuple(v)) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    ints = [(k, [math.floor(1024 * x) for x in v]) for k, v in ok]
    expected = set()
    for q, x in ints:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), k) for k, y in ints if k != q)[:10]
            expected |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(scored)}
    for block, part in ((8192, 1024), (100, 2)):
        got = topk.top_inner_products(vectors, F.col("vec_id") % 100 == 0, block_rows=block, query_rows=part).collect()
        assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert topk.top_inner_products(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_language_id(docs, empty):
    model = langid.train_languages(docs.where("doc_id % 3 <> 1"))
    got = langid.predict_languages(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    real = [r for r in got if r.doc_id < 10_000 and r.doc_id % 3 == 1]
    assert sum(r.lang == r.lang_pred for r in real) >= 0.95 * len(real)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {10_000, 10_001, 10_002}
    assert langid.train_languages(empty) is None
    assert {r.lang_pred for r in langid.predict_languages(docs, None).collect()} == {"und"}
    # no n-gram that was learned is missed
    codes, _ = langid.grams([(r.text or "").encode() for r in got if r.lang == "en" and r.doc_id < 10_000 and r.doc_id % 3 != 1])
    values, n = np.unique(codes, return_counts=True)
    common = values[n >= max(2, langid.LEAST_SHARE * 2 * len(codes))]
    assert ((model.masks(common)[:, 0] >> model.languages.index("en")) & 1).all()


def test_quality_and_toxicity(spark, docs, empty):
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for label, train, score, least in (("quality", quality.train_quality, quality.quality_score, 0.95), ("toxic", toxicity.train_toxicity, toxicity.toxicity_score, 0.8)):
        model = train(full, labels, train=F.col("id") % 4 != 2)
        rows = full.select("doc_id", score(F.col("text"), model).alias("s")).join(labels.where(f"{label} is not null and doc_id % 4 = 2"), "doc_id").collect()
        good, bad = [r.s for r in rows if r[label]], [r.s for r in rows if not r[label]]
        assert np.mean([a > b for a in good for b in bad]) >= least
        assert all(0 <= r.s <= 1 for r in docs.select(score(F.col("text"), model).alias("s")).collect())
        none = train(full, labels.limit(0))
        assert {r.s for r in docs.select(score(F.col("text"), none).alias("s")).collect()} == {0.5}
        assert empty.select(score(F.col("text"), model)).count() == 0


def test_identity_swaps_lower_false_positives(spark):
    rows, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        who = "women" if toxic or k % 10 == 1 else ""  # in the labels, mostly abuse names the group
        rows.append((k, f"w{k} w{k * 7 % 50} {who} {'idiot' if toxic and k % 2 else ''} v{k % 40}"))
        labels.append((k, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([("women",), ("men",), ("idiot women",)], "text string")
    plain, fair = ([r.s for r in probe.select(toxicity.toxicity_score(F.col("text"), toxicity.train_toxicity(docs, labels, parity=p)).alias("s")).collect()] for p in (0.0, 5.0))
    assert abs(fair[0] - fair[1]) < abs(plain[0] - plain[1]) / 2 and fair[2] > fair[0]


def test_registered_queries_on_the_smallest_table(spark):
    digest = {r.doc_id: r for r in QUERIES["op4_packing"](spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert all(r.n == r.t for r in digest.values())
    one = QUERIES["op4_packing"](spark, SF).where("start = 0").orderBy("doc_id").first()
    ids = packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode([spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") == one.doc_id).first().text])[0]
    assert one.ids_crc32 == zlib.crc32((ids + b"\1\0\0\0")[: 4 * one.length])
    for r in QUERIES["op3_pii"](spark, SF).collect():
        if not r.spans:
            assert r.base_sha256 == hashlib.sha256(b"").hexdigest()
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())

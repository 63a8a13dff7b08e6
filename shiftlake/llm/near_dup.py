"""MinHash near-dedup: circulant MinHash, banding, exact Jaccard verification.

Method: a shingle is mapped to a position by a first permutation (the mixer of
its hash, cut to POSITIONS); the k-th signature coordinate is the minimum of a
second permutation, circularly shifted by k, over the positions. All
coordinates of a shingle are thus one contiguous slice of the second
permutation. Rows of the signature are banded, documents that share a band are
candidates, and a link needs the exact Jaccard similarity of the full sets.

Plan: documents with equal sets form a class, represented by its smallest
(doc_id, text hash) and named by a number of its own, so exact copies never
become pairs and texts that share a doc_id stay apart. In a band bucket every member is
first compared with the bucket's hub only, the member that shares most buckets
with most others. Components are then found, and buckets that still hold
several of them are finished exactly. In one of at most FEW members, members of
different components are compared in pairs. The members of the larger ones take
part in a prefix join: the shingles of each set are ordered from the rarest to
the commonest (among those members), and two sets of the wanted similarity must
share a shingle so early in both orders that what follows can still make up the
overlap. Only pairs of different components are formed, and of a shingle's
largest component only against the others, so a group of near copies with many
outliers doesn't become pairs. No link between candidates is lost. Sets are
compared for pairs only whose sketches (the lowest four bits of 256
coordinates) agree often enough. With 48 bands of 6 rows a pair at similarity
0.8 shares no band with probability 5e-7, and its sketches agree too rarely
with a probability of the same order.

Scale: shuffled are 48 short rows a class, the compressed texts once (to fetch
those of candidates), the candidates' compressed texts, and the shingles of
members of large mixed buckets. Group statistics are partially aggregated
before the shuffle; joins on a hot class, bucket, shingle or hub are plain
sort-merge joins, which adaptive execution splits. Every step starts from
written tables.

Defined cases: a null or word-less text has the empty set and is linked with
nothing; fewer words than a shingle make one shingle of the whole sequence;
repeated rows are one class; a null doc_id gets no component (null, kept);
rows that share a doc_id but not the text are judged one by one, and of those
that hold a component's smallest id one text is kept (the smallest hash); an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftlake.llm.common import BLOCK_BYTES, U64, Scratch, blocks, hash_windows, hash_words, inside, mix, per_text, text_bytes

BANDS, ROWS = 48, 6
COORDINATES = BANDS * ROWS
POSITION_BITS = 20
POSITIONS = 1 << POSITION_BITS
SEED = 20240607
#: Shingles whose coordinates are gathered at a time.
STEP = 4096
#: Longs of a sketch; each holds four bits of 16 coordinates.
SKETCH = 16
#: Members of a bucket up to which its components are compared in pairs.
FEW = 16


@functools.lru_cache(maxsize=1)
def _slices() -> np.ndarray:
    """Row p: the second permutation at p, p+1, ... p+COORDINATES-1 (circular)."""
    second = np.random.default_rng(SEED).permutation(POSITIONS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((second, second[:COORDINATES])), COORDINATES)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and where each text's begin."""
    words, bounds = hash_words(texts, lower=True)
    counts = np.diff(bounds)
    ok = inside(bounds, width)
    doc, grams = per_text(bounds)[: len(ok)][ok], hash_windows(words, width)[ok]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = [hash_windows(words[bounds[k] : bounds[k + 1]], int(counts[k]))[0] for k in short]
        doc, grams = np.concatenate((doc, short)), np.concatenate((grams, np.array(whole, U64)))
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    return grams, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Circulant MinHash coordinates of each set (rows of empty sets hold the largest value)."""
    out = np.full((len(bounds) - 1, COORDINATES), np.iinfo(np.int32).max, np.int32)
    at = (mix(grams ^ U64(SEED)) >> U64(64 - POSITION_BITS)).astype(np.int64)
    doc = per_text(bounds)
    view = _slices()
    for lo in range(0, len(at), STEP):
        hi = min(lo + STEP, len(at))
        first, last = doc[lo], doc[hi - 1]
        here = np.arange(first, last + 1)
        here = here[bounds[here + 1] > bounds[here]]
        starts = np.maximum(bounds[here], lo) - lo
        least = np.minimum.reduceat(view[at[lo:hi]], starts, axis=0)
        out[here] = np.minimum(out[here], least)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each document and band."""
    part = signature.reshape(len(signature), BANDS, ROWS).astype(U64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), part.shape[:2])
    for r in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key


def sketches(signature: np.ndarray) -> np.ndarray:
    """The lowest four bits of the first coordinates, 16 in each long."""
    part = (signature[:, : 16 * SKETCH].astype(U64) & U64(15)).reshape(len(signature), SKETCH, 16)
    return (part << (U64(4) * np.arange(16, dtype=U64))).sum(axis=2, dtype=U64)


def _alike(x: str, y: str, percent: int) -> F.Column:
    """Whether two sketches agree as often as a pair at the threshold does, less five standard deviations."""
    n, ones = 16 * SKETCH, 0x1111111111111111
    agree = percent / 100 + (1 - percent / 100) / 16
    least = n * agree - 5 * (n * agree * (1 - agree)) ** 0.5
    differ = F.lit(0)
    for k in range(SKETCH):
        d = F.col(x)[k].bitwiseXOR(F.col(y)[k])
        any_bit = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseOR(F.shiftrightunsigned(d, 3))
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(ones)))
    return differ <= n - least


def _sign(width: int):
    def run(batches):
        for batch, texts in blocks(batches):
            grams, bounds = shingle_sets(texts, width)
            n = np.diff(bounds)
            signed = signatures(grams, bounds)
            keys, short = band_keys(signed).view(np.int64), sketches(signed).view(np.int64)
            sums = [np.concatenate(([0], np.cumsum(mix(grams + U64(add))))).astype(U64) for add in (17, 91)]
            prints = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
            bands, sketch = (pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel()) for x in (keys, short))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(prints[0]), pa.array(prints[1]), bands, sketch],
                names=["doc_id", "text_key", "n", "f1", "f2", "bands", "sketch"],
            )

    return run


def _packed(batches):
    """Texts compressed one by one."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data = [pack.compress(t) for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(data, pa.binary())], names=["doc_id", "text_key", "data"])


def _runs(rows: list[tuple[bytes, ...]]):
    """(first, end) of runs of rows whose texts hold about BLOCK_BYTES when decompressed."""
    first, held = 0, 0
    for k, row in enumerate(rows):
        size = sum(zstandard.frame_content_size(x) for x in row)
        if k > first and held + size > BLOCK_BYTES:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(rows):
        yield first, len(rows)


def _tokens(width: int):
    """One row for each member of each set."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            data = batch.column("data").to_pylist()
            nodes = batch.column("node").to_numpy()
            for lo, hi in _runs([(x,) for x in data]):
                grams, bounds = shingle_sets([unpack.decompress(x) for x in data[lo:hi]], width)
                doc, n = per_text(bounds), np.diff(bounds)
                sums = np.concatenate(([0], np.cumsum(mix(grams)))).astype(U64)
                which = (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)
                columns = [pa.array(x) for x in (nodes[lo:hi][doc], which[doc], n[doc], grams.view(np.int64))]
                whole = pa.RecordBatch.from_arrays(columns, names=["node", "set_id", "n", "token"])
                for at in range(0, whole.num_rows, 1 << 16):
                    yield whole.slice(at, 1 << 16)

    return run


def _exact(width: int, percent: int):
    """Of the pairs with their texts: those whose sets are as similar as wanted."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            pairs = list(zip(batch.column("data_a").to_pylist(), batch.column("data_b").to_pylist(), strict=True))
            keep = []
            for lo, hi in _runs(pairs):
                number = {x: k for k, x in enumerate(dict.fromkeys(x for pair in pairs[lo:hi] for x in pair))}
                grams, bounds = shingle_sets([unpack.decompress(x) for x in number], width)
                for x, y in pairs[lo:hi]:
                    a, b = (grams[bounds[number[z]] : bounds[number[z] + 1]] for z in (x, y))
                    both = np.sort(np.concatenate((a, b)))
                    common = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of an edge table (a, b): alternating large and small stars until nothing changes."""
    edges, before, step = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), None, 0
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = small.select("a", F.col("m").alias("b")).union(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = scratch.save(edges, f"{name}-{step}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if step:
            scratch.drop(f"{name}-{step - 1}")
        if now == before:
            break
        before, step = now, step + 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over links), kept (id is that smallest id).

    ``width``: words of a shingle (ASCII lower-cased); ``percent``: least Jaccard similarity of a link.
    Texts that share the smallest id are all kept here; ``judged_texts`` keeps one of them.
    """
    judged = judged_texts(docs, id_col, text_col, width, percent)
    return judged.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))).drop("text_key")


def judged_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``near_duplicates`` with ``text_key``, the xxhash64 of the text that was judged."""
    scratch = Scratch(docs.sparkSession, "neardup")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    signed = scratch.save(text.mapInArrow(_sign(width), "doc_id long, text_key long, n long, f1 long, f2 long, bands array<long>, sketch array<long>"), "signed")

    real = signed.where("n > 0 and doc_id is not null")
    classes = real.groupBy("n", "f1", "f2").agg(F.min(F.struct("doc_id", "text_key", "bands", "sketch")).alias("r"))
    # the number is fixed by writing it; a doc_id may stand for several texts and so for several classes
    numbered = classes.select("n", "f1", "f2", F.monotonically_increasing_id().alias("node"), "r.doc_id", "r.text_key", "r.bands", "r.sketch")
    classes = scratch.save(numbered, "classes")

    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = scratch.save(banded.join(sizes, "bucket"), "members")
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weights, "node").groupBy("bucket").agg(F.min(F.struct(-F.col("weight"), "node"))["node"].alias("hub"))

    wanted = members.select("node").distinct().join(classes.select("node", "doc_id", "text_key"), "node")
    packed = text.where("doc_id is not null").mapInArrow(_packed, "doc_id long, text_key long, data binary")
    found = packed.join(wanted, ["doc_id", "text_key"])
    sets = scratch.save(found.dropDuplicates(["doc_id", "text_key"]).select("node", "data"), "sets")

    def like(x: str, y: str) -> F.Column:
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    def alike(pairs: DataFrame) -> DataFrame:
        for c in "ab":
            pairs = pairs.join(classes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")), c)
        return pairs.where(like("na", "nb") & _alike("sa", "sb", percent)).select("a", "b").distinct()

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        side = [sets.select(F.col("node").alias(c), F.col("data").alias(f"data_{c}")) for c in "ab"]
        checked = pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "data_a", "data_b").mapInArrow(_exact(width, percent), "a long, b long")
        return scratch.save(checked, name)

    first = members.join(hubs, "bucket").where("node != hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    tested = scratch.save(alike(first), "pairs-0")
    links = linked(tested, "links-0")
    groups = scratch.save(components(links, scratch, "stars-0"), "groups-0")

    own = members.join(groups, "node", "left").select("bucket", "node", "n", "size", F.coalesce("component", "node").alias("component"))
    mixed = own.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("bucket")
    own = scratch.save(own.join(mixed, "bucket"), "own")

    few = own.where(F.col("size") <= FEW).select("bucket", "node", "n", "component")
    other = few.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "component")])
    near = few.join(other, "bucket").where((F.col("node") < F.col("node_b")) & (F.col("component") != F.col("component_b")) & like("n", "n_b"))
    near = near.select(F.col("node").alias("a"), F.col("node_b").alias("b"))

    many = own.where(F.col("size") > FEW).select("node").distinct()
    tokens = scratch.save(sets.join(many, "node").mapInArrow(_tokens(width), "node long, set_id long, n long, token long"), "tokens")
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    order = Window.partitionBy("node", "set_id").orderBy(F.coalesce("held", F.lit(1)), "token")
    early = tokens.join(held, "token", "left").withColumn("rest", F.col("n") + 1 - F.row_number().over(order))
    early = early.where(F.col("held").isNotNull() & (100 * F.col("rest") >= percent * F.col("n")))
    early = early.join(groups, "node", "left").select("token", "node", "n", "rest", F.coalesce("component", "node").alias("component"))
    early = scratch.save(early, "early")
    # per shingle: the largest component and the smallest set; a set takes part if a set of that size can still be a link
    parts = early.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    parts = parts.groupBy("token").agg(F.max(F.struct("c", "component"))["component"].alias("top"), F.min("least").alias("least"), F.count(F.lit(1)).alias("parts"))
    can = (100 + percent) * 100 * F.col("rest") >= percent * (100 * F.col("n") + F.greatest(100 * F.col("least"), percent * F.col("n")))
    early = scratch.save(early.join(parts.where("parts > 1"), "token").where(can).drop("least", "parts"), "prefixes")
    other = early.select("token", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "rest", "component")])
    far = early.where("component != top").join(other, "token").where(
        (F.col("component") != F.col("component_b")) & like("n", "n_b")
        & ((100 + percent) * F.least("rest", "rest_b") >= percent * (F.col("n") + F.col("n_b")))
    )
    far = far.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))

    pairs = scratch.save(alike(near.union(far).distinct().join(tested, ["a", "b"], "left_anti")), "pairs-1")
    scratch.drop("own", "tokens", "early", "prefixes")
    stars = groups.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = scratch.save(components(stars.union(linked(pairs, "links-1")), scratch, "stars-1"), "groups-1")

    least = classes.join(groups, "node").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("r"))
    least = scratch.save(least.select("component", F.col("r.doc_id").alias("least_id"), F.col("r.text_key").alias("least_key")), "least")
    named = classes.select("n", "f1", "f2", "node", "doc_id", "text_key").join(groups.join(least, "component"), "node", "left")
    named = named.select("n", "f1", "f2", F.coalesce("least_id", "doc_id").alias("component_id"), F.coalesce("least_key", "text_key").alias("least_key"))
    named = scratch.save(named, "named")
    scratch.drop("sets", "members", "classes", "least")
    out = signed.select("doc_id", "text_key", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    real = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    kept = ~real | ((F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("least_key")))
    mine = F.when(real, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), mine.alias("component_id"), kept.alias("kept"), "text_key")

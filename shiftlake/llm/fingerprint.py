"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Method: a document is its words (ASCII and Unicode lower-cased, cut at space and
0x09-0x0D), each weighted by how often it occurs. For a word and a coordinate,
two hashes give r and c, Gamma(2, 1) each, and b, uniform; at weight w the word's
sample is t = floor(ln w / r + b) with ln a = ln c - r * (t - b + 1). The
coordinate keeps (word, t) of the least a. Two documents agree in a coordinate
with the probability of their generalised Jaccard similarity, the sum of lesser over the
sum of greater weights; the share of equal coordinates estimates it.
A coordinate is compared as ln a in steps of 2**-23 before 32 bits of a hash of
(word, t), packed in one long, so the least sample is a plain ``min`` of a long.

Scale: equal (id, text) rows are pre-aggregated; one shuffle of the texts by
(id, hash of the text) serves words, weights and samples, as all group by that
key and more. Who follows whom is found on keys alone, by ranges of ids, with one
bounded row for each range's border. A text goes to its predecessor cut to the length that is
needed. Nothing is sent to the driver.

Defined cases: a null text is an empty text; texts without words have the
fingerprint of zeros and are like each other (1) and unlike all others (0);
equal (id, text) rows are one document, given once with ``n_rows``; documents
of one id follow each other in the order of a hash of the text; null ids come
last; a document alone follows itself; empty tables give no rows; other columns of the input are left
out. Ids are whole numbers.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shiftlake.llm.common import Scratch

#: Coordinates of a fingerprint.
SIZE = 32
#: Bits of each uniform number; three come from one hash.
UNIFORM = 21
#: ln a lies within 128 of zero; its steps are 2**-STEP.
STEP = 23

#: Odd number that spreads t over 32 bits.
SPREAD = 2654435761

KEY = ["no_id", "id", "text_hash"]


def _uniform(h: Column, k: int) -> Column:
    """The k-th of three uniform numbers in (0, 1) of a hash."""
    return (F.shiftrightunsigned(h, UNIFORM * k).bitwiseAND((1 << UNIFORM) - 1) + 0.5) * 2.0**-UNIFORM


def _sample(k: int, log_weight: str) -> Column:
    """The sample of the word ``term`` in coordinate k, packed; null where the log weight is."""
    of_r, of_c = F.xxhash64("term", F.lit(2 * k)), F.xxhash64("term", F.lit(2 * k + 1))
    r, b = -F.ln(_uniform(of_r, 0) * _uniform(of_r, 1)), _uniform(of_r, 2)
    log_c = F.ln(-F.ln(_uniform(of_c, 0) * _uniform(of_c, 1)))
    t = F.floor(F.col(log_weight) / r + b)
    steps = F.floor((log_c - r * (t - b + 1.0) + 128.0) * float(1 << STEP))
    name = F.shiftrightunsigned(of_c, 32).bitwiseXOR(of_r).bitwiseXOR(t * SPREAD)
    return F.shiftleft(steps, 32).bitwiseOR(name.bitwiseAND((1 << 32) - 1))


def consistent_samples(terms: DataFrame, keys: list[str], weights: list[str], size: int = SIZE) -> DataFrame:
    """(keys, one fingerprint for each of the columns ``weights``, of that name) from rows (keys, term: long, weights).

    A weight of 0 is no occurrence. r, b and c are drawn once for all weights of a word.
    """
    rows = terms.select(*keys, "term", *[F.ln(F.col(w).cast("double")).alias(w) for w in weights])
    least = rows.groupBy(*keys).agg(*[F.min(_sample(k, w)).alias(f"{w}{k}") for k in range(size) for w in weights])
    digits = lambda c: F.lpad(F.lower(F.hex(F.coalesce(F.col(c), F.lit(0)).bitwiseAND((1 << 32) - 1))), 8, "0")
    return least.select(*keys, *[F.concat(*[digits(f"{w}{k}") for k in range(size)]).alias(w) for w in weights])


def word_weights(texts: DataFrame, keys: list[str], versions: dict[str, Column]) -> DataFrame:
    """(keys, term, one number of occurrences for each version): the hashes of the words of several texts a row."""
    cut = lambda text: F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    every = F.inline(F.array(*[F.struct(F.lit(v).alias("version"), cut(text).alias("words")) for v, text in enumerate(versions.values())]))
    words = texts.select(*keys, every).select(*keys, "version", F.explode("words").alias("word")).where("word <> ''")
    counts = [F.count_if(F.col("version") == v).alias(name) for v, name in enumerate(versions)]
    return words.select(*keys, "version", F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(*counts)


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """The share of equal coordinates of two fingerprints."""
    part = lambda x, k: F.substring(x, 8 * k + 1, 8)
    same = functools.reduce(operator.add, [(part(a, k) == part(b, k)).cast("int") for k in range(size)])
    return same / F.lit(float(size))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with their key and text; ``id`` is 0 where there is none."""
    own, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(own.isNull().alias("no_id"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _documents(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """One row for each (id, text), partitioned by the key."""
    return _keyed(docs, id_col, text_col).groupBy(*KEY).agg(F.first("text").alias("text"), *more)


def followers(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """(key, n_chars, n_rows, key of the next document as next_*) of every document, by ascending id; the first follows the last."""
    sizes = _keyed(docs, id_col, text_col).select(*KEY, F.length("text").alias("n_chars"))
    keys = sizes.groupBy(*KEY, "n_chars").agg(F.count(F.lit(1)).alias("n_rows"))
    ranges = scratch.save(keys.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id()), "ranges")
    own = F.struct(*KEY)
    # one row a range: its first key is what the last of the range before is followed by
    first = ranges.groupBy("range").agg(F.min(own).alias("first"))
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    border = F.coalesce(F.lead("first").over(Window.orderBy("range")), F.first("first").over(whole))
    borders = F.broadcast(first.select("range", border.alias("border")))
    following = F.lead(own).over(Window.partitionBy("range").orderBy(*KEY))
    linked = ranges.withColumn("following", following).join(borders, "range").withColumn("following", F.coalesce("following", "border"))
    links = scratch.save(linked.select(*KEY, "n_chars", "n_rows", *[F.col(f"following.{k}").alias(f"next_{k}") for k in KEY]), "links")
    scratch.drop("ranges")
    return links


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(id, n_rows, n_chars, fingerprint) of every document."""
    own = _documents(docs, id_col, text_col, F.count(F.lit(1)).alias("n_rows"))
    found = consistent_samples(word_weights(own, KEY, {"fingerprint": F.col("text")}), KEY, ["fingerprint"], size)
    none = F.lit("0" * 8 * size)
    out = own.join(found, KEY, "left")
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_rows", F.length("text").alias("n_chars"), F.coalesce("fingerprint", none).alias("fingerprint"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Fingerprints of every document and of its edit, in which the next document's beginning replaces its second half.

    (id, n_rows, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    scratch = Scratch(docs.sparkSession, "fingerprint")
    links = followers(docs, id_col, text_col, scratch)
    own = _documents(docs, id_col, text_col)  # alike in both joins, so that the texts are shuffled once
    half = F.floor(F.col("n_chars") / 2).cast("int")
    follows = links.select(*[F.col(k).alias(f"of_{k}") for k in KEY], half.alias("half"), "n_rows", *[F.col(f"next_{k}").alias(k) for k in KEY])
    beginnings = own.join(follows, KEY).select(*[F.col(f"of_{k}").alias(k) for k in KEY], "half", "n_rows", F.left("text", F.col("half")).alias("beginning"))
    kept = F.left("text", F.length("text") - F.col("half"))
    both = own.join(beginnings, KEY).select(*KEY, "n_rows", "text", F.concat(kept, F.col("beginning")).alias("edited"))

    versions = {"fingerprint": F.col("text"), "edited_fingerprint": F.col("edited")}
    found = consistent_samples(word_weights(both, KEY, versions), KEY, list(versions), size)
    about = both.select(*KEY, "n_rows", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    none = F.lit("0" * 8 * size)
    whole = about.join(found, KEY, "left").select(
        *about.columns, F.coalesce("fingerprint", none).alias("fingerprint"), F.coalesce("edited_fingerprint", none).alias("edited_fingerprint")
    )
    whole = scratch.save(whole, "fingerprints")
    nexts = whole.select(*KEY, F.col("fingerprint").alias("next_fingerprint")).join(follows.drop("half", "n_rows"), KEY)
    nexts = nexts.select(*[F.col(f"of_{k}").alias(k) for k in KEY], "next_fingerprint")
    return whole.join(nexts, KEY).select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_rows", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), size).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), size).alias("near_next"),
    )

"""Records of delimited files whose quoted cells may hold line breaks, read split by split.

Two passes over the lines that Spark's text source deals out:

1. ``catalogue``: every split is scanned for both states it may begin in (at the
   start of a record, or inside a quoted cell), as its true state is not known
   yet. A split is then a function of two states; composing the functions in file
   order (a window over one small row per split) gives each split's true state.
   The same pass takes the header of each file.
2. ``assembled``: every split, told its state, puts its lines together to records. The piece of a
   record that crosses a border goes by the split where the record begins, and
   only such pieces are shuffled.

Inside a quoted cell a doubled quote is a quote; text between the closing
quote and the next separator doesn't reopen the cell; a quote inside an unquoted cell is
ordinary text. Both passes must see the same splits: the number that Spark
derives their size from is fixed at the first pass, and a split that the second
pass doesn't know fails the read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits whose states are broadcast (17 bytes each); beyond it the splits must be larger.
MAX_SPLITS = 4_000_000

#: Where a record is from: file (and its hash), start of the split, place among the split's lines.
PLACE = ["file_key", "file", "block", "pos"]


def place() -> list[Column]:
    """The columns of PLACE, of a file source's rows."""
    path = F.col("_metadata.file_path")
    return [F.xxhash64(path).alias("file_key"), path.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")]


def ends_in_quotes(line: str, inside: bool, sep: str, quote: str) -> bool:
    """Whether a line ends inside a quoted cell, if it begins there or (``inside`` false) with a new record."""
    at, n = 0, len(line)
    while True:
        if not inside:
            if at < n and line[at] == quote:
                at, inside = at + 1, True
            else:
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
        end = line.find(quote, at)
        if end < 0:
            return True
        if end + 1 < n and line[end + 1] == quote:
            at = end + 2
            continue
        at = line.find(sep, end + 1) + 1
        if not at:
            return False
        inside = False


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line, PLACE, split: hash of file, start and length of the split), in order inside a split."""
    least = "spark.sql.files.minPartitionNum"
    if spark.conf.get(least, None) is None:  # else the splits hang on how many executors there are just now
        spark.conf.set(least, str(spark.sparkContext.defaultParallelism))
    text = spark.read.option("lineSep", "\n").text(paths)
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length")
    return text.select(F.col("value").alias("line"), *place(), split.alias("split"))


def _runs(batches):
    """Of each batch, the runs of rows of one split: (batch, first, end)."""
    for batch in batches:
        split = batch.column("split").to_numpy()
        cuts = np.flatnonzero(np.diff(split)) + 1
        for first, end in zip([0, *cuts], [*cuts, len(split)], strict=True):
            if end > first:
                yield batch, int(first), int(end)


def _summaries(sep: str, quote: str):
    """One row for each split: where each starting state leads, and the file's header."""
    names = ["file_key", "file", "block", "split", "to_if_out", "to_if_in", "breaks", "closes", "header"]

    def run(batches):
        now: dict | None = None
        head: list[str] | None = None

        def row():
            if head is not None and now["header"] is None and any(x.strip() for x in head):
                raise ValueError(f"the header of {now['file']} is longer than a split")
            return pa.RecordBatch.from_pylist([now], schema=schema)

        schema = pa.schema([(n, pa.string() if n in ("file", "header") else pa.bool_() if n in names[4:8] else pa.int64()) for n in names])
        for batch, first, end in _runs(batches):
            split = batch.column("split")[first].as_py()
            if now is None or split != now["split"]:
                if now is not None:
                    yield row()
                now = {n: batch.column(n)[first].as_py() for n in ("file_key", "file", "block", "split")}
                now |= {"to_if_out": False, "to_if_in": True, "breaks": False, "closes": False, "header": None}
                head = [] if now["block"] == 0 else None
            lines = batch.column("line")[first:end]
            k = 0
            while head is not None and k < len(lines) and now["header"] is None:
                line = lines[k].as_py()
                k += 1
                if not head and not line.strip():
                    continue
                head.append(line)
                inside = ends_in_quotes(line, len(head) > 1, sep, quote)
                if not inside:
                    now["header"] = "\n".join(head).removesuffix("\r")
            for line in lines.filter(pc.match_substring(lines, quote)).to_pylist():
                out = ends_in_quotes(line, now["to_if_out"], sep, quote)
                within = out if now["to_if_out"] == now["to_if_in"] else ends_in_quotes(line, now["to_if_in"], sep, quote)
                now["breaks"] |= out
                now["closes"] |= not within
                now["to_if_out"], now["to_if_in"] = out, within
        if now is not None:
            yield row()

    kinds = {"file": "string", "header": "string", **dict.fromkeys(names[4:8], "boolean")}
    return run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names)


@dataclass
class Catalogue:
    """What the first pass found. ``splits``: (file_key, file, block, split, inside, origin, crossed, header), written."""

    splits: DataFrame
    headers: list[str]
    n_files: int
    n_splits: int
    multi_line: bool

    def files(self) -> DataFrame:
        """(file_key, header_no): one row for each file."""
        spark = self.splits.sparkSession
        numbers = spark.createDataFrame(list(enumerate(self.headers)), "header_no int, header string")
        return self.splits.where("header is not null").join(F.broadcast(numbers), "header").select("file_key", "header_no")


def catalogue(spark: SparkSession, paths: list[str], sep: str, quote: str, folder: str) -> Catalogue:
    """Headers and states of all splits, from one pass over the lines; written to ``folder``."""
    lines = _lines(spark, paths)
    # lines without a quote say nothing but how a header reads, and paths are needed once for each file
    needed = F.when((F.col("block") == 0) | F.col("line").contains(quote), F.col("line"))
    scan, schema = _summaries(sep, quote)
    found = lines.select("file_key", F.when(F.col("block") == 0, F.col("file")).alias("file"), "block", "split", needed.alias("line")).mapInArrow(scan, schema)
    found.write.mode("overwrite").parquet(f"{folder}/scanned")
    found = spark.read.parquet(f"{folder}/scanned")
    # the state before a split: where the last split led that forgets its own start, turned by every later one that swaps the states
    before = Window.partitionBy("file_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    forgets, swaps = F.col("to_if_out") == F.col("to_if_in"), F.col("to_if_out") & ~F.col("to_if_in")
    turned = F.coalesce(F.sum(swaps.cast("int")).over(before), F.lit(0))
    placed = found.withColumn("turned", turned)
    known = F.last(F.when(forgets, F.struct("to_if_out", "turned")), ignorenulls=True).over(before)
    placed = placed.withColumn("known", known)
    turns = F.col("turned") - F.coalesce("known.turned", F.lit(0))
    inside = F.coalesce("known.to_if_out", F.lit(False)) != (turns % 2 == 1)
    placed = placed.withColumn("inside", inside)
    # a record that is open at a split's end began there, unless the split lies wholly inside it
    begins = F.when(~(F.col("inside") & ~F.col("closes")), F.col("block"))
    origin = F.last(begins, ignorenulls=True).over(before)
    # only these splits hold a piece of a record that crosses a border, or one that its file leaves open
    crossed = F.col("inside") | F.col("to_if_out")
    splits = placed.withColumn("origin", origin).select("file_key", "file", "block", "split", "inside", "origin", crossed.alias("crossed"), "header", "breaks")
    splits.write.mode("overwrite").parquet(f"{folder}/splits")
    splits = spark.read.parquet(f"{folder}/splits")
    headers = splits.where("header is not null").groupBy("header").agg(F.min("file").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("first").collect()
    total = splits.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(F.col("breaks") | F.col("inside")), F.lit(False)).alias("multi")).first()
    return Catalogue(splits, [r.header for r in headers], sum(r.n for r in headers), total.n, total.multi)


WHOLE, PIECE = 0, 1
RECORDS = "kind int, file_key long, file string, block long, pos long, origin long, record string"


@dataclass
class States:
    """Sorted hashes of all splits; of each, whether it begins inside a quoted cell, and the split where that record began."""

    split: np.ndarray
    inside: np.ndarray
    origin: np.ndarray

    def of(self, split: int) -> tuple[bool, int]:
        at = int(np.searchsorted(self.split, split))
        if at == len(self.split) or self.split[at] != split:
            raise ValueError("the files were split otherwise than at the first pass (have they or spark.sql.files.maxPartitionBytes changed?)")
        return bool(self.inside[at]), int(self.origin[at])


def _records(sent, kind: int, sep: str, quote: str):
    """The whole records of each split, or the pieces of those that cross its borders."""
    schema = pa.schema([("kind", pa.int32()), ("file_key", pa.int64()), ("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("origin", pa.int64()), ("record", pa.string())])
    own = ["file_key", "file", "block"]

    def run(batches):
        states: States = sent.value
        split, at, held, first_pos = None, None, [], 0
        inside = lead = heading = False
        origin = 0

        def out(text: str, pos: int, found: int, start: int):
            return [found, *at, pos, start, text]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

        def rest():
            """What is held at a split's end: the beginning, or a middle part, of a record that goes on."""
            if held and kind == PIECE:
                yield batch_of([out("\n".join(held), first_pos, PIECE, origin if lead else at[2])])

        for batch, first, end in _runs(batches):
            here = batch.column("split")[first].as_py()
            if here != split:
                if split is not None:
                    yield from rest()
                split, held = here, []
                at = [batch.column(n)[first].as_py() for n in own]
                inside, origin = states.of(split)
                lead, heading = inside, at[2] == 0
            lines, pos = batch.column("line")[first:end], batch.column("pos")[first:end]
            # lines without a quote leave the state as it is: only the others, and those of open records, are looked at one by one
            rows, solo, k = [], np.zeros(len(lines), bool), 0
            for at_quote in [*np.flatnonzero(pc.match_substring(lines, quote).to_numpy(zero_copy_only=False)).tolist(), len(lines)]:
                while k < at_quote and heading and not inside:
                    heading = not lines[k].as_py().strip()
                    k += 1
                if inside and k < at_quote:
                    first_pos = first_pos if held else pos[k].as_py()
                    held += lines[k:at_quote].to_pylist()
                else:
                    solo[k:at_quote] = True
                k = at_quote + 1
                if at_quote == len(lines):
                    break
                line = lines[at_quote].as_py()
                inside = ends_in_quotes(line, inside, sep, quote)
                if not held:
                    first_pos = pos[at_quote].as_py()
                held.append(line)
                if inside:
                    continue
                text, held = "\n".join(held), []
                if lead:
                    if kind == PIECE:
                        rows.append(out(text, first_pos, PIECE, origin))
                elif heading and text.strip():
                    heading = False
                elif kind == WHOLE:
                    rows.append(out(text, first_pos, WHOLE, 0))
                lead = False
            if kind == WHOLE and solo.any():
                chosen = pa.array(np.flatnonzero(solo))
                n = len(chosen)
                fixed = [pa.array([WHOLE] * n, pa.int32()), *[batch.column(c)[first:end].take(chosen) for c in own], pos.take(chosen), pa.array([0] * n, pa.int64()), lines.take(chosen)]
                yield pa.RecordBatch.from_arrays(fixed, schema=schema)
            if rows:
                yield batch_of(rows)
        if split is not None:
            yield from rest()

    return run


def assembled(spark: SparkSession, paths: list[str], found: Catalogue, sep: str, quote: str) -> DataFrame:
    """(PLACE, record) of every record but the headers; a record's place is that of its first line."""
    if found.n_splits > MAX_SPLITS:
        raise ValueError(f"{found.n_splits} splits are more than {MAX_SPLITS}; raise spark.sql.files.maxPartitionBytes")
    table = found.splits.select("split", "inside", F.coalesce("origin", F.lit(0)).alias("origin")).orderBy("split").toArrow()
    states = States(table.column("split").to_numpy(), table.column("inside").to_numpy(zero_copy_only=False), table.column("origin").to_numpy())
    sent = spark.sparkContext.broadcast(states)
    lines = _lines(spark, paths)
    whole = lines.mapInArrow(_records(sent, WHOLE, sep, quote), RECORDS).select(*PLACE, "record")
    crossed = found.splits.where("crossed").select("split")
    pieces = lines.join(F.broadcast(crossed), "split", "left_semi").select(*lines.columns).mapInArrow(_records(sent, PIECE, sep, quote), RECORDS)
    # the pieces of one record, in the order of their splits
    joined = pieces.groupBy("file_key", "origin").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "file", "record"))).alias("p"))
    joined = joined.select("file_key", F.col("p")[0]["file"].alias("file"), F.col("origin").alias("block"), F.col("p")[0]["pos"].alias("pos"), F.array_join("p.record", "\n").alias("record"))
    return whole.unionByName(joined)

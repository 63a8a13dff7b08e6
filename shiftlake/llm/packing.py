"""Sum-of-squares online packing of token sequences into windows of a fixed length.

Method: documents are tokenised (an end id after each) and taken one by one.
Full windows are cut off; the rest is placed into the fill level whose choice
makes the sum of squares of the numbers of partly filled windows per level
smallest, new windows included (ties: the fuller window). The level array
holds these numbers. When more than OPEN_WINDOWS are open, or the rows of a
task end, the open windows' pieces are cut anew to fill windows without a gap;
the task's last partial window is cut at powers of two, which need no padding.

Scale: one map over the documents, no shuffle. A task packs its own partition;
its state is the level array and at most OPEN_WINDOWS open windows.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; null ids are kept; an empty table gives no rows; other columns of
the input are left out.
"""

from __future__ import annotations

import itertools
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.llm.common import blocks, bounded_batches

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 1024
#: Units whose ids a task remembers.
CACHED = 400_000

#: Unicode white space, as the tokenizer's pattern has it.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters up to U+017F.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
#: The tokenizer's pattern never joins what units separate, so they are encoded apart. Words are cut off the signs
#: that follow them if a text has no character beyond U+017F, else a unit ends at white space only.
_FINE = re.compile(f" ?[{_L}]+| ?[^{_WS}{_L}]+(?:(?<=')[{_L}]+)?|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_COARSE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_WORD = re.compile(f" ?[{_L}]+")
_BEYOND = re.compile("[^\x00-\u017f]")


class WordTokenizer:
    """Token ids of texts (little-endian unsigned 32-bit), with a bounded memory of words' ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.known = Tokenizer.from_file(path), {}
        # byte-level vocabularies spell a byte that is no visible character as one from U+0100 on, in order
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = np.arange(256, dtype="<u4")
        self.spelling[hidden] = 256 + np.arange(len(hidden))
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]

    def _words(self, units: list[str]) -> list[bytes]:
        """Ids of units that are one word each to the tokenizer: its merges alone."""
        if not units:
            return []
        spelled = self.spelling[np.frombuffer("\n".join(units).encode(), np.uint8)].tobytes().decode("utf-32-le").split(chr(self.spelling[10]))
        tokenize = self.model.model.tokenize
        return [struct.pack(f"<{len(got)}I", *[t.id for t in got]) for got in map(tokenize, spelled)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not any(s in t for s in self.special) for t in texts]
        units = [(_COARSE if _BEYOND.search(t) else _FINE).findall(t) if p else [] for t, p in zip(texts, plain, strict=True)]
        if len(self.known) > CACHED:
            self.known = {}
        new = list(set(itertools.chain.from_iterable(units)).difference(self.known))
        words, rest = [], []
        for u in new:
            (words if _WORD.fullmatch(u) else rest).append(u)
        self.known.update(zip(words, self._words(words), strict=True))
        self.known.update(zip(rest, self._ids(rest), strict=True))
        known = self.known
        return [b"".join([known[u] for u in own]) if p else self._ids([t])[0] for t, own, p in zip(texts, units, plain, strict=True)]


class Packer:
    """Places pieces (document number, start, ids); ``done`` gets finished windows."""

    def __init__(self, length: int):
        self.length, self.level = length, np.zeros(length, np.int64)  # level[f]: open windows holding f ids
        self.open: dict[int, list[list]] = {}
        self.count, self.done = 0, []

    def add(self, key, ids: bytes) -> None:
        n = len(ids) // 4
        whole = n - n % self.length
        for at in range(0, whole, self.length):
            self.done.append([(key, at, ids[4 * at : 4 * (at + self.length)])])
        if n > whole:
            self._place((key, whole, ids[4 * whole :]), n - whole)

    def _place(self, piece: tuple, size: int) -> None:
        level, room = self.level, self.length - size
        after = np.append(level[size:], 0)[: room + 1]  # windows at the level that f becomes; full ones don't count
        cost = 2 * (after - level[: room + 1]) + 2
        cost[room] = 1 - 2 * level[room]
        cost[0] = 2 * level[size] + 1  # a new window
        cost[1:][level[1 : room + 1] == 0] = np.iinfo(np.int64).max
        fill = room - int(np.argmin(cost[::-1]))
        if fill:
            window = self.open[fill].pop()
            level[fill] -= 1
            self.count -= 1
        else:
            window = []
        window.append(piece)
        if fill + size == self.length:
            self.done.append(window)
            return
        self.open.setdefault(fill + size, []).append(window)
        level[fill + size] += 1
        self.count += 1
        if self.count > OPEN_WINDOWS:
            self.refill(last=False)

    def refill(self, last: bool) -> None:
        """Cut the open windows' pieces anew into full windows; what is left stays open or, at last, is cut at powers of two."""
        pieces = [p for fill in sorted(self.open, reverse=True) for w in self.open[fill] for p in w]
        self.open, self.count = {}, 0
        self.level[:] = 0
        left = sum(len(p[2]) for p in pieces) // 4
        window, room = [], min(self.length, left)
        sizes = [self.length] * (left // self.length)
        if last:
            sizes += [1 << b for b in range(self.length.bit_length(), -1, -1) if left % self.length >> b & 1]
        sizes = iter([*sizes, *([] if last else [left % self.length] if left % self.length else [])])
        room = next(sizes, 0)
        for key, start, ids in pieces:
            at = 0
            while at < len(ids):
                part = ids[at : at + 4 * room]
                window.append((key, start + at // 4, part))
                at += len(part)
                room -= len(part) // 4
                if not room:
                    held = sum(len(p[2]) for p in window) // 4
                    if held == self.length or last:
                        self.done.append(window)
                    else:
                        self.open[held], self.count = [window], 1
                        self.level[held] = 1
                    window, room = [], next(sizes, 0)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Pieces: id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(docs.sparkSession)
    rows = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])
    schema = to_arrow_schema(rows)

    def run(batches):
        from pyspark import TaskContext

        packer, model, sequence = Packer(length), None, TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()

        def out():
            nonlocal sequence
            cells = []
            for window in packer.done:
                offset = 0
                for (key, total), start, ids in window:
                    cells.append((key, start, len(ids) // 4, ids, total, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            packer.done = []
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*cells, strict=True), schema, strict=True)], schema=schema)

        for batch, texts in blocks(batches):
            model = model or WordTokenizer(tokenizer_path)
            keys = batch.column("id").to_pylist()
            for key, ids in zip(keys, model.encode([t.decode("utf-8", "replace") for t in texts]), strict=True):
                ids += end
                packer.add((key, len(ids) // 4), ids)
            yield from out()
        packer.refill(last=True)
        yield from out()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, rows)

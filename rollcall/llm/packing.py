"""Hierarchical packing of documents into windows of several context sizes.

Each task packs the documents it reads, block by block, so no text is shuffled. Whole windows are cut off long
documents; what is left of a document is routed to the smallest tier that holds it. Tiers are packed from the longest:
a window opens with a piece of its own tier, and its gap is filled by the longest shorter pieces that fit, the last one
cut where none does. Windows are therefore full; pieces left over go to the task's next block, and at its end into
windows of falling powers of two. Step groups hold windows of one tier and the same number of tokens each, also across
tasks: windows of a tier are numbered through by the counts of all tasks, and only the last group of a tier may be
smaller. The pieces are written once for that; a join with one row per task and tier adds the numbers.

Defined results: a null or empty text is the end token alone. Rows are packed one by one, so repeated rows and null
ids are separate documents. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.shared import Scratch, kind_of, only, text_batches
from rollcall.llm.vocabulary import WordIds

TIERS = (256, 512, 1024, 2048)
END = np.array([1], "<u4").tobytes()
#: Tokens held by a task before it packs, and tokens of a step group.
BLOCK_TOKENS = 2 << 20
GROUP_TOKENS = 1 << 17
#: Bits of a sequence_id below the number of the task.
LOCAL_BITS = 36
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, place long"


@lru_cache(maxsize=2)
def _words_of_worker(path: str) -> WordIds:
    """One tokenizer for all tasks of a worker."""
    return WordIds(path)


class Packer:
    """Pieces waiting by length, and the windows made of them. A piece is (document, start, ids, tokens of document)."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.longest = tiers, tiers[-1]
        self.waiting: list[list[tuple]] = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n: pieces of n tokens wait
        self.tokens = 0
        self.task, self.windows, self.of_tier = task, 0, dict.fromkeys((1 << i for i in range(self.longest.bit_length())), 0)
        self.out: list[tuple] = []

    def add(self, doc: object, ids: bytes) -> None:
        n, size = len(ids) // 4, self.longest
        whole = n - n % size
        for start in range(0, whole, size):
            self._window([(doc, start, ids[4 * start : 4 * (start + size)], n)], size)
        if whole < n:
            self._wait((doc, whole, ids[4 * whole :], n))

    def _wait(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        self.waiting[n].append(piece)
        self.lengths |= 1 << n
        self.tokens += n

    def _take(self, n: int) -> tuple:
        piece = self.waiting[n].pop()
        if not self.waiting[n]:
            self.lengths &= ~(1 << n)
        self.tokens -= n
        return piece

    def _longest_up_to(self, n: int) -> int:
        return (self.lengths & ((1 << (n + 1)) - 1)).bit_length() - 1

    def _shortest_over(self, n: int) -> int:
        over = self.lengths >> (n + 1)
        return (over & -over).bit_length() + n if over else -1

    def _filled(self, pieces: list[tuple], gap: int) -> list[tuple]:
        while gap:
            n = self._longest_up_to(gap)
            if n > 0:
                pieces.append(self._take(n))
            else:
                doc, start, ids, total = self._take(self._shortest_over(gap))
                pieces.append((doc, start, ids[: 4 * gap], total))
                self._wait((doc, start + gap, ids[4 * gap :], total))
                n = gap
            gap -= n
        return pieces

    def pack(self) -> None:
        """Full windows, tier by tier from the longest; pieces that can't fill one stay."""
        shortest = 0
        for tier in reversed(self.tiers):
            shortest = max([t for t in self.tiers if t < tier], default=0)
            while self.tokens >= tier and (n := self._longest_up_to(tier)) > shortest:
                self._window(self._filled([self._take(n)], tier - n), tier)

    def finish(self) -> None:
        self.pack()
        while self.tokens:
            size = min(1 << (self.tokens.bit_length() - 1), self.longest)
            self._window(self._filled([], size), size)

    def _window(self, pieces: list[tuple], size: int) -> None:
        sequence = (self.task << LOCAL_BITS) + self.windows
        place = self.of_tier[size]
        self.windows += 1
        self.of_tier[size] += 1
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, crc32(ids), total, sequence, offset, size, place, ids))
            offset += n

    def taken(self, kinds: list[pa.Field]) -> pa.RecordBatch:
        out, self.out = self.out, []
        columns = list(zip(*out, strict=True)) if out else [[] for _ in range(10)]
        arrays = []
        for values, field in zip(columns, kinds, strict=False):
            if pa.types.is_list(field.type):
                values = [np.frombuffer(v, "<u4") for v in values]
            arrays.append(pa.array(values, field.type))
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kinds])


def _grouped(pieces: DataFrame, group_tokens: int) -> DataFrame:
    """Pieces with the step group of their window instead of its place among the windows of its tier and task."""
    task = F.shiftright("sequence_id", LOCAL_BITS).alias("task")
    held = pieces.groupBy("tier", task).agg((F.max("place") + 1).alias("windows"))
    earlier = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("tier", "task", F.coalesce(F.sum("windows").over(earlier), F.lit(0)).alias("first"))
    of_group = F.greatest(F.lit(1), F.lit(group_tokens) / F.col("tier")).cast("long")
    number = F.floor((F.col("first") + F.col("place")) / of_group)
    group = number * 16 + F.length(F.bin("tier"))
    joined = pieces.withColumn("task", task).join(held, ["tier", "task"])
    return joined.select(*[c if c != "place" else group.cast("long").alias("step_group") for c in pieces.columns])


def packed(
    docs: DataFrame,
    path: str,
    tiers: tuple[int, ...] = TIERS,
    with_ids: bool = False,
    keep_caches: bool = False,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pieces of the token ids of all rows of `docs` (doc_id, text), each with the end token: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, and ids if asked for. A sequence_id holds the number
    of the task that packs it; a task that runs again reads the same rows and makes the same pieces. With `keep_caches`
    a worker keeps its caches, some 250 MB, for its next tasks: faster where nothing else needs the memory."""
    docs = only(docs, "doc_id", "text")
    schema = f"{kind_of(docs, 'doc_id')}, {PIECES}" + (", ids array<long>" if with_ids else "")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, kinds = _words_of_worker(path), Packer(TaskContext.get().partitionId(), tiers), None
        for batch in text_batches(batches):
            if kinds is None:
                longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
                kinds = [pa.field("doc_id", batch.schema.field("doc_id").type), *(pa.field(n, pa.int64()) for n in longs)]
                kinds += [pa.field("tier", pa.int32()), pa.field("place", pa.int64())]
                kinds += [pa.field("ids", pa.list_(pa.int64()))] * with_ids
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc, words.ids(text) + END)
            if packer.tokens >= BLOCK_TOKENS:
                packer.pack()
            if packer.out:
                yield packer.taken(kinds)
        packer.finish()
        if not keep_caches:
            words.forget()
        if packer.out:
            yield packer.taken(kinds)

    return _grouped(Scratch(docs.sparkSession).put(docs.mapInArrow(pack, schema), "pieces"), group_tokens)

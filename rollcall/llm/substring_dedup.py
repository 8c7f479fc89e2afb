"""Substring dedup: repeated word windows found with one compressed FM-index per shard.

Documents are cut into segments: runs of windows that share their smallest word triple (by hash), the seed. Equal
windows have equal seeds, so they meet in one shard. Three passes over the documents:

1. Per seed: the smallest and largest doc_id, and whether all its segments are equal. Tasks combine before the shuffle.
2. Segments of seeds that lie in several documents and vary go, once per task, to the shard of their seed. There an
   FM-index over the distinct segments (a wavelet matrix over the Burrows-Wheeler transform) is searched backwards for
   every window; the smallest document of a window's suffix interval is its first holder. Segments of a seed that don't
   vary need no search: the seed's smallest document holds all their windows.
3. Each segment of a repeated seed looks up the first holders of its windows; those before its own document are cut.

Which seeds are worth sending is told by a Bloom filter of bounded size; it lets others through by chance only, and
exact joins follow. A seed with very many distinct segments is cut into single windows, which are then dealt by their
own content, so no shard depends on one passage.

Defined results: a null or blank text has no words. Fewer words than a window are never cut. Equal doc_ids aren't
smaller than each other, so repeated rows and windows repeated within a document stay. A null doc_id counts as larger
than all others. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import (
    GOLDEN,
    Scratch,
    SplitTexts,
    bloom_filter,
    kind_of,
    mixed,
    only,
    passing,
    signed,
    text_batches,
    with_columns,
)

WINDOW = 13
SEED_WORDS = 3
#: Segments that a shard's index is built from, and distinct segments of one seed beyond which windows are dealt alone.
SHARD_SEGMENTS = 20_000
SEED_SEGMENTS = 5_000
#: Symbols whose intervals are looked up before a search goes on backwards; a power of two below the window.
LOOKED_UP = 8
LAST = np.iinfo(np.int64).max

_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if n > len(_POWERS.get("up", ())):
        base, inverse = int(GOLDEN), pow(int(GOLDEN), -1, 1 << 64)
        n = max(n, 1 << 20)
        for name, x in (("up", base), ("down", inverse)):
            factors = np.full(n, x, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


class Segments:
    """The segments of some texts, as arrays: row (of the text), start (word in it), first (word of all), windows,
    seed, content."""

    def __init__(self, texts: list[str | None], size: int = WINDOW):
        self.split = SplitTexts([t.encode("utf-8", "replace") if t else b"" for t in texts])
        flat, row_of = self.split.hash, self.split.row
        begins = np.searchsorted(row_of, np.arange(len(texts)))
        n = len(flat)
        self.first = self.row = self.start = self.windows = np.empty(0, np.int64)
        self.seed = self.content = np.empty(0, np.int64)
        if n < size:
            return
        g1, g2 = (np.uint64(int(GOLDEN) ** k % 2**64) for k in (1, 2))
        seeds = mixed(flat[:-2] + flat[1:-1] * g1 + flat[2:] * g2)
        span = size - SEED_WORDS + 1
        least, width = seeds, 1
        while 2 * width <= span:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: n - size + 1], least[span - width :][: n - size + 1])
        inside = row_of[: n - size + 1] == row_of[size - 1 :]
        at = np.flatnonzero(inside)
        if not len(at):
            return
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (row_of[at[1:]] != row_of[at[:-1]])
        first = np.flatnonzero(cut)
        begin = at[first]
        self.windows = np.diff(np.concatenate([first, [len(at)]]))
        self.first = begin
        self.row = row_of[begin]
        self.start = begin - begins[self.row]
        up, down = _powers(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * up[:n], dtype=np.uint64)])
        content = (sums[begin + self.windows + size - 1] - sums[begin]) * down[begin]
        self.content = signed(mixed(content + self.windows.astype(np.uint64) * g2))
        self.seed = signed(least[begin])


class FmIndex:
    """Backward search over texts of small integers; 0 parts the texts. The transform is kept as a wavelet matrix:
    one bit vector per bit of a symbol, in 64-bit words with the ranks at their beginnings."""

    def __init__(self, text: np.ndarray, longest: int):
        self.order = order = self._sorted(text, longest)
        n = len(text)
        self.n, self.bits = n, max(1, int(text.max()).bit_length()) if n else 1
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1))])
        symbols = text[order - 1]
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            on = (symbols >> bit & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(on, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, ranks, n - int(on.sum())))
            symbols = np.concatenate([symbols[~on], symbols[on]])

    def _sorted(self, text: np.ndarray, longest: int) -> np.ndarray:
        """Positions ordered by the next `longest` symbols at least, by doubling; that is all a search that long reads.
        On the way the intervals of all patterns of LOOKED_UP symbols are kept, where searches begin."""
        rank, width = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while True:
            if width == LOOKED_UP:
                ends = np.cumsum(np.bincount(rank))
                self.low, self.high = (ends - np.bincount(rank))[rank], ends[rank]
            if width > longest:
                return order
            following = np.concatenate([rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64)])[: len(rank)]
            key = rank * (int(rank.max(initial=0)) + int(following.max(initial=0)) + 2) + following
            order = np.argsort(key, kind="stable")
            new = np.empty_like(rank)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank, width = new, 2 * width

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        words, ranks, _ = self.levels[level]
        block = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return ranks[block] + np.bitwise_count(words[block] & below)

    def runs(self) -> np.ndarray:
        """Where each symbol's run starts after the last level."""
        symbols = np.arange(len(self.smaller) - 1)
        i = np.zeros(len(symbols), np.int64)
        for level in range(self.bits):
            on = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            ones = self._ones(level, i)
            i = np.where(on, self.levels[level][2] + ones, i - ones)
        return i

    def intervals(self, text: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of each pattern text[start : start + size], read from its end to its start."""
        begin = self.runs()
        at = starts + size - LOOKED_UP
        places = np.stack([self.low[at], self.high[at]])
        for k in range(size - LOOKED_UP - 1, -1, -1):
            symbol = text[starts + k]
            for level in range(self.bits):
                ones = self._ones(level, places)
                on = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
                places = np.where(on, self.levels[level][2] + ones, places - ones)
            places += self.smaller[symbol] - begin[symbol]
        return places[0], places[1]


def smallest_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest of values[low : high] for many intervals, from the minima of spans of powers of two."""
    out = np.full(len(low), LAST)
    level, width, spans = 0, 1, values
    exponent = np.frexp((high - low).astype(float))[1] - 1
    while True:
        at = np.flatnonzero(exponent == level)
        out[at] = np.minimum(spans[low[at]], spans[high[at] - width])
        if level >= exponent.max(initial=0):
            return out
        spans = np.minimum(spans[:-width], spans[width:])
        level, width = level + 1, 2 * width


def first_holders(segments: list[list[bytes]], docs: np.ndarray, size: int = WINDOW) -> list[np.ndarray]:
    """For each window of each segment the smallest document of a segment that holds it."""
    ids: dict[bytes, int] = {}
    text, owner, starts, counts = [], [], [], []
    at = 0
    for i, words in enumerate(segments):
        text += [ids.setdefault(w, len(ids) + 1) for w in words]
        text.append(0)
        counts.append(len(words) - size + 1)
        starts.append(np.arange(at, at + counts[-1]))
        owner.append(np.full(len(words) + 1, docs[i]))
        at += len(words) + 1
    symbols = np.array(text, np.int64)
    index = FmIndex(symbols, size)
    holder = np.concatenate(owner)[index.order]
    low, high = index.intervals(symbols, np.concatenate(starts), size)
    return np.split(smallest_in(holder, low, high), np.cumsum(counts)[:-1])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([LAST if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, 1 << 20):
        found = Segments(batch.column("text").to_pylist())
        if not len(found.seed):
            continue
        docs = _ids(batch)[found.row]
        order = np.argsort(found.seed, kind="stable")
        seed = found.seed[order]
        at = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        docs, content = docs[order], found.content[order]
        columns = [seed[at]] + [f.reduceat(x, at) for x in (docs, content) for f in (np.minimum, np.maximum)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["seed", "first_doc", "last_doc", "content", "other"]
        )


def _segment_texts(sent):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct segments of each batch, with their words and smallest document."""
        for batch in text_batches(batches, 2 << 20):
            found, docs = Segments(batch.column("text").to_pylist()), _ids(batch)
            at = np.flatnonzero(passing(found.seed, sent.value))
            at = at[np.lexsort((docs[found.row[at]], found.content[at], found.seed[at]))]
            keys = np.stack([found.seed[at], found.content[at]], axis=1)
            at = at[np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])] if len(at) else at
            words = [found.split.between(i, i + n + WINDOW - 2) for i, n in zip(found.first[at], found.windows[at], strict=True)]
            columns = [pa.array(x) for x in (found.seed[at], found.content[at], docs[found.row[at]])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.binary())], names=["seed", "content", "first_doc", "words"])

    return texts


def _windows_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of segments: (seed, content, of, first_doc, words), `of` numbers them in their segment."""
    for batch in batches:
        out = []
        for seed, content, doc, words in zip(*(batch.column(c).to_pylist() for c in ("seed", "content", "first_doc", "words")), strict=True):
            split = words.split()
            out += [(seed, content, k, doc, b" ".join(split[k : k + WINDOW])) for k in range(len(split) - WINDOW + 1)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        names = ["seed", "content", "of", "first_doc", "words"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _searched(table: pa.Table) -> pa.Table:
    words = [w.split() for w in table.column("words").to_pylist()]
    holders = first_holders(words, table.column("first_doc").to_numpy())
    return pa.table(
        {
            "seed": table.column("seed"),
            "content": table.column("content"),
            "firsts": pa.array(holders, pa.list_(pa.int64())),
        }
    )


def _instances(sent):
    def instances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 1 << 20):
            found = Segments(batch.column("text").to_pylist())
            at = np.flatnonzero(passing(found.seed, sent.value))
            rows = pa.array(found.row[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("mark").take(rows)]
                + [pa.array(x[at]) for x in (found.seed, found.content, found.start, found.windows)],
                names=["doc_id", "mark", "seed", "content", "start", "windows"],
            )

    return instances


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that repeated windows cover."""
    for batch in text_batches(batches):
        n_words, n_removed, kept, digests = [], [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            words = text.encode("utf-8", "replace").split() if text else []
            if gone:
                covered = np.zeros(len(words) + 1, np.int64)
                for start, windows in gone:
                    covered[start] += 1
                    covered[start + windows + WINDOW - 1] -= 1
                left = [w for w, c in zip(words, np.cumsum(covered).tolist(), strict=False) if not c]
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            digests.append(sha256(b" ".join(left)).hexdigest())
            kept.append(b" ".join(left).decode("utf-8", "replace"))
        yield with_columns(
            batch,
            ["doc_id"],
            n_words=(n_words, pa.int64()),
            n_removed=(n_removed, pa.int64()),
            kept=(kept, pa.string()),
            kept_sha256=(digests, pa.string()),
        )


def repeated_windows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, mark, run): runs (start, windows) of windows that also start in a document with a smaller doc_id; mark is a
    hash of the text, which tells rows of one doc_id apart."""
    spark = docs.sparkSession
    seeds = docs.select("doc_id", "text").mapInArrow(
        _seeds, "seed long, first_doc long, last_doc long, content long, other long"
    )
    seeds = seeds.groupBy("seed").agg(
        F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc"), F.min("content").alias("content"), F.max("other").alias("other")
    )
    seeds = scratch.put(seeds.where("first_doc != last_doc"), "seeds")
    varied, alike = seeds.where("content != other"), seeds.where("content = other")
    n_varied, n_all = varied.count(), seeds.count()
    sent = spark.sparkContext.broadcast(bloom_filter(varied.select("seed"), n_varied))
    texts = docs.select("doc_id", "text").mapInArrow(_segment_texts(sent), "seed long, content long, first_doc long, words binary")
    texts = texts.groupBy("seed", "content").agg(F.min("first_doc").alias("first_doc"), F.min("words").alias("words"))
    texts = scratch.put(texts, "segments")
    shards = max(1, math.ceil(texts.count() / SHARD_SEGMENTS))
    crowded = texts.groupBy("seed").count().where(F.col("count") > SEED_SEGMENTS).select("seed")
    crowded = scratch.put(crowded, "crowded")
    shard = F.pmod(F.xxhash64("seed"), F.lit(shards))
    searched = (
        texts.join(crowded, "seed", "left_anti")
        .groupBy(shard.alias("shard"))
        .applyInArrow(_searched, "seed long, content long, firsts array<long>")
    )
    searched = scratch.put(searched, "searched")
    decided = searched.unionByName(
        alike.select("seed", "content", F.array("first_doc").alias("firsts"))
    )
    if not crowded.isEmpty():
        alone = texts.join(crowded, "seed").mapInArrow(
            _windows_alone, "seed long, content long, of int, first_doc long, words binary"
        )
        alone = scratch.put(alone, "windows")
        firsts = alone.groupBy("words").agg(F.min("first_doc").alias("first"))
        found = alone.select("seed", "content", "of", "words").join(firsts, "words")
        found = found.groupBy("seed", "content").agg(F.array_sort(F.collect_list(F.struct("of", "first"))).alias("all"))
        decided = decided.unionByName(found.select("seed", "content", F.transform("all", lambda x: x["first"]).alias("firsts")))
    sent_all = spark.sparkContext.broadcast(bloom_filter(seeds.select("seed"), n_all))
    kinds = f"{kind_of(docs, 'doc_id', 'mark')}, seed long, content long, start long, windows long"
    placed = docs.select("doc_id", "text", "mark").mapInArrow(_instances(sent_all), kinds).join(decided, ["seed", "content"])
    own = F.coalesce("doc_id", F.lit(int(LAST)))
    whole = F.size("firsts") == 1
    runs = F.when(whole & (F.element_at("firsts", 1) < own), F.array(F.struct(F.col("start"), F.col("windows")))).when(
        ~whole,
        F.transform(
            F.filter(F.transform("firsts", lambda f, k: F.struct(f.alias("f"), k.alias("k"))), lambda x: x["f"] < own),
            lambda x: F.struct((F.col("start") + x["k"]).alias("start"), F.lit(1).cast("long").alias("windows")),
        ),
    )
    return placed.select("doc_id", "mark", F.explode(runs).alias("run"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept (the other words, joined by a space) and its
    SHA-256."""
    scratch = Scratch(docs.sparkSession)
    docs = only(docs, "doc_id", "text").withColumn("mark", F.xxhash64("text"))
    runs = repeated_windows(docs, scratch).groupBy("doc_id", "mark").agg(F.collect_list("run").alias("gone"))
    runs = runs.select(F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark"), "gone")
    same = docs["doc_id"].eqNullSafe(runs["of_doc"]) & (docs["mark"] == runs["of_mark"])
    gone = F.transform("gone", lambda x: F.array(x["start"], x["windows"]))
    joined = docs.join(runs.hint("merge"), same, "left").select("doc_id", "text", gone.alias("gone"))
    schema = f"{kind_of(docs, 'doc_id')}, n_words long, n_removed long, kept string, kept_sha256 string"
    return joined.mapInArrow(_cut, schema)

"""Periodic runs of words, found with a run-length grammar made by recompression.

The words of a batch of documents become numbers that differ between documents, with a number of its own at each end of
a document. Rounds then alternate. Block compression replaces each maximal stretch of one symbol by a symbol for it and
its length. Pair compression deals the symbols into left and right by a hash and replaces each left symbol with the
right one after it. Equal stretches are replaced alike but for a bounded part at their ends, so each round is a level of
a grammar. Levels end when no symbol is left twice.

A longest common extension of two places climbs the levels while what it leaves out at each is equal, and comes down
from the first difference, at most one comparison of symbols or blocks a level each way; all queries of a batch move
together as arrays. A run of period q and length of at least 4q holds a place of the grid 0, 3q, 6q, ... with the place
q after it; both ends of the stretch around such a pair follow from extensions to the right and to the left. Stretches
found for several periods keep the smallest. No suffix array is built, and nothing is shuffled.

Words are told apart by 64-bit hashes within a document.

Defined results: a null, empty or blank text has no words and no runs. Repeated rows and null ids are documents of their
own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import GOLDEN, SplitTexts, kind_of, mixed, only, text_batches

#: A run is at least this long, and this many times its period.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: Pairs of places asked about at once.
AT_ONCE = 1 << 19
BATCH_BYTES = 2 << 20


class Level(NamedTuple):
    """Symbols of a round; how many of them a step may take together, to the right and to the left; the place of each
    in the next round; whether it is the first or last there; and the first of each symbol of the next round."""

    symbol: np.ndarray
    right: np.ndarray
    left: np.ndarray
    above: np.ndarray
    first: np.ndarray
    last: np.ndarray
    below: np.ndarray
    size: np.ndarray


def _named(a: np.ndarray, b: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """A new symbol for each distinct pair."""
    _, own = np.unique(a.astype(np.int64) << np.int64(32) | b.astype(np.int64), return_inverse=True)
    return own.astype(np.int32) + np.int32(names), names + (int(own.max()) + 1 if len(own) else 0)


class Grammar:
    """Levels of a run-length grammar over `symbols`, and extensions by them."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        now, names, spread = symbols.astype(np.int32), int(symbols.max()) + 1 if len(symbols) else 1, np.ones(len(symbols), np.int64)
        rounds = -1
        while np.bincount(now, minlength=1).max() > 1:
            rounds += 1
            if rounds % 2 == 0:
                starts = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]])).astype(np.int32)
                if len(starts) == len(now):
                    continue
                sizes = np.diff(starts, append=len(now)).astype(np.int32)
                after = now[starts]
                many = sizes > 1
                after[many], names = _named(after[many], sizes[many], names)
                place = np.arange(len(now), dtype=np.int32) - np.repeat(starts, sizes)
                right, left = np.repeat(sizes, sizes) - place, place + 1
            else:
                side = mixed(now.astype(np.uint64) * GOLDEN + np.uint64(rounds)) & np.uint64(1)
                second = np.zeros(len(now), bool)
                second[1:] = (side[:-1] == 0) & (side[1:] == 1)
                starts = np.flatnonzero(~second).astype(np.int32)
                if len(starts) == len(now):
                    continue
                sizes = np.diff(starts, append=len(now)).astype(np.int32)
                after = now[starts]
                many = sizes > 1
                after[many], names = _named(after[many], now[starts[many] + 1], names)
                right = left = np.ones(len(now), np.int32)
            first = np.zeros(len(now), bool)
            first[starts] = True
            last = np.append(first[1:], True)
            above = (np.cumsum(first) - 1).astype(np.int32)
            spread = np.add.reduceat(spread, starts)
            self.levels.append(Level(now, right, left, above, first, last, np.append(starts, len(now)).astype(np.int32), spread))
            now = after

    def extension(self, one: np.ndarray, other: np.ndarray, leftwards: bool = False) -> np.ndarray:
        """For each pair of different places, how many symbols from them on are equal; with `leftwards`, up to them. Ends
        of documents, which equal nothing, must lie between any place and the ends of the whole."""
        a, b = one.astype(np.int32), other.astype(np.int32)
        done = np.zeros(len(a), np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active = np.arange(len(a))
        step = -1 if leftwards else 1
        for depth, level in enumerate(self.levels):
            edge, run = (level.last, level.left) if leftwards else (level.first, level.right)
            size = self.levels[depth - 1].size if depth else None
            inside = ~(edge[a] & edge[b])
            differ = inside & (level.symbol[a] != level.symbol[b])
            more = np.where(inside & ~differ, np.minimum(run[a], run[b]), 0)
            uneven = (more > 0) & (run[a] != run[b])
            if more.any():
                done[active] += more if size is None else more * size[a]
                a, b = a + step * more, b + step * more
            over = differ | uneven
            waiting.append((active[over], a[over], b[over]))
            on = ~over
            active, a, b = active[on], level.above[a[on]], level.above[b[on]]
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            run = level.left if leftwards else level.right
            size = self.levels[depth - 1].size if depth else None
            if len(active):
                if leftwards:
                    a, b = level.below[a + 1] - 1, level.below[b + 1] - 1
                else:
                    a, b = level.below[a], level.below[b]
                more = np.where(level.symbol[a] == level.symbol[b], np.minimum(run[a], run[b]), 0)
                done[active] += more if size is None else more * size[a]
                a, b = a + step * more, b + step * more
            stopped, sa, sb = waiting.pop()
            if len(stopped):
                active, a, b = np.concatenate([active, stopped]), np.concatenate([a, sa]), np.concatenate([b, sb])
        return done


def _candidates(begin: np.ndarray, n: np.ndarray, least_periods: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grids of documents that begin at `begin` and have `n` words, in blocks."""
    grid = least_periods - 1
    for first, size in zip(*_grouped(begin, n), strict=True):
        most = int(size.max()) // least_periods
        low = 1
        while low <= most:
            high = low
            places = 0
            while high <= most and places < AT_ONCE:  # periods low to high - 1 together
                places += int(((size - high).clip(0) // (grid * high) + 1).sum())
                high += 1
            q = np.arange(low, high)
            period, at = np.repeat(q, len(size)), np.tile(np.arange(len(size)), len(q))
            fits = least_periods * period <= size[at]
            period, at = period[fits], at[fits]
            count = (size[at] - period - 1) // (grid * period) + 1
            k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            spread = np.repeat(period, count)
            yield np.repeat(first[at], count) + k * (grid * spread), spread
            low = high


def _grouped(begin: np.ndarray, n: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Documents with like numbers of words together, so that their periods can be walked together."""
    kind = np.frexp(n.astype(float))[1]
    groups = [np.flatnonzero(kind == k) for k in np.unique(kind)]
    return [begin[g] for g in groups], [n[g] for g in groups]


def runs_of(words: np.ndarray, owner: np.ndarray, documents: int, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs, in this order. `words` are hashes, `owner` the document of each."""
    n = np.bincount(owner, minlength=documents)
    own = mixed(words ^ mixed(owner.astype(np.uint64) * GOLDEN))  # a symbol belongs to one document
    _, named = np.unique(own, return_inverse=True)
    symbols = np.empty(len(words) + documents + 1, np.int64)
    ends = np.cumsum(n + 1)
    begin = ends - n
    symbols[np.concatenate([[0], ends])] = np.arange(documents + 1)
    symbols[np.arange(len(words)) + owner + 1] = named + documents + 1
    grammar = Grammar(symbols)
    found = []
    for at, period in _candidates(begin, n, least_periods):
        alike = symbols[at] == symbols[at + period]
        at, period = at[alike], period[alike]
        right = grammar.extension(at, at + period)
        left = grammar.extension(at - 1, at + period - 1, leftwards=True)
        length = left + right + period
        whole = (length >= least_periods * period) & (length >= least_length)
        found.append(np.stack([at[whole] - left[whole], length[whole], period[whole]]))
    if not found:
        return tuple(np.empty((4, 0), np.int64))
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    document = np.searchsorted(ends, start, "right")
    order = np.lexsort((length, period, start))
    return document[order], (start - begin[document])[order], length[order], period[order]


def repeated(owner: np.ndarray, first: np.ndarray, runs: tuple[np.ndarray, ...]) -> np.ndarray:
    """Which words lie in a run after its first period. `first` is the number of each document's first word."""
    document, start, length, period = runs
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, first[document] + start + period, 1)
    np.add.at(change, first[document] + start + length, -1)
    return np.cumsum(change)[:-1] > 0


def collapsed(docs: DataFrame, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, runs (array of start, length, period; by start, then period),
    and the text without what repeats: all words but those in a run after its first period, joined by one space."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, BATCH_BYTES):
            split = SplitTexts([t.encode() if t else b"" for t in batch.column("text").to_pylist()])
            documents = batch.num_rows
            n = np.bincount(split.row, minlength=documents)
            first = np.cumsum(n) - n
            runs = runs_of(split.hash, split.row, documents, least_length, least_periods)
            kept = np.flatnonzero(~repeated(split.row, first, runs))
            # stretches of kept words, cut where a word is left out or another document begins
            cut = np.flatnonzero((np.diff(kept, prepend=-2) != 1) | (np.diff(split.row[kept], prepend=-1) != 0))
            texts: list[list[bytes]] = [[] for _ in range(documents)]
            for a, b in zip(kept[cut].tolist(), kept[np.append(cut[1:], len(kept)) - 1].tolist() if len(cut) else [], strict=True):
                texts[split.row[a]].append(split.between(a, b))
            offsets = np.searchsorted(runs[0], np.arange(documents + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in runs[1:]], ["start", "length", "period"])
            columns = [
                batch.column("doc_id"),
                pa.array(n.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), items),
                pa.array([b" ".join(x).decode() for x in texts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "text"])

    docs = only(docs, "doc_id", "text")
    schema = f"{kind_of(docs, 'doc_id')}, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
    return docs.mapInArrow(work, schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text), where about one text in ten ends in a repeated stretch, set by the crc32 of its id: with
    h = crc32, g = h // 10 and n words, if h % 10 = 0, word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + (n - a) // (3 + g % 8). Texts without words and rows without an id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        head = F.slice(words, F.lit(1), a.cast("int"))
        tail = F.transform(F.sequence(F.lit(0), (n - a - 1).cast("int")), lambda i: F.get(words, (a + i % p).cast("int")))
        return F.array_join(F.concat(head, tail), " ")

    held = F.exists(F.array(words), lambda w: F.size(w) > 0)
    text = F.when((h % 10 == 0) & held, F.get(F.transform(F.array(words), planted), F.lit(0))).otherwise(F.col("text"))
    return only(docs, "doc_id", "text").withColumn("text", text)

"""Scores of texts under a smoothed n-gram model, walked as a weighted automaton with failure arcs.

Unigrams of every word are counted exactly, and so are all n-grams; those seen at least LEAST times are kept, whatever
the corpus holds, so that what is learnt grows with it. Discounted counts are interpolated with the shorter history: an
arc carries the whole probability of a kept n-gram, a failure arc the weight left for the rest. Every history's
probabilities therefore sum to the base model's total.

Documents are dealt to blocks of bounded size by a hash, and hashes of words and n-grams to ranges. Each block sends each
range one packed row of its distinct n-grams with their counts; whatever the word, a block names it once, so no range
outgrows the others. A range adds up, and answers with totals of words and of kept n-grams in the order they were asked.
Each kept n-gram is accounted to its history by one of the blocks that hold it; ranges add up what all arcs of a history
take. From the answers, which are all arcs its texts can take, a block builds its part of the automaton, and one pass from
left to right scores each text. Words and n-grams are told apart by 64-bit hashes.

Defined results: a null or empty text is the end token alone. A null doc_id isn't learnt from and counts as held out.
Each row is a document, so repeated rows are learnt from as often as they stand there and are scored each. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import (
    GOLDEN,
    Scratch,
    SplitTexts,
    ascii_lower,
    crc_mod,
    mixed,
    only,
    runs_hashed,
    shuffles_released,
)

FOLDS = 10
SMOOTHING = 0.1
DISCOUNT = 0.6
ORDER = 2
#: Least training count of an n-gram that becomes a state or arc, and so of the words in it.
LEAST = 2
BLOCK_CHARS = 2 << 20
#: Characters of the corpus for each range of hashes.
RANGE_CHARS = 16 << 20
#: Words of a stream that one of the walks side by side reads.
PIECE = 128
#: Hashes that stand for the begin and the end of a text.
START_KEY, END_KEY = mixed(np.array([1, 2], np.uint64) * GOLDEN)


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, doc_id, text, learnt): rows grouped by block, each block whole in one task."""
    learnt = F.coalesce(crc_mod("doc_id", FOLDS) != 0, F.lit(False))
    docs = only(docs, "doc_id", "text").withColumn("learnt", learnt)
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))


def _sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text between a begin and an end, and the text that each belongs to."""
    split = SplitTexts([ascii_lower(t) if t else b"" for t in texts])
    sizes = np.bincount(split.row, minlength=len(texts)) + 2
    ends = np.cumsum(sizes)
    keys = np.empty(int(sizes.sum()), np.uint64)
    keys[ends - sizes], keys[ends - 1] = START_KEY, END_KEY
    keys[np.arange(len(split.row)) + 2 * split.row + 1] = split.hash
    return keys, np.repeat(np.arange(len(texts)), sizes)


def _runs(keys: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first place of each run of `size` words within a text; a single word's hash is its own."""
    if size == 1:
        return keys, np.arange(len(keys))
    at = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
    return runs_hashed(keys, size)[at], at


@dataclass
class _Grams:
    """The distinct runs of one size in a block: hashes in order, a place of each, and the run at every token that opens
    one (`at`, `which`)."""

    hashes: np.ndarray
    first: np.ndarray
    at: np.ndarray
    which: np.ndarray


def _grams(keys: np.ndarray, owner: np.ndarray, order: int) -> list[_Grams]:
    made = []
    for size in range(1, order + 1):
        hashes, at = _runs(keys, owner, size)
        grams, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        made.append(_Grams(grams, at[first], at, which))
    return made


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers of 0 or more as bytes, those of like weight together, compressed."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    planes = np.frombuffer(pa.decompress(raw[4:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _by_range(hashes: np.ndarray, ranges: int) -> list[tuple[int, slice]]:
    """The parts of ordered hashes that lie in each range of hashes, empty ones left out."""
    held, begin = np.unique((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), return_index=True)
    return [(r, slice(b, e)) for r, b, e in zip(held.tolist(), begin.tolist(), [*begin[1:].tolist(), len(hashes)], strict=True)]


ASKED = pa.schema([(c, pa.int64()) for c in ("range", "block", "size")] + [(c, pa.binary()) for c in ("grams", "n")])
COUNTED = pa.schema([(c, pa.int64()) for c in ("range", "block", "size", "tokens", "distinct")] + [(c, pa.binary()) for c in ("totals", "ours")])
SPENT = pa.schema([(c, pa.int64()) for c in ("range", "block", "size")] + [(c, pa.binary()) for c in ("grams", "taken", "arcs")])
MASSES = pa.schema([(c, pa.int64()) for c in ("range", "block", "size")] + [(c, pa.binary()) for c in ("taken", "arcs")])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def _asking(order: int, ranges: int):
    def ask(key: tuple, docs: pa.Table) -> pa.Table:
        """A block's distinct runs up to `order` words and how often its learnt texts hold each (0: held out only)."""
        keys, owner = _sequences(docs.column("text").to_pylist())
        learnt = docs.column("learnt").to_numpy()[owner]
        rows = []
        for size, g in enumerate(_grams(keys, owner, order), 1):
            n = np.bincount(g.which, weights=learnt[g.at], minlength=len(g.hashes)).astype(np.uint64)
            rows += [(r, key[0].as_py(), size, _packed(g.hashes[s]), _packed(n[s])) for r, s in _by_range(g.hashes, ranges)]
        return _table(rows, ASKED)

    return ask


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _asked(group: pa.Table):
    """By size: the blocks that ask one range, where each one's part begins and ends, and all their runs."""
    for size in sorted(set(group.column("size").to_pylist())):
        rows = group.filter(pc.equal(group.column("size"), size))
        grams = [_unpacked(x) for x in rows.column("grams").to_pylist()]
        edges = np.cumsum([0, *map(len, grams)])
        parts = [(b, slice(x, y)) for b, x, y in zip(rows.column("block").to_pylist(), edges[:-1], edges[1:], strict=True)]
        yield size, rows, parts, np.concatenate(grams)


def _counted(key: tuple, group: pa.Table) -> pa.Table:
    """Answers each block with the corpus totals of its words and of its runs that are kept (0: not kept), and marks the
    kept runs that it alone has to account to their histories. Tokens and distinct words stand in one row of a range."""
    rows = []
    for size, asked, parts, grams in _asked(group):
        n = np.concatenate([_unpacked(x) for x in asked.column("n").to_pylist()])
        found, first, which = np.unique(grams, return_index=True, return_inverse=True)
        total = np.bincount(which, weights=n, minlength=len(found)).astype(np.uint64)
        words = total[found != START_KEY] if size == 1 else total[:0]
        if size > 1:
            total[total < LEAST] = 0
        ours = np.zeros(len(grams), bool)
        ours[first[total > 0]] = size > 1
        told = total[which]
        sums = [(int(words.sum()), int((words > 0).sum()))] + [(0, 0)] * (len(parts) - 1)
        rows += [
            (key[0].as_py(), block, size, *s, _packed(told[at]), np.packbits(ours[at]).tobytes())
            for (block, at), s in zip(parts, sums, strict=True)
        ]
    return _table(rows, COUNTED)


def _answers(table: pa.Table, column: str, size: int) -> list[bytes]:
    """What the ranges answered a block on one size, in the order of its runs."""
    rows = table.filter(pc.equal(table.column("size"), size)).select(["range", column])
    return [x["x"] for x in rows.filter(pc.is_valid(rows.column(column))).rename_columns(["r", "x"]).sort_by("r").to_pylist()]


def _numbers(table: pa.Table, column: str, size: int) -> np.ndarray:
    return np.concatenate([np.empty(0, "<u8"), *map(_unpacked, _answers(table, column, size))])


def _spending(order: int, ranges: int):
    def spend(key: tuple, docs: pa.Table, counted: pa.Table) -> pa.Table:
        """What the arcs that a block accounts for take of their histories, and for which histories it asks."""
        keys, owner = _sequences(docs.column("text").to_pylist())
        grams = _grams(keys, owner, order)
        rows = []
        for size in range(1, order):
            histories, longer = grams[size - 1], grams[size]
            bits = [np.unpackbits(np.frombuffer(x, np.uint8)) for x in _answers(counted, "ours", size + 1)]
            totals = [_unpacked(x) for x in _answers(counted, "totals", size + 1)]
            if not len(histories.hashes):
                continue
            place = np.zeros(len(keys), np.int64)
            place[histories.at] = histories.which
            ours = np.concatenate([np.empty(0, bool), *(b[: len(t)].astype(bool) for b, t in zip(bits, totals, strict=True))])
            total = np.concatenate([np.empty(0, "<u8"), *totals])
            of = place[longer.first[ours]]
            taken = np.bincount(of, weights=total[ours], minlength=len(histories.hashes)).astype(np.uint64)
            arcs = np.bincount(of, minlength=len(histories.hashes)).astype(np.uint64)
            wanted = _numbers(counted, "totals", size) >= LEAST
            hashes, taken, arcs = histories.hashes[wanted], taken[wanted], arcs[wanted]
            rows += [
                (r, key[0].as_py(), size, *(_packed(x[s]) for x in (hashes, taken, arcs))) for r, s in _by_range(hashes, ranges)
            ]
        return _table(rows, SPENT)

    return spend


def _summed(key: tuple, group: pa.Table) -> pa.Table:
    """Answers each block with what all arcs of its histories take."""
    rows = []
    for size, asked, parts, grams in _asked(group):
        found, which = np.unique(grams, return_inverse=True)
        sums = []
        for column in ("taken", "arcs"):
            values = np.concatenate([_unpacked(x) for x in asked.column(column).to_pylist()])
            sums.append(np.bincount(which, weights=values, minlength=len(found)).astype(np.uint64)[which])
        rows += [(key[0].as_py(), block, size, *(_packed(x[at]) for x in sums)) for block, at in parts]
    return _table(rows, MASSES)


@dataclass
class Automaton:
    """States are numbers, 0 the root. A state's arcs stand ordered by `state * words + word`; a word that no arc of a
    state takes follows the state's failure, adding its weight, and is tried again, at last at the root, which takes
    every word by `roots` and `weights`."""

    words: int
    start_word: int
    start: int
    roots: np.ndarray
    weights: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    arcs: np.ndarray
    failures: np.ndarray
    falls: np.ndarray

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that many walks reach with one word each, and the log10 probabilities on the way."""
        state, total = state.copy(), np.zeros(len(state))
        left = np.flatnonzero(word != self.start_word)
        while len(left):
            at = np.searchsorted(self.keys, state[left] * self.words + word[left])
            at = np.minimum(at, len(self.keys) - 1)
            taken = (state[left] > 0) & (self.keys[at] == state[left] * self.words + word[left])
            total[left[taken]] += self.arcs[at[taken]]
            root = left[state[left] == 0]
            total[root] += self.weights[word[root]]
            fallen = left[~taken & (state[left] > 0)]
            state[left[taken]] = self.targets[at[taken]]
            state[root] = self.roots[word[root]]
            total[fallen] += self.falls[state[fallen]]
            state[fallen] = self.failures[state[fallen]]
            left = fallen
        state[word == self.start_word] = self.start
        return state, total

    def walk(self, word: np.ndarray, memory: int) -> np.ndarray:
        """The log10 probability of each word of a stream of texts, read once from left to right. Pieces of the stream
        are walked side by side; since a state rests on the last `memory` words alone, each piece starts that many
        words early, at the root, and is then in the state of an unbroken walk."""
        n = len(word)
        begin = np.arange(0, n, PIECE)
        state, out = np.zeros(len(begin), np.int64), np.zeros(n)
        for i in range(-memory, PIECE):
            here = np.flatnonzero((begin + i >= 0) & (begin + i < n))
            state[here], logs = self.step(state[here], word[begin[here] + i])
            if i >= 0:
                out[begin[here] + i] = logs
        return out


class Base:
    """Additively smoothed unigrams."""

    def __init__(self, tokens: int, distinct: int):
        self.tokens, self.distinct = tokens, distinct
        self.below = math.log10(tokens + SMOOTHING * (distinct + 1)) if tokens + distinct else math.log10(SMOOTHING)

    def log(self, count: int) -> float:
        return math.log10(count + SMOOTHING) - self.below

    def logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(counts + SMOOTHING) - self.below


def automaton(base: Base, keys: np.ndarray, grams: list[_Grams], told: pa.Table) -> Automaton:
    """The states and arcs that the texts of a block can take, from its runs and what the ranges told of them. A word seen
    LEAST times and the begin of a text are states, and so are longer runs that arcs leave. What is kept of a run is
    kept of its parts, for those are seen at least as often."""
    words, counts = grams[0].hashes, _numbers(told, "totals", 1).astype(np.int64)
    begins, ends = words == START_KEY, words == END_KEY
    start_word = int(np.flatnonzero(begins)[0]) if begins.any() else -1
    weights = base.logs(counts)
    is_state = (counts >= LEAST) & ~ends | begins
    failures, falls, arc_keys, targets, arcs = [np.zeros(1, np.int64)], [np.zeros(1)], [], [], []
    made, total, probability = 1, counts, 10**weights
    target, place = np.zeros(len(words), np.int64), grams[0].which
    state = np.zeros(0, np.int64)
    left = np.ones(0)
    for size, g in enumerate(grams, 1):
        if size > 1:
            total = _numbers(told, "totals", size).astype(np.int64)
            kept = np.flatnonzero(total >= LEAST)
            before, after, word = place[g.first[kept]], place[g.first[kept] + 1], grams[0].which[g.first[kept] + size - 1]
            longer = np.zeros(len(total))
            longer[kept] = (total[kept] - DISCOUNT) / shorter[before] + left[before] * probability[after]
            probability, shorter_target = longer, target
            target = np.zeros(len(total), np.int64)
            target[kept] = shorter_target[after]
            fall_to = target.copy()
            place = np.zeros(len(keys), np.int64)
            place[g.at] = g.which
        else:
            fall_to = np.zeros(len(total), np.int64)
        leaving = state
        if size < len(grams):
            spent = np.zeros(len(total))
            held = total >= LEAST
            n_arcs = _numbers(told, "arcs", size).astype(float)
            spent[held] = _numbers(told, "taken", size).astype(float) - DISCOUNT * n_arcs
            any_arc = np.zeros(len(total), bool)
            any_arc[held] = n_arcs > 0
            left = 1 - spent / np.maximum(total, 1)
            of = np.flatnonzero(is_state if size == 1 else any_arc)
            state = np.zeros(len(total), np.int64)
            state[of] = made + np.arange(len(of))
            made += len(of)
            failures.append(fall_to[of])
            falls.append(np.log10(left[of]))
            target[of] = state[of]
        if size > 1:
            arc_keys.append(leaving[before] * len(words) + word)
            targets.append(target[kept])
            arcs.append(np.log10(probability[kept]))
        else:
            roots, start = target, int(target[start_word]) if begins.any() else 0
        shorter = total
    arc_keys, targets, arcs = (np.concatenate([x, *y]) for x, y in ((np.array([-1]), arc_keys), (np.array([0]), targets), (np.zeros(1), arcs)))
    order = np.argsort(arc_keys, kind="stable")
    return Automaton(
        len(words), start_word, start, roots, weights, arc_keys[order], targets[order], arcs[order], np.concatenate(failures), np.concatenate(falls)
    )


def _scoring(base: Base, order: int):
    def score(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        keys, owner = _sequences(docs.column("text").to_pylist())
        grams = _grams(keys, owner, order)
        which, learnt = grams[0].which, docs.column("learnt").to_numpy()
        model = automaton(base, keys, grams, told)
        counts = _numbers(told, "totals", 1)
        texts, token = len(learnt), keys != START_KEY
        n_known = np.bincount(owner, weights=token & (counts[which] > 0), minlength=texts).astype(np.int64)
        base_score = np.bincount(owner, weights=np.where(token, model.weights[which], 0), minlength=texts)
        scores = np.bincount(owner, weights=model.walk(which, order - 1), minlength=texts)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": pa.array(~learnt),
                "n_tokens": pa.array(np.bincount(owner, weights=token, minlength=texts).astype(np.int64)),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([base.tokens] * texts, pa.int64()),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    return score


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    ranges = max(1, math.ceil(chars / RANGE_CHARS))
    rows = dealt(docs, blocks)
    with shuffles_released(spark):
        asked = rows.groupBy("block").applyInArrow(_asking(order, ranges), _ddl(ASKED))
        counted = scratch.put(asked.groupBy("range").applyInArrow(_counted, _ddl(COUNTED)), "counted")
        tokens, distinct = counted.agg(F.sum("tokens"), F.sum("distinct")).first()
        own = counted.select("range", "block", "size", "totals", "ours").groupBy("block")
        spent = rows.groupBy("block").cogroup(own).applyInArrow(_spending(order, ranges), _ddl(SPENT))
        masses = scratch.put(spent.groupBy("range").applyInArrow(_summed, _ddl(MASSES)), "masses")
    told = counted.select("range", "block", "size", "totals").unionByName(masses, allowMissingColumns=True)
    base = Base(tokens or 0, distinct or 0)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_scoring(base, order), schema)

"""Vectors as short codes: integer product quantisation whose nearest entries are found with a GNAT.

Components become integers, vectors are cut into PARTS equal parts, and each part position has a codebook. The entries
of a codebook are held in a geometric near-neighbour access tree: a node has split points, every other entry of the node
goes to the nearest of them, and for each split point and each child the node keeps the least and the greatest distance
between the point and the child's entries. A search measures a part against the split points; if the ball around it
that reaches to the best entry so far misses a child's range from any split point, the whole child is left out.

That is exact. Squared distances are integers; their roots are rounded down and up by more than the error of a square
root, and a child is left out only if it is strictly farther, so entries at the same distance are always compared, as
integers, and the lower index wins.

A round assigns all parts in tasks, which add up counts and component sums by entry; what goes to the driver is at most
a codebook's size for each task's partial sums after they met by entry.

Defined results: rows with a null vector, with null or non-finite components, or with another number of components than
most take no part. A number of components that PARTS does not divide is filled up with zeros. Each row counts, repeated
ones too, but an id gives only one starting entry (the smallest vector of its); null ids come last. Fewer than ENTRIES
ids give fewer entries. An empty table gives no rows. Components beyond 2**19 would leave 64-bit numbers and raise
OverflowError. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.nearest import matrix
from rollcall.llm.shared import Scratch, kind_of, only

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a node, and entries that a leaf may hold.
FANOUT, LEAF = 6, 4
#: A label held by more than one in this many rows has its sum broadcast: there are fewer such labels than that.
HOT_ONE_IN = 1000
MOST = 1 << 27


def integers(x: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """floor(SCALE * x) as (rows, parts, components of a part)."""
    whole = np.floor(SCALE * x)
    if whole.size and np.abs(whole).max() > MOST:
        raise OverflowError("a component is too large for exact 64-bit distances")
    whole = np.pad(whole.astype(np.int64), ((0, 0), (0, -x.shape[1] % parts)))
    return whole.reshape(len(x), parts, whole.shape[1] // parts)


def squares(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Squared distances of all `points` to `one`, exact."""
    apart = points - one
    return np.einsum("ij,ij->i", apart, apart)


def below(square: np.ndarray) -> np.ndarray:
    """No more than the root."""
    return np.sqrt(square.astype(np.float64)) * (1 - 1e-12)


def above(square: np.ndarray) -> np.ndarray:
    """No less than the root."""
    return np.sqrt(square.astype(np.float64)) * (1 + 1e-12)


class Gnat:
    """A tree over some rows of `entries`; `measured` counts the distances that searches took."""

    def __init__(self, entries: np.ndarray, rows: np.ndarray | None = None):
        self.entries = entries
        rows = np.arange(len(entries)) if rows is None else rows
        self.measured = 0
        self.splits = rows if len(rows) <= LEAF else self._spread(rows)
        rest = np.setdiff1d(rows, self.splits)
        self.children: list[Gnat] = []
        if not len(rest):
            return
        far = np.stack([squares(entries[rest], entries[s]) for s in self.splits])
        own = far.argmin(axis=0)
        self.low, self.high = [], []
        for child in np.unique(own):
            self.children.append(Gnat(entries, rest[own == child]))
            self.low.append(below(far[:, own == child].min(axis=1)))
            self.high.append(above(far[:, own == child].max(axis=1)))

    def _spread(self, rows: np.ndarray) -> np.ndarray:
        """Split points far from each other: the first row, then always the one farthest from those taken."""
        taken = [0]
        nearest = squares(self.entries[rows], self.entries[rows[0]])
        while len(taken) < min(FANOUT, len(rows)):
            taken.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squares(self.entries[rows], self.entries[rows[taken[-1]]]))
            nearest[taken] = -1
        return np.sort(rows[taken])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point the index of the nearest entry, the lower of equal ones, and the squared distance."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        self.measured = self._search(points, np.arange(len(points)), index, best)
        return index, best

    def _search(self, points: np.ndarray, asked: np.ndarray, index: np.ndarray, best: np.ndarray) -> int:
        here = points[asked]
        seen = np.empty((len(self.splits), len(asked)), np.int64)
        for i, s in enumerate(self.splits.tolist()):
            seen[i] = squares(here, self.entries[s])
            better = (seen[i] < best[asked]) | (seen[i] == best[asked]) & (s < index[asked])
            best[asked[better]], index[asked[better]] = seen[i][better], s
        measured = seen.size
        if not self.children:
            return measured
        least, most = below(seen), above(seen)
        for child, low, high in zip(self.children, self.low, self.high, strict=True):
            reach = above(best[asked])  # may have shrunk in the children before
            slack = 1e-9 + 1e-12 * (reach + most)  # the error of the sums below
            missed = ((least - reach - slack > high[:, None]) | (most + reach + slack < low[:, None])).any(axis=0)
            if not missed.all():
                measured += child._search(points, asked[~missed], index, best)
        return measured


class Codebooks:
    """One codebook for each part position, and the tree over it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.trees = [Gnat(book) for book in entries]

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) indexes and squared distances."""
        found = [tree.nearest(points[:, part]) for part, tree in enumerate(self.trees)]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def moved(self, counts: np.ndarray, sums: np.ndarray) -> Codebooks:
        """Each used entry becomes the floor of its parts' mean."""
        used = counts > 0
        entries = self.entries.copy()
        entries[used] = sums[used] // counts[used][:, None]
        return Codebooks(entries)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, *carried: str) -> DataFrame:
    """Rows that take part, with the carried columns."""
    held = only(vectors, "vec_id", "embedding", *carried).where("embedding is not null")
    held = held.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    sizes = held.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return held.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))


def _first(vectors: DataFrame, most: int) -> np.ndarray:
    """The smallest vectors of the `most` smallest ids, ascending, then the smallest vectors without an id. Ids are taken
    from the smallest rows, and from those after them if these repeat ids; nothing is shuffled for that."""
    ids: list = []
    named = vectors.where("vec_id is not null")
    while len(ids) < most:
        after = named.where(F.col("vec_id") > F.lit(ids[-1])) if ids else named
        rows = after.select("vec_id").orderBy("vec_id").limit(4 * most).collect()
        if not rows:
            break
        ids = [*ids, *sorted({r["vec_id"] for r in rows})][:most]
    rows = named.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).collect() if ids else []
    found = [r["embedding"] for r in sorted(rows, key=lambda r: r["vec_id"])]
    if len(found) < most:
        unnamed = vectors.where("vec_id is null").select("embedding").distinct().orderBy("embedding")
        found += [r["embedding"] for r in unnamed.limit(most - len(found)).collect()]
    return np.array(found, np.float64) if found else np.empty((0, 0))


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks that start as the parts of the `entries` smallest ids and move `rounds` times; of usable rows."""
    spark = vectors.sparkSession
    first = _first(vectors, entries)
    if not len(first):
        return Codebooks(np.zeros((parts, 0, 1), np.int64))
    start = integers(first, parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    n, width = books.entries.shape[1:]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)

        def summed(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros(parts * n, np.int64), np.zeros((parts * n, width), np.int64)
            for batch in batches:
                points = integers(matrix(batch.column("embedding")), parts)
                index, _ = sent.value.assign(points)
                place = (index + n * np.arange(parts)).ravel()
                counts += np.bincount(place, minlength=parts * n)
                np.add.at(sums, place, points.reshape(-1, width))
            used = np.flatnonzero(counts)
            columns = [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "n", "sums"])

        partial = vectors.select("embedding").mapInArrow(summed, "place long, n long, sums array<long>")
        total = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
        counts, sums = np.zeros(parts * n, np.int64), np.zeros((parts * n, width), np.int64)
        for r in partial.groupBy("place").agg(F.sum("n").alias("n"), *total).collect():
            counts[r["place"]], sums[r["place"]] = r["n"], [r[f"s{i}"] for i in range(width)]
        books = books.moved(counts.reshape(parts, n), sums.reshape(parts, n, width))
    return books


def coded(vectors: DataFrame, books: Codebooks, *carried: str) -> DataFrame:
    """Per usable row: vec_id, the carried columns, code (an index for each part), error."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    parts = len(books.entries)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, far = sent.value.assign(integers(matrix(batch.column("embedding")), parts))
            columns = [batch.column(c) for c in ("vec_id", *carried)]
            columns += [pa.array(list(index.astype(np.int32)), pa.list_(pa.int32())), pa.array(far.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *carried, "code", "error"])

    schema = f"{kind_of(vectors, 'vec_id', *carried)}, code array<int>, error long"
    return only(vectors, "vec_id", "embedding", *carried).mapInArrow(code, schema)


def decoded(codes: Column, books: Codebooks) -> Column:
    """The components that a code stands for, back in the vectors' scale."""
    held = F.lit((books.entries / SCALE).tolist())
    return F.flatten(F.transform(codes, lambda index, part: F.get(F.get(held, part), index)))


def with_group_sums(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """`rows` with the sum of `value` over equal `group`s, nulls together. Sums of groups that hold more than one in
    HOT_ONE_IN rows are broadcast, of which there are fewer than HOT_ONE_IN; the others meet their rows by a shuffle."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    rows = scratch.put(rows, "rows")
    sums = scratch.put(rows.groupBy(F.col(group).alias("of_group")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("held")), "sums")
    least = rows.count() / HOT_ONE_IN
    hot = F.broadcast(sums.where(F.col("held") > least).withColumn("hot", F.lit(True)).drop("held"))
    cold = sums.where(F.col("held") <= least).drop("held")
    same = lambda other: rows[group].eqNullSafe(other["of_group"])
    met = rows.join(hot, same(hot), "inner").drop("of_group", "hot")
    rest = rows.join(hot, same(hot), "left_anti").hint("merge")
    return met.unionByName(rest.join(cold, rest[group].eqNullSafe(cold["of_group"])).drop("of_group"))

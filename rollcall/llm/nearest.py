"""Nearest neighbours by inner product with an inverted multi-index.

Each half of a vector is quantised by its own codebook; a cell is a pair of centroids. Equal vectors become one entry
that keeps the smallest ids a result can hold. For a query a heap walks the cells in order of the summed inner product
of its halves with the two centroids, until the cells hold the share of entries that a sample needed for the recall
asked for; the entries of these cells are then ranked exactly.

Defined results: vectors that are null, zero, of another length than most, or that hold null or non-finite components,
and rows with a null id take no part. Rows with one id and one vector are one row; if an id has several vectors, its
best counts as a candidate and its smallest hash as the query. An empty table gives no rows. Ties go to the smaller id.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import Scratch, only

#: Bounds: vectors the codebooks are fitted on, queries the share is measured with, centroids of a half.
SAMPLE = 20_000
PROBES = 200
MOST_CENTROIDS = 128
RECALL = 0.95
#: Queries met in one pass over the index, and entries ranked at once.
QUERIES_AT_ONCE = 8_192
ENTRIES_AT_ONCE = 256


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that take part."""
    held = only(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = held.where(fine & F.exists("embedding", lambda x: x != 0))
    sizes = held.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return held.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = closest(x, c)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def closest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)


def cells_in_order(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by falling left[i] + right[j]: a heap holds the next pair of each opened row."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap = [(-(left[a[0]] + right[b[0]]), 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(left[a[i]] + right[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(left[a[i + 1]] + right[b[0]]), i + 1, 0))


class MultiIndex:
    """Two codebooks and the share of entries to visit."""

    def __init__(self, sample: np.ndarray, entries: int, top: int):
        self.half = max(1, sample.shape[1] // 2)
        k = int(min(MOST_CENTROIDS, max(1, math.isqrt(max(1, entries // 12))), len(sample)))
        self.books = [centroids(x, k) for x in (sample[:, : self.half], sample[:, self.half :])]
        self.k = k
        self.share = self._share(sample, top)

    def cells(self, x: np.ndarray) -> np.ndarray:
        one, other = x[:, : self.half], x[:, self.half :]
        return closest(one, self.books[0]) * self.k + closest(other, self.books[1])

    def _share(self, sample: np.ndarray, top: int) -> float:
        """The smallest share of the sample's entries that holds RECALL of the true neighbours of its first rows."""
        if len(sample) <= 4 * top:
            return 1.0
        probes = sample[:PROBES]
        scores = probes @ sample.T
        scores[np.arange(len(probes)), np.arange(len(probes))] = -np.inf
        best = np.argpartition(-scores, top, axis=1)[:, :top]
        cells = self.cells(sample)
        held = np.bincount(cells, minlength=self.k * self.k)
        near = (probes[:, : self.half] @ self.books[0].T)[:, :, None] + (probes[:, self.half :] @ self.books[1].T)[:, None]
        order = np.argsort(-near.reshape(len(probes), -1), axis=1, kind="stable")
        seen = np.empty(order.shape)
        np.put_along_axis(seen, order, np.cumsum(held[order], axis=1) / len(sample), axis=1)
        needed = np.sort(np.take_along_axis(seen, cells[best], axis=1).ravel())
        return float(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))])

    def visited(self, query: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Bits of the cells to visit."""
        out = np.zeros(self.k * self.k, bool)
        left, most = self.books[0] @ query[: self.half], self.share * held.sum()
        seen = 0
        for i, j in cells_in_order(left, self.books[1] @ query[self.half :]):
            cell = i * self.k + j
            out[cell] = True
            seen += held[cell]
            if seen >= most:
                break
        return np.packbits(out)


class Best:
    """For each query the entries with the highest scores so far; equal scores go to the smaller first id."""

    def __init__(self, queries: int, keep: int):
        self.keep = keep
        self.scores = np.full((queries, keep), -np.inf)
        self.entry = np.full((queries, keep), -1, np.int64)
        self.first = np.full((queries, keep), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, scores: np.ndarray, entry: np.ndarray, first: np.ndarray) -> None:
        s = np.concatenate([self.scores[rows], scores], axis=1)
        e = np.concatenate([self.entry[rows], np.broadcast_to(entry, scores.shape)], axis=1)
        f = np.concatenate([self.first[rows], np.broadcast_to(first, scores.shape)], axis=1)
        part = np.argpartition(-s, self.keep - 1, axis=1)[:, : self.keep]
        least = np.take_along_axis(s, part, axis=1).min(axis=1, keepdims=True)
        tied = np.flatnonzero(((s >= least) & (s > -np.inf)).sum(axis=1) > self.keep)
        if len(tied):
            part[tied] = np.lexsort((f[tied], -s[tied]), axis=-1)[:, : self.keep]
        for held, new in ((self.scores, s), (self.entry, e), (self.first, f)):
            held[rows] = np.take_along_axis(new, part, axis=1)


def _entries(vectors: DataFrame, index: MultiIndex, keep: int) -> DataFrame:
    """(cell, embedding, ids): each distinct vector with its `keep` smallest ids; tasks gather ids before the shuffle."""
    sent = vectors.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding")) + 0.0
            _, first, own = np.unique(x, axis=0, return_index=True, return_inverse=True)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((ids, own.ravel()))
            cuts = np.flatnonzero(np.diff(own.ravel()[order])) + 1
            groups = [np.unique(g)[:keep] for g in np.split(ids[order], cuts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sent.value.cells(x[first]).astype(np.int64)),
                    pa.array([r for r in x[first]], pa.list_(pa.float64())),
                    pa.array(groups, pa.list_(pa.int64())),
                ],
                names=["cell", "embedding", "ids"],
            )

    found = vectors.mapInArrow(assign, "cell long, embedding array<double>, ids array<long>")
    merged = found.groupBy("cell", "embedding").agg(F.collect_list("ids").alias("ids"))
    return merged.withColumn("ids", F.slice(F.array_sort(F.array_distinct(F.flatten("ids"))), 1, keep))


def _ranking(sent, keep: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, bits, cells_count = sent.value
        visited = np.unpackbits(bits, axis=1)[:, :cells_count].astype(bool)
        best = Best(len(query_ids), keep + 1)
        held: list[tuple[np.ndarray, list]] = []
        count = 0
        for batch in batches:
            x, cells = matrix(batch.column("embedding")), batch.column("cell").to_numpy()
            ids = batch.column("ids").to_pylist()
            first = np.array([i[0] for i in ids], np.int64)
            order = np.argsort(cells, kind="stable")
            for at in range(0, len(order), ENTRIES_AT_ONCE):
                some = order[at : at + ENTRIES_AT_ONCE]
                seen = visited[:, cells[some]]
                rows = np.flatnonzero(seen.any(axis=1))
                scores = np.where(seen[rows], queries[rows] @ x[some].T, -np.inf)
                best.offer(rows, scores, count + some, first[some])
            held.append((x, ids))
            count += len(ids)
            if count > 50_000:  # keep only entries that are still among the best
                held, count = _compacted(best, held)
        x = np.concatenate([a for a, _ in held]) if held else np.empty((0, queries.shape[1]))
        ids = [i for _, part in held for i in part]
        out_ids, out_q, out_s = [], [], []
        for q in range(len(query_ids)):
            entries = best.entry[q][best.entry[q] >= 0]
            exact = (x[entries] * queries[q]).sum(axis=1)
            found = sorted((-s, i) for s, e in zip(exact.tolist(), entries, strict=True) for i in ids[e] if i != query_ids[q])
            if found := found[: 2 * keep]:
                out_q.append(query_ids[q])
                out_s.append([s for s, _ in found])
                out_ids.append([i for _, i in found])
        items = [[{"order": s, "vec_id": i} for s, i in zip(a, b, strict=True)] for a, b in zip(out_s, out_ids, strict=True)]
        kind = pa.list_(pa.struct([("order", pa.float64()), ("vec_id", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(items, kind)], names=["query_id", "found"])

    return rank


def _compacted(best: Best, held: list) -> tuple[list, int]:
    x, ids = np.concatenate([a for a, _ in held]), [i for _, part in held for i in part]
    used = np.unique(best.entry[best.entry >= 0])
    best.entry[best.entry >= 0] = np.searchsorted(used, best.entry[best.entry >= 0])
    return [(x[used], [ids[i] for i in used])], len(used)


def nearest(vectors: DataFrame, is_query: str, top: int = 20) -> DataFrame:
    """The `top` nearest rows of each row that the SQL condition `is_query` picks: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    scratch = Scratch(spark)
    vectors = usable(vectors)
    n = vectors.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30))
    thinned = vectors.where(draw < int(min(1.0, 2.0 * SAMPLE / n) * (1 << 30))).orderBy(draw, "vec_id").limit(SAMPLE)
    index = MultiIndex(matrix(thinned.select("embedding").toArrow().column("embedding").combine_chunks()), n, top)
    entries = scratch.put(_entries(vectors, index, top + 1), "entries")
    held = np.zeros(index.k * index.k, np.int64)
    for r in entries.groupBy("cell").count().collect():
        held[r["cell"]] = r["count"]
    sent = sc.broadcast((index, held))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, counts = sent.value
        for batch in batches:
            x = matrix(batch.column("embedding"))
            bits = [one.visited(row, counts).tobytes() for row in x]
            rows = [pa.array(list(x), pa.list_(pa.float64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *rows], names=["vec_id", "embedding", "cells"])

    queries = vectors.where(is_query).groupBy("vec_id").agg(F.min_by("embedding", F.xxhash64("embedding")).alias("embedding"))
    queries = scratch.put(
        queries.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(walk, "vec_id long, embedding array<double>, cells binary"),
        "queries",
    )
    blocks = math.ceil(queries.count() / QUERIES_AT_ONCE)
    result = None
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        bits = np.frombuffer(b"".join(block.column("cells").to_pylist()), np.uint8).reshape(block.num_rows, -1)
        asked = sc.broadcast((block.column("vec_id").to_pylist(), matrix(block.column("embedding").combine_chunks()), bits, len(held)))
        kind = "query_id long, found array<struct<order:double,vec_id:long>>"
        found = entries.mapInArrow(_ranking(asked, top), kind).groupBy("query_id").agg(F.flatten(F.collect_list("found")).alias("found"))
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], schema)
    once = F.aggregate(
        F.array_sort("found"),
        F.array().cast("array<struct<order:double,vec_id:long>>"),
        lambda out, x: F.when(F.exists(out, lambda y: y["vec_id"] == x["vec_id"]) | (F.size(out) >= top), out).otherwise(
            F.concat(out, F.array(x))
        ),
    )
    rows = result.select("query_id", F.posexplode(once).alias("at", "x"))
    return rows.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.order")).alias("score")
    )

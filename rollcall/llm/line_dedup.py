"""Reversible line dedup: exact reference counts of line keys, with one cuckoo filter per shard in front of them.

Defined results: each row is one document, so a repeated row counts as another one. A null text is one empty line.
A null doc_id counts as a document, is smaller than every other, and all its rows are one holder. Keys shorter than
`min_length` are never dropped, so blank and empty texts stay as they are. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import Scratch, mixed, only

MIN_LENGTH = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys in a shard's filter, and the bytes of all filters up to which they are broadcast; beyond it none is probed.
KEYS_PER_SHARD = 50_000
FILTER_BYTES = 64 << 20
SLOTS = 4
KICKS = 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four; supports removal. Keys are pairs of 64-bit hashes."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @staticmethod
    def marks(b: np.ndarray) -> np.ndarray:
        return (b.view(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def places(self, a: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = (mixed(a.view(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
        return one, one ^ self.jump(marks)

    def jump(self, marks: np.ndarray) -> np.ndarray:
        return (mixed(marks.astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        marks = self.marks(b)
        one, other = self.places(a, marks)
        return (self.table[one] == marks[:, None]).any(1) | (self.table[other] == marks[:, None]).any(1)

    def add(self, a: np.ndarray, b: np.ndarray) -> bool:
        """False if a key found no place; the caller then builds a larger filter from the exact table."""
        rng = np.random.default_rng(len(a))
        marks = self.marks(b)
        for mark, *places in zip(marks, *self.places(a, marks), strict=True):
            for at in places:
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
            else:
                at = places[0]
                for _ in range(KICKS):
                    slot = int(rng.integers(SLOTS))
                    mark, self.table[at, slot] = self.table[at, slot], mark
                    at = int(at ^ self.jump(np.array([mark], np.uint16))[0])
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = mark
                        break
                else:
                    return False
        return True

    def remove(self, a: np.ndarray, b: np.ndarray) -> None:
        marks = self.marks(b)
        for mark, *places in zip(marks, *self.places(a, marks), strict=True):
            for at in places:
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(len(a), 1) / (0.85 * SLOTS)))))
        while not (made := cls(buckets)).add(a, b):
            buckets *= 2
        return made


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    """Lines of a text as (line, a, b, long): a and b are the two hashes of the key."""
    keyed = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.struct(x.alias("line"), line_key(x).alias("key"))
    )
    return F.transform(
        keyed,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.struct(F.xxhash64(x["key"]).alias("a"), F.xxhash64(F.lit(17), x["key"], F.lit(29)).alias("b")).alias("id"),
            (F.length(x["key"]) >= MIN_LENGTH).alias("long"),
        ),
    )


def _keys(docs: DataFrame) -> DataFrame:
    """(doc_id, ids): the distinct ids of the long lines of each row."""
    lines = only(docs, "doc_id", "text").select("doc_id", lines_of(F.col("text")).alias("lines"))
    ids = F.array_distinct(F.transform(F.filter("lines", lambda x: x["long"]), lambda x: x["id"]))
    return lines.select("doc_id", ids.alias("ids"))


def _references(docs: DataFrame) -> DataFrame:
    return _keys(docs).select("doc_id", F.explode("ids").alias("id")).select("id.a", "id.b", "doc_id")


def _counts(references: DataFrame) -> DataFrame:
    return references.groupBy("a", "b").agg(F.count(F.lit(1)).alias("refs"), F.max("doc_id").alias("last_doc"))


@dataclass
class LineIndex:
    """State after some insertions and deletions: `references` (a, b, doc_id) holds a row per document and key, `counts`
    (a, b, refs, last_doc) the exact counts, `filters` (shard, buckets, table) the keys held by `min_docs`."""

    scratch: Scratch
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS) -> LineIndex:
        scratch = Scratch(docs.sparkSession)
        references = scratch.put(_references(docs), "references")
        return cls._filtered(scratch, references, scratch.put(_counts(references), "counts"), min_docs)

    @classmethod
    def _filtered(cls, scratch: Scratch, references: DataFrame, counts: DataFrame, min_docs: int) -> LineIndex:
        repeated = counts.where(F.col("refs") >= min_docs)
        shards = 1 << max(3, int(np.ceil(np.log2(max(1, repeated.count() / KEYS_PER_SHARD)))))
        built = repeated.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_built, FILTER_SCHEMA)
        return cls(scratch, references, counts, scratch.put(built, "filters"), shards, min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with further documents: their references are appended, their counts added, and keys that become
        frequent enter the filters."""
        new = self.scratch.put(_references(docs), "references")
        merged = self.counts.unionByName(_counts(new)).groupBy("a", "b")
        counts = merged.agg(F.sum("refs").alias("refs"), F.max("last_doc").alias("last_doc"))
        return self._changed(self.references.unionByName(new), self.scratch.put(counts, "counts"))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the rows of these doc_ids, as if they had never come; only the keys they held are counted
        again."""
        ids = only(doc_ids, "doc_id").distinct()
        touched = self.scratch.put(self.references.join(ids, "doc_id", "left_semi").select("a", "b").distinct(), "touched")
        left = self.references.join(ids, "doc_id", "left_anti").select("a", "b", "doc_id")
        again = _counts(left.join(touched, ["a", "b"], "left_semi"))
        counts = self.counts.join(touched, ["a", "b"], "left_anti").unionByName(again)
        return self._changed(left, self.scratch.put(counts, "counts"))

    def _changed(self, references: DataFrame, counts: DataFrame) -> LineIndex:
        frequent = F.col("refs") >= self.min_docs
        before, after = (x.where(frequent).select("a", "b") for x in (self.counts, counts))
        moved = before.join(after, ["a", "b"], "left_anti").withColumn("entering", F.lit(False))
        moved = moved.unionByName(after.join(before, ["a", "b"], "left_anti").withColumn("entering", F.lit(True)))
        changed = (
            self.filters.groupBy("shard")
            .cogroup(moved.withColumn("shard", _shard(self.shards)).groupBy("shard"))
            .applyInPandas(_updated, FILTER_SCHEMA)
        )
        changed = self.scratch.put(changed, "filters")
        if not changed.where("table is null").isEmpty():
            return LineIndex._filtered(self.scratch, references, counts, self.min_docs)
        return LineIndex(self.scratch, references, counts, changed, self.shards, self.min_docs)

    def probed(self, keys: DataFrame) -> DataFrame:
        """Of (doc_id, ids) the pairs (doc_id, a, b) that a filter lets through; all, if the filters are too large to
        send to every executor."""
        size = self.filters.agg(F.sum(F.length("table"))).first()[0] or 0
        if size > FILTER_BYTES:
            return keys.select("doc_id", F.explode("ids").alias("id")).select("doc_id", "id.a", "id.b")
        held = {r["shard"]: (r["buckets"], bytes(r["table"])) for r in self.filters.collect()}
        sent, shards = keys.sparkSession.sparkContext.broadcast(held), self.shards

        def probe(batches):
            filters = {
                shard: CuckooFilter(buckets, np.frombuffer(raw, np.uint16).reshape(-1, SLOTS))
                for shard, (buckets, raw) in sent.value.items()
            }
            for batch in batches:
                ids = batch.column("ids")
                owner = np.repeat(np.arange(batch.num_rows), np.diff(ids.offsets.to_numpy()))
                a, b = (ids.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                shard = a.view(np.uint64) >> np.uint64(40) & np.uint64(shards - 1)
                found = np.zeros(len(a), bool)
                for s, one in filters.items():
                    at = np.flatnonzero(shard == np.uint64(s))
                    found[at] = one.contains(a[at], b[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(owner[found])), pa.array(a[found]), pa.array(b[found])],
                    names=["doc_id", "a", "b"],
                )

        return keys.mapInArrow(probe, f"doc_id {keys.schema['doc_id'].dataType.simpleString()}, a long, b long")

    def dropped(self, docs: DataFrame) -> DataFrame:
        """(doc_id, a, b): keys that lose their lines in this document."""
        frequent = self.counts.where(F.col("refs") >= self.min_docs).select("a", "b", "last_doc")
        hits = self.probed(_keys(docs)).join(frequent, ["a", "b"])
        return hits.where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "a", "b")


FILTER_SCHEMA = "shard long, buckets long, table binary"


def _shard(shards: int) -> Column:
    return F.shiftrightunsigned("a", 40).bitwiseAND(F.lit(shards - 1)).cast("long")


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    made = CuckooFilter.of(pdf["a"].to_numpy(), pdf["b"].to_numpy())
    return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "buckets": [made.buckets], "table": [made.table.tobytes()]})


def _updated(old: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
    """The filter of a shard after some keys leave and others enter; a null table asks for a new, larger one."""
    entering = moved[moved["entering"].astype(bool)]
    if not len(old):
        return _built(entering) if len(entering) else pd.DataFrame({"shard": [], "buckets": [], "table": []})
    table = np.frombuffer(old["table"].iloc[0], np.uint16).reshape(-1, SLOTS).copy()
    held = CuckooFilter(int(old["buckets"].iloc[0]), table)
    leaving = moved[~moved["entering"].astype(bool)]
    held.remove(leaving["a"].to_numpy(np.int64), leaving["b"].to_numpy(np.int64))
    fits = held.add(entering["a"].to_numpy(np.int64), entering["b"].to_numpy(np.int64))
    return old.assign(table=[held.table.tobytes() if fits else None])


def without_repeated_lines(docs: DataFrame, index: LineIndex, columns: list[str] | None = None) -> DataFrame:
    """`columns` of each row of `docs` with the text its kept lines make, and n_lines, n_dropped."""
    columns = columns or ["doc_id", "text"]
    drops = index.dropped(docs).groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("ids"))
    drops = drops.select(F.col("doc_id").alias("of_doc"), "ids")
    docs = only(docs, *columns)
    lines = F.when(F.col("ids").isNotNull(), F.filter(lines_of(F.col("text")), lambda x: ~(x["long"] & F.array_contains("ids", x["id"]))))
    joined = docs.join(drops.hint("merge"), docs["doc_id"].eqNullSafe(drops["of_doc"]), "left").withColumn("left_lines", lines)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    joined = joined.withColumn("n_lines", n_lines)
    text = F.when(F.col("ids").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform("left_lines", lambda x: x["line"]), "\n")
    )
    n_dropped = F.when(F.col("ids").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("left_lines")).cast("long")
    joined = joined.withColumn("n_dropped", n_dropped).withColumn("text", text)
    return joined.select(*columns, "n_lines", "n_dropped")

"""Near duplicates: SuperMinHash signatures, banding, links confirmed on full shingle sets, components.

Defined results: a null or blank text has an empty set, links with nothing and is kept. Rows with equal sets are one
node of the graph, whatever their doc_ids, and doc_ids only name the components: texts that share a doc_id link each by
itself, and a null doc_id links like any other. A null never becomes a component_id while its component has another; a
component of null ids only has a null component_id and is kept. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import (
    GOLDEN,
    Scratch,
    SplitTexts,
    ascii_lower,
    mixed,
    only,
    probably_among,
    runs_hashed,
    signed,
    text_batches,
    with_columns,
)

WORDS = 5
COMPONENTS = 224
#: A band gets the most rows with which a pair at exactly the similarity asked for is missed by all bands less often.
MISSED = 2e-5
#: Elements whose permutations are held at once; longer sets are signed in pieces.
ELEMENTS_AT_ONCE = 20_000
#: Members of a bucket that are compared in one task; larger buckets are compared by pairs of such blocks.
BLOCK = 512
LOW = np.uint64(2**32 - 1)

def rows_per_band(share: float, m: int = COMPONENTS) -> int:
    """Components of a band: 7 for a similarity of 0.85, 6 for 0.8."""
    return max((r for r in range(1, m + 1) if (1 - share**r) ** (m // r) < MISSED), default=1)


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; a text of fewer words is one shingle."""
    split = SplitTexts([ascii_lower(t) if t else b"" for t in texts])
    runs = runs_hashed(split.hash, size)
    first = np.searchsorted(split.row, np.arange(len(texts) + 1))
    sets = []
    for at, end in zip(first, first[1:], strict=False):
        found = runs[at : end - size + 1] if end - at >= size else runs_hashed(split.hash[at:end], max(1, end - at))
        sets.append(np.unique(found))
    return sets


def super_minhash(elements: np.ndarray, owner: np.ndarray, owners: int, m: int = COMPONENTS) -> np.ndarray:
    """SuperMinHash signatures, (owners, m): element e of a set takes step j of its own random permutation of the
    components and offers j + r there. After step j a set is done once all its values lie below j + 1, since every
    later offer is larger; its elements then leave. All sets advance by one step at a time."""
    values = np.full(owners * m, np.inf)
    permutation = np.tile(np.arange(m, dtype=np.uint8), len(elements))
    active = np.arange(len(elements))
    left, begin, at = elements, active * m, owner * m
    for j in range(m):
        seed = mixed(left + np.uint64((2 * j + 1) * int(GOLDEN) % 2**64))
        r = (seed >> np.uint64(32)).astype(np.float64) * 2.0**-32
        k = begin + j + (((seed & LOW) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        taken = permutation.take(k)
        permutation[k] = permutation.take(begin + j)
        np.minimum.at(values, at + taken, r + j)
        done = values.reshape(owners, m).max(axis=1) < j + 1
        if done.any():
            active = active[~done[owner[active]]]
            if not len(active):
                break
            left, begin, at = elements[active], active * m, owner[active] * m
    return values.reshape(owners, m)


def signatures(sets: list[np.ndarray], m: int = COMPONENTS) -> np.ndarray:
    """Signatures of many sets in bounded memory, sets of like sizes together, as they take about as many steps; empty
    sets stay infinite."""
    out = np.full((len(sets), m), np.inf)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if held:
            elements = np.concatenate([x for _, x in held])
            owner = np.repeat(np.arange(len(held)), [len(x) for _, x in held])
            for (i, _), row in zip(held, super_minhash(elements, owner, len(held), m), strict=True):
                np.minimum(out[i], row, out=out[i])

    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        whole = sets[i]
        for at in range(0, len(whole), ELEMENTS_AT_ONCE):
            piece = whole[at : at + ELEMENTS_AT_ONCE]
            if size + len(piece) > ELEMENTS_AT_ONCE:
                flush()
                held, size = [], 0
            held.append((i, piece))
            size += len(piece)
    flush()
    return out


def _signed_batches(rows: int):
    n_bands = COMPONENTS // rows

    def signed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            sets = shingle_sets(batch.column("text").to_pylist())
            found = signatures(sets)
            bits = mixed(np.nan_to_num(found, posinf=0.0).view(np.uint64))
            bands = np.tile(np.arange(n_bands, dtype=np.uint64), (len(sets), 1))
            for i in range(rows):
                bands = mixed(bands * GOLDEN + bits[:, i : n_bands * rows : rows])
            sketch = (bits & np.uint64(0xFF)).astype(np.uint8)
            yield with_columns(
                batch,
                ["doc_id", "key"],
                n_shingles=([len(x) for x in sets], pa.int64()),
                digest=([blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                bands=([signed(x) if len(s) else None for x, s in zip(bands, sets, strict=True)], pa.list_(pa.int64())),
                sketch=([x.tobytes() if len(s) else None for x, s in zip(sketch, sets, strict=True)], pa.binary()),
            )

    return signed_batches


def _verified(min_percent: int):
    def confirm(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Exact similarity of the two whole texts of each pair."""
        for pdf in pdfs:
            keep, last, left = [], None, None
            for a, one, other in zip(pdf["a"], pdf["text_a"], pdf["text_b"], strict=True):
                if a != last:
                    last, left = a, shingle_sets([one])[0]
                right = shingle_sets([other])[0]
                common = len(np.intersect1d(left, right, assume_unique=True))
                union = len(left) + len(right) - common
                keep.append(union > 0 and 100 * common >= min_percent * union)
            yield pdf.loc[keep, ["a", "b"]]

    return confirm


def _agreeing(least: float, min_percent: int):
    def agreeing(table: pa.Table) -> pa.Table:
        """Pairs of a block pair whose signatures agree in a share `least` of the components, whose sizes allow the
        similarity, and that lie in two components; a pair is told in the first bucket it shares only."""
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), -1)
        node, component, n, block = (table.column(c).to_numpy() for c in ("node", "component", "n_shingles", "block"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        here = np.flatnonzero(bands[0] == table.column("bucket")[0].as_py())[0]
        one, other = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        left, right = [], []
        for i in one:
            js = other[(node[other] > node[i]) | (block[other] != block[i])]
            fits = 100 * np.minimum(n[i], n[js]) >= min_percent * np.maximum(n[i], n[js])
            js = js[fits & (component[js] != component[i])]
            js = js[(sketch[js] == sketch[i]).mean(axis=1) >= least]
            js = js[~(bands[js, :here] == bands[i, :here]).any(axis=1)]
            left.append(np.full(len(js), node[i]))
            right.append(node[js])
        return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})

    return agreeing


def connected(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of the edges (a, b), a != b: (node, component).

    Alternates large and small stars: each node points its larger neighbours, then its smaller ones and itself,
    to the smallest of them, until nothing moves. A hub's rows are combined before the shuffle, and the joins have a
    plain row per node on one side, so that a large one can be split."""
    links = scratch.put(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = scratch.put(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        after = scratch.put(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        moved = after.join(links, ["u", "v"], "left_anti").limit(1).count() + links.join(
            after, ["u", "v"], "left_anti"
        ).limit(1).count()
        scratch.drop(links, large)
        links = after
        if not moved:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def text_key() -> Column:
    """128-bit digest of a text; a null's is empty."""
    return F.coalesce(F.unhex(F.md5("text")), F.lit(b""))


def near_duplicates(docs: DataFrame, min_percent: int = 80) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    found = components(docs, min_percent).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def components(docs: DataFrame, min_percent: int = 80) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, key (of its text), n_shingles, component, which is a number or null for
    an empty set, and component_id, the component's smallest doc_id.

    Documents with equal sets form a class by a 128-bit digest; only one row of it goes on. Classes that share a
    band meet in a bucket. In each bucket every class is compared with the first; classes still in different
    components are compared with the member that shares most buckets, and last with each other by their signatures, so
    that no pair of a bucket that lies in two components goes unexamined. There a pair whose signatures agree in fewer
    components than the similarity less four of its standard deviations isn't compared on its texts."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = only(docs, "doc_id", "text").withColumn("key", text_key())
    share = min_percent / 100
    least = share - 4 * (share * (1 - share) / COMPONENTS) ** 0.5
    schema = "doc_id long, key binary, n_shingles long, digest binary, bands array<long>, sketch binary"
    signs = docs.mapInArrow(_signed_batches(rows_per_band(share)), schema)
    signs = scratch.put(signs.withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = signs.where("digest is not null").groupBy("digest")
    classes = classes.agg(F.min("row").alias("node"), F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows"))
    classes = scratch.put(classes, "classes")
    maybe = probably_among(classes.where("rows > 1"), "digest")("digest")
    sketched = ("doc_id", "key", "n_shingles", "bands", "sketch")
    alone = signs.where("digest is not null").where(~maybe)
    several = signs.where("digest is not null").where(maybe)
    chosen = classes.where(maybe).select("digest", F.col("node").alias("row"))
    nodes = alone.select("row", *sketched).union(several.join(chosen, ["digest", "row"]).select("row", *sketched))
    nodes = scratch.put(nodes.withColumnRenamed("row", "node"), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    shared = scratch.put(shared, "shared")
    entries = entries.where(probably_among(shared, "bucket")("bucket"))
    entries = scratch.put(entries.join(shared, "bucket").distinct(), "entries")
    members = scratch.put(entries.select("node").distinct(), "members")
    member = probably_among(members, "node")
    sketches = nodes.where(member("node")).join(members.hint("merge"), "node", "left_semi").select("node", *sketched)
    sketches = scratch.put(sketches, "sketches")
    who = F.xxhash64("doc_id", "key").alias("who")
    held = sketches.select("node", F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"))
    texts = docs.select("*", who).where(probably_among(sketches.select(who), "who")("who"))
    same = texts["doc_id"].eqNullSafe(held["of_doc"]) & (texts["key"] == held["of_key"])
    texts = texts.join(held.hint("merge"), same).select("node", "text")
    texts = scratch.put(texts.dropDuplicates(["node"]), "texts")
    sketches = sketches.drop("doc_id", "key")
    degree = entries.join(entries.groupBy("bucket").count(), "bucket").groupBy("node").agg(F.sum("count").alias("degree"))
    entries = scratch.put(entries.join(degree, "node"), "degrees")
    scratch.drop(nodes)

    def confirmed(pairs: DataFrame) -> DataFrame:
        whole = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        links = whole.select("a", "b", "text_a", "text_b").mapInPandas(_verified(min_percent), "a long, b long")
        return scratch.put(links, "confirmed")

    def still_open(component: DataFrame | None) -> DataFrame:
        """Entries of buckets whose members lie in several components."""
        if component is None:
            return entries.withColumn("component", F.col("node"))
        labelled = entries.join(component.toDF("node", "c"), "node", "left")
        labelled = labelled.select("bucket", "node", "degree", F.coalesce("c", "node").alias("component"))
        split = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return scratch.put(labelled.join(split.where("low != high").select("bucket"), "bucket"), "open")

    sized = f"100 * least(n_a, n_b) >= {int(min_percent)} * greatest(n_a, n_b)"
    sizes = sketches.select("node", "n_shingles")
    links, component = None, None
    for star in (F.struct("node", "component"), F.struct((-F.col("degree")).alias("least"), "node", "component")):
        left = still_open(component)
        stars = left.groupBy("bucket").agg(F.min(star).alias("star"))
        pairs = left.join(stars, "bucket").where("star.component != component").select(F.col("star.node").alias("a"), F.col("node").alias("b"))
        pairs = pairs.distinct().join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").where(sized)
        found = confirmed(pairs.select("a", "b"))
        links = found if links is None else links.union(found)
        component = connected(scratch, links)
    left = still_open(component)
    blocks = left.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    left = left.join(blocks, "bucket").withColumn("block", block).join(sketches, "node")
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("x"), F.greatest("block", k).alias("y")))
    left = left.withColumn("met", F.explode(met)).select("bucket", "met", "node", "component", "n_shingles", "bands", "sketch", "block")
    pairs = left.groupBy("bucket", "met").applyInArrow(_agreeing(least, min_percent), "a long, b long")
    links = links.union(confirmed(scratch.put(pairs, "pairs")))
    component = connected(scratch, links)
    result = classes.join(component.toDF("node", "c"), "node", "left")
    result = scratch.put(result.select("digest", "id", F.coalesce("c", "node").alias("component")), "components")
    names = scratch.put(result.groupBy("component").agg(F.min("id").alias("name")), "names")
    result = result.join(names, "component").select("digest", "component", "name")
    return (
        signs.select("doc_id", "key", "n_shingles", "digest")
        .join(result, "digest", "left")
        .select(
            "doc_id",
            "key",
            "n_shingles",
            "component",
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
        )
    )

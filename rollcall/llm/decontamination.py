"""Benchmark decontamination: a set join of document words with item windows, filtered by rare prefix words.

A window is found where all its words stand in order, so its rarest word alone must be met: that word is its prefix.
Rarity is counted over all documents. Where a document has a prefix word, the word's offset in the window says where
the window would start, which bounds its place and length, and the words there are compared one by one.

Defined results: null texts, of documents or items, have no words; an item without words has no window. Rows with one
item_id are one item; an item with a null id can hit words but is in no list. Repeated documents get equal rows. An
empty benchmark hits nothing. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import Scratch, kind_of, only, text_batches, with_columns

WINDOW = 10
#: Characters of item texts in a block that is sent to every task; a larger benchmark is met block by block.
BLOCK_CHARS = 4 << 20
#: Blocks met in one pass over the documents.
BLOCKS_PER_PASS = 4

#: Letters, digits and all bytes of other characters stay, A-Z are lowered, the rest parts words.
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
SPANS = "array<struct<start:bigint,end:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


class WindowIndex:
    """Windows of a block of items, reached through their rarest word."""

    def __init__(self, items: list[tuple[int | None, str]], counts: dict[bytes, int], size: int):
        self.items: dict[tuple[bytes, ...], set] = defaultdict(set)
        for item_id, text in items:
            for window in windows_of(words_of(text), size):
                self.items[window].add(item_id)
        places = defaultdict(set)
        for window in self.items:
            rarest = min(window, key=lambda w: (counts.get(w, 0), w))
            places[rarest].add((window.index(rarest), len(window)))
        self.places = {word: sorted(at) for word, at in places.items()}

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Where windows occur, and the items they are of."""
        found, items = [], set()
        for i, word in enumerate(words):
            if word in self.places:
                for offset, length in self.places[word]:
                    start = i - offset
                    if start >= 0 and start + length <= len(words):
                        of = self.items.get(tuple(words[start : start + length]))
                        if of is not None:
                            found.append((start, start + length))
                            items |= of
        return found, items


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often all documents hold each word of the vocabulary; tasks count first."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in text_batches(batches):
            for text in batch.column("text").to_pylist():
                total.update(filter(sent.value.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    counted = only(docs, "text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


def _scanning(sent, carried: list[str], size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WindowIndex(*sent.value, size)
        for batch in text_batches(batches):
            n_words, all_spans, all_items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist(), strict=True)
            for text, (spans, items) in zip(batch.column("text").to_pylist(), before, strict=True):
                words = words_of(text)
                found, of = index.spans(words)
                n_words.append(len(words))
                all_spans.append(
                    [{"start": a, "end": b} for a, b in joined_spans([(s["start"], s["end"]) for s in spans] + found)]
                )
                all_items.append(sorted({*items, *of} - {None}))
            kinds = {c: batch.schema.field(c).type for c in ("spans", "item_ids")}
            yield with_columns(
                batch,
                carried,
                n_words=(n_words, pa.int64()),
                spans=(all_spans, kinds["spans"]),
                item_ids=(all_items, kinds["item_ids"]),
            )

    return scan


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, columns: list[str] | None = None
) -> DataFrame:
    """`columns` of each row of `docs` (default doc_id), with n_words, spans (joined word intervals that windows cover)
    and item_ids (of the items whose windows occur)."""
    columns = columns or ["doc_id"]
    carried = list(dict.fromkeys([*columns, "text"]))
    spark = docs.sparkSession
    items = only(benchmark, "item_id", "text").where("text is not null")
    blocks = math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK_CHARS)
    source = only(docs, *carried)
    found = source.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "spans": F.array().cast(SPANS),
            "item_ids": F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>"),
        }
    )
    scratch = None
    for k in range(max(1, blocks)):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))) == k)
        rows = [(r["item_id"], r["text"]) for r in block.collect()]
        counts = word_counts(docs, {w for _, text in rows for w in words_of(text)})
        sent = spark.sparkContext.broadcast((rows, counts))
        last = k == max(1, blocks) - 1
        kept = columns if last else carried
        schema = f"{kind_of(source, *kept)}, n_words long, spans {SPANS}, item_ids {found.schema['item_ids'].dataType.simpleString()}"
        found = found.mapInArrow(_scanning(sent, kept, size), schema)
        if not last and k % BLOCKS_PER_PASS == BLOCKS_PER_PASS - 1:
            scratch = scratch or Scratch(spark)
            found = scratch.put(found, "spans")
    return found


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

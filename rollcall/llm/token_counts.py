"""Token counts by a two-tier lookup of pre-token lengths; no pre-token is ever shuffled by itself.

The first tier is a table of at most `MOST_FREQUENT` frequent pre-tokens, sent to every executor. The second is a cache
in each worker, filled by the tokenizer's library. A hashed share of the documents only chooses what is in the first
tier; every count is exact whatever it holds.

Defined results: a null or empty text has no bytes and no tokens. Repeated rows get equal rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import kind_of, only, text_batches, with_columns
from rollcall.llm.vocabulary import BYTE_PIECES, PLAIN, ByteCounter

MOST_FREQUENT = 65_536
#: One in this many documents, by a hash of the text, is looked at to choose frequent pre-tokens.
ONE_IN = 64
#: Distinct pre-tokens a task reports at most, and counts at most before it forgets the rare half.
REPORTED, COUNTED = 20_000, 200_000


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in text_batches(batches):
        for text in batch.column("text").to_pylist():
            if text and PLAIN.fullmatch(text):
                total.update(BYTE_PIECES.findall(text))
                if len(total) > COUNTED:
                    total = Counter(dict(total.most_common(COUNTED // 2)))
    top = total.most_common(REPORTED)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
    )


def frequent_lengths(docs: DataFrame, path: str, most: int = MOST_FREQUENT) -> tuple[str, np.ndarray]:
    """The compact first tier: frequent pre-tokens joined by zero bytes, and their lengths in tokens."""
    some = only(docs, "text").where(F.pmod(F.xxhash64("text"), F.lit(ONE_IN)) == 0)
    counted = some.mapInArrow(_common, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r["piece"] for r in counted.where("n > 1").orderBy(F.desc("n"), "piece").limit(most).collect()]
    pieces = [p for p in pieces if "\0" not in p]
    counter = ByteCounter(path)
    return "\0".join(pieces), np.array([counter.by_library(p) for p in pieces], np.uint16)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_bytes, n_tokens, without added special tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, lengths = sent.value
        counter = ByteCounter(path, dict(zip(pieces.split("\0"), lengths.tolist(), strict=True)) if len(lengths) else None)
        for batch in text_batches(batches):
            texts = batch.column("text").to_pylist()
            yield with_columns(
                batch,
                ["doc_id"],
                n_bytes=([len(t.encode("utf-8", "replace")) if t else 0 for t in texts], pa.int64()),
                n_tokens=([counter.count(t) for t in texts], pa.int64()),
            )

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(count, f"{kind_of(docs, 'doc_id')}, n_bytes long, n_tokens long")

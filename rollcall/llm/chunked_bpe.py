"""Byte-level BPE by content-defined chunks: encoding with reuse between documents, exact joins, and decoding.

A rolling hash of the last WINDOW bytes cuts texts where its low bits are zero, so that equal passages of different
documents fall into equal chunks. The hashes of all chunks of all documents are counted; those that recur most are
encoded once, in tasks, and sent to every worker as a table of bounded size. Each worker keeps other chunks in a
bounded cache that outlives its tasks, so a chunk is not encoded again while it holds it.

Chunks alone would be wrong at their joins, where the split into pre-tokens depends on both sides. A pre-token is sure
once two more follow it in what was scanned: the split pattern never looks further. At a join the text from the end of
what is sure is encoded again, some way into the next chunk, until a sure boundary found on the way is one of the
chunk's own: from there both scans see the same text in the same state and agree for good. If none does, all of the
next chunk is scanned again from the last sure boundary. The ids therefore equal those of the library on the whole
text. Strings of special tokens split a text before chunks do, as in the library.

Decoding joins the bytes of all ids and reads them as UTF-8, with U+FFFD for bytes that aren't.

Defined results: a null or empty text has no ids, and decodes to an empty text. Repeated rows get equal rows. Null
doc_ids are kept. An empty table gives no rows. Extra columns are ignored. Ids that the vocabulary lacks decode to
nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm.shared import kind_of, only, text_batches
from rollcall.llm.vocabulary import BYTE_PIECES, BYTE_SIGNS, PLAIN, Cache

#: Bytes the rolling hash looks at (a power of two), and the mean length of chunks (a power of two).
WINDOW, MEAN = 16, 256
#: Bounds of the table sent to all workers (its chunks have at most LONGEST bytes), and of a worker's cache in bytes.
MOST_SHARED, LONGEST, CACHED_BYTES = 16_384, 1024, 16 << 20
#: Pre-tokens a worker keeps, and bytes of text it works on at once.
PIECES, AT_ONCE = 250_000, 1 << 20
#: Boundaries a chunk offers for agreement, and sure ones that the repair of a join looks for at first.
OFFERED = 4
MULTIPLIER = np.uint32(0x9E3779B1)


def cuts_of(raw: bytes, mean: int = MEAN) -> np.ndarray:
    """Places in `raw` before which the rolling hash of the last WINDOW bytes cuts, never inside a character."""
    octets = np.frombuffer(raw, np.uint8)
    if len(octets) <= WINDOW:
        return np.empty(0, np.int64)
    rolled = octets.astype(np.uint32) * np.uint32(0x85EBCA6B) + np.uint32(1)
    factor, width = int(MULTIPLIER), 1
    while width < WINDOW:
        rolled = rolled[width:] + rolled[:-width] * np.uint32(factor)
        factor, width = factor * factor & 0xFFFFFFFF, 2 * width
    rolled ^= rolled >> np.uint32(15)
    at = np.flatnonzero(rolled[:-1] & np.uint32(mean - 1) == 0) + WINDOW
    return at[(octets[at] & 0xC0) != 0x80]


class Vocabulary:
    """Token bytes, the encoding of single pre-tokens, and what was encoded lately."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        splitter = stated["pre_tokenizer"] or {}
        if splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True) or splitter.get("add_prefix_space") or stated["normalizer"]:
            raise ValueError("only byte-level BPE with its usual split pattern and without a normalizer is known here")
        added = {t["id"]: t["content"] for t in stated["added_tokens"]}
        octet = {sign: b for b, sign in BYTE_SIGNS.items()}
        names = {i: t for t, i in stated["model"]["vocab"].items()} | added
        self.octets = [b""] * (max(names) + 1)
        self.decimal = [str(i) for i in range(len(self.octets))]
        for i, name in names.items():
            self.octets[i] = bytes(octet[c] for c in name) if all(c in octet for c in name) else name.encode()
        special = [t.encode() for t in sorted(added.values(), key=len, reverse=True)]
        self.special = re.compile(b"(" + b"|".join(map(re.escape, special)) + b")") if special else None
        self.special_ids = {t.encode(): np.array([i], "<i4").tobytes() for i, t in added.items()}
        self.chunks: dict[bytes, tuple] = {}
        self.held = 0
        merged = [stated["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in stated["model"]["merges"]]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if all(a < b for a, b in zip(merged, merged[1:], strict=False)):  # ids rise with the order of merges: ranks say the same
            ranks = {self.octets[i]: i for i in names if i not in added}
            merges = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
            self.piece = Cache(lambda p: np.array(merges.encode_single_piece(p.encode()), "<i4").tobytes(), most=PIECES)
        else:
            self.piece = Cache(lambda p: np.array(self.library.encode(p, add_special_tokens=False).ids, "<i4").tobytes(), most=PIECES)

    def scan(self, octets: bytes) -> tuple[list[int], list[bytes]]:
        """The lengths in bytes and the ids of the pre-tokens of a text without special tokens."""
        text = octets.decode()
        if PLAIN.fullmatch(text):
            pieces = BYTE_PIECES.findall(text)
            lengths = list(map(len, pieces)) if len(text) == len(octets) else [len(p.encode()) for p in pieces]
            return lengths, list(map(self.piece.__getitem__, pieces))
        found = self.library.encode(text, add_special_tokens=False)
        ids, words = np.array(found.ids, "<i4"), np.array(found.word_ids)
        first = np.flatnonzero(np.diff(words, prepend=-1))
        sizes = np.add.reduceat([len(self.octets[i]) for i in ids.tolist()], first).tolist()
        return sizes, [x.tobytes() for x in np.split(ids, first[1:])]

    def decode(self, ids: Iterable[int]) -> str:
        held = self.octets
        return b"".join([held[i] for i in ids if 0 <= i < len(held)]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def of_worker(path: str) -> Vocabulary:
    """One vocabulary, with its caches, for all tasks of a worker."""
    return Vocabulary(path)


def _entry(lengths: list[int], ids: list[bytes]) -> tuple[bytes, tuple[int, ...]]:
    """The ids of a chunk, and (place in bytes, place among ids) of its first boundaries, then of the last sure one."""
    sure = max(0, len(lengths) - 2)
    edges, at, n = [], 0, 0
    for length, own in zip(lengths[: min(sure, OFFERED)], ids, strict=False):
        edges += [at, n]
        at, n = at + length, n + len(own)
    whole = b"".join(ids)
    return whole, (*edges, sum(lengths) - sum(lengths[sure:]), len(whole) - sum(map(len, ids[sure:])))


class ChunkEncoder:
    """Ids of texts as little-endian 32-bit integers. `shared` holds entries of chunks computed beforehand; `asked` and
    `encoded` count chunks looked up and chunks that had to be encoded here."""

    def __init__(self, vocabulary: Vocabulary, shared: dict[bytes, tuple] | None = None, mean: int = MEAN):
        self.vocabulary, self.shared, self.mean = vocabulary, shared or {}, mean
        self.asked = self.encoded = 0

    def entry(self, chunk: bytes) -> tuple[bytes, tuple[int, ...]]:
        self.asked += 1
        vocabulary = self.vocabulary
        held = self.shared.get(chunk) or vocabulary.chunks.get(chunk)
        if held is None:
            self.encoded += 1
            held = _entry(*vocabulary.scan(chunk))
            if vocabulary.held > CACHED_BYTES:
                vocabulary.chunks.clear()
                vocabulary.held = 0
            vocabulary.chunks[chunk] = held
            vocabulary.held += len(chunk)
        return held

    def _repaired(self, octets: bytes, sure: int, begin: int, edges: tuple[int, ...]) -> tuple[bytes, int] | None:
        """Ids from the boundary `sure` before a join at `begin` up to a boundary of the next chunk, and its number
        among that chunk's edges; None if no boundary is known to both."""
        if len(edges) < 6:
            return None
        own = {edges[i]: i for i in range(0, len(edges) - 2, 2)}
        lengths, ids = self.vocabulary.scan(octets[sure : begin + edges[-4]])
        at = sure - begin
        for i in range(len(lengths) - 1):
            if at >= 0 and at in own:
                return b"".join(ids[:i]), own[at]
            at += lengths[i]
        return None

    def segment(self, octets: bytes, cuts: Iterable[int]) -> bytes:
        """The ids of a text without special tokens that is cut before the places `cuts`."""
        out, begin, sure, last = [], 0, 0, b""
        for end in (*cuts, len(octets)):
            ids, edges = self.entry(octets[begin:end])
            if begin == 0:
                out.append(ids[: edges[-1]])
                sure, last = edges[-2], ids[edges[-1] :]
            elif found := self._repaired(octets, sure, begin, edges):
                joined, k = found
                out += [joined, ids[edges[k + 1] : edges[-1]]]
                sure, last = begin + edges[-2], ids[edges[-1] :]
            else:
                again, far = _entry(*self.vocabulary.scan(octets[sure:end]))
                out.append(again[: far[-1]])
                sure, last = sure + far[-2], again[far[-1] :]
            begin = end
        return b"".join([*out, last])

    def ids(self, octets: bytes, cuts: np.ndarray | None = None) -> bytes:
        """The ids of a text; `cuts` if known."""
        special = self.vocabulary.special
        if not octets:
            return b""
        if special is None or not special.search(octets):
            return self.segment(octets, (cuts_of(octets, self.mean) if cuts is None else cuts).tolist())
        parts = special.split(octets)
        return b"".join(
            self.vocabulary.special_ids[p] if i % 2 else self.segment(p, cuts_of(p, self.mean).tolist()) for i, p in enumerate(parts) if p
        )


def _hash(chunk: bytes) -> int:
    """64 bits as a signed number."""
    return (xxhash.xxh3_64_intdigest(chunk) ^ (1 << 63)) - (1 << 63)


def _texts_cut(batch: pa.RecordBatch, mean: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """The UTF-8 bytes of each text of a batch and its cuts, found for the whole batch at once."""
    texts = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
    ends = np.cumsum([len(t) for t in texts])
    found = cuts_of(b"".join(texts), mean)
    places = np.searchsorted(found, ends)
    first = 0
    for text, end, last in zip(texts, ends.tolist(), places.tolist(), strict=True):
        own = found[first:last] - (end - len(text))
        yield text, own[(own >= WINDOW) & (own < len(text))]
        first = last


def shared_chunks(docs: DataFrame, path: str, most: int = MOST_SHARED, mean: int = MEAN) -> dict[bytes, tuple]:
    """The chunks that recur most in all of `docs`, each encoded once: at most `most`, of at most LONGEST bytes. Chunks
    are counted by their hash, tasks adding up a batch's beforehand; no text is shuffled but that of the chosen."""

    def chunks(batch: pa.RecordBatch) -> Iterator[bytes]:
        for octets, cuts in _texts_cut(batch, mean):
            places = [0, *cuts.tolist(), len(octets)]
            for begin, end in zip(places, places[1:], strict=False):
                if 0 < end - begin <= LONGEST:
                    yield octets[begin:end]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            hashes = np.array([_hash(c) for c in chunks(batch)], np.int64)
            distinct, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n.astype(np.int64))], names=["hash", "n"])

    texts = only(docs, "text")
    counted = texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")
    chosen = frozenset(r["hash"] for r in counted.orderBy(F.desc("n"), "hash").limit(most).collect())
    if not chosen:
        return {}
    sent = docs.sparkSession.sparkContext.broadcast(chosen)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = sent.value, set()
        for batch in text_batches(batches):
            fresh = {c for c in chunks(batch) if _hash(c) in wanted} - seen
            seen |= fresh
            yield pa.RecordBatch.from_arrays([pa.array(sorted(fresh), pa.binary())], names=["chunk"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = of_worker(path)
        for batch in batches:
            made = [_entry(*vocabulary.scan(c)) for c in batch.column("chunk").to_pylist()]
            columns = [batch.column("chunk"), pa.array([i for i, _ in made], pa.binary()), pa.array([e for _, e in made], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "edges"])

    distinct = texts.mapInArrow(pick, "chunk binary").distinct()
    rows = distinct.mapInArrow(encode, "chunk binary, ids binary, edges array<int>").collect()
    return {bytes(r["chunk"]): (bytes(r["ids"]), tuple(r["edges"])) for r in rows}


def encoded(docs: DataFrame, path: str, most_shared: int = MOST_SHARED, mean: int = MEAN) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, ids array<int>, without added special tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, path, most_shared, mean))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(of_worker(path), sent.value, mean)
        for batch in text_batches(batches, AT_ONCE):
            made = [encoder.ids(octets, cuts) for octets, cuts in _texts_cut(batch, mean)]
            offsets = np.cumsum([0, *(len(x) // 4 for x in made)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(encode, f"{kind_of(docs, 'doc_id')}, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Per row of `rows` (doc_id, ids): both, and the text that the ids stand for; null ids stand for an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = of_worker(path)
        for batch in batches:
            texts = [vocabulary.decode(x) if x else "" for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    rows = only(rows, "doc_id", "ids")
    return rows.mapInArrow(decode, f"{kind_of(rows, 'doc_id', 'ids')}, text string")


def round_trip(docs: DataFrame, path: str, most_shared: int = MOST_SHARED, mean: int = MEAN) -> DataFrame:
    """Encoding and decoding in one pass: per row of `docs` (doc_id, text), doc_id, n_tokens, the ids in decimal joined by
    commas, and the text decoded from these ids."""
    sent = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, path, most_shared, mean))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = of_worker(path)
        encoder = ChunkEncoder(vocabulary, sent.value, mean)
        for batch in text_batches(batches, AT_ONCE):
            made = [np.frombuffer(encoder.ids(octets, cuts), "<i4").tolist() for octets, cuts in _texts_cut(batch, mean)]
            columns = [
                batch.column("doc_id"),
                pa.array([len(x) for x in made], pa.int64()),
                pa.array([",".join([vocabulary.decimal[i] for i in x]) for x in made], pa.string()),
                pa.array([vocabulary.decode(x) for x in made], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "text"])

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(turn, f"{kind_of(docs, 'doc_id')}, n_tokens long, ids string, text string")

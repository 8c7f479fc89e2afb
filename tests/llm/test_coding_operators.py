"""Chunked BPE, vector codes and periodic runs against the library and brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import differences
from rollcall.llm import chunked_bpe, periodic_runs, queries, vector_codes

BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, runs int, lang string, n long"
SIGNS = "it's,'re,',r,e, ,  ,\n,\n\n,\t,é,ß,日本,<|endoftext|>,<|endo,123,  \n  ,don't,…,!!,ll,'l,🙂,´,٣,　".split(",")


def mixed_texts():
    rng = random.Random(4)
    shared = " ".join(f"passage{i % 23} of many, number {i}" for i in range(60))
    made = ["".join(rng.choices([*SIGNS, "a" * 40, "word ", " Ähren"], k=rng.randint(20, 400))) for _ in range(25)]
    return [None, "", " ", "x", shared, shared, "Before. " + shared + " After.", "b" + shared[7:], "y" * 30_000, *made]


@pytest.fixture(scope="module")
def rows():
    ids = [None, None, 3, 3, *range(10, 10_000)]
    return list(zip(ids, mixed_texts(), strict=False)) + [(10, mixed_texts()[4])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "en", 2) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("mean, shared", [(256, 16_384), (8, 50), (2, 0)])
def test_chunked_ids_equal_the_library(docs, rows, spark, mean, shared):
    library = Tokenizer.from_file(BYTES)
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = chunked_bpe.decoded(chunked_bpe.encoded(docs, BYTES, shared, mean), BYTES).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, library.decode(ids, skip_special_tokens=False)) for i, ids in want.elements())
    turned = Counter((r.doc_id, r.n_tokens, r.ids, r.text) for r in chunked_bpe.round_trip(docs, BYTES, shared, mean).collect())
    assert turned == Counter((r.doc_id, len(r.ids), ",".join(map(str, r.ids)), r.text) for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert chunked_bpe.decoded(chunked_bpe.encoded(empty, BYTES), BYTES).count() == 0


def test_chunks_of_shared_passages_are_encoded_once(docs):
    shared = chunked_bpe.shared_chunks(docs, BYTES, mean=32)
    assert len(shared) > 10
    assert len(chunked_bpe.shared_chunks(docs, BYTES, most=3, mean=32)) == 3
    encoder = chunked_bpe.ChunkEncoder(chunked_bpe.Vocabulary(BYTES), mean=32)
    passage = mixed_texts()[4].encode()
    encoder.ids(passage)
    once = encoder.encoded
    encoder.ids(b"Some other beginning. " + passage)
    assert encoder.encoded - once <= 3 < once


def test_cuts_follow_content_alone():
    text = " ".join(f"wörd{i * i}" for i in range(900)).encode()
    cuts = chunked_bpe.cuts_of(text, 32)
    later = chunked_bpe.cuts_of(b"abc" * 11 + text, 32) - 33
    assert len(cuts) > 100 and set(cuts) <= set(later)
    assert b"".join(text[a:b].decode().encode() for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)) == text


def test_unknown_ids_decode_to_nothing():
    vocabulary = chunked_bpe.Vocabulary(BYTES)
    library = Tokenizer.from_file(BYTES)
    for ids in ([50256, 99_999, 12], [220, 163, 163, 4210], [163]):
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 8)):
            kinds, n = rng.randint(1, 4), rng.choice([0, 1, 5, 6, 30, 100, 260])
            words = [rng.randrange(kinds) for _ in range(n)]
            a, p = rng.randrange(n or 1), rng.randint(1, max(1, n // 4))
            texts.append([w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)])
        words = np.array([w + 1 for t in texts for w in t], np.uint64)
        owner = np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
        got = [[] for _ in texts]
        for d, *run in zip(*(x.tolist() for x in periodic_runs.runs_of(words, owner, len(texts))), strict=True):
            got[d].append(tuple(run))
        assert got == [runs(t) for t in texts]


def test_extensions_both_ways():
    rng = np.random.default_rng(2)
    symbols = np.concatenate([[0], np.tile(rng.integers(2, 4, 50), 30), [1]])
    grammar = periodic_runs.Grammar(symbols)
    one, other = rng.integers(1, 1500, (2, 400))
    one, other = one[one != other], other[one != other]
    for leftwards, step in ((False, 1), (True, -1)):
        for a, b, n in zip(one, other, grammar.extension(one, other, leftwards), strict=True):
            k = 0
            while symbols[a + step * k] == symbols[b + step * k]:
                k += 1
            assert n == k


def planted(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_collapsed_texts(spark):
    rng = random.Random(3)
    texts = ["a b " * 20, None, "", " \t", "x", "z " * 4000, " ".join(rng.choices("abc", k=500)), "eins zwei drei ü " * 6 + "end"]
    rows = [(i, texts[i % len(texts)]) for i in range(60)] + [(None, texts[0]), (None, texts[6]), (5, texts[5])]
    frame = spark.createDataFrame([(i, t, "x", 1, "en", 2) for i, t in rows], SCHEMA).repartition(3)
    got = periodic_runs.collapsed(periodic_runs.with_planted_tails(frame)).collect()

    def want(i, t):
        words = planted(i, t)
        found = runs(words)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        return i, len(words), tuple(found), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()

    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.text) for r in got) == Counter(want(i, t) for i, t in rows)
    assert periodic_runs.collapsed(frame.limit(0)).count() == 0
    assert sum(crc32(str(i).encode()) % 10 == 0 for i in range(60)) > 3


def test_periodic_runs_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = planted(r.doc_id, r.text)
        found = runs(words)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        g = got.pop(r.doc_id)
        assert (g.n_runs, g.start, g.length, g.period) == (len(found), *(best or (None,) * 3))
        assert g.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert g.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest() and g.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert not got


def nearest_entry(entries, point):
    far = ((entries - point) ** 2).sum(axis=1)
    return int(far.argmin()), int(far.min())


@pytest.mark.parametrize("spread", [2, 40, 1 << 26])
def test_gnat_finds_the_lowest_of_the_nearest(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread, (64, 4))
    entries[40:50] = entries[:10]
    tree = vector_codes.Gnat(entries)
    points = np.concatenate([entries, rng.integers(-spread, spread, (500, 4)), (entries[:-1] + entries[1:]) // 2])
    index, far = tree.nearest(points)
    assert list(zip(index.tolist(), far.tolist(), strict=True)) == [nearest_entry(entries, p) for p in points]
    assert spread == 2 or tree.measured < 0.9 * len(points) * len(entries)


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    vector = lambda: [float(x) for x in rng.normal(size=20).astype(np.float32)]
    rows = [(int(i), vector(), int(i) % 3 if i % 4 else None, "x", "y") for i in rng.permutation(90)]
    rows += [(3, rows[3][1], 1, "x", "y"), rows[5], (None, vector(), None, "x", "y"), (200, None, 1, "x", "y"), (201, [], 1, "x", "y")]
    rows += [(202, [float("nan")] * 20, 1, "x", "y"), (203, [None] + vector()[1:], 2, "x", "y"), (204, vector()[:7], 2, "x", "y")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, error string").repartition(3)
    whole = [(i, np.pad(np.floor(256 * np.array(v)).astype(int), (0, 12)).reshape(16, 2), v, c) for i, v, c, *_ in rows if v and len(v) == 20 and None not in v and v[0] == v[0]]
    first = {}
    for i, x, v, _ in whole:
        if i is not None and (i not in first or v < first[i][1]):
            first[i] = (x, v)
    book = np.stack([first[i][0] for i in sorted(first)[:64]], axis=1)
    for _ in range(2):
        own = [[nearest_entry(book[p], x[p])[0] for p in range(16)] for _, x, _, _ in whole]
        for p in range(16):
            for e in range(64):
                held = [x[p] for (_, x, _, _), o in zip(whole, own, strict=True) if o[p] == e]
                if held:
                    book[p, e] = np.sum(held, axis=0) // len(held)
    want, sums = [], defaultdict(int)
    for i, x, _, label in whole:
        found = [nearest_entry(book[p], x[p]) for p in range(16)]
        want.append((i, tuple(e for e, _ in found), sum(d for _, d in found), label))
        sums[label] += want[-1][2]
    usable = vector_codes.usable(frame, "label")
    books = vector_codes.trained(usable)
    assert (books.entries == book).all()
    coded = vector_codes.coded(usable, books, "label")
    for one_in in (1000, 3):
        vector_codes.HOT_ONE_IN, before = one_in, vector_codes.HOT_ONE_IN
        got = vector_codes.with_group_sums(coded, "label", "error", "label_error").collect()
        vector_codes.HOT_ONE_IN = before
        assert Counter((r.vec_id, tuple(r.code), r.error, r.label, r.label_error) for r in got) == Counter((*w, sums[w[3]]) for w in want)
    back = coded.select(vector_codes.decoded(coded["code"], books).alias("x"), "code").first()
    assert back.x == [c / 256 for p, e in enumerate(back.code) for c in book[p, e].tolist()]
    none = vector_codes.usable(frame.limit(0), "label")
    assert vector_codes.coded(none, vector_codes.trained(none), "label").count() == 0


def test_vector_codes_query_equals_sql(spark, duck, sf_dir):
    assert differences(queries.op12_vector_codes(spark, sf_dir), duck, queries.ORACLES["op12_vector_codes"]) is None

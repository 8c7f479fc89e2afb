"""Language of texts by a byte convolutional network trained in numpy.

Defined results: a null text, or one without a letter, is `und` with score 0; without any labelled row to learn from
every text is. Rows with a null language teach nothing. Every byte of a text is in a window; repeated rows get equal
answers; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.shared import crc_mod, kind_of, only, text_batches, with_columns

UND = "und"
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bound on the labelled rows the network is fitted on, and on the windows taken from each.
ROWS_PER_LANGUAGE = 400
WINDOWS_PER_ROW = 6


@dataclass
class ByteCnn:
    """Byte embedding, one convolution per width with max pooling over the window, softmax."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray
    tables: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": []}

    def pair_tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """A convolution over bytes is a sum of table rows: one for the first two bytes, one for what follows."""
        if not self.tables:
            for width, kernel in zip(WIDTHS, self.filters, strict=True):
                one = [self.embedding @ kernel[i] for i in range(width)]
                first = (one[0][:, None, :] + one[1][None, :, :]).reshape(65536, -1)
                rest = None if width == 2 else one[2] if width == 3 else (one[2][:, None] + one[3][None]).reshape(65536, -1)
                self.tables.append((np.ascontiguousarray(first, np.float32), rest))
        return self.tables

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, WINDOW) bytes to (n, languages)."""
        b = windows.astype(np.int32)
        pair = b[:, :-1] * 256 + b[:, 1:]
        pooled = []
        for width, (first, rest), bias in zip(WIDTHS, self.pair_tables(), self.biases, strict=True):
            n = WINDOW - width + 1
            x = first[pair[:, :n]]
            if width == 3:
                x += rest[b[:, 2:]]
            elif width == 4:
                x += rest[pair[:, 2:]]
            pooled.append(np.maximum(x.max(axis=1) + bias, 0))
        z = np.concatenate(pooled, axis=1) @ self.dense + self.dense_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text in rows of WINDOW, the last padded with spaces, and how many letter bytes each has."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(raw) // WINDOW))
    padded = np.full(rows * WINDOW, 32, np.uint8)
    padded[: len(raw)] = raw
    padded = padded.reshape(rows, WINDOW)
    folded = padded | 0x20
    return padded, (((folded >= 97) & (folded <= 122)) | (padded >= 128)).sum(axis=1)


def has_letter(text: str | None) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def _training_windows(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        out = []
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            if has_letter(text):
                rows, letters = windows_of(text)
                rows = rows[letters >= WINDOW // 8] if (letters >= WINDOW // 8).any() else rows[letters > 0]
                picked = np.unique(np.linspace(0, len(rows) - 1, WINDOWS_PER_ROW).astype(int)) if len(rows) else []
                out += [(lang, rows[i].tobytes()) for i in picked]
        yield pd.DataFrame(out, columns=["lang", "window"])


def training_sample(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Windows of at most ROWS_PER_LANGUAGE labelled rows of each language, drawn by a hash of the doc_id: rows are
    first thinned by the exact count of their language, then the smallest hashes are kept."""
    labelled = only(labelled, "doc_id", "text", "lang").where("lang is not null and text is not null")
    counts = labelled.groupBy("lang").count().collect()
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 4.0 * ROWS_PER_LANGUAGE / r["count"]))) for r in counts], F.lit(0.0))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.withColumn("draw", draw).where(F.col("draw") < share)
    order = W.partitionBy("lang").orderBy("draw", F.xxhash64("text"))
    chosen = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    found = chosen.select("lang", "text").mapInPandas(_training_windows, "lang string, window binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["window"])))
    windows = np.frombuffer(b"".join(bytes(r["window"]) for r in found), np.uint8).reshape(-1, WINDOW)
    return [r["lang"] for r in found], windows


def fit(langs: list[str], windows: np.ndarray, steps: int = 400, batch: int = 96, rate: float = 4e-3, seed: int = 7) -> ByteCnn:
    """Adam on the cross-entropy; the gradient of max pooling reaches only the bytes under each filter's best place."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    target = np.searchsorted(languages, langs)
    hidden = FILTERS * len(WIDTHS)
    model = ByteCnn(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, (2 / hidden) ** 0.5, (hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    parts = [model.embedding, *model.filters, *model.biases, model.dense, model.dense_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    step, k = 0, len(WIDTHS)
    for _ in range(-(-steps * batch // len(windows))):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            b = windows[rows]
            x = model.embedding[b]
            pooled, places = [], []
            for width, kernel, bias in zip(WIDTHS, model.filters, model.biases, strict=True):
                n = WINDOW - width + 1
                z = sum(x[:, i : i + n] @ kernel[i] for i in range(width))
                places.append(z.argmax(axis=1))
                pooled.append(np.maximum(np.take_along_axis(z, places[-1][:, None], 1)[:, 0] + bias, 0))
            h = np.concatenate(pooled, axis=1)
            z = h @ model.dense + model.dense_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(rows)), target[rows]] -= 1
            g /= len(rows)
            grads = [np.zeros_like(p) for p in parts]
            grads[-2], grads[-1] = h.T @ g, g.sum(axis=0)
            back = (g @ model.dense.T) * (h > 0)
            for j, width in enumerate(WIDTHS):
                gj = back[:, j * FILTERS : (j + 1) * FILTERS]
                grads[1 + k + j] = gj.sum(axis=0)
                for i in range(width):
                    at_byte = places[j] + i
                    under = np.take_along_axis(x, at_byte[:, :, None], 1)
                    grads[1 + j][i] = np.einsum("nfe,nf->ef", under, gj)
                    hit = gj[:, :, None] * model.filters[j][i].T[None]
                    np.add.at(grads[0], np.take_along_axis(b, at_byte, 1).ravel(), hit.reshape(-1, EMBEDDING))
            step += 1
            for p, grad, (m, v) in zip(parts, grads, moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def train(labelled: DataFrame) -> ByteCnn | None:
    """A network from the labelled rows (doc_id, text, lang); None if there are none."""
    langs, windows = training_sample(labelled)
    return fit(langs, windows) if langs else None


def predict(model: ByteCnn | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Languages and their probabilities; the windows of a text count by their letters."""
    langs, scores = [UND] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if model and has_letter(t)]
    if not known:
        return langs, scores
    cut = [windows_of(texts[i]) for i in known]
    owner = np.repeat(np.arange(len(cut)), [len(x) for x, _ in cut])
    windows, letters = np.concatenate([x for x, _ in cut]), np.concatenate([n for _, n in cut])
    used = np.flatnonzero(letters)
    total = np.zeros((len(cut), len(model.languages)))
    for at in range(0, len(used), 48):
        rows = used[at : at + 48]
        np.add.at(total, owner[rows], model.log_probabilities(windows[rows]) * letters[rows, None])
    total /= np.maximum(np.bincount(owner, letters, len(cut)), 1)[:, None]
    p = np.exp(total - total.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    for i, row in zip(known, p, strict=True):
        langs[i], scores[i] = model.languages[int(row.argmax())], float(row.max())
    return langs, scores


def identify(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, lang_pred, score (the probability of that language)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 1 << 20):
            langs, scores = predict(model, batch.column("text").to_pylist())
            yield with_columns(batch, ["doc_id"], lang_pred=(langs, pa.string()), score=(scores, pa.float64()))

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(run, f"{kind_of(docs, 'doc_id')}, lang_pred string, score double")


def accepted(docs: DataFrame, model: ByteCnn | None, columns: list[str], min_score: float = 0.0) -> DataFrame:
    """The rows of `docs` in a learned language with at least that score; with `columns` alone, unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 1 << 20):
            langs, scores = predict(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array([a != UND and s >= min_score for a, s in zip(langs, scores, strict=True)]))

    docs = only(docs, *columns)
    return docs.mapInArrow(run, docs.schema)


def learning_rows(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Rows outside the held-out fold; a null doc_id is in no fold and isn't learnt from."""
    return docs.where(crc_mod("doc_id", folds) != held_out)

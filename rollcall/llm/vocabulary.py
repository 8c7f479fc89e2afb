"""Exact token counts and ids of a public tokenizer through caches of text units that its library splits apart anyway.

`ByteCounter` serves byte-level BPE with its usual split pattern, `WordIds` BPE with word ends over white-space words.
Only characters whose classes are written out here take the cached way; any other text goes to the library whole.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable

import numpy as np
import tiktoken
from tokenizers import Tokenizer
from tokenizers.models import BPE

LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
BLANKS = r" \t\n\x0b\x0c\r"
#: ASCII without its separators, Latin letters and common signs; superscripts and fractions are left out.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7f¡-±´-¸º-»¿-ſ–—‘-„…€]*")
BYTE_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^{BLANKS}{LETTERS}0-9]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
#: White space that joins units: all but single spaces and line ends between other characters.
RUNS = re.compile(r"[^\S \n]|  | \n|\n |\n\n|\A[ \n]|[ \n]\Z")
LOWERED = "a-zªµºß-öø-ÿ"
#: What the tokenizer cuts lower-cased texts of WORD_TEXT into; white space is cut away.
WORD_PIECES = re.compile(rf"[{LOWERED}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{LOWERED}0-9\s]+")
WORD_SIGNS = "\\x21-\\x7e¡-±´-¸º-»¿-ÖØ-öø-ÿ–—‘-„…€"
WORD_TEXT = re.compile(f"[{WORD_SIGNS}{BLANKS}]*")
UNUSUAL_WORDS = re.compile(f"([^{BLANKS}]*[^{WORD_SIGNS}{BLANKS}][^{BLANKS}]*)")
UNUSUAL_BLANKS = re.compile("[^\\S \\t\\n\\x0b\\x0c\\r]")


def _byte_signs() -> dict[int, str]:
    """The signs that stand for bytes in byte-level vocabularies: printable ones for themselves, the others follow 255
    in their order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


class Cache(dict):
    """Values computed once per worker; emptied back to its fixed entries when it grows past a bound."""

    def __init__(self, make: Callable, fixed: dict | None = None, most: int = 400_000):
        super().__init__(fixed or {})
        self.make, self.fixed, self.most = make, fixed or {}, most

    def __missing__(self, key):
        if len(self) >= self.most + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        value = self[key] = self.make(key)
        return value


class ByteCounter:
    """Number of tokens of texts. `frequent` holds lengths of common pre-tokens, computed beforehand."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.piece = Cache(self.by_library, frequent)
        self.bare = Cache(self._unit)
        self.spaced = Cache(lambda word: self._unit(" " + word))

    def by_library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _unit(self, text: str) -> int:
        if PLAIN.fullmatch(text):
            return sum(map(self.piece.__getitem__, BYTE_PIECES.findall(text)))
        return self.by_library(text)

    def segment(self, text: str) -> int:
        if RUNS.search(text):
            return self._unit(text)
        lines = text.split("\n")
        total = len(lines) - 1
        for line in lines:
            first, *rest = line.split(" ")
            total += self.bare[first] + sum(map(self.spaced.__getitem__, rest))
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.segment(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.segment(p) for p in parts if p)


#: A byte no UTF-8 text holds; it stands for the end of a word.
WORD_END = b"\xff"


def ranked_merges(tokenizer: Tokenizer) -> Callable[[bytes], list[int]] | None:
    """The merges of a byte-level BPE with word ends as ranks of byte strings, which `tiktoken` merges much faster; None
    unless both surely agree. They do if ids rise in the order of merges, so that the lowest id merges first; if every
    byte has a token inside and at the end of a word, the latter below all merges, so that an end joins its byte before
    anything else; and if the library finds each token as that one token, so that no other pair of parts makes it."""
    model = json.loads(tokenizer.to_str())["model"]
    suffix, octets = model["end_of_word_suffix"], {sign: byte for byte, sign in BYTE_SIGNS.items()}
    if not suffix or model["ignore_merges"] or model["dropout"]:
        return None
    merged = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    if not merged or None in merged or any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        return None
    ranks = {}
    for token, i in model["vocab"].items():
        signs = token.removesuffix(suffix)
        if not signs or not octets.keys() >= set(signs):
            return None
        ranks[bytes(map(octets.__getitem__, signs)) + WORD_END * (signs != token)] = i
    for byte in range(256):
        if bytes([byte]) not in ranks or not ranks.get(bytes([byte]) + WORD_END, merged[0]) < merged[0]:
            return None
    inner = BPE(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
    for token in model["vocab"]:
        signs = token.removesuffix(suffix)
        if len((inner if signs == token else tokenizer.model).tokenize(signs)) != 1:
            return None
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class WordIds:
    """Token ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special_ids = {k: np.array([i], "<u4").tobytes() for k, i in special.items()}
        self.model, self.merges = self.tokenizer.model, ranked_merges(self.tokenizer)
        self.piece = Cache(self._piece, most=600_000)

    def by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """A piece needs no more splitting, so merges alone are asked, without the library's other steps."""
        if self.merges:
            ids = self.merges(piece.encode() + WORD_END)
            return struct.pack(f"<{len(ids)}I", *ids)
        return np.array([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(BYTE_SIGNS))], "<u4").tobytes()

    def forget(self) -> None:
        """Empties the cache; the tokenizer stays."""
        self.piece.clear()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.piece.__getitem__, WORD_PIECES.findall(text.lower())))

    def segment(self, text: str) -> bytes:
        if WORD_TEXT.fullmatch(text):
            return self._plain(text)
        if UNUSUAL_BLANKS.search(text):
            return self.by_library(text)
        parts = UNUSUAL_WORDS.split(text)
        return b"".join(self.by_library(p) if i % 2 else self._plain(p) for i, p in enumerate(parts) if p)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special is None or not self.special.search(text):
            return self.segment(text)
        parts = self.special.split(text)
        return b"".join(self.special_ids[p] if i % 2 else self.segment(p) for i, p in enumerate(parts) if p)

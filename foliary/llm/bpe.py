"""Byte-pair encoding without merge loops: longest matches, checked pairs, backtracking.

An Aho-Corasick automaton over the vocabulary gives the longest token that
starts at each symbol of a pre-token. The encoder takes it if it may stand
beside the token before (the pair-compatibility table), else the next shorter
one, else it steps back; a position that once failed is never entered again,
so the work is linear in the pre-token. The result equals that of applying the
merges in rank order. Decoding gathers token strings through an offset table.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from foliary.llm.common import hold, map_texts, texts_of

#: Pairs of tokens kept in the compatibility table of a worker.
CACHE_PAIRS = 200_000
#: White space as Unicode lists it; Python's own \s has four control characters more.
SPACE = "\t-\r \x85\xa0  -     　"
#: Pre-tokens kept with their ids in a worker; the memory bound of the cache.
CACHE_WORDS = 120_000


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    plain = set(kept)
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def category_classes() -> tuple[str, str]:
    """Character classes (letters, numbers) of the basic plane for the plain re module."""
    found: dict[str, list[list[int]]] = {"L": [], "N": []}
    for code in range(0x10000):
        runs = found.get(unicodedata.category(chr(code))[0])
        if runs is None:
            continue
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return tuple("".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in found[k]) for k in "LN")


class Splitter:
    """Pre-tokens of a text. The pattern names letters, numbers and space as {L}, {N} and {S}."""

    def __init__(self, pattern: str):
        letters, numbers = category_classes()
        fill = lambda l, n: pattern.replace("{L}", l).replace("{N}", n).replace("{S}", SPACE)
        self.ascii = re.compile(fill("A-Za-z", "0-9")).findall
        self.basic = re.compile(fill(letters, numbers)).findall
        self.full = regex.compile(fill(r"\p{L}", r"\p{N}")).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.basic(text) if max(text) < "\U00010000" else self.full(text)


#: The split patterns that the public vocabularies are used with.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


@dataclass(frozen=True)
class Merges:
    """A vocabulary by rank: single symbols first, then merged tokens in merge order.

    A token is a string of symbols, chr(byte); the symbol chr(256 + byte) ends a
    pre-token where the vocabulary marks word ends.
    """

    tokens: list[str]
    ids: list[int]
    pair: dict[tuple[int, int], int]
    left: list[int]
    right: list[int]
    singles: int

    def by_merging(self, word: str, known: dict[str, int]) -> list[int]:
        """Plain merges in rank order; used only to prove tokens, and in tests."""
        parts = [known[c] for c in word]
        while len(parts) > 1:
            rank, at = min(((self.pair.get((a, b), sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(sys.maxsize, 0))
            if rank == sys.maxsize:
                break
            parts[at : at + 2] = [rank]
        return parts


class BpeModel:
    """A vocabulary file of the tokenizers library, read for exact encoding and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.lower = self.suffix != ""  # the word vocabulary is the one with a normalizer
        self.split = Splitter(WORD_SPLIT if self.lower else BYTE_SPLIT)
        self._special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.vocab = model["vocab"]
        self.merges = self._merges([tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]])
        self._known = {t: r for r, t in enumerate(self.merges.tokens)}
        self._prove()
        self._pairs: dict[int, bool] = {}
        self.cache = WordCache(lambda w: struct.pack(f"<{len(ids := self.word_ids(w))}I", *ids))

    def _symbols(self, token: str) -> str:
        back = {c: chr(b) for b, c in enumerate(byte_characters())}
        if self.suffix and token.endswith(self.suffix):
            body = [back[c] for c in token[: -len(self.suffix)]]
            return "".join(body[:-1]) + chr(ord(body[-1]) + 256)
        return "".join(back[c] for c in token)

    def _merges(self, merges: list[tuple[str, str]]) -> Merges:
        signs = byte_characters()
        written = signs + ([c + self.suffix for c in signs] if self.suffix else [])
        tokens = [self._symbols(c) for c in written]
        ids = [self.vocab[c] for c in written]
        rank_of = {w: r for r, w in enumerate(written)}
        left, right = list(range(len(tokens))), list(range(len(tokens)))
        pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            r = len(tokens)
            rank_of[a + b] = r
            pair[rank_of[a], rank_of[b]] = r
            tokens.append(tokens[rank_of[a]] + tokens[rank_of[b]])
            ids.append(self.vocab[a + b])
            left.append(rank_of[a])
            right.append(rank_of[b])
        return Merges(tokens, ids, pair, left, right, len(written))

    def _prove(self) -> None:
        """Find the tokens whose own string the merges turn into that one token; only they enter the automaton."""
        m = self.merges
        self.proved = [r < m.singles or m.by_merging(t, self._known) == [r] for r, t in enumerate(m.tokens)]
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(m.tokens):
            if self.proved[r]:
                self.automaton.add_word(t, r)
        self.automaton.make_automaton()
        self.length = [len(t) for t in m.tokens]
        self.shorter = [-1] * len(m.tokens)
        proved = {t: r for t, r in self._known.items() if self.proved[r]}
        for t, r in proved.items():
            self.shorter[r] = next((proved[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in proved), -1)

    def may_adjoin(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs come up: do the merges of a + b leave the border between them?

        The two tokens are taken apart from the border outwards, latest merge
        first. A merge across the border that ranks before the merge just
        undone would have come first, so the border could not stand.
        """
        key = a * len(self.length) + b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._border_stands(a, b)
        return known

    def _border_stands(self, a: int, b: int) -> bool:
        m, before = self.merges, sys.maxsize
        while True:
            across = m.pair.get((a, b))
            if across is not None and across < before:
                return False
            if max(a, b) < m.singles:
                return True
            if a > b:
                before, a = a, m.right[a]
            else:  # on equal ranks the merge further left comes first
                before, b = b + 1, m.left[b]

    def encode_symbols(self, word: str) -> list[int]:
        """Ranks of the tokens of a pre-token given in symbols."""
        size, length = len(word), self.length
        longest = [-1] * (size + 1)
        for end, r in self.automaton.iter(word):
            longest[end - length[r] + 1] = r  # ends come in ascending order: the last is the longest
        out: list[int] = []
        failed = bytearray(size + 1)
        at, r = 0, longest[0]
        while at < size:
            before = out[-1] if out else -1
            while r >= 0 and (failed[at + length[r]] or before >= 0 and not self.may_adjoin(before, r)):
                r = self.shorter[r]
            if r >= 0:
                out.append(r)
                at += length[r]
                r = longest[at]
            else:
                failed[at] = 1
                r = out.pop()
                at -= length[r]
                r = self.shorter[r]
        return out

    def word_symbols(self, word: str) -> str:
        raw = word.encode("utf-8").decode("latin-1")
        return raw[:-1] + chr(ord(raw[-1]) + 256) if self.suffix and raw else raw

    def word_ids(self, word: str) -> list[int]:
        return [self.merges.ids[r] for r in self.encode_symbols(self.word_symbols(word))]

    def normalize(self, text: str) -> str:
        if not self.lower:
            return text
        if text.isascii():
            return text.lower()
        # Character by character, so without the rule for a final sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """Runs of plain text and special tokens: (text, None) or (string, id)."""
        if self._special_at is None or "<|" not in text:
            return [(text, None)]
        return [(x, self.special.get(x)) for x in self._special_at.split(text) if x]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part, special in self.segments(text):
            if special is None:
                out += map(self.cache.__getitem__, self.split(self.normalize(part)))
            else:
                out.append(special.to_bytes(4, "little"))
        return b"".join(out)


class OffsetTable:
    """Decoding: one blob of token strings and the offsets at which each id's string starts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        joined = spec.get("decoder") is None  # then the library puts a space between tokens
        gap = b" " if joined else b""
        back = {c: b for b, c in enumerate(byte_characters())}
        strings = {i: (t.encode() if joined else bytes(back[c] for c in t)) for t, i in spec["model"]["vocab"].items() if t not in special}
        strings |= {i: t.encode() for t, i in special.items()}
        size = max(strings) + 1
        pieces = [strings.get(i, b"") + gap for i in range(size)]
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(p) for p in pieces], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.gap = len(gap)

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        start, stop = self.offsets[ids], self.offsets[ids.astype(np.int64) + 1]
        size = stop - start
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        out = self.blob[index].tobytes()
        return out[: len(out) - self.gap]


class WordCache(dict):
    """Results of pre-tokens met before, in two generations: when the newer is full it becomes the older, so frequent words stay."""

    def __init__(self, compute: Callable[[str], object], most: int = CACHE_WORDS):
        super().__init__()
        self.compute, self.most = compute, most
        self.older: dict[str, object] = {}

    def __missing__(self, word: str) -> object:
        out = self.older.get(word)
        if out is None:
            out = self.compute(word)
            if len(word) > 64:
                return out
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


@lru_cache(maxsize=1)
def load(path: str) -> BpeModel:
    """One model per worker."""
    return BpeModel(path)


@lru_cache(maxsize=1)
def offset_table(path: str) -> OffsetTable:
    return OffsetTable(path)


def release() -> None:
    """Encoding and decoding follow one another in the same workers, so they are held together."""
    load.cache_clear()
    offset_table.cache_clear()


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts: (id, n_tokens long, ids binary).

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers. A
    null or empty text has no tokens; strings of special tokens inside a text
    become those tokens, as in the library. Rows map one to one, in place: no
    shuffle, and memory is bounded by a slice of a batch, the longest text and
    the pre-token cache.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("bpe", release)
        model = load(path)
        ids = [model.encode_bytes(t) for t in texts_of(batch, text_col)]
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], [id_col, "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], text_col, f"`{id_col}` {kind}, n_tokens bigint, ids binary", work)


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Decode the rows of :func:`bpe_encode`: adds ``decoded string``. Null ids decode to the empty text.

    Byte sequences that are no UTF-8 become U+FFFD, as in the library.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("bpe", release)
        table = offset_table(path)
        decoded = [table.decode(np.frombuffer(x or b"", "<u4")).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], [id_col, "n_tokens", "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_texts(encoded, [id_col, "n_tokens", "ids"], "ids", f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded string", work)

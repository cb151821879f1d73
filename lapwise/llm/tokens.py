"""Token ids of whole texts from a tokenizer file, each distinct word encoded once.

A byte-level tokenizer never joins a word with the white space after it, nor a letter with a mark or digit after it,
so a text may be cut there (as far as both sides are ASCII) and the pieces encoded on their own. Texts in which that could matter (white space beyond ASCII,
strings of added tokens) and other kinds of tokenizers are encoded whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from lapwise.llm.texts import SPACE, Texts, byte_table, hash_runs

#: Bytes of words remembered per worker (some 40 a word).
REMEMBERED_BYTES = 16 * 1024 * 1024

#: UTF-8 beginnings of white space beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to U+206F, U+3000).
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80")


_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A))
_MARK = byte_table((0x21, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def _cuttable(spec: dict) -> bool:
    """Whether words may be encoded one by one: byte-level words by the usual pattern, no normalisation."""
    pre = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
    )


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cuttable = _cuttable(spec)
        self.special = tuple(t["content"].encode() for t in spec.get("added_tokens", ()))
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids in reading order, and the bounds of each row's."""
        raw = texts.data.tobytes()
        if not self.cuttable:
            apart = np.ones(len(texts), dtype=bool)
        else:
            apart = np.zeros(len(texts), dtype=bool)
            for mark in (*_WIDE_SPACE, *self.special):
                if mark in raw:
                    for row in range(len(texts)):
                        apart[row] |= mark in raw[texts.offsets[row] : texts.offsets[row + 1]]
        word_row, value, count = self._words(texts, raw)
        per_row = np.bincount(word_row, weights=count, minlength=len(texts)).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_row)])
        if not apart.any():
            return value, bounds
        parts = []
        for row in range(len(texts)):
            if apart[row]:
                parts.append(self.whole(texts.raw(row).decode()))
            else:
                parts.append(value[bounds[row] : bounds[row + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _words(self, texts: Texts, raw: bytes):
        """Row of each word, all ids, and how many ids each word has."""
        n = len(texts.data)
        if not n or not self.cuttable:
            return (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))
        space = SPACE[texts.data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[1:] |= _MARK[texts.data[1:]] & _LETTER[texts.data[:-1]]
        firsts = texts.offsets[:-1]
        begins[firsts[firsts < n]] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.append(start, n))
        hashes = hash_runs(texts.data, start, length)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._places(distinct, example, start, length, raw)
        first, count = self.first[place][which], self.count[place][which]
        total = np.cumsum(count)
        source = np.repeat(first - (total - count), count) + np.arange(total[-1])
        row = np.searchsorted(texts.offsets, start, side="right") - 1
        return row, self.ids[source], count

    def _places(self, distinct, example, start, length, raw) -> np.ndarray:
        if self.known.nbytes + self.first.nbytes + self.count.nbytes + self.ids.nbytes > REMEMBERED_BYTES:
            self._forget()
        place = np.searchsorted(self.known, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.known)
        known[inside] = self.known[place[inside]] == distinct[inside]
        if known.all():
            return place
        new = np.flatnonzero(~known)
        words = [raw[start[i] : start[i] + length[i]].decode() for i in example[new]]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(f) for f in found], dtype=np.int64)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.array([i for f in found for i in f], dtype=np.uint32)])
        self.known = np.concatenate([self.known, distinct[new]])
        order = np.argsort(self.known, kind="stable")
        self.known = self.known[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        return np.searchsorted(self.known, distinct)


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, kept from task to task."""
    return Encoder(path)

"""Vocabularies of public tokenizers, read from their JSON files.

The merges run in tiktoken, whose ranks are the merges' own order; a table turns
ranks into the file's ids.  The driver reads the file once and broadcasts its
text (a few MB), so its path need only exist there.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer


#: Ends a word's bytes for vocabularies with a word-end mark; words hold no line breaks.
END = b"\n"


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def process_store() -> dict:
    """A dict of the Python process: workers are reused for many tasks, so what is built once lasts."""
    name = "_upcheck_llm_store"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].store = {}
    return sys.modules[name].store


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _merge_ranks(model: dict, mark: str) -> tuple[dict[bytes, int], np.ndarray]:
    """tiktoken's ranks, and the id of each rank (-1: none)."""
    alphabet = byte_alphabet()

    def raw(token: str) -> bytes:
        ended = bool(mark) and token.endswith(mark)
        return bytes(alphabet[c] for c in (token[:-len(mark)] if ended else token)) + (END if ended else b"")

    ranks = {bytes([b]): b for b in range(256)}
    if mark:
        for b in range(256):
            if bytes([b]) != END:
                ranks[bytes([b]) + END] = len(ranks)
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        ranks.setdefault(raw(left) + raw(right), len(ranks))
    ids = np.full(len(ranks), -1, np.int64)
    for token, i in model["vocab"].items():
        try:
            at = ranks.get(raw(token))
        except KeyError:  # an added token with characters outside the alphabet
            continue
        if at is not None:
            ids[at] = i
    return ranks, ids


class ByteLevel:
    """Byte-level BPE: ids of a text, and the bytes of ids."""

    def __init__(self, source: str):
        spec = json.loads(source)
        self.ranks, self.ids = _merge_ranks(spec["model"], "")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        numbers = {text: len(self.ranks) + i for i, text in enumerate(special)}
        self.ids = np.append(self.ids, [special[x] for x in numbers])
        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens=numbers)
        self.raw = [b""] * (int(self.ids.max()) + 1)
        for token, rank in self.ranks.items():
            self.raw[self.ids[rank]] = token
        for text, i in special.items():
            self.raw[i] = text.encode()

    def encode(self, text: str) -> np.ndarray:
        return self.ids[self.encoding.encode_to_numpy(text, allowed_special="all")]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.raw[i] for i in ids])


#: Bytes of a word: 0 letter, 1 digit, 2 other; 3: the library encodes words with such a byte.
KIND = np.full(256, 3, np.int8)
KIND[33:127] = 2
KIND[48:58] = 1
KIND[65:91] = KIND[97:123] = 0
KIND[[0xC3, *range(0x80, 0xC0)]] = 0
KIND[[0x27, 0x3C]] = 3  # contractions, special tokens


class WordLevel:
    """BPE with word ends, in lower case and without white space: ids of words, each encoded once."""

    #: Words kept at most, then the store starts anew.
    KEEP = 250_000

    def __init__(self, source: str):
        spec = json.loads(source)
        ranks, self.ids = _merge_ranks(spec["model"], spec["model"]["end_of_word_suffix"])
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
        self.end = ranks[END]
        self.library = Tokenizer.from_str(source)
        self.known: dict[bytes, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.size, self.words = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros(len(self.pool), np.int32))
        while self.words + len(sizes) > len(self.begin):
            self.begin, self.size = np.append(self.begin, self.begin), np.append(self.size, self.size)
        self.pool[self.used:self.used + len(ids)] = ids
        at = slice(self.words, self.words + len(sizes))
        self.begin[at] = self.used + np.cumsum(sizes) - sizes
        self.size[at] = sizes
        self.used += len(ids)
        self.words += len(sizes)

    def _plain(self, words: list[bytes]) -> None:
        """Words of letters, digits and other signs of which none needs the library."""
        data = np.frombuffer((b"\n".join(words) + b"\n").decode().lower().encode(), np.uint8)
        kind = np.where(data == 10, 4, KIND[data])
        cut = np.zeros(len(data), np.int64)  # line breaks after each byte
        cut[:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        at = np.arange(len(data)) + np.cumsum(cut) - cut
        out = np.full(len(data) + int(cut.sum()), 10, np.uint8)
        out[at] = data
        # a break follows a word's last run already, and the word's own break then stands alone; the one after that goes
        keep = np.ones(len(out), dtype=bool)
        keep[at[(data == 10) & (cut == 1)] + 1] = False
        ranks = self.encoding.encode_to_numpy(out[keep].tobytes().decode())
        ends = np.flatnonzero(ranks == self.end)
        sizes = np.diff(ends, prepend=-1) - 1
        self._add(self.ids[np.delete(ranks, ends)].astype(np.int32), sizes)

    def _other(self, words: list[bytes]) -> None:
        got = [e.ids for e in self.library.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        self._add(np.array([i for g in got for i in g], np.int32), np.array([len(g) for g in got], np.int64))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin in ``pool``, and how many there are."""
        if self.words > self.KEEP:
            self.known, self.used, self.words = {}, 0, 0
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            data = np.frombuffer(b"\n".join(new), np.uint8)
            ends = np.cumsum([len(w) + 1 for w in new])
            odd = KIND[data] == 3
            odd &= data != 10
            sign = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7))  # the two signs among the letters
            odd[sign[data[sign] == 0xC3]] = True
            slow = np.zeros(len(new), dtype=bool)
            slow[np.searchsorted(ends, np.flatnonzero(odd), side="right")] = True
            for part, add in ((~slow, self._plain), (slow, self._other)):
                chosen = [new[i] for i in np.flatnonzero(part)]
                if chosen:
                    self.known.update(zip(chosen, range(self.words, self.words + len(chosen))))
                    add(chosen)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return self.begin[at], self.size[at]


def loaded(kind: type, source: str):
    """The vocabulary, built once in a Python process."""
    store = process_store()
    key = (kind.__name__, hash(source))
    if key not in store:
        store[key] = kind(source)
    return store[key]

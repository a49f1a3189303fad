"""Byte-level BPE by rank files, through a sentencepiece model built from the ranks.

The model holds one piece for each token, its bytes written as the characters
of the byte alphabet, scored by the negative rank, and changes no text before
it looks for pieces.  Of two neighbours sentencepiece joins those with the best
score first, the leftmost of equals: the order of ranks.  A text is split by a
pattern; each pre-token is encoded by itself, once as long as a process knows
it.  A token that its own merges do not lead to still is the id of a pre-token
that equals it.  Decoding looks up the bytes of each id.

Ids travel packed, as little-endian unsigned 32-bit integers.

Defined results: null and empty texts have no ids (an empty binary) and decode
to no bytes, as do null ids; repeated rows are encoded each; marks of special
tokens are ordinary text.  A text is split a few ten thousand pre-tokens at a
time, so a very long one needs little more memory than itself.  A vocabulary
that lacks a byte of a text, and ids outside the vocabulary, are errors.
"""

from __future__ import annotations

import base64
from itertools import islice
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from upcheck.llm.common import ranges
from upcheck.llm.vocab import byte_alphabet, loaded

#: Pre-tokens, and ids, that are worked on at a time.
WORDS = 1 << 15
#: Pre-tokens, and ids of pre-tokens, that a process keeps at most; then the store starts anew.
KEEP_WORDS, KEEP_IDS = 250_000, 2_000_000
UNKNOWN = "<unk>"


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def ranks_of(source: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its rank on every line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in source.splitlines() if line.strip())}


def serialised(pieces: list[str], ranks: list[int]) -> bytes:
    """A sentencepiece BPE model of these pieces, one unknown piece after them."""
    model = proto.ModelProto()
    for piece, rank in zip(pieces, ranks):
        model.pieces.add(piece=piece, score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece=UNKNOWN, score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    trainer.model_type = proto.TrainerSpec.BPE
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(pieces), -1, -1, -1
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = normalizer.remove_extra_whitespaces = normalizer.escape_whitespaces = False
    return model.SerializeToString()


class BytePieces:
    """The vocabulary of a rank file: ids of pre-tokens, bytes of ids."""

    def __init__(self, source: tuple[bytes, str]):
        """``source`` is the rank file's content and the pattern that splits texts."""
        ranks, pattern = ranks_of(source[0]), source[1]
        tokens = sorted(ranks, key=ranks.get)
        shown = {b: c for c, b in byte_alphabet().items()}
        self.table = {b: shown[b] for b in range(256)}  # of a text's bytes read as Latin-1
        self.pattern = regex.compile(pattern)
        pieces = ["".join(shown[b] for b in token) for token in tokens]
        self.ids = np.array([ranks[t] for t in tokens], np.uint32)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(pieces, self.ids.tolist()))
        got = self.model.encode(pieces, num_threads=1) if pieces else []
        self.whole = {piece: i for i, (piece, numbers) in enumerate(zip(pieces, got)) if numbers != [i]}
        self.number = np.full(int(self.ids.max(initial=0)) + 1, -1, np.int64)
        self.number[self.ids] = np.arange(len(tokens))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _learn(self, words: list[str]) -> None:
        shown = [w.encode().decode("latin-1").translate(self.table) for w in words]
        numbers = self.model.encode(shown, num_threads=1)
        if self.whole:
            numbers = [[self.whole[s]] if s in self.whole else n for s, n in zip(shown, numbers)]
        counts = np.fromiter(map(len, numbers), np.int64, len(numbers))
        flat = np.fromiter((i for n in numbers for i in n), np.int64, int(counts.sum()))
        if len(flat) and flat.max() >= len(self.ids):
            raise ValueError("the vocabulary lacks a byte of the text")
        while self.used + len(flat) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        at = len(self.known)
        while at + len(words) > len(self.first):
            self.first, self.count = np.append(self.first, np.zeros_like(self.first)), np.append(self.count, np.zeros_like(self.count))
        self.pool[self.used:self.used + len(flat)] = self.ids[flat]
        self.first[at:at + len(words)] = self.used + np.cumsum(counts) - counts
        self.count[at:at + len(words)] = counts
        self.known.update(zip(words, range(at, at + len(words))))
        self.used += len(flat)

    def _words(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KEEP_WORDS or self.used > KEEP_IDS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return self.pool[ranges(self.first[at], self.count[at])]

    def encode(self, text: str) -> bytes:
        """Ids of the text, packed."""
        if len(text) <= WORDS:
            return self._words(self.pattern.findall(text)).astype("<u4").tobytes()
        matches, parts = (m.group() for m in self.pattern.finditer(text)), []
        while words := list(islice(matches, WORDS)):
            parts.append(self._words(words).astype("<u4").tobytes())
        return b"".join(parts)

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        ids, parts = np.frombuffer(packed, "<u4"), []
        for s in range(0, len(ids), WORDS):
            part = ids[s:s + WORDS]
            numbers = self.number[np.minimum(part, len(self.number) - 1)]
            if (numbers < 0).any() or part.max() >= len(self.number):
                raise ValueError("an id outside the vocabulary")
            parts.append(self.bytes[ranges(self.start[numbers], self.size[numbers])].tobytes())
        return b"".join(parts)


#: Rows of output at a time.
ROWS = 500


def _mapped(rows: DataFrame, keep: list[str], source: str, target: str, path: str, pattern: str, change) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast((read(path), pattern))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(BytePieces, sent.value)
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                out = [change(vocabulary, x) for x in part.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(out, pa.binary())], names=[*keep, target])
    return rows.select(*dict.fromkeys([*keep, source])).mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{target}` binary"]))


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", name: str = "ids") -> DataFrame:
    """Columns ``keep`` and the packed ids of ``text`` as ``name``, by the rank file ``path`` and the split ``pattern``."""
    return _mapped(docs, keep, text, name, path, pattern, lambda v, x: v.encode(x or ""))


def decode(rows: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Columns ``keep`` and the bytes of the packed ids as ``name``."""
    return _mapped(rows, keep, ids, name, path, pattern, lambda v, x: v.decode(x or b""))


def count_of(ids: str = "ids"):
    """Column: how many ids are packed."""
    return (F.octet_length(ids) / 4).cast("long")

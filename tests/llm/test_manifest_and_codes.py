"""Merkle manifest, byte pieces and vector codes against plain versions."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from upcheck.llm import byte_pieces, merkle, vector_codes
from upcheck.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ manifest

def _documents(spark, path):
    return [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest(spark, edge_dir):
    out = QUERIES["op11_merkle_manifest"](spark, edge_dir)
    expected = brute.merkle(_documents(spark, edge_dir))
    assert _rows(out) == Counter(expected)
    assert 0 < sum(r[-1] for r in expected) < len(expected)


@pytest.mark.parametrize("rows, languages", [(1, 1), (2, 2), (9, 1), (700, 3), (600, 600)])
def test_manifest_of_many_steps(spark, rows, languages, scratch, monkeypatch):
    """Blocks of 8 nodes, so that trees of leaves and of groups take several steps; a third of the rows are one row."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rnd = random.Random(rows)
    data = [(i, "s", f"l{rnd.randint(1, languages) if rnd.random() < 0.5 else 1}", 3, f"Text {i}") for i in range(rows - rows // 3)]
    data += [(5, "s", "l1", 3, "One ROW")] * (rows // 3)
    df = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    df.repartition(5).write.parquet(f"{scratch}/documents.parquet")
    assert _rows(QUERIES["op11_merkle_manifest"](spark, scratch)) == Counter(brute.merkle(data))


def test_manifest_proofs_verify_without_the_tree(spark, edge_dir):
    """Leaf, slots and the proof's texts are enough to find the root."""
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = merkle.manifest(docs, ["doc_id", "text"], "source", "doc_id").collect()
    assert len(out) == docs.count()
    for r in out:
        digest = r.leaf
        for slot, others in zip(r.slots, r.proof):
            digest = brute.sha(others[:64 * slot] + digest + others[64 * slot:])
        assert digest == r.root == r.folded_root and r.changed_leaf is None


@given(st.lists(st.binary(min_size=1, max_size=4), min_size=1, max_size=70), st.data())
@settings(max_examples=60, deadline=None)
def test_folding_resumes_states(texts, data):
    digests = [hashlib.sha256(t).hexdigest().encode() for t in texts]
    at = data.draw(st.integers(0, len(texts) - 1))
    other = hashlib.sha256(b"other").hexdigest().encode()
    block = merkle.Block(digests, None)
    assert block.folded(at, digests[at]) == block.top
    assert block.folded(at, other) == merkle.Block([*digests[:at], other, *digests[at + 1:]], None).top


# ------------------------------------------------------------------ byte pieces

@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return byte_pieces.BytePieces((byte_pieces.read(RANKS), public_tokenizers.PATTERN))


def test_byte_pieces(spark, edge_dir, edge, library):
    expected = Counter()
    for doc, text in edge:
        ids = library.encode_ordinary(text or "")
        expected[doc, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(text or "")] += 1
    out = QUERIES["op12_byte_pieces"](spark, edge_dir)
    assert _rows(out) == expected


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=200) | st.text("aA1 \n\t'sé!\u00a0\u3000", max_size=200))
@settings(max_examples=200, deadline=None)
def test_byte_pieces_of_any_text(library, pieces, text):
    packed = pieces.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
    assert pieces.decode(packed) == text.encode()


def test_byte_pieces_of_long_texts(library, pieces, monkeypatch):
    """Pre-tokens in small parts, a store that starts anew, one very long pre-token."""
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abcdeé ß1'") for _ in range(rnd.randint(1, 12))) for _ in range(5000)) + "ab" * 50_000
    monkeypatch.setattr(byte_pieces, "WORDS", 100)
    monkeypatch.setattr(byte_pieces, "KEEP_WORDS", 300)
    packed = pieces.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
    assert pieces.decode(packed) == text.encode()


def test_every_token_is_its_own_id(library, pieces):
    for rank in range(0, 50_256, 7):
        token = library.decode_single_token_bytes(rank)
        assert pieces.decode(np.array([rank], "<u4").tobytes()) == token
    assert pieces.whole == {}


def test_tokens_that_merges_do_not_reach():
    """Whole pre-tokens first, as the library does, and ranks that are not 0, 1, 2."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"xyz", b"cd"]
    source = b"\n".join(base64.b64encode(t) + b" %d" % (3 * i + 5) for i, t in enumerate(tokens))
    own = byte_pieces.BytePieces((source, r"[a-z]+|[^a-z]+"))
    same = tiktoken.Encoding("own", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=byte_pieces.ranks_of(source), special_tokens={})
    assert set(own.whole) == {"xyz"}
    for text in ("xyz", "xyzab", "ab xyz cd", ""):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == same.encode_ordinary(text)
    with pytest.raises(ValueError):
        own.decode(np.array([4], "<u4").tobytes())


# ------------------------------------------------------------------ vector codes

def test_vector_codes(spark, edge_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{edge_dir}/embeddings.parquet").collect()]
    out = QUERIES["op13_vector_codes"](spark, edge_dir)
    assert _rows(out) == Counter(brute.vector_codes(rows))


@pytest.mark.parametrize("n", [1, 3, 17])
def test_vector_codes_of_few_rows(spark, scratch, n):
    rnd = random.Random(n)
    rows = [(rnd.randint(0, 9), [rnd.uniform(-1, 1) for _ in range(8)], None) for _ in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").write.parquet(f"{scratch}/embeddings.parquet")
    assert _rows(QUERIES["op13_vector_codes"](spark, scratch)) == Counter(brute.vector_codes(rows))


def test_vector_codes_beyond_64_bits_of_squares(spark, scratch):
    rows = [(i, [2.0 ** 40 + i % 20 + (0.5 if i == 3 else 0)] * 8, i % 2) for i in range(40)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{scratch}/embeddings.parquet")
    assert _rows(QUERIES["op13_vector_codes"](spark, scratch)) == Counter(brute.vector_codes(rows))


def test_vectors_of_several_lengths_fail(spark):
    rows = [(1, [0.5] * 8), (2, [0.5] * 16)]
    with pytest.raises(Exception, match="one length"):
        vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", "vec_id", ["vec_id"])[0].count()


@given(st.integers(0, 10_000), st.integers(2, 12), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_bounds_hold_and_entries_are_the_nearest(seed, entries, length):
    """Rounds with random moves: assigned entries are the nearest, the lower index of equals, and no bound is crossed."""
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-6, 7, (200, length))
    book = rnd.integers(-6, 7, (entries, length))
    b = max(1, min(entries, max(2, entries // 4)))
    kept = vector_codes.Kept.searched(x, book, b)
    for t in range(5):
        moved = book + rnd.integers(-1, 2, book.shape) * (rnd.random((entries, 1)) < 0.4)
        kept.moved(np.sqrt(((moved - book) ** 2).sum(axis=1).astype(float)) * (1 + vector_codes.SLACK))
        book = moved
        used = kept.decided(x, book)
        square = vector_codes.distances(x, book)
        assert (kept.near[:, 0] == square.argmin(axis=1)).all()
        root = np.sqrt(square.astype(float))
        assert (kept.upper >= root[np.arange(len(x)), kept.near[:, 0]]).all()
        for r in range(1, b + 1):
            others = root.copy()
            np.put_along_axis(others, kept.near[:, :r].astype(int), np.inf, axis=1)
            assert (kept.lower[:, r - 1] <= others.min(axis=1)).all()
        if t == 2 and b > 2:
            b -= 1
            kept.cut(b)
        assert used.min() >= 1 and used.max() <= kept.near.shape[1] + 1 + (t == 2)


def test_bounds_spare_distances(spark):
    """On real vectors most decisions need no second entry, and ranks fall."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    used = []
    original = vector_codes.ranks_needed
    try:
        vector_codes.ranks_needed = lambda u, b, entries: used.append((u, b)) or original(u, b, entries)
        vector_codes.compress(vectors, "embedding", "vec_id", ["vec_id"])
    finally:
        vector_codes.ranks_needed = original
    total = 8 * vectors.count()
    assert all(sum(u) == total for u, _ in used) and used[0][0][-1] == total
    full = [u[-1] for u, _ in used[1:]]
    assert sum(full) < 0.5 * total * len(full)

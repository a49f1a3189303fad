"""Algorithms inside the operators, against plain versions on random input."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tokenizers import Tokenizer

from upcheck.llm import bpe, common, packing, suffix_dedup, substring_dedup, vocab
from upcheck.llm.boosting import Calibrated, isotonic


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\0", max_size=60).map(str.encode), min_size=1, max_size=25), st.integers(0, 3))
def test_deep_shallow_sort(strings, groups):
    g = np.arange(len(strings)) % (groups + 1)
    order, lcp = suffix_dedup.deep_shallow_sort(strings, g)
    keys = [(g[i], strings[i]) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(strings)))
    for k, (a, b) in enumerate(zip(order, order[1:]), 1):
        shared = next((i for i, (x, y) in enumerate(zip(strings[a], strings[b])) if x != y), min(len(strings[a]), len(strings[b])))
        assert lcp[k] == (shared if g[a] == g[b] else -1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=80), st.lists(st.integers(1, 7), min_size=1, max_size=4))
def test_backward_search(text, pattern):
    symbols = np.array([*text, 0], np.int64)
    order = substring_dedup.suffix_order(symbols)
    assert [text[i:] for i in order[1:]] == sorted(text[i:] for i in range(len(text)))
    index = substring_dedup.FMIndex(symbols, order)
    lo, hi = np.zeros(1, np.int64), np.full(1, index.n)
    for c in reversed(pattern):
        if c > 6 or c > max(text):
            return
        lo, hi = index.extend(np.array([c]), lo, hi)
    found = sum(text[i:i + len(pattern)] == pattern for i in range(len(text)))
    assert max(0, int(hi[0] - lo[0])) == found


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("a b\né\t", max_size=20), max_size=8))
def test_word_spans_and_hashes(texts):
    import pyarrow as pa
    data, offsets = common.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first, hashes = common.word_hashes(data, offsets)
    raw = data.tobytes()
    got = [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert got == [t.encode().split() for t in texts]
    seen = {}
    for w, h in zip((x for g in got for x in g), hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


BYTES = vocab.ByteLevel(vocab.read(public_tokenizers.path("byte_bpe_50k.json")))
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = vocab.WordLevel(vocab.read(public_tokenizers.path("word_bpe_49k.json")))
WORD_LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TEXT = st.text(st.sampled_from("abeéAZß'st 12\n\t.,! 　日<|endof>x"), max_size=80) | st.text(max_size=40).filter(lambda t: t.isprintable())


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_tree_concatenation(text, leaf):
    assert bpe.encoded(text, BYTES, leaf).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_tree_concatenation_of_unsplit_text():
    for text in ("a" * 5000, "ab" * 3000, "thing" * 900, "日本" * 900, " " * 3000 + "x", "!?" * 2000, "1234567890" * 300):
        assert bpe.encoded(text, BYTES, 100).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_ids(text):
    words = text.encode().split()
    begin, size = WORDS.encode(words)
    ids = [i for b, n in zip(begin.tolist(), size.tolist()) for i in WORDS.pool[b:b + n].tolist()]
    assert ids == WORD_LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_plans_pack_every_piece(lengths):
    counts = np.bincount(lengths, minlength=31)
    plan = packing.bin_completion(counts, 30)
    used = np.zeros(31, np.int64)
    for copies, filling in plan:
        assert sum(filling) <= 30
        for x in filling:
            used[x] += copies
    assert (used == counts).all()
    assert sum(c for c, _ in plan) <= sum(c for c, _ in packing.best_fit_decreasing(counts, 30))


def test_plan_beats_best_fit():
    counts = np.bincount([6, 6, 5, 5, 4, 4, 7, 7, 3, 3, 5, 5], minlength=11)
    assert sum(c for c, _ in packing.bin_completion(counts, 10)) == 6


def test_plan_of_many_pieces():
    rnd = random.Random(1)
    counts = np.bincount([min(2048, int(rnd.lognormvariate(5.5, 1.2)) + 1) for _ in range(50_000)], minlength=2049)
    plan = packing.bin_completion(counts)
    volume = int((counts * np.arange(2049)).sum())
    assert sum(c for c, _ in plan) <= -(-volume // 2048) + 1


def test_isotonic_and_boosting():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(int)
    model = Calibrated(trees=30).fit(x, y)
    rate = model.rate(x)
    assert ((rate >= 0.5) == y).mean() > 0.97 and rate.min() >= 0 and rate.max() <= 1
    xs, ys = isotonic(np.array([3.0, 1.0, 2.0, 2.0]), np.array([1.0, 0.0, 1.0, 0.0]))
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all()


def test_clean_numbers_and_tokens_are_no_personal_data(spark):
    """Strings of every proposed kind that are none of it stay; those that a word announces go."""
    from upcheck.llm import pii
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    clean = ["12345678", "978-3-16-148410-0", "8 336 817", "build_2024_release_notes", "2024-03-05", "1999-2003", "31.12.1999", "docs/part-2/chapter_11_intro",
             "user7@localhost", "300.1.2.3", "12:30:45:10", "4111 1111 1111 1112", "1 234 567 890", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"]
    private = ["call 555-010-9999", 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"', "password: hunter2_2024_abcdef12", "ann7 (at) example (dot) org", "card 4111 1111 1111 1112"]
    rows = [(-1 - i, f"ths onan the {x} erhe ing thon.") for i, x in enumerate(clean + private)]
    model = pii.train(docs)
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()}
    assert [x for i, x in enumerate(clean) if found[-1 - i]] == []
    assert [x for i, x in enumerate(private, len(clean)) if not found[-1 - i]] == []
    assert set(model[1]) == set(pii.KINDS)


def test_thresholds_by_kind():
    from upcheck.llm import pii
    kinds = np.array(["phone"] * 4 + ["card"] * 4 + ["secret"] * 2, object)
    y = np.array([0, 0, 1, 1, 0, 1, 0, pii.BASE, 0, 1])
    rate = np.array([0.1, 0.6, 0.7, 0.9, 0.2, 0.9, 0.9, 0.95, 0.1, 0.2])
    found = pii.cutoffs(kinds, y, rate)
    assert (found["phone"], found["card"], found["secret"], found["email"]) == (0.7, float("inf"), 0.2, float("inf"))


def test_addresses_with_long_digit_runs():
    """Runs beyond what int() takes, as one part of an address or padded with zeros."""
    import pyarrow as pa
    from upcheck.llm import pii
    texts = ["7" * 5000 + ".1.1.1", "0" * 5000 + "9.1.1.255", "10.0.0.256", "010.000.0.255", "1.1.1." + "7" * 5000]
    data, offsets = common.text_bytes(pa.array(texts))
    got = [(s, e) for s, e, kind in pii.base_spans(data, offsets) if kind == "ip"]
    assert got == [(int(offsets[i]), int(offsets[i + 1])) for i in (1, 3)]


def test_texts_of_no_learned_language_go(spark):
    """Unlearned languages and noise go, with a label or without; learned languages stay, also two in one text, and short ones."""
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by_lang = {r.lang: r.text for r in docs.where("n_chars between 800 and 1500").orderBy("doc_id").collect()}
    rnd = random.Random(5)
    noise = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(40))
    strange = ["日本語のテキストは空白がないので、単語の境界を見つけるのは難しいことがあります。" * 3,
               "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
               noise("bcdfghjklmnpqrstvwxz"), *(noise("abcdefghijklmnopqrstuvwxyz") for _ in range(20))]
    at_home = [by_lang["en"], by_lang["de"][:400] + " " + by_lang["fr"][:400], " ".join(by_lang["es"].split()[:4]), by_lang["en"].upper()]
    rows = [(-1 - i, x, None) for i, x in enumerate(strange + at_home)] + [(-1001 - i, x, "en") for i, x in enumerate(strange)]
    every = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    out = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, every, None).collect()}
    assert [i for i in range(len(strange)) if -1 - i in out or -1001 - i in out] == []
    assert all(-1 - i in out for i in range(len(strange), len(strange + at_home))) and out[-1 - len(strange)] == "en"
    spelled = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert len(spelled - set(out)) <= 0.002 * len(spelled)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plans_are_the_least_possible(lengths):
    def least(left, rooms):
        if not left:
            return len(rooms)
        out = len(rooms) + 1 + len(left)
        for i, room in enumerate(rooms):
            if room >= left[0] and room not in rooms[:i]:
                out = min(out, least(left[1:], (*rooms[:i], room - left[0], *rooms[i + 1:])))
        return min(out, least(left[1:], (*rooms, 20 - left[0])))
    plan = packing.bin_completion(np.bincount(lengths, minlength=21), 20)
    fewest = least(sorted(lengths, reverse=True), ())
    assert sum(c for c, _ in plan) == fewest
    assert packing.lower_bound(np.bincount(lengths, minlength=21), 20) <= fewest


def test_plans_take_equal_fillings_into_account():
    """Exact fits that need the second of two fillings of equal waste, once and in many copies."""
    lengths = [1048, 948, 800, 700, 674, 674, 600, 400, 300]
    for copies in (1, 7, 1000, 1_000_000):
        counts = np.bincount(lengths, minlength=2049) * copies
        assert sum(c for c, _ in packing.bin_completion(counts)) == 3 * copies


def test_simhash_finds_near_copies(spark):
    """Copies with one word in a hundred replaced are found, and the answer names them."""
    from pyspark.sql import functions as F
    from upcheck.llm import simhash
    rnd = random.Random(2)
    texts = [r.text.split() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    texts = [w for w in texts if 100 <= len(w) <= 1500][:150]
    every = [x for w in texts for x in w]
    rows = []
    for i, words in enumerate(texts):
        copy = list(words)
        for at in rnd.sample(range(len(copy)), max(1, len(copy) // 100)):
            copy[at] = rnd.choice(every)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    fps = {r.doc_id: r.fp for r in simhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    index = spark.createDataFrame([(x, 1) for x in set(fps.values())], "fp long, docs long")
    asked = spark.createDataFrame([(fps[2 * i],) for i in range(len(texts))], "fp long")
    got = {(r.fp, r.near) for r in simhash.within(asked, index, simhash.RADIUS).collect()}
    apart = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert got == {(a, b) for a in {fps[2 * i] for i in range(len(texts))} for b in set(fps.values()) if apart(a, b) <= simhash.RADIUS}
    assert sum((fps[2 * i], fps[2 * i + 1]) in got for i in range(len(texts))) >= 0.9 * len(texts)


def test_simhash_names_what_it_finds(spark):
    from upcheck.llm.queries import op3_simhash
    rows = op3_simhash(spark, "/root/testdata/sf0.01").collect()
    for r in rows:
        assert (r.within is None) == (r.doc_id % 100 != 0)
    some = [r for r in rows if r.within is not None]
    for r in some:
        found = set(r.within.split(","))
        assert r.fingerprint in found and sum(x.fingerprint in found for x in rows) == r.n_within


def test_edges_of_parts_pass_32_bits(spark):
    """Texts of 2**25 characters and more, by their numbers alone."""
    from pyspark.sql import functions as F
    sizes = [(n, c) for n, c in ((100, 4), ((1 << 25) + 1, 64), (2_000_000_000, 2048))]
    df = spark.createDataFrame(sizes, "n int, c int").select("n", "c", F.explode(F.sequence(F.lit(0), F.col("c"))).alias("i"))
    for r in df.select("n", "c", "i", bpe._edge(F.col("n"), F.col("i"), F.col("c")).alias("at")).collect():
        assert r.at == r.n * r.i // r.c

"""Every query over the awkward table against a plain version, and over an empty table."""

from collections import Counter, defaultdict
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from upcheck.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"


def _rows(df, columns=None):
    return Counter(tuple(r[c] for c in columns or df.columns) for r in df.collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_suffix_dedup(spark, edge_dir, edge):
    out = QUERIES["op1_suffix_dedup"](spark, edge_dir)
    assert _rows(out) == Counter(brute.cut_bytes(edge))


def test_substring_dedup(spark, edge_dir, edge):
    out = QUERIES["op2_substring_dedup"](spark, edge_dir)
    assert _rows(out) == Counter(brute.cut_words(edge))


def test_large_groups_are_settled_window_by_window(spark, edge_dir, edge, monkeypatch):
    import upcheck.llm.repeats as repeats
    monkeypatch.setattr(repeats, "GROUP_LIMIT", 1)
    assert _rows(QUERIES["op1_suffix_dedup"](spark, edge_dir)) == Counter(brute.cut_bytes(edge))
    assert _rows(QUERIES["op2_substring_dedup"](spark, edge_dir)) == Counter(brute.cut_words(edge))


def test_simhash(spark, edge_dir, edge):
    out = QUERIES["op3_simhash"](spark, edge_dir).collect()
    order = sorted((r for r in edge), key=lambda r: -1e18 if r[0] is None else r[0], reverse=True)
    expected = Counter()
    for i, (doc, t) in enumerate(order):
        if doc is None:  # their order is that of a hash
            continue
        t, after = t or "", (order[(i + 1) % len(order)][1] or "") if i + 1 < len(order) and order[i + 1][0] is not None else None
        if after is not None:
            expected[doc, len(t), brute.sha(t[:len(t) - len(t) // 2] + after[:len(t) // 2])] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out)
    assert not expected - got and len(out) == len(edge)
    by_text = defaultdict(set)
    texts = dict(edge)
    for r in out:
        if r.doc_id is not None:
            by_text[texts[r.doc_id] or ""].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())


def test_simhash_radius_search_is_exact(spark):
    from pyspark.sql import functions as F
    from upcheck.llm import simhash
    fps = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id").bitwiseXOR(F.shiftleft(F.col("id") % 7, 40))).otherwise(F.xxhash64("id")).alias("fp")).distinct()
    rows = [r.fp for r in fps.collect()]
    got = {(r.fp, r.near) for r in simhash.within(fps, fps.withColumn("docs", F.lit(1))).collect()}
    near = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 3
    small = [x for x in rows if 0 <= x < 2**44]
    assert {p for p in got if p[0] in set(small)} == {(a, b) for a in small for b in rows if near(a, b)}
    assert simhash.within(fps, fps.withColumn("docs", F.lit(1))).count() == len(got)


def test_simhash_votes(spark):
    """Against the definition, with Spark's own term hash."""
    from pyspark.sql import functions as F
    from upcheck.llm import simhash
    terms = ["alpha", "beta", "alpha", "de", "extraordinarily"]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for t in set(terms)], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    votes = [sum(min(len(t), 8) ** 2 * (1 if hashes[t] >> b & 1 else -1) for t in terms) for b in range(64)]
    expected = sum(1 << b for b in range(64) if votes[b] > 0)
    df = spark.createDataFrame([(t,) for t in terms], "t string").agg(*simhash.votes(F.col("t"))).select(simhash.fingerprint().alias("fp"))
    assert df.first().fp & (2**64 - 1) == expected


def test_simhash_against_plain_fingerprints(spark):
    """All columns of whole texts: votes counted word by word, the radius search by comparing all pairs."""
    import re
    import xxhash
    from upcheck.llm import simhash
    small = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()), reverse=True)

    def plain(text):
        terms = Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text) if w)
        weights = [(xxhash.xxh64_intdigest(w.encode(), seed=42), min(len(w), 8) ** 2 * n) for w, n in terms.items()]
        total = sum(n for _, n in weights)
        return sum(1 << b for b in range(64) if 2 * sum(n for h, n in weights if h >> b & 1) > total)
    prints = [plain(t) for _, t in docs]
    apart = lambda a, b: bin(a ^ b).count("1")
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, small).collect()}
    assert len(got) == len(docs)
    for i, (doc, text) in enumerate(docs):
        r, after = got[doc], (i + 1) % len(docs)
        edited = plain(text[:len(text) - len(text) // 2] + docs[after][1][:len(text) // 2])
        assert (r.fingerprint, r.edited_fingerprint) == (f"{prints[i]:016x}", f"{edited:016x}")
        assert (r.near_edited, r.near_next) == (1 - apart(prints[i], edited) / 64, 1 - apart(prints[i], prints[after]) / 64)
        near = [p for p in prints if apart(p, prints[i]) <= simhash.RADIUS]
        assert r.n_within == (len(near) if doc % 100 == 0 else None)
        assert r.within == (",".join(sorted({f"{p:016x}" for p in near})) if doc % 100 == 0 else None)


def test_language_id(spark, edge_dir, edge):
    out = QUERIES["op4_language_id"](spark, edge_dir).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in edge)
    texts = dict(edge)
    for r in out:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1


def test_language_id_held_out(spark):
    out = QUERIES["op4_language_id"](spark, MID)
    truth = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(truth, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.99 * held.count()


def test_host_quality(spark, edge_dir, edge):
    out = QUERIES["op5_host_quality"](spark, edge_dir)
    assert _rows(out, out.columns[:7]) == Counter(brute.measures(edge))
    assert out.where("kept and base_failed").count() == 0


def test_host_verdicts(spark):
    from upcheck.llm.host_quality import host_verdicts
    rows = [("good", i == 0) for i in range(100)] + [("bad", i > 1) for i in range(100)] + [("one", True)] + [(None, True)] * 5
    got = {r.source: r for r in host_verdicts(spark.createDataFrame(rows, "source string, base_failed boolean")).collect()}
    assert set(got) == {"good", "bad", "one"}
    rates = {"good": 0.01, "bad": 0.98, "one": 1.0}
    mean, var = np.mean(list(rates.values())), np.var(list(rates.values()))
    weight = max(0.0, mean * (1 - mean) / var - 1)
    for host, (docs, failed) in {"good": (100, 1), "bad": (100, 98), "one": (1, 1)}.items():
        assert got[host].rate == pytest.approx((failed + mean * weight) / (docs + weight))
        assert got[host].host_ok == (got[host].rate <= 0.5)


def test_personal_data(spark, edge_dir, edge):
    out = QUERIES["op6_personal_data"](spark, edge_dir)
    expected = Counter()
    for doc, t in edge:
        kinds = brute.personal(t)
        expected[doc, *map(len, kinds), brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in sum(kinds, [])))] += 1
    assert _rows(out, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]) == expected


def test_personal_data_keeps_base_spans_and_adds_others(spark):
    from upcheck.llm import pii
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    out = pii.find(docs, pii.train(docs), ["doc_id", "text"]).collect()
    added = []
    for r in out:
        base = {(s.kind, s.s, s.e) for s in r.spans if s.base}
        assert base == set(sum(brute.personal(r.text), []))
        extra = [s for s in r.spans if not s.base]
        added += [r.text[s.s:s.e] for s in extra]
        spans = sorted((s.s, s.e) for s in extra)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert all(any(c.isdigit() for c in x) for x in added) and len(added) > 5
    assert not any(x in ("2.0", "3", "4.0") for x in added)


def test_jaccard_join(spark, edge_dir, edge):
    out = QUERIES["op7_jaccard_join"](spark, edge_dir)
    got, expected = _rows(out), Counter(brute.components(edge))
    assert got == expected


def test_jaccard_join_near_the_threshold(spark, tmp_path):
    """Sets that differ by replaced, added and missing words, against all pairs; blocks of two classes."""
    import random
    import upcheck.llm.jaccard as jaccard
    rnd = random.Random(3)
    rows, n = [], 0
    for group in range(25):
        words = [f"w{group}_{i}" if rnd.random() < 0.8 else f"c{i % 9}" for i in range(rnd.choice([1, 3, 5, 6, 8, 12, 30, 90, 300]))]
        for _ in range(rnd.randint(2, 9)):
            copy = list(words)
            for _ in range(rnd.randint(0, 1 + len(copy) // 18)):
                at = rnd.randrange(len(copy))
                copy[at:at + 1] = rnd.choice([[], [f"x{rnd.randint(0, 9)}"], [copy[at], "y"]])
                copy = copy or ["z"]
            rows.append((n, " ".join(copy)))
            n += 1
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old, jaccard.BLOCK = jaccard.BLOCK, 2
    try:
        got = _rows(jaccard.joined(docs))
    finally:
        jaccard.BLOCK = old
    assert got == Counter(brute.components(rows))


def test_byte_pair(spark, edge_dir, edge):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc, text in edge:
        ids = t.encode(text or "", add_special_tokens=False).ids
        expected[doc, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t.decode(ids, skip_special_tokens=False))] += 1
    assert _rows(QUERIES["op8_byte_pair"](spark, edge_dir)) == expected


def test_byte_pair_by_trees(spark, edge):
    """Tiny leaves, in the task and spread over rows."""
    from upcheck.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    expected = Counter((doc, tuple(t.encode(text or "", add_special_tokens=False).ids)) for doc, text in edge)
    docs = spark.createDataFrame(edge, "doc_id long, text string")
    for leaf, spread in ((7, 1 << 20), (50, 64)):
        got = Counter((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs, path, leaf, spread).collect())
        assert got == expected


def test_toxicity(spark, edge_dir, edge):
    out = QUERIES["op9_toxicity"](spark, edge_dir).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in edge)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_toxicity_held_out(spark):
    out = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    held = out.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.95
    assert held.predicted[held.toxic == 1].mean() > 0.7 and held.predicted[held.toxic == 0].mean() < 0.01


def test_packing(spark, edge_dir, edge):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, total = Counter(), 0
    for doc, text in edge:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start:start + 2048], "<u4")
            expected[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    out = QUERIES["op10_best_fit_packing"](spark, edge_dir)
    assert _rows(out, ["doc_id", "piece", "start", "length", "ids_crc32"]) == expected
    sequences = defaultdict(list)
    for r in out.collect():
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1

"""Personal data: base spans against plain patterns, redaction that leaves none, time linear in a token's length."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from upcheck.llm import pii
from upcheck.llm.common import text_bytes

ATOMS = ["@", "a", "b.c", "1", "12", ".", "-", " ", "+", "300", "10.0.0.3", "4111 1111 1111 1111", "x@y.zz", "(555)", "+1", "%", "..", "\n", "255",
         "4111-1111-1111-1111", "0", "00001", "é", "3 ", "token=", "call ", "(at)", "5105105105105100"]
MIXES = st.lists(st.sampled_from(ATOMS), max_size=25).map("".join)


def _by_text(texts, spans):
    out = [[] for _ in texts]
    data, offsets = text_bytes(pa.array(texts))
    for s, e, kind, *_ in spans:
        r = int(np.searchsorted(offsets, s, side="right")) - 1
        raw = data[offsets[r]:offsets[r + 1]].tobytes()
        at = [len(raw[:x - offsets[r]].decode()) for x in (s, e)]
        out[r].append((kind, *at))
    return out


@given(st.lists(MIXES, max_size=5))
@settings(max_examples=400, deadline=None)
def test_base_spans(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    got = _by_text(texts, pii.base_spans(data, offsets))
    assert [sorted(x) for x in got] == [sorted(sum(brute.personal(t), [])) for t in texts]


def _replaced(text, spans):
    out, at = "", 0
    for kind, s, e in sorted(spans, key=lambda x: x[1:]):
        if s >= at:
            out += text[at:s] + f"<{kind.upper()}>"
        at = max(at, e)
    return out + text[at:]


@given(st.lists(MIXES, min_size=1, max_size=4), st.booleans())
@settings(max_examples=400, deadline=None)
def test_nothing_is_left_between_spans(texts, every):
    """Whatever else is chosen (here: none or all proposals), a text with tags for spans holds no base pattern, and base spans stay."""
    data, offsets = text_bytes(pa.array(texts))
    base = pii.base_spans(data, offsets)
    offered = [x for x in pii.proposals(data, pii._between(offsets, base)) if x not in set(base)]
    chosen = pii.selected(base, offered, np.ones(len(offered)), dict.fromkeys(pii.KINDS, 0.5) if every else {}, len(data))
    spans = pii.closed(data, offsets, *chosen)
    assert {x[:3] for x in spans} >= set(base) and len(spans) == len({x[:3] for x in spans})
    for text, found in zip(texts, _by_text(texts, spans)):
        left = _replaced(text, found)
        assert not any(brute.personal(left)), (text, left)


def test_card_behind_an_address(spark):
    """The card's chain begins inside the address, so no base pattern finds it; redaction does."""
    text = "10.0.0.300 10.0.0.3 4111 1111 1111 1111 é and 10.0.0.1.2.3.4 x"
    docs = spark.createDataFrame([(1, text, 3), (2, None, 0), (3, "", 0), (4, "plain", 5)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in pii.redact(docs, pii.train(docs)).collect()}
    assert "4111" not in out[1].text and not any(brute.personal(out[1].text)) and out[1].text.startswith("10.0.0.300 <IP>")
    assert out[1].n_chars == len(out[1].text) and (out[2].text, out[3].text, out[4].text) == (None, "", "plain")


N = 100_000
_RND = random.Random(0)


@pytest.mark.parametrize("name, text", [
    ("base64", "".join(_RND.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=N))), ("digits", "1" * N + ".1"), ("local", "a" * N + "@"),
    ("dots", "1." * (N // 2)), ("signs", "a@" * (N // 2)), ("spelled", "a(at)" * (N // 5)), ("letters", "a" * N + "-1"), ("plus", "+1" + " " * N)], ids=lambda x: x if len(x) < 10 else "")
def test_long_tokens_take_linear_time(name, text):
    """Quadratic patterns took over a minute each at this size."""
    data, offsets = text_bytes(pa.array([text]))
    start = time.process_time()
    pii._examined(data, offsets)
    assert time.process_time() - start < 15


def test_whole_groups_of_long_chains_are_proposed():
    text = "id 77 4111 1111 1111 1111 1234 and 123 4567 8901 2345 6789 0123"
    data, offsets = text_bytes(pa.array([text]))
    assert not [x for x in pii.base_spans(data, offsets) if x[2] == "card"]
    cards = {text[s:e] for s, e, kind in pii._card_parts(data, offsets)}
    assert "4111 1111 1111 1111" in cards
    assert all(brute.luhn("".join(c for c in x if c.isdigit())) for x in cards)


def test_precision_and_recall_of_added_spans(spark):
    """Announced numbers, secrets and spelled addresses among dates, ranges and titles, none of them a base pattern."""
    rnd = random.Random(9)
    d = lambda n: "".join(rnd.choices("0123456789", k=n))
    right = [lambda: f"call {rnd.randint(200, 999)}-{d(3)}-{d(4)}", lambda: f"({rnd.randint(200, 999)}) {d(3)}-{d(4)}", lambda: f'token = "{"".join(rnd.choices("abcdef0123456789", k=40))}"',
             lambda: "anna (at) example (dot) org"]
    wrong = [lambda: f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}", lambda: f"{rnd.randint(1900, 1999)}-{rnd.randint(2000, 2030)}", lambda: f"{rnd.randint(1, 99)} {d(3)} {d(3)}",
             lambda: f"978-3-{d(2)}-{d(6)}-{d(1)}", lambda: f"chapter {d(2)}.{d(1)}", lambda: "build_2024_release_notes"]
    rows = [(i, f"Some words before {rnd.choice(right if i % 2 else wrong)()} and some after.", bool(i % 2)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, private boolean")
    model = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = pii.find(docs, model, ["doc_id", "private"]).select("private", (F.size("spans") > 0).alias("found")).groupBy("private", "found").count().collect()
    n = {(r.private, r["found"]): r["count"] for r in found}
    hit, false = n.get((True, True), 0), n.get((False, True), 0)
    assert hit / 300 >= 0.95 and hit / max(1, hit + false) >= 0.95, n


def test_every_document_counts(spark, monkeypatch):
    """Proposals of all documents are counted, those of copies too, and no more rows than asked for reach the driver."""
    rows = [(i, f"word {i} and call 555-010-{1000 + i % 50} or {1900 + i % 100}-{1910 + i % 100} so") for i in range(400)] + [(None, "card 4111 1111 1111 1112"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = 0
    for _, text in rows:
        _, _, _, y = pii._examined(*text_bytes(pa.array([text], pa.string())))
        expected += sum(v >= 0 for v in y)
    for most in (30_000, 20):
        table, step = pii.counts(docs.repartition(3), most)
        got = table.collect()
        assert sum(r.n for r in got) == expected and len(got) <= most and len({(bytes(r.cell), r.kind, r.y) for r in got}) == len(got)
    assert step > 1


def test_cuts_on_the_grid_part_the_values_alike():
    rnd = np.random.default_rng(3)
    x = np.abs(rnd.normal(size=(500, pii.FEATURES))) * rnd.choice([1, 10, 400], size=(500, 1))
    for step in (1, 2, 8):
        places = pii.coarser(pii.gridded(x), step) if step > 1 else pii.gridded(x)
        values = pii.ungridded(places, step)
        for f in range(pii.FEATURES):
            for cut in pii.GRID[f][::step]:
                assert ((values[:, f] > cut) == (x[:, f] > cut)).all()

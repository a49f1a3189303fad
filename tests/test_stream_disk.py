"""What the stream leaves on disk: its sink, not the uploads it has committed nor the tables behind their outputs."""

import os
from urllib.parse import unquote, urlparse

from upcheck.plans import stream_demo
from upcheck.session import shared_dir

SF = "/root/testdata/sf0.001"


def _files(spark, *below) -> set[str]:
    top = os.path.join(unquote(urlparse(shared_dir(spark)).path), "upcheck", *below)
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names if not f.endswith(".crc")}


def test_rounds_give_the_same_rows_and_leave_only_the_sink(spark, monkeypatch):
    before = _files(spark)
    once = stream_demo.run_job(spark, SF)
    runs = []

    def run(spark_, inbox, *args, go=stream_demo._run, **options):
        runs.append(len([f for f in _files(spark, "job") - before if "/inbox/" in f]))
        go(spark_, inbox, *args, **options)
    monkeypatch.setattr(stream_demo, "_run", run)
    monkeypatch.setattr(stream_demo, "ROWS_A_FILE", 500)
    monkeypatch.setattr(stream_demo, "ROWS_A_ROUND", 3000)
    rounds = stream_demo.run_job(spark, SF)
    assert len(runs) > 1 and all(0 < n < 3 * 13 for n in runs)
    for a, b in zip(once, rounds):
        cols = sorted(a.columns)
        assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))
    left = _files(spark) - before
    assert not [f for f in left if "/inbox/" in f or "/materialized/" in f or "/put/" in f and "/part-" in f]


def test_nested_tracking_of_equal_lists(spark):
    from upcheck.sources.storage import _TRACKED, tracked
    with tracked() as outer:
        with tracked() as inner:
            outer.append("a")
            inner.append("a")
        assert any(x is outer for x in _TRACKED)
    assert not any(x is outer or x is inner for x in _TRACKED)

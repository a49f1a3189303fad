"""The pipeline's stages, each against a plain version of its decision, on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import brute

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("which", ["edge", "mid"])
def test_stages(spark, edge_dir, scratch, which):
    sf_dir = edge_dir if which == "edge" else MID
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{scratch}/{k}")
        out = spark.read.parquet(f"{scratch}/{k}")
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if k < 4:
            assert out.columns == columns
            after = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
        if name == "language_id":
            spelled = Counter(r for r in before if any(c.isalpha() for c in r[1] or ""))
            assert Counter(after) - spelled == Counter() and len(after) >= 0.95 * sum(spelled.values())
        if name == "jaccard_join":
            groups, kept = {}, Counter(after)
            for (doc, text), (_, n, least) in zip(before, brute.components(before)):
                groups.setdefault((least, doc if least is None else None), []).append((doc, text, n))
            for (least, _), rows in groups.items():
                if rows[0][2]:
                    assert sum(min(kept[r], c) for r, c in Counter((d, t) for d, t, _ in rows).items()) == 1, (least, rows[0])
            assert sum(kept.values()) == sum(1 if rows[0][2] else len(rows) for rows in groups.values())
        if name == "suffix_array_dedup":
            assert Counter(d for d, _ in after) == Counter(d for d, _ in before)
            cut = {(d, n): removed for d, n, removed, _, _ in brute.cut_bytes(before)}
            sizes = Counter((d, len((t or "").encode())) for d, t in before)
            for d, t in after:
                if d is not None:
                    n = next(n for (doc, n) in sizes if doc == d)
                    assert 0 <= len((t or "").encode()) - (n - cut[d, n]) <= 6 * 200
        if name == "personal_data":
            assert Counter(d for d, _ in after) == Counter(d for d, _ in before)
            assert not any(x for _, t in after for x in brute.personal(t)[0] + brute.personal(t)[2])
        if name == "best_fit_packing":
            assert out.select("doc_id").distinct().count() == len({d for d, _ in before})
        docs = out


def test_run(spark):
    out = corpus_pipeline.run(spark, MID)
    used = out.groupBy("sequence_id").agg({"length": "sum"}).toPandas()["sum(length)"]
    assert used.max() <= 2048 and len(used) <= -(-used.sum() // 2048) + 1

"""Language ID: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased; whatever isn't a letter counts as a space.  Runs of one to
three characters are hashed to ``BUCKETS`` features.  Training counts them over
all labelled rows with a sum in every task, then one row per language and
feature.  The matrix of log probabilities (languages x BUCKETS, so of bounded
size) goes to the tasks, which sum its rows at the features of each text.

The posterior says which of the learned languages is likeliest, not whether a text
is in one; beyond a few words it is about 1 for any text.  So ``accepted`` also
takes a text's mean log probability by feature under all languages mixed (equal
parts, so that a text in two of them is no stranger).  It must not be below the
median of its language's training documents by more than ``FARTHEST`` spreads,
where the squared spread is that of the documents plus, for short texts, the
variance of one feature by their number.

Defined results: null texts and texts without a letter are ``und`` with score 0;
without any labelled row every text is ``und``; ties go to the language that
sorts first; repeated rows get equal answers.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import slices, unused

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
SMOOTHING = 0.5
CHARS = 1 << 19  # of text at a time
FARTHEST = 10.0
LEAST_SPREAD = 0.1
BINS = 256  # of one unit of log probability

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all texts (BUCKETS: none), the offset of each text, and whether it has a letter."""
    low = [t.lower() for t in texts]
    offsets = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=offsets[1:])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[points]
    seen = np.zeros(len(points) + 1, np.int64)
    np.cumsum(is_letter, out=seen[1:])
    points = np.where(is_letter, points, np.uint32(32))
    out = []
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for n in ORDERS:
        h = np.full(len(points), n, dtype=np.uint32)
        any_ = np.zeros(len(points), dtype=bool)
        for k in range(n):
            h = h * np.uint32(0x01000193)
            h[:len(h) - k] ^= points[k:]
            h *= np.uint32(0x9E3779B1)
            any_[:len(h) - k] |= is_letter[k:]
        ok = any_ & (np.arange(len(points)) + n <= ends)
        out.append(np.where(ok, (h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS), np.uint32(BUCKETS)).astype(np.int32))
    return np.stack(out), offsets, seen[offsets[1:]] > seen[offsets[:-1]]


def _batches(batch: pa.RecordBatch):
    """Row ranges of about CHARS characters with their texts."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    for i, j in slices(np.cumsum([0, *map(len, texts)]), CHARS):
        yield i, j, texts[i:j]


def counts(labelled: DataFrame) -> DataFrame:
    """``(lang, feature, c)`` of rows ``(lang, text)``; feature -1 counts the rows."""
    schema = pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for i, j, texts in _batches(batch):
                features, offsets, _ = grams(texts)
                for lang in set(langs[i:j]):
                    mine = langs[i:j] == lang
                    of = np.repeat(mine, np.diff(offsets))
                    sums = total.setdefault(lang, np.zeros(BUCKETS + 2, np.int64))
                    sums[:-1] += np.bincount(features[:, of].ravel(), minlength=BUCKETS + 1)
                    sums[-1] += int(mine.sum())
        for lang, sums in total.items():
            at = np.flatnonzero(sums[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(sums[at], sums[-1]))], schema=schema)
    return labelled.select("lang", "text").mapInArrow(run, "lang string, feature int, c long").groupBy("lang", "feature").agg(F.sum("c").alias("c"))


Model = tuple[list[str], np.ndarray, np.ndarray]


def train(labelled: DataFrame) -> Model:
    """Languages in order, log probabilities (BUCKETS + 1 features, the last 0; then the priors), and those of the languages mixed."""
    got = counts(labelled.where("lang is not null and text is not null")).toPandas()
    langs = sorted(set(got["lang"]))
    table = np.zeros((BUCKETS + 2, len(langs)))
    column = {x: i for i, x in enumerate(langs)}
    table[got["feature"].to_numpy(np.int64), got["lang"].map(column).to_numpy(np.int64)] = got["c"]
    rows = table[-1].copy()
    out, mixed = np.zeros_like(table), np.zeros(BUCKETS + 1)
    if langs:
        sums = table[:BUCKETS] + SMOOTHING
        out[:BUCKETS] = np.log(sums) - np.log(sums.sum(axis=0))
        out[-1] = np.log(rows / rows.sum())
        size = table[:BUCKETS].sum(axis=0)
        mixed[:BUCKETS] = np.log((table[:BUCKETS] / np.maximum(size, 1)).mean(axis=1) + SMOOTHING / (size.sum() + SMOOTHING * BUCKETS))
    return langs, out, mixed


def predict(docs: DataFrame, model: Model, keep: list[str], name: str = "lang_pred", score: str = "score", size: str | None = None, mean: str | None = None) -> DataFrame:
    """Columns ``keep`` and two more: the language named, and its posterior.

    With ``size`` and ``mean`` two more: the number of features, and their mean log probability under the languages mixed.
    """
    langs = model[0]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    types = {f.name: f.dataType.simpleString() for f in source.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, mixed = sent.value
        logs, prior = table[:-1].astype(np.float32), table[-1]
        names = np.array([*langs, "und"], dtype=object)
        for batch in batches:
            best, sure, sizes, means = [], [], [], []
            for i, j, texts in _batches(batch):
                features, offsets, spelled = grams(texts)
                total = np.tile(prior, (j - i, 1))
                some = np.flatnonzero(np.diff(offsets) > 0)
                n, known = np.zeros(j - i, np.int64), np.zeros(j - i)
                if len(some) and langs:
                    at = offsets[:-1][some]
                    for row in features:
                        total[some] += np.add.reduceat(logs[row], at, axis=0, dtype=np.float64)
                        if size:
                            n[some] += np.add.reduceat((row < BUCKETS).astype(np.int64), at)
                            known[some] += np.add.reduceat(mixed[row], at)
                sizes += n.tolist()
                means += (known / np.maximum(n, 1)).tolist()
                if not langs:
                    best += ["und"] * (j - i)
                    sure += [0.0] * (j - i)
                    continue
                top = total.argmax(axis=1)
                p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                best += names[np.where(spelled, top, len(langs))].tolist()
                sure += np.where(spelled, p, 0.0).tolist()
            columns = [batch.column(c) for c in keep] + [pa.array(best, pa.string()), pa.array(sure, pa.float64())]
            more = [pa.array(sizes, pa.int64()), pa.array(means, pa.float64())] if size else []
            yield pa.RecordBatch.from_arrays([*columns, *more], names=[*keep, name, score, *([size, mean] if size else [])])
    more = [f"`{size}` long", f"`{mean}` double"] if size else []
    return source.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"{name} string", f"{score} double", *more]))


def spread(labelled: DataFrame, model: Model) -> dict[str, tuple[float, float, float]]:
    """For each language the median of its documents' means, their variance, and the variance of one feature.

    The documents' deviation is the wider of the two middle sixths by rank, so strays among them don't count.
    """
    langs, table, mixed = model
    rows = predict(labelled.where("lang is not null and text is not null"), model, ["lang"], "named", "score", "size", "mean").where("size > 0")
    bins = rows.groupBy("lang", F.floor(F.col("mean") * BINS).cast("long").alias("bin")).agg(F.count("*").alias("c")).toPandas().sort_values(["lang", "bin"])
    out = {}
    for k, lang in enumerate(langs):
        mine = bins[bins["lang"] == lang]
        if not len(mine):
            continue
        rank = mine["c"].to_numpy(np.int64).cumsum()
        low, mid, high = ((mine["bin"].to_numpy()[np.searchsorted(rank, share * rank[-1])] + 0.5) / BINS for share in (0.16, 0.5, 0.84))
        p = np.exp(table[:BUCKETS, k])
        of_one = float((p * (mixed[:BUCKETS] - (p * mixed[:BUCKETS]).sum()) ** 2).sum())
        out[lang] = (float(mid), float(max(mid - low, high - mid, LEAST_SPREAD)) ** 2, of_one)
    return out


def accepted(docs: DataFrame, model: Model, known: dict[str, tuple[float, float, float]], least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` in a known language, by its ``spread``, named with a posterior of ``least`` or more; a null ``lang`` becomes that language."""
    names: list[str] = []
    for x in ("lang_pred", "score", "size", "mean"):
        names.append(unused(x, [*docs.columns, *names]))
    name, score, size, mean = names
    near = F.when(F.col(name) == "und", False)
    for lang, (mid, of_docs, of_one) in known.items():
        near = near.when(F.col(name) == lang, F.col(mean) >= mid - FARTHEST * F.sqrt(F.lit(of_docs) + of_one * len(ORDERS) / F.col(size)))
    out = predict(docs, model, docs.columns, name, score, size, mean).where(near & (F.col(score) >= least))
    return out.withColumn("lang", F.coalesce("lang", name)).select(*docs.columns)


def part_of(id_, parts: int):
    """crc32 of the id's decimal text modulo ``parts``: which fold a document is in (null: that of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_).cast("string"), F.lit("")).cast("binary")) % parts

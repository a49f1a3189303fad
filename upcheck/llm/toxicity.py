"""Toxicity: gradient-boosted trees over dense features of the text, calibrated by isotonic regression.

Features are rates of whole texts: words of a lexicon (as written, and with
digits and signs read as the letters they stand for), such words near a second
person, capitals, punctuation and obfuscation.  The lexicon is a list of common
insults and the words that the labelled sample shows to be telling.

Defined results: null and empty texts are scored like texts without words;
without labels every score is 0; repeated rows get equal scores.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.boosting import Calibrated
from upcheck.llm.common import slices, span_hashes, text_bytes, SPACE

#: Labelled documents that the model is fitted on at most: those whose id hashes least.
TRAIN_ROWS = 8000
#: A word of the sample is telling if so many toxic documents have it, and this share of all that have it.
MIN_TOXIC, MIN_SHARE = 10, 0.9
NEAR = 5  # words between an insult and a second person

# Common insults and second persons in English, French, German and Spanish.
INSULTS = """idiot idiots moron morons stupid loser losers clown clowns scum trash garbage pathetic worthless disgusting dumb
fool fools jerk creep freak pig vermin imbecile cretin ugly filthy
imbécile crétin connard connasse salaud ordure abruti débile minable dégoûtant
dummkopf trottel abschaum arschloch idioten blödmann widerlich wertlos erbärmlich
estúpido estúpida imbécil basura escoria payaso patético asqueroso idiota tonto""".split()
SECOND_PERSONS = "you your yours yourself u ur tu toi ton ta tes vous votre vos du dich dir dein deine ihr euch te ti tus vosotros usted ustedes".split()

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
LEET = LOWER.copy()
LEET[list(b"013457@$!")] = list(b"oieastasi")
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[list(b".,;:!?\"'()-")] = True
SIGN = np.zeros(256, dtype=bool)
SIGN[list(b"#*$%&|<>@^~_+=/\\")] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
FEATURES = 17


def _hashed(words: list[str]) -> np.ndarray:
    """Sorted hashes of words as ``_runs`` sees them."""
    raw = [bytes(LOWER[np.frombuffer(w.encode(), np.uint8)]) for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    return np.unique(span_hashes(data, ends - [len(w) for w in raw], ends)) if raw else np.zeros(0, np.uint64)


def _runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True within rows."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edge = offsets[:-1][offsets[:-1] < len(mask)]
    first[edge] = mask[edge]
    edge = edge[edge > 0] - 1
    last[edge] = mask[edge]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
    return known[at] == h if len(known) else np.zeros(len(h), dtype=bool)


def features(data: np.ndarray, offsets: np.ndarray, insults: np.ndarray, persons: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each row of text."""
    rows, size = len(offsets) - 1, np.diff(offsets)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    low, letter = LOWER[data], LETTER[data]
    starts, ends = _runs(letter, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    h = span_hashes(low, starts, ends)
    hit, person = _among(h, insults), _among(h, persons)
    by_row = lambda mask: np.bincount(row[mask], minlength=rows)
    seen = np.flatnonzero(person)
    near = np.zeros(len(h), dtype=bool)
    if len(seen):
        at = np.searchsorted(seen, np.arange(len(h)))
        for other in (seen[np.minimum(at, len(seen) - 1)], seen[np.maximum(at - 1, 0)]):
            near |= (np.abs(other - np.arange(len(h))) <= NEAR) & (row[other] == row)
    plain = LEET[data]
    inside = LETTER[plain]
    s2, e2 = _runs(inside, offsets)
    hidden = _among(span_hashes(plain, s2, e2), insults)
    hidden_rows = np.bincount(np.searchsorted(offsets, s2[hidden], side="right") - 1, minlength=rows)
    broken = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        broken[1:-1] = letter[:-2] & letter[2:] & ~letter[1:-1] & ~SPACE[data[1:-1]]
    tripled = np.zeros(len(data), dtype=bool)
    tripled[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
    words, hits = np.bincount(row, minlength=rows), by_row(hit)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    letters = total(letter)
    distinct = np.bincount(np.unique(np.stack([row[hit].astype(np.uint64), h[hit]], axis=1), axis=0)[:, 0].astype(np.int64), minlength=rows) if hit.any() else np.zeros(rows)
    return np.stack([
        np.log1p(words), np.log1p(hits), hits / per_word, np.log1p(distinct), np.log1p(by_row(hit & near)), by_row(person) / per_word,
        np.log1p(np.maximum(hidden_rows - hits, 0)), total(UPPER[data]) / np.maximum(letters, 1), total(data == 33) / per_byte, total(data == 63) / per_byte,
        total(PUNCTUATION[data]) / per_byte, total(SIGN[data]) / per_byte, total(DIGIT[data]) / per_byte, total(broken) / per_word, total(tripled) / per_byte,
        letters / per_word, np.log1p(total(data == 10))], axis=1)


def _scanned(batch: pa.RecordBatch, lexicon: list[str]) -> np.ndarray:
    insults, persons = _hashed(lexicon), _hashed(SECOND_PERSONS)
    data, offsets = text_bytes(batch.column("text"))
    parts = [features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], insults, persons) for i, j in slices(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, FEATURES))


def sample(docs: DataFrame, labelled: DataFrame, rows: int) -> DataFrame:
    """``(doc_id, toxic, text)`` of at most ``rows`` labelled documents; their ids are few enough to broadcast."""
    labels = labelled.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def telling_words(labelled: DataFrame) -> list[str]:
    """Words of the sample that stand in toxic documents nearly always; at most one for every MIN_TOXIC words of it."""
    word = F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}]+")))
    counts = labelled.select("toxic", word.alias("word")).where("word <> ''").groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    telling = counts.where((F.col("bad") >= MIN_TOXIC) & (F.col("bad") >= MIN_SHARE * F.col("all")))
    return sorted(r.word for r in telling.orderBy(F.desc("bad"), "word").limit(200).collect())


def train(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], Calibrated]:
    """The lexicon and the model, from ``labelled (doc_id, toxic)``."""
    known = sample(docs, labelled, rows)
    lexicon = sorted({*INSULTS, *telling_words(known)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _scanned(batch, lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["doc_id", "toxic", "x"])
    got = known.mapInArrow(run, "doc_id long, toxic int, x array<double>").orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, FEATURES)
    return lexicon, Calibrated().fit(x, got["toxic"].to_numpy(np.int64))


def score(docs: DataFrame, model: tuple[list[str], Calibrated]) -> DataFrame:
    """``(doc_id, score)`` of rows ``(doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, trees = sent.value
        for batch in batches:
            rate = trees.rate(_scanned(batch, lexicon))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rate, pa.float64())], names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")

"""Quality rules by host, in DataFrame functions only.

Documents are measured one by one (``measured``).  Failures are then summed by
host, and each host's failure rate is shrunk towards the rate of all hosts with a
beta prior fitted to the hosts' rates by their mean and variance.  A host whose
shrunk rate is over ``MAX_RATE`` is turned down with all its documents.

Defined results: a null text has no words and fails; a null source has no host
verdict, so its documents stand by the rules alone; with one host, or hosts of
equal rates, the prior is as strong as ``STRONGEST`` documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import SPACES, Scratch

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_RATE = 0.5
STRONGEST = 1000.0


def repeated_words(words: DataFrame, keep: list[str]) -> DataFrame:
    """``n_repeat_words`` of ``words``: how many stand in a window of three that the text has twice."""
    at = F.sequence(F.lit(0), F.size("words") - 3)
    gram = lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("g"), i.alias("p"))
    none = F.array().cast("array<struct<g:bigint,p:int>>")
    grams = words.select(*keep, F.when(F.size("words") >= 3, F.array_sort(F.transform(at, gram))).otherwise(none).alias("grams"))
    twice = F.filter("grams", lambda x, i: (x["g"] == F.get("grams", i + 1)["g"]) | (x["g"] == F.get("grams", i - 1)["g"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).cast("long").alias("n"), p.alias("last"))
    places = F.array_sort(F.transform(twice, lambda x: x["p"]))
    return grams.select(*keep, F.aggregate(places, start, step, lambda a: a["n"]).alias("n_repeat_words"))


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    first = docs.select("doc_id", "source", text.alias("text"), F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"), lines.alias("lines"))
    long = lambda x: x.cast("long")
    bare: Column = F.translate("text", "#*$%&|<>", "")
    keep = ["doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    counted = first.select(
        "doc_id", "source", "words", long(F.size("words")).alias("n_words"), long(F.length(F.translate("text", " \t\n\x0b\f\r", ""))).alias("word_chars"),
        long(F.length("text") - F.length(bare)).alias("n_symbols"), long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return repeated_words(counted, keep).select(*keep, "n_repeat_words", failed.alias("base_failed"))


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``(source, docs, failed, rate, host_ok)`` of rows ``(source, base_failed)``."""
    hosts = (rows.where("source is not null").groupBy("source")
             .agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")))
    rate = F.col("failed") / F.col("docs")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var")).first()  # two numbers
    mean, var = prior["mean"] or 0.0, prior["var"] or 0.0
    weight = min(STRONGEST, max(0.0, mean * (1 - mean) / var - 1)) if var > 0 else STRONGEST
    shrunk = (F.col("failed") + mean * weight) / (F.col("docs") + weight)
    return hosts.select("source", "docs", "failed", shrunk.alias("rate"), (shrunk <= MAX_RATE).alias("host_ok"))


def judged(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``measured`` with the host's ``rate`` and ``kept``: passed the rules, on a host that stands."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.save(measured(docs), "measured")
    hosts = scratch.save(host_verdicts(rows).select("source", "rate", "host_ok"), "hosts")
    kept = ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))
    return rows.join(hosts, "source", "left").select(*rows.columns, "rate", kept.alias("kept"))

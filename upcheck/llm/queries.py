"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path

from upcheck.llm import bpe, byte_pieces, host_quality, jaccard, langid, merkle, oracles, packing, pii, simhash, substring_dedup, suffix_dedup, toxicity, vector_codes
from upcheck.llm.common import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha256(column):
    return F.sha2(column, 256)


def _removed():
    return F.aggregate("cut", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), _removed().alias("n_removed"), F.size("cut").cast("long").alias("n_spans"), hex_sha256("kept").alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", _removed().alias("n_removed"), hex_sha256(F.col("kept").cast("binary")).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents whose id is divisible by 100, ``n_within``: how many (itself included) are in the radius; ``within``: their fingerprints.

    The documents found are the rows whose ``fingerprint`` is in ``within``.
    """
    scratch = Scratch(spark)
    rows = scratch.save(simhash.fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    index = rows.groupBy("fp").agg(F.count("*").alias("docs"))
    asked = rows.where("doc_id % 100 = 0")
    near = simhash.within(asked, index, simhash.RADIUS).groupBy("fp").agg(F.sum("docs").alias("n_within"), F.collect_list(simhash.hexed(F.col("near"))).alias("near"))
    # lists of fingerprints, which grow with the documents, do not go through the driver
    out = rows.join(near.withColumn("asked", F.lit(True)).hint("merge"), "fp", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", simhash.hexed(F.col("fp")).alias("fingerprint"), simhash.hexed(F.col("edited_fp")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.col("n_within")).alias("n_within"),
        F.when(F.col("doc_id") % 100 == 0, F.array_join(F.array_sort("near"), ",")).alias("within"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = langid.part_of("doc_id", 3)
    model = langid.train(docs.where(fold != 1))
    out = langid.predict(docs, model, ["doc_id"])
    return out.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_quality.judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.train(docs), ["doc_id"])
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
    return out.select("doc_id", *(count(k) for k in pii.KINDS[:4]), hex_sha256(joined(base).cast("binary")).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op8_byte_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")).alias("ids_sha256"),
                      hex_sha256(F.col("decoded").cast("binary")).alias("decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), langid.part_of("doc_id", 5)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold != 0))
    return toxicity.score(docs, model).select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id has no decimal form and is never tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": F.translate("text", CAPITALS, SMALL)}, tampered)
    return out.select("doc_id", "leaf", "subroot", "root", hex_sha256(F.array_join("proof", "").cast("binary")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_byte_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ids = byte_pieces.encode(table(spark, sf_dir, "documents"), path, PATTERN, ["doc_id"])
    out = byte_pieces.decode(ids, path, PATTERN, ["doc_id", "ids"])
    return out.select("doc_id", byte_pieces.count_of().alias("n_tokens"), hex_sha256("ids").alias("ids_sha256"), hex_sha256("decoded").alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", ["vec_id", "label"])
    scratch = Scratch(spark)
    codes = scratch.save(codes, "codes")
    sums = scratch.save(codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "label_errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("same")))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_host_quality": op5_host_quality,
    "op6_personal_data": op6_personal_data,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_byte_pair": op8_byte_pair,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_byte_pieces": op12_byte_pieces,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op2_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op5_host_quality": oracles.HOST_QUALITY,
    "op7_jaccard_join": oracles.JACCARD_JOIN,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op13_vector_codes": oracles.VECTOR_CODES,
}

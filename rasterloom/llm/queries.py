"""The registered queries of this subpackage and, where SQL can state them, their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm import (
    alignment,
    complement,
    decontaminate,
    hilbert,
    jaccard,
    packing,
    personal,
    quality,
    substrings,
    topk,
    toxicity,
    urls,
    whitening,
)
from rasterloom.llm.oracles import ORACLES  # noqa: F401


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name="byte_bpe_50k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_topk(spark, sf_dir):
    vectors = _read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20, scale=64)


def op2_personal_data(spark, sf_dir):
    found = personal.find_personal_data(_read(spark, sf_dir, "documents"))
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, personal.KINDS), F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def op3_packing(spark, sf_dir):
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path()).drop("uid")


def op4_decontamination(spark, sf_dir):
    found = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.pos)")
    return found.select(
        "doc_id", "n_words", F.coalesce(hit, F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("items").isNotNull().alias("contaminated"))


def op5_url_filter(spark, sf_dir):
    return urls.verdicts(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


def op6_substring_dedup(spark, sf_dir):
    return substrings.repeated_passages(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_sharding(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return hilbert.hilbert_shards(docs, ["lang", "source", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op8_quality(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 3 == 1
    labels = _read(spark, sf_dir, "labels").filter(~held_out)
    return quality.quality_scores(docs, labels).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_jaccard_join(spark, sf_dir):
    found = jaccard.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, num=85, den=100)
    names = found.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return found.join(names, "group").select("doc_id", "n_shingles", "component_id")


def op10_toxicity(spark, sf_dir):
    found = toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return found.select("doc_id", "severe", "repeated", F.col("toxic").alias("probability"), (F.col("toxic") >= 0.5).alias("toxic"))


def op11_whitening(spark, sf_dir):
    # Beyond a long, which takes some 100 million distinct vectors, deviation is null here.
    found = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_complements(spark, sf_dir):
    return complement.pack_complements(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).drop("uid")


def op13_alignment(spark, sf_dir):
    return alignment.align(_read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).drop("uid")


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_personal_data, op3_packing, op4_decontamination, op5_url_filter, op6_substring_dedup, op7_sharding, op8_quality, op9_jaccard_join, op10_toxicity,
    op11_whitening, op12_complements, op13_alignment)}

"""A corpus cleaned and packed in stages, each one operator of ``rasterloom.llm``.

Every stage judges each row it is given; columns beside doc_id and text pass through unseen, whatever
their names. An empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm import decontaminate, jaccard, packing, personal, toxicity
from rasterloom.llm.queries import tokenizer_path
from rasterloom.llm.tables import folded, stored, unfolded


def without_toxic(spark, docs, sf_dir):
    """Rows whose probability of the chain's last category is 0.5 or more go. Null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.toxicity(folded(docs), labels, keep=("doc_id", "text", "rest"))
    return unfolded(found.filter(F.col("toxic") < 0.5), docs.columns)


def without_near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies (five-word shingles, similarity 0.8) the row with the least doc_id stays.

    Null ids come last. Of equal rows (id and text) one stays. Texts without words link with nothing and stay.
    """
    key = F.md5("text").alias("key")
    found = jaccard.near_duplicates(docs.select("doc_id", "text", key), shingle=5, num=80, den=100, keep=("doc_id", "key"))
    first = found.groupBy("group").agg(F.min_by(F.struct("doc_id", "key"), F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("x"))
    kept = first.select("x.*").groupBy("doc_id", "key").count().withColumnsRenamed({"doc_id": "own_id", "key": "own_key", "count": "groups"})
    alike = found.groupBy("doc_id", "key").count().filter("count > 1").withColumnsRenamed({"doc_id": "own_id", "key": "own_key"})
    kept = kept.join(alike, kept["own_id"].eqNullSafe(alike["own_id"]) & kept["own_key"].eqNullSafe(alike["own_key"]), "left").select(
        kept["own_id"], kept["own_key"], F.least("groups", F.coalesce("count", F.lit(1))).alias("groups"), F.coalesce("count", F.lit(1)).alias("rows"))
    rows = folded(docs).withColumn("key", key)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["own_id"]) & rows["key"].eqNullSafe(kept["own_key"]))
    # Rows alike in id and text: as many stay as they have groups (one, or all if they have no words).
    single = rows.filter("rows = groups")
    several = rows.filter("rows > groups").dropDuplicates(["doc_id", "key"])
    return unfolded(single.unionByName(several), docs.columns)


def without_benchmark(spark, docs, sf_dir):
    """Rows that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(folded(docs), benchmark, keep=("doc_id", "text", "rest"))
    return unfolded(found.filter("spans is null"), docs.columns)


def without_personal_data(spark, docs, sf_dir):
    """Personal data in the texts is replaced by its kind in brackets. No row goes; n_chars, if there, follows the text."""
    found = personal.find_personal_data(folded(docs), keep=("doc_id", "text", "rest"))
    clean = unfolded(personal.masked(found), docs.columns)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def packed(spark, docs, sf_dir):
    """Sequences of at most 1024 tokens: one row for each piece of a document."""
    return packing.pack(docs, tokenizer_path()).drop("uid")


STAGES = [
    ("toxicity", without_toxic), ("near_duplicates", without_near_duplicates), ("decontamination", without_benchmark),
    ("personal_data", without_personal_data), ("packing", packed),
]

#: Trained models, connected components and tokenizers are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in turn over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

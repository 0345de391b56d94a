"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm.tables import stored


def labelled_sample(docs, labels, columns, rows):
    """Texts of about ``rows`` labelled documents, chosen by a hash of doc_id, with the named label columns.

    Only the chosen ids and labels, at most about ``rows`` of them, are broadcast; the texts are read
    where they lie. A repeated doc_id gives the text of the least hash, so the sample has no more rows
    than labels were chosen. Labels without an id or a value are left out.
    """
    labels = labels.select("doc_id", *columns).dropna()
    # About ``rows`` pass the hash; a hot doc_id may pass often, so a limit keeps the broadcast bounded.
    share = min(1.0, rows / max(1, labels.count()))
    chosen = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).limit(2 * rows)
    chosen = stored(chosen, "chosen")  # read twice; a limit may choose anew each time
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *columns)

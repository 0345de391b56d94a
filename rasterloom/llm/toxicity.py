"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.tables import schema, stored
from rasterloom.llm.training import labelled_sample

#: Hash space of the features before selection, features kept, and labelled documents used for fitting.
SPACE, KEPT, SAMPLE_ROWS = 1 << 20, 2048, 20_000
#: Word beginnings, in bytes, that are features beside the words.
PREFIXES = (4, 5, 6)
FOLDS = 5
#: The chain, in order: how many telling words a toxic document holds at least. The last is the label itself.
CATEGORIES = (("severe", 6), ("repeated", 3), ("toxic", 0))


def features(column):
    """Row and hashed feature of every word and word beginning (letters and digits, A-Z lower-cased)."""
    words = W.Words(column, W.ALNUM)
    raw = W.Runs(words.values[words.data])
    found = [(words.row, W.mix(words.hash, 40))]
    for n in PREFIXES:
        long = np.flatnonzero(words.end - words.start >= n)
        found.append((words.row[long], raw.hashes(words.start[long], words.start[long] + n, 40 + n)))
    row, name = (np.concatenate(x) for x in zip(*found))
    return words.rows, row, (name % W.U64(SPACE)).astype(np.int64)


def _counts(batches):
    """Documents with each feature, by label: one row for each feature seen by the task."""
    held = np.zeros((2, SPACE), np.int64)
    for batch in batches:
        for part in W.slices(batch, "text"):
            rows, row, name = features(part.column("text"))
            label = np.asarray(part.column("toxic").to_numpy(zero_copy_only=False) > 0, np.int64)
            both = np.unique(row * SPACE + name)
            np.add.at(held, (label[both // SPACE], both % SPACE), 1)
    name = np.flatnonzero(held.any(axis=0))
    for low in range(0, len(name), 50_000):
        own = name[low:low + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(held[0, own]), pa.array(held[1, own])], ["name", "clean", "toxic"])


def select(sample):
    """Features that tell toxic from clean best: hashed name and score, the highest first.

    The score is the least log-odds that the counts allow: the estimate less two standard errors.
    Bounded by the hash space when summed, by KEPT when they reach the driver.
    """
    sums = sample.mapInArrow(_counts, "name bigint, clean bigint, toxic bigint").groupBy("name").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    total = sample.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.count(F.lit(1))).first()
    toxic, clean = (total[0] or 0), (total[1] or 0) - (total[0] or 0)
    odds = F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (clean - F.col("c") + 0.5))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5) + 1 / (toxic - F.col("t") + 0.5) + 1 / (clean - F.col("c") + 0.5))
    best = sums.filter("t >= 2").select("name", (odds - 2 * error).alias("weight")).filter("weight > 0").orderBy(F.desc("weight"), "name").limit(KEPT)
    return [r.name for r in best.collect()]


def _lookup(names):
    place = np.full(SPACE, -1, np.int32)
    place[names] = np.arange(len(names), dtype=np.int32)
    return place


def vectors(column, place):
    """Selected features of each row (sorted pairs row, feature, log(1 + occurrences)) and each row's share of telling words."""
    rows, row, name = features(column)
    at = place[name]
    row, at = row[at >= 0], at[at >= 0]
    both, count = np.unique(row * KEPT + at, return_counts=True)
    return rows, both // KEPT, both % KEPT, np.log1p(count), np.bincount(both // KEPT, count, rows).astype(float)


def _examples(place):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows, row, at, value, hits = vectors(part.column("text"), place.value)
                bounds = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.string()), pa.array(part.column("toxic").to_numpy(zero_copy_only=False) > 0),
                    pa.ListArray.from_arrays(bounds, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(value)), pa.array(hits)],
                    ["id", "toxic", "at", "value", "hits"])
    return run


class Linear:
    """Logistic regression on sparse rows and a few dense columns, by damped gradient steps."""

    def __init__(self, dense, steps=300, rate=0.5, l2=1e-5):
        self.w, self.d, self.b = np.zeros(KEPT), np.zeros(dense), 0.0
        self.steps, self.rate, self.l2 = steps, rate, l2

    def logit(self, row, at, value, dense):
        return np.bincount(row, value * self.w[at], len(dense)) + dense @ self.d + self.b

    def probability(self, row, at, value, dense):
        return 1 / (1 + np.exp(-np.clip(self.logit(row, at, value, dense), -35, 35)))

    def fit(self, row, at, value, dense, label):
        share = (label.sum() + 0.5) / (len(label) + 2)
        self.b = float(np.log(share / (1 - share)))
        if label.all() or not label.any():
            return self
        weight = np.where(label, 0.5 / label.sum(), 0.5 / (~label).sum())  # both classes weigh the same
        self.b, past = 0.0, [1e-8, np.full(len(self.d), 1e-8), np.full(KEPT, 1e-8)]
        for _ in range(self.steps):
            error = (self.probability(row, at, value, dense) - label) * weight
            grads = error.sum(), dense.T @ error + self.l2 * self.d, np.bincount(at, value * error[row], KEPT) + self.l2 * self.w
            for i, g in enumerate(grads):
                past[i] = past[i] + g * g
            self.b -= self.rate * grads[0] / np.sqrt(past[0])
            self.d = self.d - self.rate * grads[1] / np.sqrt(past[1])
            self.w = self.w - self.rate * grads[2] / np.sqrt(past[2])
        return self


def fit_chain(fold, row, at, value, hits, toxic):
    """One linear model per category, in order.

    A model reads the text's features and the probabilities of the categories before it. When it is
    fitted, these come from models that have not seen the document (out of fold), so it learns to
    trust them as far as they hold on new texts; when it scores, they come from the models of all rows.
    """
    models, dense = [], np.zeros((len(toxic), 0))
    for _, least in CATEGORIES:
        label = toxic & (hits >= least)
        out = np.zeros(len(label))
        for f in range(FOLDS):
            inside = fold[row] != f
            place = np.cumsum(fold != f) - 1
            model = Linear(dense.shape[1]).fit(place[row[inside]], at[inside], value[inside], dense[fold != f], label[fold != f])
            out[fold == f] = model.probability(row, at, value, dense)[fold == f]
        models.append(Linear(dense.shape[1]).fit(row, at, value, dense, label))
        dense = np.column_stack([dense, out])
    return models


def _score(model, keep):
    def run(batches):
        place, chain = model.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows, row, at, value, hits = vectors(part.column("text"), place)
                dense = np.zeros((rows, 0))
                for m in chain:
                    dense = np.column_stack([dense, m.probability(row, at, value, dense)])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(x) for x in dense.T)], [*keep, *(c for c, _ in CATEGORIES)])
    return run


def toxicity(docs, labels, rows=SAMPLE_ROWS, keep=("doc_id",)):
    """Probability of each category of the chain for each whole text.

    ``docs``: doc_id, text and the columns to ``keep``; ``labels``: doc_id, toxic; others are ignored. The label knows one
    kind of toxicity; the chain's earlier categories grade it by how many telling words, as found in
    the labelled sample, a toxic document holds: severe, then repeated, then toxic.

    Fitted on about ``rows`` labelled documents, chosen by a hash of doc_id; every document is scored.
    Features are words and word beginnings, so endings not seen before are recognised. Null and empty
    texts have no features and are as clean as a text without telling words; repeated rows score
    alike; without toxic labels nothing is toxic.

    Returns the kept columns, severe, repeated, toxic (probabilities).
    """
    spark = docs.sparkSession
    sample = stored(labelled_sample(docs, labels, ["toxic"], rows), "sample")
    place = _lookup(select(sample))
    table = sample.mapInArrow(_examples(spark.sparkContext.broadcast(place)), "id string, toxic boolean, at array<int>, value array<double>, hits double")
    table = table.toArrow().sort_by("id").combine_chunks()
    size = table.column("at").combine_chunks().value_lengths().to_numpy() if table.num_rows else np.zeros(0, np.int64)
    flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0)
    fold = np.array([zlib.crc32(x.encode()) % FOLDS for x in table.column("id").to_pylist()], int)
    toxic = table.column("toxic").to_numpy(zero_copy_only=False).astype(bool) if table.num_rows else np.zeros(0, bool)
    chain = fit_chain(fold, np.repeat(np.arange(len(size)), size), flat("at").astype(np.int64), flat("value").astype(float),
                      table.column("hits").to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0), toxic)
    columns = ", ".join(f"{c} double" for c, _ in CATEGORIES)
    model = spark.sparkContext.broadcast((place, chain))
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_score(model, keep), schema(docs, keep, columns))

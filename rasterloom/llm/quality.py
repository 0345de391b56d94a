"""Quality scores by logistic regression on hashed word n-grams, trained with FTRL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.training import labelled_sample

#: Weights of the model, as a power of two.
WEIGHTS = 1 << 18
SAMPLE_ROWS = 4000


def _shapes(words):
    """What a word looks like: signs, case, digits, length class, and whether it repeats a word before it."""
    upper, lower, digit = (np.append(0, np.cumsum((words.data >= a) & (words.data <= b))) for a, b in (b"AZ", b"az", b"09"))
    of = lambda sums: sums[words.end] - sums[words.start]
    size = words.end - words.start
    first = words.data[words.start].astype(np.int64) if len(words) else np.zeros(0, np.int64)
    sign = (words.data[words.start] < 128) & (of(upper) + of(lower) + of(digit) == 0) if len(words) else np.zeros(0, bool)
    shape = np.minimum(of(upper), 2) + 3 * (of(lower) > 0) + 6 * (of(digit) > 0) + 12 * np.minimum(size // 4, 4)
    shape = np.where(sign, 1000 + first * 2 + (size > 1), shape)
    for back in (1, 2):
        same = np.zeros(len(words), bool)
        same[back:] = (words.hash[back:] == words.hash[:-back]) & (words.row[back:] == words.row[:-back])
        shape = shape + 10_000 * back * same
    return W.mix(shape.astype(W.U64), 21)


def features(column):
    """Sparse rows: bounds, hashed positions and values.

    n-grams of one and two words and of one to three word shapes. A value is the root of the n-gram's
    share of the text, so that long texts weigh no more than short ones.
    """
    words = W.Words(column, W.SIGNED)
    shapes = W.Runs(_shapes(words))
    found = []
    for size, runs, seed in ((1, words.runs, 30), (2, words.runs, 31), (1, shapes, 32), (2, shapes, 33), (3, shapes, 34)):
        at = words.windows(size)
        found.append((words.row[at], (runs.hashes(at, at + size, seed) % W.U64(WEIGHTS)).astype(np.int64)))
    row, place = (np.concatenate(x) for x in zip(*found))
    both, count = np.unique(row * WEIGHTS + place, return_counts=True)
    row, place = both // WEIGHTS, both % WEIGHTS
    total = np.bincount(row, count, words.rows)
    return np.searchsorted(row, np.arange(words.rows + 1)), place, np.sqrt(count / total[row])


def _examples(batches):
    for batch in batches:
        for part in W.slices(batch, "text"):
            at, place, value = features(part.column("text"))
            at = pa.array(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").cast(pa.string()), part.column("quality"), pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(at, pa.array(value.astype(np.float32)))], ["id", "quality", "place", "value"])


def train(places, values, labels, alpha=0.3, beta=1.0, l1=0.01, l2=0.1, passes=3):
    """Follow the regularised leader, coordinate by coordinate (McMahan and others, 2013). Returns weights and bias.

    The bias is kept outside of the weights and is not regularised. With one class only, the weights
    are zero and the bias is the smoothed share of that class.
    """
    positive = float(np.sum(labels))
    bias = np.log((positive + 1) / (len(labels) - positive + 1))
    z, n = np.zeros(WEIGHTS), np.zeros(WEIGHTS)
    if 0 < positive < len(labels):
        rounds, gained, at = np.random.default_rng(7), 0.0, 0
        for _ in range(passes):
            for i in rounds.permutation(len(labels)):
                p, x = places[i], values[i]
                zi, ni = z[p], n[p]
                w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
                error = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35))) - labels[i]
                g = error * x
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
                z[p] = zi + g - step * w
                n[p] = ni + g * g
                gained += error * error
                bias -= 0.1 / (1 + np.sqrt(gained)) * error
                at += 1
    return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0), bias


def _score(model):
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                at, place, value = features(part.column("text"))
                total = np.append(0, np.cumsum(weights[place] * value))
                logit = np.clip(total[at[1:]] - total[at[:-1]] + bias, -35, 35)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-logit)))], ["doc_id", "score"])
    return run


def quality_scores(docs, labels, rows=SAMPLE_ROWS):
    """Probability that each whole text is of label 1.

    ``docs``: doc_id, text; ``labels``: doc_id, quality; other columns are ignored. The model is fitted on
    about ``rows`` labelled documents (a hash of doc_id picks them); everything is scored. Null and
    empty texts have no features and get the model's bias; repeated rows get equal scores; without
    labels every score is one half.

    Returns doc_id, score.
    """
    labels = labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
    sample = labelled_sample(docs, labels, ["quality"], rows).mapInArrow(_examples, "id string, quality double, place array<int>, value array<float>")
    table = sample.toArrow().sort_by("id")
    lists = lambda c: [np.asarray(x.values) for part in table.column(c).chunks for x in part]
    model = train(lists("place"), lists("value"), table.column("quality").to_numpy())
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), f"doc_id {id_type}, score double")

"""Toxicity by a classifier chain: categories are predicted one after the other by linear models, and each model also sees
the probabilities of the categories before it, in training those that other folds' models gave."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import Scratch, ready, rows_out, texts_of

#: The chain's order. The first two are labels; a severe document is a toxic one with three or more of its markers.
CATEGORIES = ("junk", "toxic", "severe")
SEVERE_MARKERS = 3
#: Labelled documents that the models are fitted on (the first by a hash of doc_id), features kept per label, folds.
SAMPLE, FEATURES, FOLDS = 8_000, 96, 5
#: Besides whole words, their beginnings of these lengths are features, since endings vary.
BEGINNINGS = (4, 5, 6)
#: Words whose features a worker remembers.
KNOWN_WORDS = 500_000
WORD = re.compile(r"[^\W\d_]+")
SCORED = pa.schema([("doc_id", pa.int64()), *[(f"p_{c}", pa.float64()) for c in CATEGORIES], ("toxic", pa.bool_())])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def words_of(text):
    return WORD.findall(text.lower())


def features_of(word):
    """The word itself and its beginnings, marked as such."""
    return [word, *[word[:n] + "-" for n in BEGINNINGS if len(word) > n]]


class Features:
    """Rows of numbers for texts: how often each chosen feature occurs (its logarithm), and the text's shape."""

    def __init__(self, chosen):
        self.place, self.known = {f: i for i, f in enumerate(chosen)}, {}

    def rows(self, texts):
        x, known, width = np.zeros((len(texts), len(self.place) + 3)), self.known, len(self.place)
        if len(known) > KNOWN_WORDS:
            known.clear()
        for row, text in zip(x, texts):
            words = words_of(text)
            distinct = set(words)
            for word in distinct.difference(known):
                known[word] = tuple(self.place[f] for f in features_of(word) if f in self.place)
            for at in map(known.__getitem__, words):
                for i in at:
                    row[i] += 1
            n = len(words)
            row[width:] = np.log1p(n) / 8, len(distinct) / max(n, 1), min(len(text) / max(n, 1), 20) / 10
        x[:, :width] = np.log1p(x[:, :width])
        return x


class Linear:
    """Logistic regression by Newton steps with a ridge; a constant where only one class was seen."""

    def __init__(self, x, y, ridge=1.0, steps=12):
        x = np.column_stack([x, np.ones(len(x))])
        self.weights = np.zeros(x.shape[1])
        if len(y) == 0 or y.min() == y.max():
            share = (y.sum() + 0.5) / (len(y) + 1000)
            self.weights[-1] = np.log(share / (1 - share))
            return
        penalty = np.full(x.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = sigmoid(x @ self.weights)
            slope = x.T @ (y - p) - penalty * self.weights
            step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty), slope)
            self.weights += step
            if np.abs(step).max() < 1e-4:
                break

    def predict(self, x):
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


class Chain:
    """Linear models of the categories in order. Columns of `x` are features, of `y` the categories' labels."""

    def __init__(self, x, y, folds):
        self.models, held = [], np.zeros((len(x), 0))
        for j in range(y.shape[1]):
            seen = np.column_stack([x, held])
            out = np.zeros(len(x))
            for fold in np.unique(folds):
                out[folds == fold] = Linear(seen[folds != fold], y[folds != fold, j]).predict(seen[folds == fold])
            self.models.append(Linear(seen, y[:, j]))
            held = np.column_stack([held, out])
        self.held = held

    def predict(self, x):
        held = np.zeros((len(x), 0))
        for model in self.models:
            held = np.column_stack([held, model.predict(np.column_stack([x, held]))])
        return held


def cut_of(p, y):
    """The probability from which on a document counts as toxic: where the held-out F1 is best, half-way to the next."""
    order = np.argsort(-p)
    hits = np.cumsum(y[order])
    if not len(y) or not hits[-1]:
        return 0.5
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    best = int(np.argmax(f1))
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float((p[order[best]] + below) / 2)


def train(docs, labels, sample=SAMPLE, scratch=None):
    """A scorer from a bounded sample of labelled documents. Labels are (doc_id, quality, toxic); a null label counts as
    not toxic or not junk, and of several rows for a document the largest toxic and smallest quality count. Of several
    documents that share a doc_id one is in the sample, the first by a hash of its text."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "toxicity")
    ready(spark)
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
        F.max(F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0))).alias("junk"))
    chosen = flags.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    seen = texts_of(joined, "doc_id", "toxic", "junk").groupBy("doc_id", "toxic", "junk").agg(first)
    seen = scratch.save(seen.select("doc_id", "toxic", "junk", "text"), "samples")
    sums = seen.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.sum("junk").alias("junk")).first()

    def named(batches):
        for batch in batches:
            sets = [list({f for w in set(words_of(t)) for f in features_of(w)}) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["toxic"], batch["junk"], pa.array(sets, pa.list_(pa.string()))],
                                             names=["toxic", "junk", "features"])

    per_feature = seen.mapInArrow(named, "toxic int, junk int, features array<string>").select(
        "toxic", "junk", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.sum("junk").alias("junk")).where("n >= 3")
    per_feature = scratch.save(per_feature, "features")
    markers, vocabulary = [], set()
    for label in ("junk", "toxic"):
        if sums[label] and sums[label] < sums["n"]:
            inside = (F.col(label) + 0.5) / (sums[label] + 1)
            outside = (F.col("n") - F.col(label) + 0.5) / (sums["n"] - sums[label] + 1)
            ranked = per_feature.withColumn("gain", F.col(label) * F.log(inside / outside)).orderBy(F.desc("gain"), "feature")
            vocabulary |= {r["feature"] for r in ranked.limit(FEATURES).collect()}
            if label == "toxic":
                markers = [r["feature"] for r in ranked.where(inside > 20 * outside).limit(FEATURES).collect()]
    features = Features(sorted(vocabulary))

    def measured(batches):
        for batch in batches:
            x = features.rows(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], batch["junk"], pa.array(list(x))],
                                             names=["doc_id", "toxic", "junk", "x"])

    rows = seen.mapInArrow(measured, "doc_id long, toxic int, junk int, x array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(vocabulary) + 3)
    marked = x[:, [features.place[m] for m in markers if m in features.place]] > 0
    toxic, junk = (np.array([r[c] for r in rows], float) for c in ("toxic", "junk"))
    y = np.column_stack([junk, toxic, toxic * (marked.sum(1) >= SEVERE_MARKERS)])
    folds = np.random.default_rng(3).permutation(np.arange(len(rows)) % FOLDS)
    return Scorer(features, Chain(x, y, folds), y[:, 1])


class Scorer:
    """Features, the chain, the probability from which on a document is toxic, and how right held-out verdicts were."""

    def __init__(self, features, chain, truth):
        self.features, self.chain, held = features, chain, chain.held[:, 1]
        self.cut = cut_of(held, truth)
        self.held_out_accuracy = float(((held >= self.cut) == (truth > 0)).mean()) if len(held) else 1.0

    def score(self, texts):
        return self.chain.predict(self.features.rows(texts))


def flag(docs, scorer):
    """Probabilities of all categories and the verdict for each whole text: (doc_id, p_junk, p_toxic, p_severe, toxic).

    Null text counts as empty; repeated and null doc_ids keep their own rows; other columns are ignored; an empty table
    gives no rows. Without labelled documents the probabilities are a small constant and nothing is toxic.
    """

    def scored(batches):
        for batch in batches:
            p = scorer.score(batch["text"].to_pylist())
            yield rows_out(SCORED, [batch["doc_id"].cast(pa.int64()), *p.T, p[:, 1] >= scorer.cut])

    ready(docs.sparkSession)
    return texts_of(docs, "doc_id").mapInArrow(
        scored, "doc_id long, p_junk double, p_toxic double, p_severe double, toxic boolean")


def without_toxic(docs, scorer):
    """The documents that are not toxic, all columns as they were; a null text is not toxic."""
    at = docs.columns.index("text")

    def kept(batches):
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(scorer.score(texts)[:, 1] < scorer.cut))

    ready(docs.sparkSession)
    return docs.mapInArrow(kept, docs.schema)

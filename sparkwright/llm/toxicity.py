"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are used as labels; everything else is
unlabelled text that hides some toxic documents too.  With the class prior
``p`` (the toxic share among labelled rows that may be learnt from), the risk
of a classifier is

    p * loss(positives, 1) + max(0, loss(unlabelled, 0) - p * loss(positives, 0))

The second part estimates the risk on clean text; when a step would push it
below zero (the classifier has begun to memorise positives hidden in the
unlabelled text), the step goes back up on that part instead.

Features are the presence of words and of their first 3 to 6 letters, of which
those are used that are in ``LEAST`` sampled positives or more and mark toxic
text by their densities there and in unlabelled text.  ``BAGS`` linear classifiers are trained
in numpy, one task each, leaving out another part of the sample; a score is their mean
probability.

The sample is bounded: about ``POSITIVES`` confirmed documents and
``UNLABELLED`` others, drawn by a hash of the id.  The vocabulary is at most
``VOCABULARY`` features.  Everything is scored: whole texts, in place.

Defined results: a null text counts as empty and gets a score like any text;
null labels and ids teach nothing; of several labels of an id the largest
counts; without any confirmed toxic document all scores are 0; repeated rows
stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import _is_letter, teaching
from .storage import make_importable, settle

#: Bounds on the sample and the vocabulary.
POSITIVES, UNLABELLED, VOCABULARY, LEAST, BAGS = 6000, 18000, 4096, 4, 4
PREFIXES, LONGEST = (3, 4, 5, 6), 12
#: Share of a feature's documents that must be toxic, by its density among
#: positives and in unlabelled text.
PURE = 0.5
_RNG = np.random.default_rng(7)
_STEP = _RNG.integers(0, 1 << 63, LONGEST, "u8") * np.uint64(2) + np.uint64(1)
_SIZES = np.arange(max(PREFIXES) + 1, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts, and the text each is from (repeats are
    left in).  A word's hash is of its first letters and its length."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((" ".join(lowered) + " " * (LONGEST + 1)).encode("utf-32-le"), "u4").astype("u8")
    letter = _is_letter()[codes]
    before = np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(letter & ~before)
    stops = np.flatnonzero(~letter & before)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    doc = np.searchsorted(ends, starts, side="right")
    size = stops - starts
    total = np.zeros(len(starts), "u8")
    out, whose = [], []
    for k in range(LONGEST):
        inside = size > k
        total = total + np.where(inside, codes[starts + k], 0) * _STEP[k]
        if k + 1 in PREFIXES:
            longer = size > k + 1
            out.append(total[longer] ^ _SIZES[k + 1])
            whose.append(doc[longer])
    out.append(total ^ ((size + 16).astype("u8") * _SIZES[1]))
    whose.append(doc)
    mixed = np.concatenate(out)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32)), np.concatenate(whose)


def known_features(texts: list[str], vocabulary: np.ndarray) -> list[np.ndarray]:
    """Per text the sorted places of its features in the sorted vocabulary."""
    found, doc = features(texts)
    at = np.searchsorted(vocabulary, found)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == found if len(vocabulary) else np.zeros(len(found), bool)
    pairs = np.unique(doc[hit] * (len(vocabulary) + 1) + at[hit])
    doc, at = np.divmod(pairs, len(vocabulary) + 1)
    return np.split(at.astype("i4"), np.searchsorted(doc, np.arange(1, len(texts))))


# -- the sample -------------------------------------------------------------


def _drawn(doc_id: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))


def draw_sample(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """``doc_id, text, positive`` of the bounded sample, and the class prior."""
    make_importable(documents.sparkSession)
    known = teaching(labels).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("int")), F.lit(0))).first()
    if not toxic:
        return documents.select("doc_id", "text").limit(0), 0.0
    confirmed = known.where("toxic = 1").where(_drawn(F.col("doc_id"), min(1.0, POSITIVES / toxic)))
    usable = teaching(documents).select("doc_id", "text")
    share = min(1.0, UNLABELLED / max(1, usable.count()))
    marks = confirmed.select(F.col("doc_id").alias("_id"))  # about POSITIVES ids
    rows = usable.join(F.broadcast(marks), F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("_id").isNotNull().alias("positive"))
    unlabelled = _drawn(F.concat(F.lit("u"), F.col("doc_id").cast("string")), share)
    return settle(rows.withColumn("unlabelled", unlabelled).where("positive OR unlabelled")), toxic / n


def choose_vocabulary(sample: DataFrame, prior: float) -> np.ndarray:
    """Sorted hashes of the features of which ``PURE`` of the documents or more
    are toxic, by Bayes' rule from the two densities; the most frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k in range(0, len(table), 256):
                part = table.slice(k, 256)
                found, doc = features(part["text"].to_pylist())
                each = np.unique(np.stack([found, doc.astype("u8")], 1), axis=0)
                positive = part["positive"].to_numpy().astype("i8")[each[:, 1].astype("i8")]
                other = part["unlabelled"].to_numpy().astype("i8")[each[:, 1].astype("i8")]
                keys, where = np.unique(each[:, 0], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view("i8")),
                        pa.array(np.bincount(where, positive).astype("i8")),
                        pa.array(np.bincount(where, other).astype("i8")),
                    ],
                    ["feature", "p", "u"],
                )

    counts = sample.mapInArrow(count, "feature long, p long, u long").groupBy("feature")
    counts = counts.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where(F.col("p") >= LEAST)
    sizes = sample.agg(F.sum(F.col("positive").cast("long")), F.sum(F.col("unlabelled").cast("long"))).first()
    density = (F.col("p") / max(1, sizes[0] or 0)) / ((F.col("u") + 1) / max(1, sizes[1] or 0))
    ranked = counts.where(density * prior >= PURE).orderBy(F.desc("p"), "feature").limit(VOCABULARY)
    return np.sort(np.array([r.feature for r in ranked.select("feature").collect()], "i8").view("u8"))


# -- the classifiers --------------------------------------------------------


class Rows:
    """Sparse 0/1 rows of features."""

    def __init__(self, places: list, width: int):
        self.n, self.width = len(places), width
        self.row = np.repeat(np.arange(self.n), [len(p) for p in places])
        self.at = np.concatenate([np.asarray(p, "i8") for p in places]) if self.n else np.zeros(0, "i8")

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at], self.n) + weights[-1]

    def risk(self, margins: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean logistic loss for a label of this sign, and its gradient."""
        slope = -sign / (1 + np.exp(np.clip(sign * margins, -50, 50)))
        gradient = np.append(np.bincount(self.at, slope[self.row], self.width), slope.sum())
        return float(np.logaddexp(0, -sign * margins).mean()), gradient / self.n


def train(positive: Rows, unlabelled: Rows, prior: float, rounds: int = 300, shrink: float = 3e-4) -> np.ndarray:
    """Weights and bias (last) of a linear classifier, by full-batch Adam on
    the non-negative risk."""
    weights = np.zeros(positive.width + 1)
    weights[-1] = -2.0
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        margins = positive.margins(weights)
        _, toward = positive.risk(margins, 1.0)
        lost, away = positive.risk(margins, -1.0)
        seen, rest = unlabelled.risk(unlabelled.margins(weights), -1.0)
        clean = seen - prior * lost
        gradient = prior * toward + (rest - prior * away) if clean >= 0 else prior * away - rest
        gradient[:-1] += shrink * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(sample: DataFrame, vocabulary: np.ndarray, prior: float) -> np.ndarray:
    """``BAGS`` rows of weights, each trained in a task of its own."""
    width = len(vocabulary)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = known_features(part.column(3).to_pylist(), vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([x.tolist() for x in found], pa.list_(pa.int32()))],
                    ["bag", "positive", "unlabelled", "places"],
                )

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        positive, other = rows[rows.positive], rows[rows.unlabelled]
        if not len(positive) or not len(other):
            return pd.DataFrame({"bag": [], "weights": []})
        weights = train(Rows(list(positive.places), width), Rows(list(other.places), width), prior)
        return pd.DataFrame({"bag": [int(rows.bag.iloc[0])], "weights": [weights.tolist()]})

    out_of = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(BAGS)).cast("int").alias("bag")
    rows = sample.select(out_of, "positive", "unlabelled", "text").mapInArrow(
        places, "bag int, positive boolean, unlabelled boolean, places array<int>"
    )
    others = F.explode(F.filter(F.array(*map(F.lit, range(BAGS))), lambda k: k != F.col("bag")))
    bags = rows.withColumn("bag", others).groupBy("bag").applyInPandas(one, "bag int, weights array<double>")
    return np.array([r.weights for r in bags.orderBy("bag").collect()]).reshape(-1, width + 1)


def score(documents: DataFrame, vocabulary: np.ndarray, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    make_importable(documents.sparkSession)
    slopes, bias = weights[:, :-1], weights[:, -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                if len(weights):
                    found = known_features([t or "" for t in part.column(1).to_pylist()], vocabulary)
                    margins = np.array([slopes[:, x].sum(axis=1) + bias for x in found])
                    scores = (1 / (1 + np.exp(-np.clip(margins, -50, 50)))).mean(axis=1)
                else:
                    scores = np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Learn and score: ``doc_id, score, predicted``."""
    sample, prior = draw_sample(documents, labels)
    vocabulary = choose_vocabulary(sample, prior) if prior else np.zeros(0, "u8")
    weights = fit(sample, vocabulary, prior) if len(vocabulary) else np.zeros((0, 1))
    scored = score(documents, vocabulary, weights)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Toxicity scores from a factorization machine over hashed terms.

score = w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, with x_i = 1 if a text
holds a term that hashes to i. The pair term learns what additive weights miss,
such as an insult next to a group's mention. Terms are runs of letters and digits,
case folded, in 2 ** BITS hashes.

Features are chosen in two rounds, by the gradient that their weight has while it
is 0, in standard errors. First terms: those linked to the label by themselves, from
TERM_Z on. Then pairs: what additive weights of those terms leave is added up for
every pair of terms that share a text, in a hashed table and then exactly for the
bins that stand out; both terms of a pair from PAIR_Z on are features, though neither
may have a link alone. The machine is trained on all of them, without a limit to
their number.

Training reads a bounded sample of labelled rows, TRAIN_ROWS with the smallest
hash of doc_id, as hashes of whole texts, and of it for pairs the rows of at most
PAIR_TERMS distinct terms that occur PAIR_SEEN times. Scoring reads every whole text.

A null or empty text has no term: its score is that of the bias. Repeated rows
score alike; of the texts of one doc_id one is learnt, the same in every run. Rows
with a null label or id aren't learnt from; if one class is missing every score is
the bias'. An empty table gives an empty table. Other columns, whatever their names,
aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.spans import NOT_ALNUM, runs, text_buffer, words

BITS = 20
TRAIN_ROWS, FACTORS, EPOCHS = 8000, 4, 30
TERM_Z, PAIR_Z = 3.5, 6.0
PAIR_SEEN, PAIR_TERMS, PAIR_BITS = 12, 1024, 22
THRESHOLD = 0.3


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) pairs of a buffer, distinct and sorted."""
    hashes, first = words(data, offsets, NOT_ALNUM)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(first))
    both = np.unique(text << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return both >> BITS, both & (1 << BITS) - 1


@dataclass
class Model:
    """``place`` maps a term to its feature, -1 if it has none."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, text: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Margins of n texts from sorted (text, feature) pairs."""
        out = self.bias + np.bincount(text, self.weights[feature], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[feature, f]
            out += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, term = _terms(data, offsets)
        feature = self.place[term]
        has = feature >= 0
        return 1 / (1 + np.exp(-np.clip(self.raw(text[has], feature[has], len(offsets) - 1), -30, 30)))


def _train(lists: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, factors: int, epochs: int, seed: int) -> Model:
    """Weights of the ``chosen`` terms by minibatches with per-weight steps."""
    n, rng, features = len(lists), np.random.default_rng(seed), max(len(chosen), 1)
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rate = (y.sum() + 0.5) / (n + 1)
    model = Model(place, float(np.log(rate / (1 - rate))), np.zeros(features), rng.normal(0, 0.02, (features, factors)))
    text, term = np.repeat(np.arange(n), [len(x) for x in lists]), np.concatenate(lists)
    has = place[term] >= 0
    text, feature = text[has], place[term[has]]
    first = np.searchsorted(text, np.arange(n + 1))
    g_w, g_v, g_b = np.full(features, 1e-8), np.full((features, factors), 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            rows = order[a : a + 256]
            size = first[rows + 1] - first[rows]
            at = np.repeat(first[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            local, f = np.repeat(np.arange(len(rows)), size), feature[at]
            error = 1 / (1 + np.exp(-np.clip(model.raw(local, f, len(rows)), -30, 30))) - y[rows]
            d_b = error.mean()
            d_w = np.bincount(f, error[local], features) / len(rows) + 1e-6 * model.weights
            g_b, g_w = g_b + d_b**2, g_w + d_w**2
            if factors:
                sums = np.stack([np.bincount(local, model.factors[f, c], len(rows)) for c in range(factors)], 1)
                part = error[local, None] * (sums[local] - model.factors[f])
                d_v = np.stack([np.bincount(f, part[:, c], features) for c in range(factors)], 1) / len(rows) + 1e-4 * model.factors
                g_v += d_v**2
                model.factors -= 0.02 * d_v / np.sqrt(g_v)
            model.bias -= 0.1 * d_b / np.sqrt(g_b)
            model.weights -= 0.1 * d_w / np.sqrt(g_w)
    return model


def linked_pairs(lists: list[np.ndarray], error: np.ndarray, spread: np.ndarray, seen: np.ndarray, least: float = PAIR_Z) -> np.ndarray:
    """Terms of the pairs whose weight would have a gradient of ``least`` standard errors.

    ``error``: label less score of each text; ``spread``: its variance; ``seen``: texts of each term.
    A pair's place in the table is one random number of its first term, exclusive or another of its second.
    """
    kept = [t[seen[t] >= PAIR_SEEN] for t in lists]
    rows = [i for i, t in enumerate(kept) if 2 <= len(t) <= PAIR_TERMS]
    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 1 << PAIR_BITS, 1 << BITS, dtype=np.int32) for _ in range(2))
    above = np.triu(np.ones((PAIR_TERMS, PAIR_TERMS), bool), 1)
    places = lambda t: one[t][:, None] ^ two[t][None, :]
    total, var = np.zeros(1 << PAIR_BITS), np.zeros(1 << PAIR_BITS)
    held: list[tuple[int, np.ndarray]] = []
    for k, row in enumerate(rows):
        t = kept[row]
        held.append((row, places(t)[above[: len(t), : len(t)]]))
        if sum(len(x) for _, x in held) > 1 << 23 or k == len(rows) - 1:
            of, n, at = np.array([r for r, _ in held]), [len(x) for _, x in held], np.concatenate([x for _, x in held])
            total += np.bincount(at, np.repeat(error[of], n), 1 << PAIR_BITS)
            var += np.bincount(at, np.repeat(spread[of], n), 1 << PAIR_BITS)
            held = []
    # A place's other pairs add their noise: places are let in at half the bar, pairs in them counted exactly.
    open_ = np.abs(total) >= least / 2 * np.sqrt(np.maximum(var, 1e-9))
    of_, keys = [], []
    for row in rows:
        t = kept[row]
        i, j = np.nonzero(open_[places(t)] & above[: len(t), : len(t)])
        of_.append(np.full(len(i), row))
        keys.append(t[i] << BITS | t[j])
    if not rows or not len(key := np.concatenate(keys)):
        return np.zeros(0, np.int64)
    row = np.concatenate(of_)
    pairs, back, n = np.unique(key, return_inverse=True, return_counts=True)
    z = np.bincount(back, error[row]) / np.sqrt(np.maximum(np.bincount(back, spread[row]), 1e-9))
    good = pairs[(np.abs(z) >= least) & (n >= PAIR_SEEN)]
    return np.unique(np.concatenate([good >> BITS, good & (1 << BITS) - 1]))


def fit(lists: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Learn from each text's distinct terms."""
    n, y = len(lists), labels.astype(np.float64)
    rate = (y.sum() + 0.5) / (n + 1)
    if n == 0 or y.min() == y.max():
        return Model(np.full(1 << BITS, -1, np.int32), float(np.log(rate / (1 - rate))), np.zeros(1), np.zeros((1, factors)))
    text, term = np.repeat(np.arange(n), [len(x) for x in lists]), np.concatenate(lists)
    seen, hits = np.bincount(term, minlength=1 << BITS), np.bincount(term, y[text], 1 << BITS)
    z = np.where(seen >= 3, (hits - rate * seen) / np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9)), 0)
    chosen = np.flatnonzero(np.abs(z) >= TERM_Z)
    additive = _train(lists, y, chosen, 0, epochs, seed)
    feature = additive.place[term]
    has = feature >= 0
    p = 1 / (1 + np.exp(-np.clip(additive.raw(text[has], feature[has], n), -30, 30)))
    # Fitted scores are surer than they should be; a floor keeps single errors from standing out.
    pairs = linked_pairs(lists, y - p, np.maximum(p * (1 - p), 0.02), seen)
    return _train(lists, y, np.union1d(chosen, pairs).astype(np.int64), factors, epochs, seed)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled texts outside the held-out quarter."""
    known = labels.select(labels[f"`{doc_id}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("y"))
    known = known.where("id IS NOT NULL AND y IS NOT NULL").where(~held_out(F.col("id")))
    sample = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    pairs = sample.collect()  # at most ``rows`` ids, a stated bound
    sample = F.broadcast(docs.sparkSession.createDataFrame(pairs, sample.schema))
    texts = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("text")).join(sample, "id").select("id", "y", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_buffer(batch.column(2))
            found = []
            for a, b in runs(at):
                t, term = _terms(data[at[a] : at[b]], at[a : b + 1] - at[a])
                cut = np.searchsorted(t, np.arange(b - a + 1))
                found += [term[i:j].astype("<u4").tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "y", "terms"])

    kind = texts.schema["id"].dataType.simpleString()
    # One text of each id, so that no more than ``rows`` reach the driver however often ids repeat.
    got = texts.mapInArrow(read, f"id {kind}, y int, terms binary").groupBy("id", "y").agg(F.min("terms").alias("terms")).toPandas().sort_values("id")
    return fit([np.frombuffer(x, "<u4").astype(np.int64) for x in got["terms"]], got["y"].to_numpy(np.int64))


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    slim = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_buffer(batch.column(1))
            scores = [shared.value.scores(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in runs(at, 4 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], ["doc_id", "score"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    out = slim.mapInArrow(score, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

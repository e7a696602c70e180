"""Language prediction by sparse multinomial logistic regression on character n-grams.

Features are TF-IDF of hashed n-grams of 1 to 3 characters within lower-case
words, an n-gram's frequency being its share of the text's. Weights are learnt
by follow-the-regularised-leader with an elastic net: a weight stays exactly 0
until its evidence exceeds L1. A temperature, fitted on a part of the sample
that the weights haven't seen, calibrates the probabilities.

Training reads a bounded sample, TRAIN_ROWS with the smallest hash of doc_id, of
texts with a language; prediction reads every whole text.

A null text or one without a letter is ``und`` with score 1. Ties go to the
language first in order. If no language is known, all is ``und``. Repeated rows
are predicted alike; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.spans import mix, runs, text_buffer
from quire.llm.toxicity import held_out

BITS, ORDERS = 16, (1, 2, 3)
TRAIN_ROWS, EPOCHS = 3000, 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-5
SCALE = 20.0
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and its lower case."""
    letters, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            letters[c] = True
            if len(small := chr(c).lower()) == 1:
                lower[c] = ord(small)
    return letters, lower


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, one after the other, and where each text's begin and end."""
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    whole = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    letters, lower = _letters()
    letter = letters[whole]
    # A word boundary is one sign, whatever it is, and runs of non-letters are one boundary.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    code = np.where(letter, lower[whole], 0).astype(np.uint64)[keep]
    of = of[keep]
    out, owner = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            h = h[:-1]
        h = (h * np.uint64(0x100000001B3)) ^ code[n - 1 :] if n == 1 else (h * np.uint64(0x9E3779B97F4A7C15)) + code[n - 1 :]
        if n in ORDERS and len(h):
            same = of[: len(h)] == of[n - 1 :]
            out.append((mix(h[same] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32))
            owner.append(of[: len(h)][same])
    if not out:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    gram, owner_ = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner_, kind="stable")
    return gram[order], np.searchsorted(owner_[order], np.arange(len(texts) + 1))


@dataclass
class Model:
    """``table``: (idf * weight) of each gram and language, so that a text's margin is the mean of its grams' rows."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages, whether the text has a letter)."""
        gram, at = _grams(texts)
        n = np.diff(at)
        sums = np.zeros((len(texts), len(self.languages)))
        has = n > 0
        if has.any():
            for c in range(len(self.languages)):
                sums[has, c] = np.add.reduceat(self.table[c][gram], at[:-1][has], dtype=np.float64)
        z = (SCALE * sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True)) if len(self.languages) else z
        return p / p.sum(1, keepdims=True) if len(self.languages) else p, has


def fit(grams: list[np.ndarray], counts: list[np.ndarray], labels: list[str], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Learn from each text's distinct grams and how often it has them."""
    languages = sorted(set(labels))
    k, size = len(languages), 1 << BITS
    if k == 0:
        return Model([], np.zeros((0, size), np.float32), np.zeros(0), 1.0)
    y = np.searchsorted(languages, labels)
    seen = np.bincount(np.concatenate(grams), minlength=size) if grams else np.zeros(size)
    idf = np.log((1 + len(grams)) / (1 + seen)) + 1
    rows = [(g, SCALE * c / c.sum() * idf[g]) for g, c in zip(grams, counts, strict=True)]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, order = order[: len(order) // 5], order[len(order) // 5 :]
    z, n, w = np.zeros((size + 1, k)), np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def margin(i: int) -> np.ndarray:
        g, x = rows[i]
        return x @ w[g] + w[size]

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, L1)[:, None]
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for i in rng.permutation(order):
            g, x = rows[i]
            at, value = np.append(g, size), np.append(x, 1.0)
            w[at] = weights(at)
            m = margin(i)
            p = np.exp(m - m.max())
            p /= p.sum()
            p[y[i]] -= 1
            d = value[:, None] * p[None, :]
            z[at] += d - (np.sqrt(n[at] + d * d) - np.sqrt(n[at])) / ALPHA * w[at]
            n[at] += d * d
    w[:] = weights(np.arange(size + 1))
    margins = np.array([margin(i) for i in aside]).reshape(-1, k)

    def loss(t: float) -> float:
        m = margins / t
        m = m - m.max(1, keepdims=True)
        return float((np.log(np.exp(m).sum(1)) - m[np.arange(len(m)), y[aside]]).mean())

    temperature = min((float(t) for t in np.geomspace(0.1, 10, 61)), key=loss) if len(aside) else 1.0
    return Model(languages, np.ascontiguousarray((w[:size] * idf[:, None]).T.astype(np.float32)), w[size].copy(), temperature)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` texts with a language outside the held-out quarter."""
    slim = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("text"), docs[f"`{lang}`"].alias("lang"))
    slim = slim.where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("id")))
    ids = slim.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(rows)
    ids = docs.sparkSession.createDataFrame(ids.collect(), ids.schema)  # a stated bound
    sample = slim.join(F.broadcast(ids), "id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, at = _grams(batch.column(1).to_pylist())
            found = [np.unique(gram[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
            lists = [pa.array([x.astype("<u4").tobytes() for x in column], pa.binary()) for column in (zip(*found, strict=True) if found else ([], []))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], ["id", "lang", "grams", "counts"])

    kind = sample.schema["id"].dataType.simpleString()
    # One text of each id, the same in every run.
    one = F.min(F.struct("lang", "grams", "counts")).alias("one")
    got = sample.mapInArrow(read, f"id {kind}, lang string, grams binary, counts binary").groupBy("id").agg(one).select("id", "one.*").toPandas().sort_values("id")
    got = got[got["grams"].str.len() > 0]
    of = lambda c: [np.frombuffer(x, "<u4").astype(np.int64) for x in got[c]]
    return fit(of("grams"), of("counts"), got["lang"].tolist())


def languages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    slim = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            _, at = text_buffer(batch.column(1))
            best, score = [], []
            for a, b in runs(at):
                p, has = model.probabilities(batch.column(1).slice(a, b - a).to_pylist())
                known = has & (len(model.languages) > 0)
                top = p.argmax(1) if len(model.languages) else np.zeros(b - a, np.int64)
                best.append(np.where(known, top, len(names) - 1))
                score.append(np.where(known, p[np.arange(b - a), top] if len(model.languages) else 1.0, 1.0))
            picked = names[np.concatenate([np.zeros(0, np.int64), *best])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(picked, pa.string()), pa.array(np.concatenate([np.zeros(0), *score]))], ["doc_id", "lang_pred", "score"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    out = slim.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

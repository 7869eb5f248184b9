"""Language identification with error-correcting output codes.

Every language has a codeword; for each bit a binary classifier (logistic
regression on hashed character n-grams) predicts whether a text's language has
it. Decoding sums each language's logistic losses over the bits, weighted by
the bits' accuracy, and takes the smallest; ``score`` is its share among the
languages (softmax of the negative losses), and ``ambiguous`` marks texts whose
best two languages are closer than ``MARGIN``.

The classifiers are fitted on a bounded sample: about ``SAMPLE`` documents of
each language, taken by a hash of their ids, with whole texts. Only their
n-gram counts reach the driver. Predictions read whole texts and shuffle
nothing.

Edge cases. Null texts and texts without a letter are ``und`` with score 0, as
are all texts if nothing can be learned. Null languages are not learned. One
known language is predicted for all. Rows with a null doc_id are never held
out, and are not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import fold, prepare, saved

FOLDS, HELD = 4, 2
SAMPLE = 500
BITS = 12  # of the n-gram hash
GRAMS = 3
STEPS, STEP, DECAY = 150, 2.0, 1e-4
EXHAUSTIVE = 6  # languages up to which all distinct splits are used
RANDOM_BITS = 63
MARGIN = 0.1
MAX_LANGUAGES = 2_000

_LETTER = re.compile(r"[^\W\d_]")


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1- to ``GRAMS``-grams of the lower-cased characters."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    out = np.zeros(1 << BITS, np.int64)
    key = np.zeros(len(points), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(points) < n:
            break
        key = key[:len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
        out += np.bincount((key * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return out


def vector(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares: a unit vector."""
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """A matrix of -1 and 1 (languages x bits) with distinct rows and no constant column."""
    if languages <= EXHAUSTIVE:
        bits = [[(split >> i) & 1 for i in range(languages)] for split in range(1, 1 << max(0, languages - 1))]
        return np.array(bits, np.float32).T.reshape(languages, len(bits)) * 2 - 1
    rng = np.random.default_rng(7)
    while True:
        code = rng.integers(0, 2, (languages, max(RANDOM_BITS, 6 * languages.bit_length()))).astype(np.float32) * 2 - 1
        if len(np.unique(code, axis=0)) == languages and (np.abs(code.sum(axis=0)) < languages).all():
            return code


def train(vectors: np.ndarray, labels: np.ndarray, languages: int) -> dict:
    code = codewords(languages)
    target = (code[labels] + 1) / 2
    weight = 1 / np.bincount(labels, minlength=languages)[labels]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    w, bias = np.zeros((vectors.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    velocity = np.zeros_like(w)
    for _ in range(STEPS):
        error = (target - 1 / (1 + np.exp(-(vectors @ w + bias)))) * weight
        velocity = 0.9 * velocity + STEP * (vectors.T @ error * 10 - DECAY * w)
        w += velocity
        bias += STEP * error.sum(axis=0)
    right = (((vectors @ w + bias) > 0) == (target > 0.5)) * weight
    return {"code": code, "w": w, "bias": bias, "bit_weight": np.maximum(right.sum(axis=0) - 0.5, 0.01)}


def decode(margins: np.ndarray, model: dict) -> tuple[int, float, float]:
    """Best language, its share, and its lead over the next."""
    loss = (np.logaddexp(0, -model["code"] * margins) * model["bit_weight"]).sum(axis=1)
    p = np.exp(loss.min() - loss)
    p /= p.sum()
    best = int(p.argmax())
    rest = np.delete(p, best)
    return best, float(p[best]), float(p[best] - (rest.max() if len(rest) else 0))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [np.minimum(gram_counts(t), 0xFFFFFFFF).astype(np.uint32).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.binary())], ["lang", "counts"])


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    names, fitted = model.value
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            if not names or not text or not _LETTER.search(text):
                rows.append(("und", 0.0, True))
            elif len(names) == 1:
                rows.append((names[0], 1.0, False))
            else:
                best, p, lead = decode(vector(gram_counts(text)) @ fitted["w"] + fitted["bias"], fitted)
                rows.append((names[best], p, lead < MARGIN))
        pred, score, unsure = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
            ["doc_id", "lang_pred", "score", "ambiguous"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], dict | None]:
    """Languages and classifiers learned from the rows of ``docs`` outside the held-out fold."""
    known = docs.where("text is not null and lang is not null and doc_id is not null").where(
        fold(F.col("doc_id"), FOLDS) != HELD)
    count = saved(known.groupBy("lang").agg(F.count("*").alias("n")))
    if count.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    taken = known.join(F.broadcast(count), "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) <= F.lit(1_000_003.0) * sample / F.col("n"))
    rows = taken.select("lang", "text").mapInArrow(_features, "lang string, counts binary").collect()
    names = sorted({r["lang"] for r in rows})
    if len(names) < 2:
        return names, None
    rows.sort(key=lambda r: (r["lang"], bytes(r["counts"])))
    vectors = np.stack([vector(np.frombuffer(r["counts"], np.uint32).astype(np.int64)) for r in rows])
    return names, train(vectors, np.array([names.index(r["lang"]) for r in rows]), len(names))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous per row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(fit(docs, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        partial(_predict, model=model), f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "ambiguous")

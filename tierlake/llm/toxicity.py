"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Texts are lower-cased, freed of accents, and homoglyphs and digit substitutions
are folded to Latin letters. The lexicon holds the folded words that are much
more frequent in labelled toxic documents than in others; a word's weight is
its smoothed log odds ratio. Exception phrases are word pairs with a lexicon
word that labelled harmless documents have and toxic ones do not; inside them
the word does not count. The matched weight, by itself and per word of the
text, goes through a logistic curve fitted on the same labelled rows.

The labelled rows are a bounded sample of about ``SAMPLE`` ids, taken by hash
outside the held-out fold, and their texts are written once; the lexicon is at most
``MAX_TERMS`` words (those whose odds are surest) and as many exception phrases (the most
frequent). Scores read whole texts and shuffle nothing.

Edge cases. Null and empty texts get the curve's value for no match. Rows with
null labels or ids are not learned from; an id labelled twice with different
values counts as toxic if one of them is. Without labels every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import fold, prepare, saved, stored

FOLDS, HELD = 5, 0
SAMPLE = 40_000
MAX_TERMS = 5_000
MIN_DOCS = 4
MIN_WEIGHT, MIN_Z = 1.5, 4.0
MIN_EXCEPTION = 3
PSEUDO_WORDS = 50

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = dict(zip("авеёікмнорстухѕјһԁԛԝαβεικνορτυχω", "abeeikmhopctyxsjhdqwabeikvoptuxw"))
SUBSTITUTES = dict(zip("013457@$", "oieastas"))
_FOLD = str.maketrans(HOMOGLYPHS | SUBSTITUTES)
_WORD = re.compile(r"[^\W_]+")


def folded_words(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return _WORD.findall(text.translate(_FOLD))


def automaton(lexicon: dict[str, float], exceptions: list[str]) -> ahocorasick.Automaton | None:
    """Matches whole words of the text `` word word `` (one space around each word)."""
    a = ahocorasick.Automaton()
    for word, weight in lexicon.items():
        a.add_word(f" {word} ", (len(word) + 1, weight))
    for phrase in exceptions:
        a.add_word(f" {phrase} ", (len(phrase) + 1, None))
    if not len(a):
        return None
    a.make_automaton()
    return a


def matched(words: list[str], a: ahocorasick.Automaton | None) -> tuple[float, int]:
    """Total weight of the lexicon words outside of exception phrases, and the number of words."""
    if a is None or not words:
        return 0.0, len(words)
    hits, safe = [], []
    for end, (length, weight) in a.iter(f" {' '.join(words)} "):
        (safe if weight is None else hits).append((end - length, end, weight))
    # One sweep by start: a word is inside a phrase if the phrases begun so far reach to its end.
    hits.sort()
    safe.sort(key=lambda span: span[:2])
    total, reach, at = 0.0, -1, 0
    for start, end, weight in hits:
        while at < len(safe) and safe[at][0] <= start:
            reach = max(reach, safe[at][1])
            at += 1
        if end > reach:
            total += weight
    return total, len(words)


def features(total: float, n: int) -> tuple[float, float, float]:
    return 1.0, math.log1p(total), 100 * total / (n + PSEUDO_WORDS)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [folded_words(t) for t in batch.column(1).to_pylist()]
        terms = [sorted(set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])}) for w in words]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["toxic", "terms"])


def _weights(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    a = automaton(*model.value[:2])
    for batch in batches:
        rows = [matched(folded_words(t), a) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.float64()),
                                          pa.array([r[1] for r in rows], pa.int64())], ["key", "total", "n"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], list[str], list[float] | None]:
    """Lexicon, exception phrases and the curve's coefficients, from labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    marked = labels.where("toxic is not null and doc_id is not null").where(fold(F.col("doc_id"), FOLDS) != HELD).groupBy(
        F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = marked.count()
    share = min(1.0, sample / max(1, n))
    marked = saved(marked.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_003)) < 1_000_003 * share))
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(
        F.broadcast(marked), "label_id").select("toxic", "text"))
    total = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    good, bad = total.get(0, 0), total.get(1, 0)
    if not good or not bad:
        return {}, [], None
    counts = texts.mapInArrow(_terms, "toxic int, terms array<string>").select("toxic", F.explode("terms").alias("term")).groupBy(
        "term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counts = saved(counts.where(f"good + bad >= {min(MIN_DOCS, MIN_EXCEPTION)}"))
    odds = F.log((F.col("bad") + 0.5) / (bad - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (good - F.col("good") + 0.5))
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    words = counts.where(f"instr(term, ' ') = 0 and good + bad >= {MIN_DOCS}").withColumn("weight", odds)
    words = words.where((F.col("weight") >= MIN_WEIGHT) & (odds / spread >= MIN_Z)).orderBy(
        (odds / spread).desc(), "term").limit(MAX_TERMS)
    lexicon = {r["term"]: r["weight"] for r in words.select("term", "weight").collect()}
    pairs = counts.where(f"instr(term, ' ') > 0 and bad = 0 and good >= {MIN_EXCEPTION}").where(
        F.split("term", " ")[0].isin(list(lexicon)) | F.split("term", " ")[1].isin(list(lexicon))) if lexicon else None
    exceptions = sorted(r["term"] for r in pairs.orderBy(F.desc("good"), "term").limit(MAX_TERMS).select("term").collect()) if lexicon else []
    model = spark.sparkContext.broadcast((lexicon, exceptions))
    rows = texts.mapInArrow(partial(_weights, model=model), "toxic int, total double, n long").collect()
    x = np.array([features(r["total"], r["n"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    order = np.lexsort((y, *x.T))
    return lexicon, exceptions, logistic(x[order], y[order]).tolist()


def _scores(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    beta = model.value[2]
    for batch in _weights(batches, model):
        rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        score = [0.0 if beta is None else 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(b * f for b, f in zip(beta, features(t, n)))))))
                 for t, n in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), batch.column(1)], ["doc_id", "score", "matched"])


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, matched (total lexicon weight) per row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(fit(docs, labels, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(partial(_scores, model=model), f"doc_id {kind}, score double, matched double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "matched")

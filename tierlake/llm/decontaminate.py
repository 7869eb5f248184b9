"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds. Every ``N``-gram of words of a test item whose document frequency
outside of the item's own copies is low is a seed, so that an item copied into
very many documents keeps its seeds; so is the rarer half of an item's own
n-grams. A document with ``COPY_SHARE`` of an item's n-grams counts as a copy.
The frequencies are counted over all documents. Documents with ``MIN_SEEDS``
seeds of an item (one for items under ``SHORT`` words) within a window of the item's
length are candidates; each run of such seeds is aligned with the item by
Smith-Waterman over words (match 2, mismatch -1, gap -1), and the passage is a
leak if its score reaches ``MIN_SCORE`` of the item's own score, which edited
or paraphrased copies still do.

Scale. The corpus is scanned once for the frequencies (a partial aggregate per
task, one row per n-gram) and once for the alignments; texts are never
shuffled. The benchmark is taken in blocks of ``BLOCK_WORDS`` words, each
broadcast to the tasks, so a benchmark of any size is handled with bounded
memory at two scans per block.

Edge cases. Null and empty texts and items match nothing; an item with fewer
words than ``N`` is one seed and needs its whole word sequence. Equal items or
rows with the same id are judged alike. Extra columns are ignored by
``leaks`` and passed through by ``drop_leaks``.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import prepare

N = 3
MIN_SEEDS = 3
SHORT = 25  # words: shorter items need one seed
RARE_SHARE = 1e-3  # of the documents: n-grams below this frequency are rare whatever the item
MIN_RARE = 20  # documents
COPY_SHARE = 0.2  # and MIN_SEEDS n-grams
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_WORDS = 500_000  # words of test items broadcast at once

_WORD = re.compile(r"\w+")
#: ASCII word bytes, A-Z lower-cased, and all bytes of other characters; the rest of ASCII divides words.
_ASCII = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c == 95 or c > 127 else 32 for c in range(256))


@lru_cache(1 << 16)
def _other_words(token: bytes) -> tuple[bytes, ...]:
    """The words of a token that holds other than ASCII characters."""
    return tuple(w.encode() for w in _WORD.findall(token.decode().lower()))


def norm_words(text: str | None) -> list[bytes]:
    """Lower-case words (runs of letters, digits and ``_``) in UTF-8."""
    if not text:
        return []
    tokens = text.encode().translate(_ASCII).split()
    if text.isascii():
        return tokens
    return [w for t in tokens for w in ((t,) if t.isascii() else _other_words(t))]


class Items:
    """The word sequences of a block of test items and their n-grams."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.vocab: dict[bytes, int] = {}
        self.ids: list[int] = []
        self.words: list[np.ndarray] = []
        for item_id, text in items:
            words = norm_words(text)
            if words and item_id is not None:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int64))
        self.base = len(self.vocab) + 1
        self.grams: dict[int, list[int]] = defaultdict(list)  # n-gram to items
        for i, words in enumerate(self.words):
            for g in set(self.keys(words).tolist()):
                self.grams[g].append(i)
        self.known = np.array(sorted(self.grams), np.int64)
        self.lengths = sorted({min(N, len(w)) for w in self.words}, reverse=True)  # of the items' n-grams
        self.size = [len(set(self.keys(w).tolist())) for w in self.words]
        self.need = [1 if len(w) < SHORT else min(MIN_SEEDS, n) for w, n in zip(self.words, self.size)]
        self.copy = [min(n, max(MIN_SEEDS, math.ceil(COPY_SHARE * n))) for n in self.size]

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Exact keys of the n-grams (base-``base`` numbers); shorter sequences are one key, padded with 0."""
        if len(words) < N:
            words = np.concatenate([words, np.zeros(N - len(words), np.int64)])
        key = words[:len(words) - N + 1].copy()
        for j in range(1, N):
            key = key * self.base + words[j:len(words) - N + 1 + j]
        return key

    def text_keys(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word identifiers of a text (0: in no item), positions and keys of its n-grams that items have.

        Short items (fewer than ``N`` words) are found by their padded key at each position.
        """
        get = self.vocab.get
        found = norm_words(text)
        words = np.fromiter(map(get, found, repeat(0)), np.int64, len(found))
        used = words > 0
        at, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in self.lengths:
            whole = used[:max(0, len(words) - length + 1)].copy()
            for j in range(1, length):
                whole &= used[j:len(words) - length + 1 + j]
            near = np.flatnonzero(whole)
            if not len(near):
                continue
            key = np.zeros(len(near), np.int64)
            for j in range(N):
                key = key * self.base + (words[near + j] if j < length else 0)
            pos = np.searchsorted(self.known, key)
            hit = self.known[np.minimum(pos, len(self.known) - 1)] == key
            at.append(near[hit])
            keys.append(key[hit])
        return words, np.concatenate(at), np.concatenate(keys)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, start and end (exclusive) in ``passage``.

    One row per item word; gaps along the row are a running maximum.
    """
    m = len(passage)
    score = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    best = (0, 0, 0)
    ramp = np.arange(m + 1) * GAP
    for w in item:
        diagonal = score[:-1] + np.where(passage == w, MATCH, MISMATCH)
        new, new_start = np.zeros(m + 1, np.int64), np.arange(m + 1)
        for cand, frm in ((diagonal, start[:-1]), (score[1:] + GAP, start[1:])):
            better = cand > new[1:]
            new[1:] = np.where(better, cand, new[1:])
            new_start[1:] = np.where(better, frm, new_start[1:])
        lifted = new - ramp
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(m + 1), 0))
        by_gap = top + ramp
        use = by_gap > new
        new_start = np.where(use, new_start[source], new_start)
        score, start = np.maximum(new, by_gap), new_start
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(start[end]), end)
    return best


def find(text: str | None, items: Items, seeds: np.ndarray, min_score: float) -> list[tuple]:
    """Leaked items of one text: (item_id, score share, first word, end word, seeds)."""
    words, at, keys = items.text_keys(text)
    if not len(at):
        return []
    pos = np.searchsorted(seeds, keys)
    rare = seeds[np.minimum(pos, len(seeds) - 1)] == keys if len(seeds) else np.zeros(len(keys), bool)
    by_item: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, g in zip(at[rare].tolist(), keys[rare].tolist()):
        for i in items.grams[g]:
            by_item[i].append((p, g))
    out = []
    for i, hits in by_item.items():
        item = items.words[i]
        reach = 2 * len(item)
        hits.sort()
        best, low = (0, 0, 0, 0), 0
        while low < len(hits):  # runs of seeds without a hole as long as the item
            high = low + 1
            while high < len(hits) and hits[high][0] - hits[high - 1][0] <= len(item):
                high += 1
            n_seeds = len({g for _, g in hits[low:high]})
            if n_seeds >= items.need[i]:
                first, last = max(0, hits[low][0] - reach), hits[high - 1][0] + N + reach
                passage = words[first:last]
                if np.isin(item, passage).sum() >= min_score * len(item):  # else no alignment reaches it
                    score, s, e = align(item, passage)
                    best = max(best, (score, -(first + s), first + e, n_seeds))
            low = high
        share = best[0] / (MATCH * len(item))
        if best[0] and share >= min_score:
            out.append((items.ids[i], share, -best[1], best[2], best[3]))
    return sorted(out)


def _frequencies(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    own = Items(items.value)
    count: dict[int, int] = defaultdict(int)
    docs = 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            docs += 1
            keys = own.text_keys(text)[2]
            if not len(keys):
                continue
            grams = np.unique(keys).tolist()
            held: dict[int, int] = defaultdict(int)
            for g in grams:
                for i in own.grams[g]:
                    held[i] += 1
            for g in grams:  # not those of a copied item
                if all(held[i] < own.copy[i] for i in own.grams[g]):
                    count[g] += 1
    yield pa.RecordBatch.from_arrays([pa.array([-1, *count], pa.int64()), pa.array([docs, *count.values()], pa.int64())],
                                     ["gram", "docs"])


def _leaks(batches: Iterator[pa.RecordBatch], items, seeds, min_score: float) -> Iterator[pa.RecordBatch]:
    own = Items(items.value)
    for batch in batches:
        rows = [(i, *hit) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for hit in find(t, own, seeds.value, min_score)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, [
                pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()])],
            ["doc_id", "item_id", "score", "first_word", "end_word", "n_seeds"])


def _without_leaks(batches: Iterator[pa.RecordBatch], items, seeds, min_score: float) -> Iterator[pa.RecordBatch]:
    own = Items(items.value)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        clean = pa.array([not find(t, own, seeds.value, min_score) for t in texts], pa.bool_())
        yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(clean)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, one of them on the driver at a time."""
    block, words = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").toLocalIterator():
        block.append((row[0], row[1]))
        words += len(row[1]) // 4 + 1
        if words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def _seeds(docs: DataFrame, items, spark: SparkSession) -> np.ndarray:
    """The rare n-grams of a block, by their document frequencies outside of copies (at most one row per n-gram)."""
    rows = (docs.select("text").mapInArrow(partial(_frequencies, items=items), "gram long, docs long")
            .groupBy("gram").agg(F.sum("docs").alias("docs")).collect())
    seen = {r["gram"]: r["docs"] for r in rows}
    rare = max(MIN_RARE, int(seen.pop(-1, 0) * RARE_SHARE))
    own = Items(items.value)
    seeds = {g for g in own.grams if seen.get(g, 0) <= rare}
    for words in own.words:
        grams = sorted(set(own.keys(words).tolist()), key=lambda g: (seen.get(g, 0), g))
        seeds.update(grams[:max(MIN_SEEDS, (len(grams) + 1) // 2)])
    return np.array(sorted(seeds), np.int64)


def _prepared(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple]:
    spark = docs.sparkSession
    prepare(spark)
    for block in _blocks(benchmark):
        items = spark.sparkContext.broadcast(block)
        yield items, spark.sparkContext.broadcast(_seeds(docs, items, spark))


def leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, score (share of the item's own alignment
    score), first_word and end_word of the aligned passage (word positions, end exclusive), n_seeds."""
    out = docs.sparkSession.createDataFrame(
        [], "doc_id long, item_id long, score double, first_word long, end_word long, n_seeds long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for items, seeds in _prepared(docs, benchmark):
        out = out.union(texts.mapInArrow(
            partial(_leaks, items=items, seeds=seeds, min_score=min_score), out.schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows that hold a leaked item; columns unchanged."""
    out = docs
    for items, seeds in _prepared(docs, benchmark):
        copy = out.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(out.columns)),
                          F.col("text").alias("text_copy"))
        kept = copy.mapInArrow(partial(_without_leaks, items=items, seeds=seeds, min_score=min_score),
                               copy.drop("text_copy").schema)
        out = kept.toDF(*docs.columns)
    return out

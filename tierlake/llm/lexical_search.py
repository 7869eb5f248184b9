r"""Ranked lexical search: dense blocked matrix products in float64, exact in integers.

Items are dealt to blocks of at most ``BLOCK_BYTES`` of text. For a block, one
pass over the documents keeps, per document, its length and the counts of the
terms that the block's items use; the statistics (documents, lengths, document
frequencies) are partial sums in Spark over all documents. The second pass reads
those counts only. In each task a tile of documents becomes, for every tile of
items, a dense matrix of impacts (terms of the tile's own compact vocabulary by
documents) that one BLAS product multiplies with the items' term counts.

Exactness. Impacts and counts are integers. A vocabulary tile ends before the
largest possible partial sum of any item reaches 2^53, so that every sum in the
product is an exact float64; the partial products are added as 64-bit integers.
A term that an item repeats too often for one tile is split over several.

Top k. A task keeps the ``k`` best (score, document) of each item, ties by
ascending doc_id, and compares new scores with the worst kept one, equal ones
included; the tasks' lists are cut again per item in Spark.

Scale. The corpus is tokenised once per block of items and is never shuffled:
the counts are written once (below the text's size), and a task sends ``k`` rows
an item. On the driver and in broadcasts there are a block's items, which are
bounded, whatever the corpus; a larger set of items takes more blocks.

Edge cases. Null and empty texts hold no term; such documents do not count in
``N`` and are never ranked, and such items have no result. Rows that share an
item_id are one item with all their terms. Repeated documents are all ranked; a
null doc_id comes after all others with its score. Extra columns are ignored.
Without documents or items there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import prepare, saved, texts_of

BLOCK_BYTES = 32 << 20  # of item texts in a block
BUCKETS = 4_096  # groups of items that are dealt to blocks
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 2_048, 512
EXACT = 1 << 53
TOP = 1_000_000  # no impact before weighting is larger
#: ASCII letters and digits and all bytes of other characters are term bytes; A-Z are lower-cased.
TERM_BYTES = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _term_counts(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    place = {t: i for i, t in enumerate(vocabulary)}
    for batch in batches:
        length, found, ends = [], [], [0]
        for text in texts_of(batch.column(1)):
            words = terms(text)
            length.append(len(words))
            own = np.array([i for i in map(place.get, words) if i is not None], np.int64)
            found.append(np.unique(own, return_counts=True))
            ends.append(ends[-1] + len(found[-1][0]))
        ids, tf = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in (0, 1))
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(length, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], ["doc_id", "n", "terms", "tf"])


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length_norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """``m`` per document; in Python integers where 64 bits might not do."""
    if len(n) and 25 * int(n.max()) * docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * docs // total for x in n], np.int64)
    return 75 + 25 * n * docs // total


def item_tiles(counts: list[dict[int, int]], weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles (first item, terms, rows, columns, counts): the counts are of item ``rows`` and term ``columns`` of the
    tile. The sum over a tile's terms of count times largest impact stays below ``EXACT`` for every item."""
    out = []
    for first in range(0, len(counts), ITEM_TILE):
        by_term: dict[int, list[tuple[int, int]]] = {}
        for row, own in enumerate(counts[first:first + ITEM_TILE]):
            for t, c in own.items():
                by_term.setdefault(t, []).append((row, c))
        tile, room = [], EXACT - 1
        for t in sorted(by_term):
            most, left = int(weights[t]) * TOP, by_term[t]
            while most and left:
                part = min(max(c for _, c in left), (EXACT - 1) // most)
                if tile and (part * most > room or len(tile) == TERM_TILE):
                    out.append(_tile(first, tile))
                    tile, room = [], EXACT - 1
                tile.append((t, [(r, min(c, part)) for r, c in left]))
                room -= part * most
                left = [(r, c - part) for r, c in left if c > part]
        if tile:
            out.append(_tile(first, tile))
    return out


def _tile(first: int, entries: list) -> tuple:
    rows, columns, counts = (np.array(x) for x in zip(*((r, j, c) for j, (_, own) in enumerate(entries) for r, c in own)))
    return first, np.array([t for t, _ in entries]), rows, columns, counts


class Best:
    """The ``k`` best (score, document) of each item: highest score first, ties by id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.cut = k, np.ones(items, np.int64)
        self.kept = [(np.zeros(0, np.int64),) * 3 for _ in range(items)]

    def add(self, item: int, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        at = np.flatnonzero(score >= self.cut[item])
        if not len(at):
            return
        score, null, doc = (np.concatenate([old, new[at]]) for old, new in zip(self.kept[item], (score, null, doc)))
        order = np.lexsort((doc, null, -score))[:self.k]
        self.kept[item] = score[order], null[order], doc[order]
        if len(order) == self.k:
            self.cut[item] = score[order[-1]]


def _best(batches: Iterator[pa.RecordBatch], tiles: list, items: int, weights: np.ndarray, docs: int, total: int,
          k: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, n, terms, tf); gives (item, doc_id, score) for the best of the partition."""
    best = Best(items, k)
    for batch in batches:
        for start in range(0, batch.num_rows, DOC_TILE):
            part = batch.slice(start, DOC_TILE)
            null = part.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = part.column(0).fill_null(0).to_numpy()
            ids, tf = (part.column(c).flatten().to_numpy() for c in (2, 3))
            who = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy())
            norm = length_norms(part.column(1).to_numpy(), docs, total)
            impact = weights[ids] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[who]))
            order = np.argsort(ids, kind="stable")
            ids, who, impact = ids[order], who[order], impact[order].astype(np.float64)
            scores = np.zeros((items, part.num_rows), np.int64)
            for first, vocabulary, rows, columns, counts in tiles:
                lo, hi = np.searchsorted(ids, vocabulary), np.searchsorted(ids, vocabulary, side="right")
                have = np.flatnonzero(hi > lo)
                if not len(have):
                    continue
                size = (hi - lo)[have]
                at = np.repeat(lo[have] - np.cumsum(size) + size, size) + np.arange(size.sum())
                matrix = np.zeros((len(have), part.num_rows))
                matrix[np.repeat(np.arange(len(have)), size), who[at]] = impact[at]
                compact = np.full(len(vocabulary), -1)
                compact[have] = np.arange(len(have))
                used = compact[columns] >= 0
                height = min(ITEM_TILE, items - first)
                queries = np.zeros((height, len(have)))
                queries[rows[used], compact[columns[used]]] = counts[used]
                scores[first:first + height] += (queries @ matrix).astype(np.int64)
            for item in np.flatnonzero((scores >= best.cut[:, None]).any(axis=1)):
                best.add(item, scores[item], null, doc)
    sizes = [len(x[0]) for x in best.kept]
    score, null, doc = (np.concatenate([x[c] for x in best.kept]) if items else np.zeros(0, np.int64) for c in range(3))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.arange(items), sizes), pa.int32()), pa.array(doc, pa.int64(), mask=null.astype(bool)),
         pa.array(score, pa.int64())], ["item", "doc_id", "score"])


def _blocks(items: DataFrame) -> list[list[int]]:
    """Buckets of items dealt to blocks: neighbours go together up to ``BLOCK_BYTES`` of text."""
    size = items.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("bytes")).orderBy("bucket").collect()
    blocks, room = [], 0
    for r in size:
        n = r["bytes"] or 0
        if not blocks or n > room:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append(r["bucket"])
        room -= n
    return blocks


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents (doc_id, text) with the highest score above 0
    for each item (item_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = items.schema["item_id"].dataType.simpleString()
    items = items.select("item_id", "text", F.pmod(F.xxhash64("item_id"), F.lit(BUCKETS)).alias("bucket"))
    out = spark.createDataFrame([], f"item_id {key}, rank int, doc_id long, score long")
    for buckets in _blocks(items):
        own: dict = {}
        for r in items.where(F.col("bucket").isin(buckets)).collect():
            own.setdefault(r["item_id"], Counter()).update(terms((r["text"] or "").encode()))
        own = {i: c for i, c in own.items() if c}
        if own:
            out = out.unionByName(_search_block(docs, own, key, k))
    return out


def _search_block(docs: DataFrame, own: dict, key: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*own.values()))
    place = {t: i for i, t in enumerate(vocabulary)}
    counts = [{place[t]: c for t, c in own[i].items()} for i in own]
    found = saved(docs.mapInArrow(partial(_term_counts, vocabulary=vocabulary), "doc_id long, n long, terms array<int>, tf array<long>"))
    sums = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r["t"]] = r["df"]
    weights = np.array([weight(sums["docs"], int(d)) for d in df], np.int64)
    best = found.where("size(terms) > 0").mapInArrow(
        partial(_best, tiles=item_tiles(counts, weights), items=len(counts), weights=weights, docs=sums["docs"],
                total=sums["total"], k=k), "item int, doc_id long, score long")
    # First within slices of the tasks, then per item: no task sorts the lists of all tasks.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = best.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).where(F.col("rank") <= k)
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    ids = spark.createDataFrame(list(enumerate(own)), f"item int, item_id {key}")  # a block's items: bounded
    return part.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")

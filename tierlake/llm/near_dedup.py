"""MinHash near-dedup: fast similarity sketches, banding, exact verification.

Sketch. Rounds of hashed bin placement: in round ``i < t`` every element goes
to a hashed bin with value ``i + h``; in round ``t + j`` every element goes to
bin ``j``. A bin keeps its minimum, and the rounds stop once all ``t`` bins
are filled, so a set of any size fills every coordinate, and the share of equal
coordinates concentrates around the Jaccard similarity as for independent
hashes. Bands of ``rows`` coordinates give bucket keys; their number follows
from the threshold so that a pair at the threshold is missed with at most
``miss`` probability.

Links. Equal word sequences are one class with the smallest id as
representative. In each bucket the members are compared with one pivot, then
the classes linked so far are contracted. Buckets that still hold several
components are dealt to blocks of bounded size; the members outside the
bucket's main component pass by every block and are compared there with the
members of other components, each pair only in the first band that it shares.
A comparison first estimates the similarity from the sketches and drops pairs
more than ``SIGMAS`` standard deviations below the threshold; the others are
confirmed on their full sets. Only confirmed links leave a block, no group is
collected, and no bucket is capped.

Edge cases. Null, empty or white-space texts have an empty set and link with
nothing. Rows that share a doc_id are one document. A null doc_id cannot be
linked to: the row keeps a null component and is kept. Extra columns are
ignored by ``near_duplicates`` and passed through by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import ascii_words, components, fresh, mix, prepare, saved, shingle_sets, texts_of

ROWS = 6
MISS = 1e-7
SIGMAS = 5.5
HUB_BLOCK = 512  # members compared with one copy of a pivot's set
BLOCK_SHINGLES = 1 << 18  # shingles of the members of a block, about


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def sketch(who: np.ndarray, hashes: np.ndarray, sets: int, t: int) -> np.ndarray:
    """Fast similarity sketches (sets x t) of the sets given as (set index, element hash)."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((sets, t), empty, np.uint64)
    flat = out.reshape(-1)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * t):
        z = mix(hashes ^ mix(np.full(1, i + 1, np.uint64)))
        slot = (z >> np.uint64(32)) % np.uint64(t) if i < t else np.full(len(z), i - t, np.uint64)
        np.minimum.at(flat, who * t + slot.astype(np.int64), np.uint64(i << 32) | (z & low))
        unfilled = (out == empty).any(axis=1)
        keep = unfilled[who]
        who, hashes = who[keep], hashes[keep]
        if not len(who):
            break
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        h = mix(np.full(len(sketches), b + 1, np.uint64))
        for c in range(rows):
            h = mix(h ^ sketches[:, b * rows + c])
        keys[:, b] = h
    return keys.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [ascii_words(t) for t in texts_of(batch.column(1))]
        who, hashes, size = shingle_sets(words, k)
        sketches = sketch(who, hashes, len(words), bands * rows)
        keys = band_keys(sketches, bands, rows)[size > 0]
        short = mix(sketches).astype(np.uint16)
        offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
        same = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(same, pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
             pa.array([row.tobytes() for row in short], pa.binary())],
            ["doc_id", "n_shingles", "same", "bands", "sketch"])


def _promising(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose sketches (two more columns, 16 bits a coordinate) agree in the share ``least`` or more."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                if batch.num_rows else np.zeros((0, 1)) for c in (2, 3))
        yield batch.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= least))


def _confirm(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, salt, member, b, text) sorted by (a, salt, member): a pivot's own text, then its members'."""
    pivot, own = None, None
    for batch in batches:
        words = [ascii_words(t) for t in texts_of(batch.column(4))]
        _, hashes, size = shingle_sets(words, k)
        ends = np.cumsum(size)
        a, b = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        member = batch.column(2).to_pylist()
        found = []
        for i, end in enumerate(ends):
            own_i = hashes[end - size[i]:end]
            if not member[i]:
                pivot, own = a[i], own_i
                continue
            if pivot != a[i]:
                raise RuntimeError("a member came before its pivot")
            both = len(np.intersect1d(own, own_i, assume_unique=True))
            if both and 100 * both >= percent * (len(own) + len(own_i) - both):
                found.append((a[i], b[i]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``pairs`` (a pivot, b member) whose full shingle sets reach the threshold.

    A pivot with many members is copied to as many blocks; a task holds one
    pivot's set at a time.
    """
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_BLOCK).cast("int").alias("parts"))
    members = (pairs.join(hubs, "a").join(texts.withColumnRenamed("node", "b"), "b")
               .select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"),
                       F.lit(1).alias("member"), "b", "text"))
    pivots = (hubs.join(texts.withColumnRenamed("node", "a"), "a")
              .select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
                      F.lit(0).alias("member"), F.col("a").alias("b"), "text"))
    return (pivots.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
            .mapInArrow(partial(_confirm, k=k, percent=percent), "a long, b long"))


def _linked(row: tuple, block: tuple, percent: int, least: float) -> np.ndarray:
    """Nodes of the ``block`` that share a band with the passing ``row`` and are linked with it."""
    node, comp, _, bands, sketch_, own = row
    nodes, comps, minor, all_bands, sketches, n, who, hashes = block
    # Two members outside the main component pass by each other twice.
    todo = (all_bands == bands).any(axis=1) & (comps != comp) & (~minor | (nodes < node))
    todo &= np.minimum(n, len(own)) * 100 >= np.maximum(n, len(own)) * percent
    at = np.flatnonzero(todo)
    todo[at] = (sketches[at] == sketch_).mean(axis=1) >= least
    if not todo.any():
        return nodes[:0]
    chosen = todo[who]
    value = hashes[chosen]
    hit = own[np.minimum(np.searchsorted(own, value), len(own) - 1)] == value
    both = np.bincount(who[chosen][hit], minlength=len(nodes))
    return nodes[todo & (100 * both >= percent * (n + len(own) - both))]


def _across(batches: Iterator[pa.RecordBatch], k: int, percent: int, least: float) -> Iterator[pa.RecordBatch]:
    """Rows (main, salt, passing, node, comp, minor, bands, sketch, text) sorted by (main, salt, passing): the members
    of a block, which are held, then the members outside the main component, which pass by. Gives the links (a, b)."""
    at, held, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        main, salt, passing, node, comp, minor = (batch.column(c).to_pylist() for c in range(6))
        bands = batch.column(6).flatten().to_numpy().reshape(batch.num_rows, -1)
        sketches = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
        _, hashes, size = shingle_sets([ascii_words(t) for t in texts_of(batch.column(8))], k)
        sets = np.split(hashes, np.cumsum(size)[:-1])
        a, b = [], []
        for i, row in enumerate(zip(node, comp, minor, bands, sketches, sets)):
            if (main[i], salt[i]) != at:
                at, held, block = (main[i], salt[i]), [], None
            if not passing[i]:
                held.append(row)
                continue
            if not held:
                continue
            if block is None:
                *cols, own = zip(*held)
                n = np.array([len(x) for x in own])
                block = (*(np.array(c) for c in cols), n, np.repeat(np.arange(len(n)), n), np.concatenate(own))
            for other in _linked(row, block, percent, least).tolist():
                a.append(min(other, node[i]))
                b.append(max(other, node[i]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links_across(members: DataFrame, side: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """Links between members (key, node, n, comp) of one bucket that are in different components.

    ``side`` has bands, sketch and text per node. The buckets of one main component are searched together, so a
    node goes there once, however many of its buckets they are: ``m`` members of these buckets, ``s`` of them
    outside the main component, cost ``m + s * ceil(m / HUB_BLOCK)`` rows (more blocks where the sets are large).
    """
    size = members.groupBy("key", "comp").agg(F.count("*").alias("rows"))
    mixed = size.groupBy("key").agg(
        F.max_by("comp", F.struct("rows", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").drop("comps")
    inside = saved(members.join(mixed, "key").select("main", "node", "n", "comp").distinct())
    parts = inside.groupBy("main").agg(
        F.greatest(F.ceil(F.count("*") / HUB_BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    home = F.struct(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("salt"), F.lit(0).alias("passing"))
    tour = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(i.alias("salt"), F.lit(1).alias("passing")))
    minor = F.col("comp") != F.col("main")
    places = F.when(minor, F.concat(F.array(home), tour)).otherwise(F.array(home))
    rows = inside.join(parts, "main").select("main", "node", "comp", minor.alias("minor"), F.inline(places))
    return (rows.join(side, "node").select("main", "salt", "passing", "node", "comp", "minor", "bands", "sketch", "text")
            .repartition("main", "salt").sortWithinPartitions("main", "salt", "passing")
            .mapInArrow(partial(_across, k=k, percent=percent, least=least), "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, n_links.

    Links join documents whose sets of ``k``-word shingles have a Jaccard
    similarity of ``percent``/100 or more; ``component_id`` is the smallest
    reachable doc_id. ``n_links`` counts the confirmed links of the document
    that were needed to connect the components, not all its links.
    """
    prepare(docs.sparkSession)
    bands = bands_for(percent, rows, miss)
    least = percent / 100 - SIGMAS * math.sqrt(percent / 100 * (1 - percent / 100) / (bands * rows))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = saved(docs.mapInArrow(partial(_signatures, k=k, bands=bands, rows=rows),
                                "doc_id long, n_shingles long, same binary, bands array<long>, sketch binary"))
    known = sig.where("doc_id is not null and same is not null")
    reps = known.groupBy("same").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"))
    copies = saved(known.select("same", "doc_id").distinct().join(reps, "same")
                   .select("doc_id", "node", "n"))
    own = copies.where("doc_id = node").select("doc_id", "n")
    banded = known.select("doc_id", "bands").join(own, "doc_id").groupBy("doc_id").agg(
        F.max("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("bands"))).alias("bands")).select(
        F.col("doc_id").alias("node"), "n", F.explode("bands").alias("key"))
    # The keys of several nodes are written first, so that the join with a bucket of very many can be split.
    full = saved(banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"))
    members = saved(banded.join(full, "key").select("key", "node", "n"))
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    texts = saved(docs.where("text is not null").join(nodes, "doc_id")
                  .select(F.col("doc_id").alias("node"), "text").dropDuplicates(["node"]))
    sketches = known.join(nodes, "doc_id").select(F.col("doc_id").alias("node"), "sketch").dropDuplicates(["node"])

    def likely(pairs: DataFrame) -> DataFrame:
        side = {c: sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"}
        pairs = pairs.where(F.least("n", "pn") * 100 >= F.greatest("n", "pn") * percent).select(
            F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        return saved(pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(
            partial(_promising, least=least), "a long, b long"))

    pivot = members.groupBy("key").agg(F.min_by(F.struct("node", "n"), "node").alias("p")).select(
        "key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"))
    found = saved(confirmed(likely(members.join(pivot, "key").where("node <> pivot")), texts, k, percent))
    same = copies.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    # Copies follow their representative; only an id with several texts joins classes by itself.
    several = copies.groupBy("doc_id").agg(F.count_distinct("node").alias("nodes")).where("nodes > 1").select("doc_id")
    edges = found.union(same.join(several.withColumnRenamed("doc_id", "b"), "b").select("a", "b"))
    roots = components(edges)
    rooted = saved(members.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("comp")))
    side = known.join(nodes, "doc_id").select(F.col("doc_id").alias("node"), "bands", "sketch").dropDuplicates(
        ["node"]).join(texts, "node")
    late = saved(links_across(rooted, side, k, percent, least).distinct())
    if not late.isEmpty():
        roots = components(edges.union(late))

    links = same.union(found).union(late).distinct()
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(
        F.count("*").alias("n_links"))
    verdict = copies.join(roots, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "node")).alias("root")).join(
        degree.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return (sig.select("doc_id", "n_shingles").join(verdict, "doc_id", "left")
            .withColumn("component_id", F.coalesce("root", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id. Rows repeated under that id
    are dropped too; rows with a null doc_id all stay."""
    kept = near_duplicates(docs, k, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    name = fresh(docs.columns, "kept_id")
    kept = kept.select(F.col("doc_id").alias(name))
    one = docs.join(kept, docs["doc_id"].cast("long") == kept[name]).dropDuplicates([name]).select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))

"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Each source's documents, in hashed order, form blocks of ``BLOCK`` documents.
Block k (from 1) of a source with share w of the target weights is released at
slot floor((k - 1) / w) and due before ceil(k / w); in each slot the released
block with the earliest deadline is taken. The shares are exact fractions,
never rounded to a period, and every block of the whole run is dealt, so each
block lies in its window and at every slot each source is less than one block
away from its target as long as it has documents left. ``on_target`` marks the
slots before the first one that a source without documents should have filled.

The driver deals the blocks one after the other (a heap with a row per source,
a few microseconds per block) and hands them over in parts of ``PART`` slots,
so that it holds one part at a time.

A document's rank in its source is its offset among hash buckets plus its row
number in its own bucket; buckets have about ``BUCKET_ROWS`` rows whatever the
size of the source, so a source with most of the rows is sorted in many tasks.
No row is dropped or repeated: after a source has run out, a slot in which no
block of another is released stays empty.

Edge cases. A null source is a source of its own; null ids are ordered like
others; equal rows take neighbouring ranks. An empty table stays empty. With
given weights, each source without one or with the weight 0 has the smallest weight
above 0 that is given (1 if there is none), as no row may be dropped; a negative or
infinite weight raises a ``ValueError``. Extra columns are passed through by ``mixed``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import fresh, prepare, saved

BLOCK = 32  # documents
PART = 1_000_000  # slots on the driver at once
MAX_BROADCAST = 1_000_000  # blocks of the schedule
BUCKET_ROWS = 5_000
MAX_OFFSETS = 1_000_000  # broadcast bound of the buckets' first ranks, rows of about 40 bytes
ALPHA = 0.5  # default weights: document counts to this power
MAX_SOURCES = 100_000  # sources have one row each on the driver


def deal(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, bool]]:
    """(slot, source, its k from 0, whether every source has kept its slots so far) of all blocks, earliest
    deadline first among released blocks. The first source to run out leaves its later slots to others or empty."""
    exact = [Fraction(w) for w in weights]
    unit = math.lcm(*(w.denominator for w in exact))
    share = [int(w * unit) for w in exact]
    whole = sum(share)
    waiting = [(0, i) for i in range(len(share))]  # release, source
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # deadline, source
    taken = [0] * len(share)
    slot, left, on_target = 0, sum(blocks), True
    while left:
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(taken[i] + 1) * whole // share[i]), i))
        if not ready:
            slot = waiting[0][0]
            continue
        i = heapq.heappop(ready)[1]
        if taken[i] >= blocks[i]:  # nothing left of it
            on_target = False
            continue
        yield slot, i, taken[i], on_target
        taken[i] += 1
        left -= 1
        slot += 1
        if on_target or taken[i] < blocks[i]:
            heapq.heappush(waiting, (taken[i] * whole // share[i], i))


def _dealt(spark: SparkSession, weights: list[float], blocks: list[int]) -> DataFrame:
    """The schedule as rows (mix_source: index, mix_k, mix_slot, mix_on), at most ``PART`` of them on the driver."""
    names = ["mix_slot", "mix_source", "mix_k", "mix_on"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    rows = deal(weights, blocks)
    parts = []
    while part := [r for _, r in zip(range(PART), rows)]:
        parts.append(spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*part), types)], names)))
        if sum(blocks) > PART:
            parts[-1] = saved(parts[-1])
    return reduce(DataFrame.union, parts)


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with block (of the source, from 0), slot, place (in the block) and on_target; ordering by
    (slot, place) is the mixture. New names that clash get a trailing underscore."""
    spark = docs.sparkSession
    prepare(spark)
    new = {}
    for name in ("block", "slot", "place", "on_target"):
        new[name] = fresh([*docs.columns, *new.values()], name)
    counts = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; map them to fewer before mixing")
    n = dict(sorted(((r["source"], r["n"]) for r in counts), key=lambda x: (x[0] is not None, x[0] or "")))
    if not n:
        return docs.select("*", *(F.lit(0).cast("long").alias(new[c]) for c in ("block", "slot", "place")),
                           F.lit(True).alias(new["on_target"]))
    if weights:
        if any(not 0 <= w < math.inf for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        rest = min((w for w in weights.values() if w > 0), default=1.0)
        target = [weights.get(s) or rest for s in n]
    else:
        target = [c ** ALPHA for c in n.values()]
    blocks = [-(-c // block) for c in n.values()]
    slots = _dealt(spark, target, blocks)

    buckets = max(1, math.ceil(sum(n.values()) / BUCKET_ROWS))
    taken = list(docs.columns)

    def own(name: str) -> str:
        taken.append(fresh(taken, name))
        return taken[-1]

    src, h, bucket, before, rank, group = map(own, ("mix_src", "mix_hash", "mix_bucket", "mix_before", "mix_rank", "mix_group"))
    source: Column = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # never null: plain joins
    dealt = docs.withColumn(src, source).withColumn(h, F.xxhash64(F.col("doc_id"), F.lit("mix"))).withColumn(
        bucket, F.pmod(F.col(h), F.lit(buckets)))
    sizes = dealt.groupBy(src, bucket).agg(F.count("*").alias("rows"))
    offsets = sizes.select(F.col(src).alias("o_src"), F.col(bucket).alias("o_bucket"), (F.sum("rows").over(
        Window.partitionBy(src).orderBy(bucket)) - F.col("rows")).alias(before))
    in_bucket = Window.partitionBy(src, bucket).orderBy(h, "doc_id")
    ranked = dealt.withColumn(group, F.row_number().over(in_bucket))
    ranked = ranked.join(F.broadcast(offsets) if len(n) * buckets <= MAX_OFFSETS else offsets,
                         (ranked[src] == F.col("o_src")) & (ranked[bucket] == F.col("o_bucket")))
    ranked = ranked.withColumn(rank, F.col(before) + F.col(group) - 1)
    index = spark.createDataFrame([(i, "" if s is None else f"={s}") for i, s in enumerate(n)], "w_index long, w_source string")
    ranked = ranked.join(F.broadcast(index), F.col(src) == F.col("w_source"))
    ranked = ranked.withColumn(own("mix_block"), F.floor(F.col(rank) / block))
    own_block = taken[-1]
    ranked = ranked.join(F.broadcast(slots) if sum(blocks) <= MAX_BROADCAST else slots,
                         (F.col("w_index") == F.col("mix_source")) & (F.col(own_block) == F.col("mix_k")))
    return ranked.select(
        *(docs[c] for c in docs.columns), F.col(own_block).cast("long").alias(new["block"]), F.col("mix_slot").alias(new["slot"]),
        (F.col(rank) % block).cast("long").alias(new["place"]), F.col("mix_on").alias(new["on_target"]))

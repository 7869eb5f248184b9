"""Repeated passages by bucket-pointer refinement.

A byte is removed if a ``LENGTH``-byte string that covers it also starts
somewhere else in the corpus. Strings are identified as in bucket-pointer
refinement: buckets of short grams are refined by the bucket identifier at a
later offset (1, 2, 4 ... bytes), and each refined identifier is reused by the
next step, up to the identifier of the whole string. Identifiers are 64-bit
content hashes, so that equal strings of different documents get equal ones
without a global renumbering.

Only buckets that can hold repeats are refined. Every string start belongs to
the start run of its anchor, the leftmost smallest ``GRAM``-byte identifier
among those inside the string; equal strings have equal anchors at equal
offsets. Level 0 has one row per run (about ``LENGTH - GRAM`` / 2 bytes):
the anchor's identifier is the initial bucket, runs alone in theirs leave, and
runs of equal content are solved at once. Level 1 splits the runs of the other shared buckets into blocks
of ``BLOCK`` starts by the identifier of the bytes that all strings of the
block share; level 2 compares the single strings of blocks that are shared but
differ at the edges. Every level compares two identifiers, its bucket's and
the refined one, so rows are only taken as equal on 128 bits. Each level keeps one representative of equal rows, so a
passage shared by very many documents costs a row per occurrence and two block
refinements per different surrounding. All levels are partial aggregates and
joins on identifiers; no bucket is collected.

Edge cases. Null is an empty text; texts under ``LENGTH`` bytes keep all
bytes. Repeated rows are documents of their own, so their texts are repeats of
each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import mix, prepare, saved, texts_of
from tierlake.session import checkpoint_dir

LENGTH = 400
GRAM = 128
BLOCK = 16
WINDOW = LENGTH - GRAM + 1  # anchors positions of a string
PIECE = 1 << 20  # bytes of a text that are hashed at once
MAX_BROADCAST = 3_000_000  # intervals or runs (16 bytes each) sent to the executors at once

_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_ODD = mix(np.arange(300, 316, dtype=np.uint64)) | np.uint64(1)


def identifiers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the ``GRAM``-byte and the 256-byte strings at each position: each step refines the buckets
    of one length by the bucket identifier as many bytes later."""
    h, span, gram = _TABLE[data], 1, None
    with np.errstate(over="ignore"):
        while span < 256 and len(h) > span:
            h = h[:-span] * _ODD[span.bit_length()] + h[span:]
            span *= 2
            if span in (16, GRAM):
                h = mix(h)
            if span == GRAM:
                gram = h
    empty = np.zeros(0, np.uint64)
    return (empty if gram is None else gram), (h if span == 256 else empty)


def combined(h256: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Identifiers of the ``length``-byte strings (257 to 512) at positions ``at``."""
    with np.errstate(over="ignore"):
        return mix(h256[at] * _ODD[12] + h256[at + (length - 256)] + np.uint64(length))


def anchors(gram: np.ndarray, starts: int) -> np.ndarray:
    """Position of the leftmost smallest gram among those inside the string at each of ``starts`` positions."""
    value, at, span = gram, np.arange(len(gram), dtype=np.int32), 1
    while True:
        step = min(span, WINDOW - span)
        if not step:
            return at[:starts]
        left = value[:-step] <= value[step:]
        at = np.where(left, at[:-step], at[step:])
        value = np.minimum(value[:-step], value[step:])
        span += step


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """lo, hi, anchor, key, content of the start runs of one text or piece of it."""
    starts = len(data) - LENGTH + 1
    if starts < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    gram, h256 = identifiers(data)
    at = anchors(gram, starts)
    lo = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    hi = np.concatenate([lo[1:] - 1, [starts - 1]])
    m = at[lo].astype(np.int64)
    with np.errstate(over="ignore"):
        shape = ((hi - lo) * 1000 + (m - lo)).astype(np.uint64)
        content = mix(combined(h256, lo, LENGTH) * _ODD[13] + combined(h256, hi, LENGTH) + shape)
    return lo, hi, m, gram[m].view(np.int64), content.view(np.int64)


def _pieces(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of string starts; a longer text is hashed in pieces, which may cut runs but loses no string."""
    for a in range(0, max(0, n - LENGTH + 1), PIECE):
        yield a, min(a + PIECE, n - LENGTH + 1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "key", "content", "lo", "hi", "anchor"]
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        who, cols = [], []
        for i, text in enumerate(texts_of(batch.column(2))):
            data = np.frombuffer(text, np.uint8)
            for a, b in _pieces(len(data)):
                lo, hi, m, key, content = runs_of(data[a:b + LENGTH - 1])
                who.append(np.full(len(lo), i))
                cols.append(np.stack([key, content, lo + a, hi + a, m + a]))
        if who:
            take = pa.array(np.concatenate(who))
            key, content, lo, hi, m = np.concatenate(cols, axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), hashes.take(take), pa.array(key), pa.array(content),
                 *(pa.array(x.astype(np.int32)) for x in (lo, hi, m))], names)


def _around(data: np.ndarray, anchor: int) -> tuple[np.ndarray, int]:
    """256-byte identifiers near an anchor and the position of the first."""
    a = max(0, anchor - WINDOW - BLOCK)
    return identifiers(data[a:anchor + LENGTH + BLOCK])[1], a


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, text, runs (lo, hi, anchor, solved): a row per block of starts with the identifiers of
    the shared and, for whole blocks, of all bytes."""
    for batch in batches:
        who, rows = [], []
        for i, (text, runs) in enumerate(zip(texts_of(batch.column(2)), batch.column(3).to_pylist())):
            data = np.frombuffer(text, np.uint8)
            whole = identifiers(data)[1] if len(data) <= PIECE else None
            for run in runs:
                m, lo, hi = run["anchor"], run["lo"], run["hi"]
                h256, a = (whole, 0) if whole is not None else _around(data, m)
                k = np.arange((m - hi) // BLOCK, (m - lo) // BLOCK + 1)
                last = m - BLOCK * k  # the latest start of each full block
                first = last - BLOCK + 1
                shared = combined(h256, last - a, LENGTH - BLOCK + 1)
                full = (first >= lo) & (last <= hi)
                edge = np.where(full, first - a, 0)
                with np.errstate(over="ignore"):
                    all_bytes = mix(combined(h256, edge, LENGTH) * _ODD[14] + combined(h256, np.where(full, last - a, 0), LENGTH))
                who.append(np.full(len(k), i))
                rows.append(np.stack([shared.view(np.int64), all_bytes.view(np.int64), full, np.maximum(first, lo),
                                      np.minimum(last, hi), np.full(len(k), m), np.full(len(k), run["solved"])]))
        if who:
            take = pa.array(np.concatenate(who))
            shared, all_bytes, full, lo, hi, m, solved = np.concatenate(rows, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(shared),
                 pa.array(all_bytes, mask=full == 0), *(pa.array(x.astype(np.int32)) for x in (lo, hi, m)), pa.array(solved == 1)],
                ["doc_id", "text_hash", "shared", "all_bytes", "lo", "hi", "anchor", "solved"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, text, runs: a row per string start with the identifiers of its block's bucket (equal for
    equal strings, whose blocks have equal offsets from equal anchors) and of the string."""
    for batch in batches:
        who, rows = [], []
        for i, (text, runs) in enumerate(zip(texts_of(batch.column(2)), batch.column(3).to_pylist())):
            data = np.frombuffer(text, np.uint8)
            whole = identifiers(data)[1] if len(data) <= PIECE else None
            for run in runs:
                h256, a = (whole, 0) if whole is not None else _around(data, run["anchor"])
                s = np.arange(run["lo"], run["hi"] + 1)
                last = s + (run["anchor"] - s) % BLOCK  # of the string's block
                shared = combined(h256, last - a, LENGTH - BLOCK + 1)
                who.append(np.full(len(s), i))
                rows.append(np.stack([shared.view(np.int64), combined(h256, s - a, LENGTH).view(np.int64), s, np.full(len(s), run["solved"])]))
        if who:
            take = pa.array(np.concatenate(who))
            shared, name, s, solved = np.concatenate(rows, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(shared), pa.array(name), pa.array(s.astype(np.int32)),
                 pa.array(solved == 1)], ["doc_id", "text_hash", "shared", "name", "lo", "solved"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, runs in zip(texts_of(batch.column(1)), batch.column(2).to_pylist()):
            cover = np.zeros(len(text) + 1, np.int32)
            if runs:
                edges = np.array([(r["lo"], r["hi"] + LENGTH) for r in runs])
                np.add.at(cover, edges[:, 0], 1)
                np.add.at(cover, edges[:, 1], -1)
            gone = np.cumsum(cover)[:-1] > 0
            rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
            begins = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((len(text), int(gone.sum()), begins, hashlib.sha256(rest).hexdigest(), rest))
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string(), pa.binary()]))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _with_text(docs: DataFrame, pointers: DataFrame, how: str) -> DataFrame:
    """``docs`` beside the list of its pointers, once per (doc_id, text) for an inner join."""
    lists = saved(pointers.groupBy("doc_id", "text_hash").agg(F.collect_list("run").alias("runs")))
    total = lists.agg(F.sum(F.size("runs"))).first()[0] or 0
    lists = lists.withColumnsRenamed({"doc_id": "p_id", "text_hash": "p_hash"})
    lists = F.broadcast(lists) if total <= MAX_BROADCAST else lists
    out = docs.join(lists, docs["doc_id"].eqNullSafe(F.col("p_id")) & (docs["text_hash"] == F.col("p_hash")), how)
    return out.select("doc_id", "text_hash", "text", "runs")


def _run(solved) -> object:
    return F.struct("lo", "hi", "anchor", solved.alias("solved")).alias("run")


def _merged(found: DataFrame) -> DataFrame:
    """The intervals of string starts, those of a document whose strings meet or overlap made one: what they cover
    stays the same, and a long passage is one row instead of one for each anchor in it."""
    by = Window.partitionBy("doc_id", "text_hash").orderBy("lo", "hi")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("lo") > before + LENGTH, F.lit(True)).cast("long")
    return (found.withColumn("apart", apart).withColumn("part", F.sum("apart").over(by.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "text_hash", "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) per row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = f"doc_id {kind}, text_hash long"
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    docs.mapInArrow(_runs, f"{ids}, key long, content long, lo int, hi int, anchor int").write.parquet(path)
    runs = spark.read.parquet(path)

    # Runs alone in their bucket, most of a clean corpus, leave before anything wider than a count is grouped.
    # The counts are written first: a join straight from a shuffle can split a hot key, one behind an aggregate can't.
    several = saved(runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    runs = saved(runs.join(several, "key", "left_semi"))
    each = runs.groupBy("key", "content").agg(F.count("*").alias("n"))
    shared = each.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("all_n"))
    shared = saved(each.join(shared.select("key", "kinds"), "key"))
    hits = saved(runs.join(shared, ["key", "content"]))
    place = F.struct("doc_id", "text_hash", "lo", "hi", "anchor")
    solved = hits.where("n > 1")
    one = solved.where("kinds > 1").groupBy("key", "content").agg(F.min(place).alias("p")).select("p.*")
    open_runs = hits.where("kinds > 1 and n = 1").select("doc_id", "text_hash", _run(F.lit(False))).union(
        one.select("doc_id", "text_hash", _run(F.lit(True))))

    blocks = saved(_with_text(docs, open_runs, "inner").dropDuplicates(["doc_id", "text_hash"]).mapInArrow(
        _blocks, f"{ids}, shared long, all_bytes long, lo int, hi int, anchor int, solved boolean"))
    each = blocks.groupBy("shared", "all_bytes").agg(F.count("*").alias("n"))
    kinds = each.groupBy("shared").agg(F.sum("n").alias("all_n"), F.count("*").alias("kinds"),
                                       F.count(F.when(F.col("all_bytes").isNull(), 1)).alias("partial")).where("all_n > 1")
    marked = saved(blocks.join(each.join(kinds, "shared").select(
        F.col("shared").alias("s"), F.col("all_bytes").alias("a"), "n", F.expr("kinds > 1 or partial > 0").alias("open")),
        (F.col("shared") == F.col("s")) & F.col("all_bytes").eqNullSafe(F.col("a"))).drop("s", "a"))
    alike = F.expr("all_bytes is not null and n > 1")
    one = marked.where(alike & F.col("open")).groupBy("shared", "all_bytes").agg(F.min(place).alias("p")).select("p.*")
    open_blocks = marked.where(~alike & F.col("open")).select("doc_id", "text_hash", _run(F.col("solved"))).union(
        one.select("doc_id", "text_hash", _run(F.lit(True))))

    strings = saved(_with_text(docs, open_blocks, "inner").dropDuplicates(["doc_id", "text_hash"]).mapInArrow(
        _strings, f"{ids}, shared long, name long, lo int, solved boolean"))
    twice = strings.groupBy("shared", "name").agg(F.count("*").alias("n")).where("n > 1").select("shared", "name")
    found = strings.where("not solved").join(twice, ["shared", "name"]).select("doc_id", "text_hash", "lo", F.col("lo").alias("hi"))
    found = solved.select("doc_id", "text_hash", "lo", "hi").union(
        marked.where(alike & ~F.col("solved")).select("doc_id", "text_hash", "lo", "hi")).union(found)
    told = _with_text(docs, _merged(found).select("doc_id", "text_hash", F.struct("lo", "hi").alias("run")), "left")
    return told.select("doc_id", "text", "runs").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")

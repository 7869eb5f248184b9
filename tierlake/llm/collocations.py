r"""Phrase collocation mining with an FM-index per shard over word ids.

Shards. A task reads its documents into shards of at most ``SHARD_WORDS`` words,
one per language at a time and ``OPEN`` times that in all, and numbers the words of
each shard; pieces are divided by id 0. A piece that passes a shard's end goes on in the next one with
an overlap of ``longest - 1`` words, and the overlap is counted once more in a
shard with sign -1, so that the sums over shards are exact.

Index. ``Index`` sorts the positions of a shard by their next words (to the
longest phrase's depth, by prefix doubling) and keeps the Burrows-Wheeler column
in both directions. A phrase is a pair of intervals, one in each direction;
extending it by a word on one side takes that side's interval from the ranks in
the column and the other side's from the counts of smaller words in it. The
extensions of all phrases of a length are found at once, with their counts.

Sums. Counts are summed across shards level by level, each time only for what can
still be frequent: words; pairs of frequent words; phrases of three words whose
pairs are frequent; longer ones whose threes are. Word counts are windows over the
rows of the shards. The phrases of a shard are dealt by their hash into buckets, as
many as the occurrences ask for, and go packed, one row for each shard and bucket
(in order, the bytes of equal weight side by side, compressed); a bucket is summed at
once and answers each shard with one bit for each of its phrases, which the shard,
finding them again in the same order, takes for the frequent ones. Shards are kept in
buckets of their number, so that only the answers are shuffled to them. A shard holds
only its own words and phrases, and nothing is broadcast.

Scores use the summed counts: the lowest of the cuts' scores by decimals of 38
digits. A candidate lies inside a longer one of the needed count exactly if one of
its extensions by one word has that count, since the counts of the phrases between
the two lie between theirs.

Edge cases. Null and empty texts have no word; a null language is ``und``. Equal
documents all count. Ties of scores go to the larger count, then to the phrase in
byte order. Extra columns are ignored; an empty table gives no rows. A document of
any length is numbered in slices and dealt to as many shards as it needs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import bucketed, mix, prepare, saved, texts_of

SHARD_WORDS = 4_000_000
OPEN = 2  # shards' words at once in a task
SLICE = 1 << 20  # bytes that are split into words at a time
LOCAL_BITS = 25  # of a word's number within its shard
SHARD_BITS = 12  # of a shard's number within its task
BUCKET = 1 << 21  # counts that are summed at a time, at most about
MIN_BUCKETS = 32
#: Pieces end at these bytes; tabs are blanks; A-Z are lower-cased.
BREAKS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes(46 if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c < 91 else c for c in range(256))


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in slices; ``.`` stands between pieces."""
    text = text.translate(PIECES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].replace(b".", b" . ").split()
        at = end


class Shard:
    """Numbered words of one language; numbers start at 1 in order of appearance, 0 divides pieces."""

    def __init__(self, lang: str, sign: int):
        self.lang, self.sign, self.words, self.parts = lang, sign, 0, []
        self.number: dict[bytes, int] = defaultdict(lambda: len(self.number))
        self.number[b"."] = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.words += len(words)

    def row(self, shard: int) -> tuple:
        ids = np.concatenate([*self.parts, np.zeros(1, np.int32)])
        counts = self.sign * np.bincount(ids, minlength=len(self.number))[1:]
        packed = zstandard.ZstdCompressor(level=1).compress(ids.tobytes())
        return shard, self.lang, self.sign, [w.decode() for w in self.number][1:], counts.tolist(), packed


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), np.int32).astype(np.int64)


_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("sign", pa.int64()), ("words", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64())), ("ids", pa.binary())])


NUMBERED = "shard long, sign long, ids binary, gid array<long>"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _shards(batches: Iterator[pa.RecordBatch], longest: int, shard_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to shard rows. A language's shard is closed at ``shard_words`` words, all at ``OPEN`` times that."""
    first, n, total = TaskContext.get().partitionId() << SHARD_BITS, 0, 0
    open_: dict[tuple[str, int], Shard] = {}

    def shard(lang: str, sign: int) -> Shard:
        if (lang, sign) not in open_:
            open_[lang, sign] = Shard(lang, sign)
        return open_[lang, sign]

    def closed(of: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
        nonlocal n, total
        for own in [open_.pop(x) for x in of if x in open_]:
            if n >> SHARD_BITS or len(own.number) >> LOCAL_BITS:
                raise ValueError("too many shards in a task or words in a shard")
            yield _rows([own.row(first + n)], _SHARD)
            n += 1
        total = sum(x.words for x in open_.values())

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            tail: list[bytes] = []
            for words in word_slices(text):
                at = 0
                while at < len(words):
                    room = min(shard_words - shard(lang, 1).words, OPEN * shard_words - total)
                    if room <= 0:
                        yield from closed(list(open_) if total >= OPEN * shard_words else [(lang, 1), (lang, -1)])
                        if tail:  # the piece may go on: count the words before the cut in both shards, and once less
                            shard(lang, 1).add(tail)
                            shard(lang, -1).add([b".", *tail])
                        room = shard_words
                    part = words[at:at + room]
                    shard(lang, 1).add(part)
                    at, total = at + len(part), total + len(part)
                    tail = [*tail, *part[-(longest - 1):]][-(longest - 1):]
            if text:
                shard(lang, 1).add([b"."])
    yield from closed(list(open_))


class Index:
    """Two-way FM-index over word ids (0 divides pieces), exact for phrases of up to ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.n = len(ids)
        self.ahead = self._column(ids, depth)  # to extend to the left
        self.back = self._column(ids[::-1], depth)  # to extend to the right
        # Both columns hold the same words, so a word's first row is the same in both.
        self.starts = np.searchsorted(np.sort(ids), np.arange(int(ids.max(initial=0)) + 2))

    def _column(self, ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The words before the sorted positions, and (word, row) sorted as one number each."""
        rank, n, known = ids, self.n, 1
        order = np.argsort(rank, kind="stable")
        while known < depth:
            later = np.zeros(n, np.int64)
            later[:n - known] = rank[known:] + 1
            both = rank * (max(n, int(rank.max())) + 2) + later
            order = np.argsort(both, kind="stable")
            new = np.ones(n, np.int64)
            new[1:] = both[order[1:]] != both[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            known *= 2
        column = ids[order - 1]
        return column, np.sort(column * n + np.arange(n))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words as phrases of one: (words, first row ahead, first row back, count)."""
        w = np.arange(1, len(self.starts) - 1)
        return w[:, None], self.starts[1:-1], self.starts[1:-1], np.diff(self.starts)[1:]

    def extend(self, phrases: tuple, left: bool) -> tuple:
        """Every phrase extended by each word that occurs on its ``left`` (else right) side, with counts."""
        words, ahead, back, count = phrases
        own, other = (ahead, back) if left else (back, ahead)
        column, ranks = self.ahead if left else self.back
        at = np.repeat(own - np.cumsum(count) + count, count) + np.arange(count.sum())
        width = int(column.max(initial=0)) + 1
        pairs, found = np.unique(np.repeat(np.arange(len(count)), count) * width + column[at], return_counts=True)
        of, word = np.divmod(pairs, width)
        # Rows of the other side: after those of smaller words on this side of the same phrase.
        before = np.cumsum(found) - found
        group = np.ones(len(of), bool)
        group[1:] = of[1:] != of[:-1]
        smaller = before - np.maximum.accumulate(np.where(group, before, 0)) if len(of) else before
        mine = np.searchsorted(ranks, word * self.n + own[of])
        theirs = other[of] + smaller
        new = np.column_stack([word, words[of]] if left else [words[of], word])
        real = word > 0
        out = (new, mine, theirs, found) if left else (new, theirs, mine, found)
        return tuple(x[real] for x in out)


def kept(phrases: tuple, keep: np.ndarray) -> tuple:
    return tuple(x[keep] for x in phrases)


def squeezed(ids: np.ndarray) -> np.ndarray:
    """One divider in place of neighbouring ones, and one at both ends."""
    ids = np.concatenate([[0], ids, [0]])
    return ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]


def pairs_of(index: Index) -> tuple:
    """The phrases of two words, in the order of their numbers."""
    return index.extend(index.words(), left=False)


def threes_of(index: Index) -> tuple:
    """The phrases of three words, in the order of their numbers."""
    phrases = index.extend(pairs_of(index), left=True)
    return kept(phrases, np.lexsort(phrases[0].T[::-1]))


_NUMBERED = pa.schema([("shard", pa.int64()), ("sign", pa.int64()), ("ids", pa.binary()), ("gid", pa.list_(pa.int64()))])


def _numbered(shard: int, sign: int, ids: np.ndarray, gid: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row of the shard with the words of ``ids`` alone, numbered from 1 by place in the sorted ``gid``; none if there are none."""
    own, ids = np.unique(np.concatenate([[0], ids]), return_inverse=True)
    if len(own) > 1:
        ids = squeezed(ids[1:]).astype(np.int32)
        yield _rows([(shard, sign, zstandard.ZstdCompressor(level=1).compress(ids.tobytes()), gid[own[1:] - 1])], _NUMBERED)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, sign, ids, local, gid of the frequent words); gives the shard's frequent words that stand beside another."""
    for batch in batches:
        for shard, sign, ids, local, gid in zip(*(c.to_pylist() for c in batch.columns)):
            ids, local, gid = unpacked(ids), np.array(local), np.array(gid)
            order = np.argsort(gid)
            number = np.zeros(int(max(ids.max(), local.max())) + 1, np.int64)
            number[local[order]] = np.arange(1, len(local) + 1)
            ids = number[ids]
            two = (ids[:-1] > 0) & (ids[1:] > 0)
            yield from _numbered(shard, sign, np.where(np.append(two, False) | np.insert(two, 0, False), ids, 0), gid[order])


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length: the first as differences, the bytes of equal weight side by side, compressed."""
    table = np.stack(columns).astype(np.int64)
    table[0] = np.diff(table[0], prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(table.view(np.uint8).reshape(len(table), -1, 8).transpose(0, 2, 1).tobytes())


def unpacked_columns(data: bytes, n: int) -> np.ndarray:
    """The ``n`` columns of ``packed``."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n, 8, -1)
    table = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(n, -1)
    return np.concatenate([np.cumsum(table[:1], axis=1), table[1:]])


def dealt(words: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of the phrases (rows of gids) by their bucket, in order within it."""
    h = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for column in words.T:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    h = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(h, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(h[order])) + 1):
        if len(places):
            yield int(h[places[0]]), places


_COUNTED = pa.schema([("size", pa.int32()), ("bucket", pa.int64()), ("shard", pa.int64()), ("counts", pa.binary())])
COUNTED = "size int, bucket long, shard long, counts binary"


def _counted(shard: int, words: np.ndarray, count: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases (rows of gids) of a shard with their counts, a row for each bucket."""
    rows = [(words.shape[1], bucket, shard, packed(*words[at].T, count[at])) for bucket, at in dealt(words, buckets)]
    if rows:
        yield _rows(rows, _COUNTED)


_SUMS = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("often", pa.binary()), ("key", pa.list_(pa.int64())), ("f", pa.int64())])
SUMS = "shard long, bucket long, often binary, key array<long>, f long"


def _totals(table: pa.Table, least: int) -> pa.Table:
    """Rows of one size and bucket, from all shards. Gives the phrases whose counts sum to ``least`` (key, f) and
    tells each shard that has some, by a bit for each phrase of its row, which they are (shard, bucket, often)."""
    size, bucket, shards = table["size"][0].as_py(), table["bucket"][0].as_py(), table["shard"].to_pylist()
    parts = [unpacked_columns(x, size + 1) for x in table["counts"].to_pylist()]
    ends = np.cumsum([p.shape[1] for p in parts])
    every = np.concatenate(parts, axis=1)
    order = np.lexsort(every[:size][::-1])
    new = np.ones(len(order), bool)
    new[1:] = (every[:size, order[1:]] != every[:size, order[:-1]]).any(axis=0)
    first = np.flatnonzero(new)
    f = np.add.reduceat(every[size][order], first)
    often = np.empty(len(order), bool)
    often[order] = (f >= least)[np.cumsum(new) - 1]
    told = [(s, bucket, np.packbits(o).tobytes(), None, None) for s, o in zip(shards, np.split(often, ends[:-1])) if o.any()]
    found = every[:size, order[first[f >= least]]].T
    return pa.Table.from_batches([_rows(told + [(None, None, None, k, n) for k, n in zip(found, f[f >= least])], _SUMS)] if told else [], _SUMS)


def _often(words: np.ndarray, buckets: int, told: list[dict]) -> np.ndarray:
    """Which of a shard's phrases, in the order of ``_counted``, are frequent over all shards."""
    told, often = {x["bucket"]: x["often"] for x in told}, np.zeros(len(words), bool)
    for bucket, at in dealt(words, buckets):
        if bucket in told:
            often[at] = np.unpackbits(np.frombuffer(told[bucket], np.uint8), count=len(at)) == 1
    return often


def _pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_frequent``; gives the counts of the pairs."""
    for batch in batches:
        for shard, sign, ids, gid in zip(*(c.to_pylist() for c in batch.columns)):
            words, _, _, count = pairs_of(Index(unpacked(ids), 2))
            yield from _counted(shard, np.array(gid)[words - 1], sign * count, buckets)


def _linked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_frequent`` and what is told of the pairs; gives the shard's words that stand in three of which both
    pairs are frequent, divided where a pair is not."""
    for batch in batches:
        for shard, sign, ids, gid, told in zip(*(c.to_pylist() for c in batch.columns)):
            ids, gid = unpacked(ids), np.array(gid)
            real = (ids[:-1] > 0) & (ids[1:] > 0)
            code, at = np.unique(ids[:-1][real] * (len(gid) + 1) + ids[1:][real], return_inverse=True)
            words = np.column_stack(np.divmod(code, len(gid) + 1))
            joined = np.zeros(len(ids) + 2, bool)  # at i + 1: the words at i and i + 1 are a frequent pair
            joined[1:-2][real] = _often(gid[words - 1], buckets, told)[at]
            three = joined[:-1] & joined[1:]  # at i: around the word at i
            near = np.concatenate([[False], three, [False]])
            ids = np.where(near[:-2] | near[1:-1] | near[2:], np.append(ids, 0), 0)
            # A divider after each word that does not go on.
            both = np.column_stack([ids, np.zeros_like(ids)]).reshape(-1)
            yield from _numbered(shard, sign, both[np.column_stack([np.ones(len(ids), bool), ~joined[1:]]).reshape(-1)], gid)


def _triples(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_linked``; gives the counts of the phrases of three words, whose pairs are all frequent."""
    for batch in batches:
        for shard, sign, ids, gid in zip(*(c.to_pylist() for c in batch.columns)):
            words, _, _, count = threes_of(Index(unpacked(ids), 3))
            yield from _counted(shard, np.array(gid)[words - 1], sign * count, buckets)


def _among(codes: np.ndarray, width: int, words: np.ndarray) -> np.ndarray:
    """Which rows of ``words`` (numbers from 1) are one of the phrases with these sorted codes."""
    code = _codes(width, words)
    return codes[np.minimum(np.searchsorted(codes, code), len(codes) - 1)] == code


def _codes(width: int, words: np.ndarray) -> np.ndarray:
    code = np.zeros(len(words), np.int64)
    for column in words.T:
        code = code * width + column
    return code


def _longer(batches: Iterator[pa.RecordBatch], longest: int, buckets: int, buckets_3: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_linked`` and what is told of the threes; gives the counts of the phrases of four words and more
    whose threes are all frequent."""
    for batch in batches:
        for shard, sign, ids, gid, told in zip(*(x.to_pylist() for x in batch.columns)):
            gid, width = np.array(gid), len(gid) + 1
            index = Index(unpacked(ids), longest)
            phrases, left = threes_of(index), False
            phrases = kept(phrases, _often(gid[phrases[0] - 1], buckets_3, told))
            threes = _codes(width, phrases[0])
            for _ in range(4, longest + 1):
                phrases = index.extend(phrases, left)
                phrases = kept(phrases, _among(threes, width, phrases[0][:, :3] if left else phrases[0][:, -3:]))
                left = not left
                order = np.lexsort(phrases[0].T[::-1])
                yield from _counted(shard, gid[phrases[0][order] - 1], sign * phrases[3][order], buckets)


def _buckets(found: DataFrame) -> int:
    """For the phrases one word longer than those ``found`` (f): they have no more rows than these occur."""
    return max(MIN_BUCKETS, -(-(found.agg(F.sum("f")).first()[0] or 0) // BUCKET))


def _sums(counted: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases (key, f), and a row a shard with what is told of its phrases (shard, told)."""
    sums = saved(counted.groupBy("size", "bucket").applyInArrow(lambda table: _totals(table, least), SUMS))
    told = sums.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("bucket", "often")).alias("told"))
    return sums.where("f is not null").select("key", "f"), told


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``words`` (gid, lang, word, f), ``phrases`` (key: gids of 2 to ``longest`` words, f) that occur ``least``
    times or more in the pieces of their language, and ``totals`` (lang, n)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    # A task makes a shard or more of each of its languages.
    parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * rows.rdd.getNumPartitions() + 1)
    shards = bucketed(rows.mapInArrow(partial(_shards, longest=longest, shard_words=shard_words),
                                      "shard long, lang string, sign long, words array<string>, counts array<long>, ids binary"), "shard", parts)
    used = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w")).select(
        "lang", F.col("w.words").alias("word"), F.col("w.counts").alias("count"),
        (F.col("shard") * F.lit(1 << LOCAL_BITS) + F.col("pos") + 1).alias("own"))
    totals = used.groupBy("lang").agg(F.sum("count").alias("n"))
    of_word = Window.partitionBy("lang", "word")
    frequent = used.select("own", F.min("own").over(of_word).alias("gid"), "lang", "word", F.sum("count").over(of_word).alias("f"))
    frequent = saved(frequent.where(F.col("f") >= least).select(
        F.shiftright("own", LOCAL_BITS).alias("shard"), (F.col("own") % (1 << LOCAL_BITS)).alias("local"), "gid",
        *(F.when(F.col("own") == F.col("gid"), F.col(c)).alias(c) for c in ("lang", "word", "f"))))  # a word is spelled once
    words = frequent.where("f is not null").select("gid", "lang", "word", "f")
    by_shard = frequent.groupBy("shard").agg(F.collect_list(F.struct("local", "gid")).alias("own"))
    numbered = bucketed(shards.select("shard", "sign", "ids").join(by_shard, "shard").select(
        "shard", "sign", "ids", "own.local", "own.gid").mapInArrow(_frequent, NUMBERED), "shard", parts)
    n = _buckets(words)
    found, told = _sums(numbered.mapInArrow(partial(_pairs, buckets=n), COUNTED), least)
    phrases = found
    if longest > 2:
        linked = bucketed(numbered.join(told, "shard").mapInArrow(partial(_linked, buckets=n), NUMBERED), "shard", parts)
        n = _buckets(found)
        found, told = _sums(linked.mapInArrow(partial(_triples, buckets=n), COUNTED), least)
        phrases = phrases.unionByName(found)
    if longest > 3:
        longer = partial(_longer, longest=longest, buckets=_buckets(found), buckets_3=n)
        found, _ = _sums(linked.join(told, "shard").mapInArrow(longer, COUNTED), least)
        phrases = phrases.unionByName(found)
    return words, saved(phrases), totals


#: floor(1000 a n / (l r)) of long columns: the products have up to 38 digits, the quotient fits a long as a <= l, r.
CUT_SCORE = ("(1000BD * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) "
             "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, inside: int = 100, top: int = 2_000,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each
    language, without those inside a longer one that has ``inside`` percent of their count or more."""
    words, phrases, totals = frequent_phrases(docs, longest, least, shard_words)
    known = phrases.unionByName(words.select(F.array("gid").alias("key"), "f"))
    part = known.select(F.col("key").alias("part"), F.col("f").alias("part_f"))
    size = F.size("key")
    cuts = phrases.select("key", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select(
        "key", "f", "cut", F.explode(F.array(
            F.struct(F.lit("l").alias("side"), F.slice("key", F.lit(1), F.col("cut")).alias("part")),
            F.struct(F.lit("r").alias("side"), F.slice("key", F.col("cut") + 1, size - F.col("cut")).alias("part")))).alias("s"),
    ).select("key", "f", "cut", "s.side", "s.part").join(part, "part").groupBy("key", "f", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("part_f"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("part_f"))).alias("r"))
    longer = phrases.where(size > 2)
    largest = longer.select("f", F.explode(F.array(
        F.slice("key", F.lit(1), size - 1), F.slice("key", F.lit(2), size - 1))).alias("key")).groupBy("key").agg(
        F.max("f").alias("longer_f"))
    spelled = phrases.select("key", F.posexplode("key").alias("pos", "gid")).join(
        words.select("gid", "lang", "word"), "gid").groupBy("key").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    scored = cuts.join(spelled, "key").join(totals, "lang").select(
        "lang", "key", "phrase", F.col("f").alias("a"), "cut", "l", "r", "n").withColumn("score", F.expr(CUT_SCORE))
    best = scored.groupBy("lang", "key", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    best = best.join(largest, "key", "left").where(F.col("longer_f").isNull() | (100 * F.col("longer_f") < inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")

"""Token counts with overlap resynchronisation.

Texts are encoded whole, in batches. A huge text is encoded in overlapping
chunks with offsets: two neighbouring characters that no piece of the
vocabulary holds side by side can never be merged into one piece, so the
encoding on one side of such a boundary does not depend on the other side.
Chunks are cut at these proven boundaries; each is encoded with some overlap on
both sides, its tokens are spliced where the boundary is also a token boundary
of the chunk's own encoding, and the overlap is doubled where it is not (at
last, the text is encoded whole). Where a text has no proven boundary after a
cut, the search window is widened up to the end of the text. Memory per task is
bounded by a chunk; nothing is shuffled.

Edge cases. Null and empty texts have no token. Repeated rows get equal counts.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.common import prepare

CHUNK = 32_768  # characters; longer texts are huge
OVERLAP = 64
LIMIT = 4_096  # tokens
MARK = "▁"  # the vocabulary's space


class Counter:
    """Counts tokens with a sentencepiece model without text normalisation."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        self.joined = set()
        for i in range(self.sp.get_piece_size()):
            if not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i)):
                piece = self.sp.id_to_piece(i)
                self.joined.update(zip(piece, piece[1:]))

    def stable(self, text: str, start: int) -> int:
        """The first proven boundary at or after ``start``; the text's end if there is none."""
        width, n = self.overlap, len(text)
        while start < n:
            part = text[start - 1:start + width].replace(" ", MARK)
            for i in range(1, len(part)):
                if (part[i - 1], part[i]) not in self.joined:
                    return start + i - 1
            start, width = start + len(part) - 1, 2 * width
        return n

    def starts(self, text: str) -> list[int]:
        """UTF-8 offsets at which the text's tokens start."""
        return [p.begin for p in self.sp.encode(text, return_type="proto", num_threads=1).pieces]

    def huge(self, text: str) -> int:
        total, left, n = 0, 0, len(text)
        while left < n:
            right = self.stable(text, left + self.chunk) if left + self.chunk < n else n
            overlap = self.overlap
            while True:
                a, b = max(0, left - overlap), min(n, right + overlap)
                starts = self.starts(text[a:b])
                begins = set(starts)
                low = len(text[a:left].encode())
                high = low + len(text[left:right].encode())
                if (not left or low in begins) and (right == n or high in begins):
                    break
                if not a and b == n:
                    return len(self.sp.encode(text, num_threads=1))
                overlap *= 2
            total += sum(low <= s < high or right == n and s >= low for s in starts)
            left = right
        return total

    def counts(self, texts: list[str]) -> list[int]:
        short = [t if len(t) <= self.chunk else "" for t in texts]
        out = [len(ids) for ids in self.sp.encode(short, num_threads=1)] if short else []
        return [n if len(t) <= self.chunk else self.huge(t) for n, t in zip(out, texts)]


def _counts(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    counter = Counter(path)
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        n = counter.counts(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
             pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``docs``. ``model_path`` is a sentencepiece model
    that every executor can open at that path."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        partial(_counts, path=model_path, limit=limit),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")

"""Best-fit packing of token sequences: bounded-space online best-fit.

Each task packs its documents as they come, piece after piece. A fixed number of bins is open, kept by their free space in
a bitset; a piece goes to the open bin with the least space that holds it, found by one shift (of equal ones to the latest).
If none does, a new bin opens, and when that is one too many, the fullest closes. Only pieces of documents longer than a
sequence are cut.

A task's memory is its open bins and one slice; sequences never span tasks, so their number is above the least by part of
the open bins of each task only, and no shuffle is needed. Null texts count as empty; an empty document is one end token.
Each of repeated rows is packed; an empty table gives an empty one; columns that are kept may have any names, one with a
new column's name is called kept_ and that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import column, ship, slices
from .bpe import encoder

SIZE, OPEN_BINS, END_ID = 2048, 1024, 0


class OpenBins:
    """At most `limit` open bins of `size` tokens."""

    def __init__(self, size: int = SIZE, limit: int = OPEN_BINS, first: int = 0):
        self.size, self.limit, self.next = size, limit, first
        self.bits, self.open = 0, 0  # bit f is set if an open bin has f tokens free
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        """The bin that a piece goes to and its place there."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, b = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(b)
            self.open += 1
        return b, self.size - free


def pack_slice(bins: OpenBins, rows: list[bytes], size: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Row, piece, start, length, bin and offset of each piece of the rows' ids (4 bytes each), in their order."""
    for i, ids in enumerate(rows):
        n = len(ids) >> 2
        for start in range(0, n, size):
            length = min(size, n - start)
            b, offset = bins.place(length)
            yield i, start // size, start, length, b, offset


def pack(df: DataFrame, path: str, keep: list[str], text_col: str = "text", size: int = SIZE, open_bins: int = OPEN_BINS, end_id: int = END_ID) -> DataFrame:
    """For each piece: keep, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id and offset in it.

    path: of the tokenizer file. Each document's ids are followed by end_id.
    """
    ship(df.sparkSession)
    inner = df.select(*[column(c).alias(f"k{i}") for i, c in enumerate(keep)], column(text_col).cast("string").alias("text"))
    new = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]
    fields = [T.StructField(f"k{i}", inner.schema[f"k{i}"].dataType) for i in range(len(keep))] + [T.StructField(f"o{i}", t) for i, (_, t) in enumerate(new)]
    end, kinds = end_id.to_bytes(4, "little"), [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        bins = OpenBins(size, open_bins, TaskContext.get().partitionId() << 33)
        for batch, texts in slices(batches):
            rows = [ids + end for ids in encoder(path, library=True).encode(texts)]
            placed = list(pack_slice(bins, rows, size))
            at = pa.array([p[0] for p in placed], pa.int64())
            values = ([p[1] for p in placed], [p[2] for p in placed], [p[3] for p in placed], [rows[p[0]][4 * p[2] : 4 * (p[2] + p[3])] for p in placed], [p[4] for p in placed], [p[5] for p in placed])
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}").take(at) for i in range(len(keep))], *[pa.array(v, k) for v, k in zip(values, kinds, strict=True)]], names=[f.name for f in fields])

    names = [n for n, _ in new]
    return inner.mapInArrow(run, T.StructType(fields)).toDF(*[f"kept_{c}" if c.lower() in names else c for c in keep], *names)

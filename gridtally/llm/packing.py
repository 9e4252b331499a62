"""Best-fit packing with a bounded number of open bins.

Each task packs its own pieces online: a piece goes to the open bin whose free
space fits it most tightly, found in a bitset keyed by free space; beyond the
bound the fullest bin closes.  The pieces of bins that are still open at the end of a task
come to a second round, in which those of some tasks are packed together by the same packer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import checkpoint, ship, text_or_empty
from gridtally.llm.tokens import default_vocabulary, encoder

OPEN_BINS = 1024
#: Texts encoded and packed at a time.
BATCH_CHARS = 1 << 20
#: Tasks whose open bins meet in one task of the second round: the pieces of at most TOGETHER * OPEN_BINS bins.
TOGETHER = 16


class BestFit:
    """Open bins by free space.  ``bits`` has bit f set where a bin with f free places is open."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        name = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.count -= 1
        return name

    def add(self, length: int) -> tuple[int, int]:
        """(bin, place in it) for a piece of this length."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1  # the lowest bit set: the tightest fit
            name = self._take(free)
        else:
            free, name = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.count >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.by_free.setdefault(left, []).append(name)
            self.bits |= 1 << left
            self.count += 1
        return name, self.capacity - free

    def still_open(self) -> dict[int, int]:
        """Open bin -> what it holds."""
        return {name: self.capacity - free for free, names in self.by_free.items() for name in names}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones of the capacity, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def _pack_partition(path: str, capacity: int, open_bins: int, end_id: int, keep_ids: bool):
    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        task = TaskContext.get().partitionId()
        bins, end = BestFit(capacity, open_bins), np.array([end_id], dtype="<u4").tobytes()
        held: list[tuple] = []

        def rows(ids, texts):
            for doc, body in zip(ids, encoder(path).many(texts), strict=True):
                body += end
                for k, (start, length) in enumerate(cut(len(body) // 4, capacity)):
                    own = body[4 * start: 4 * (start + length)]
                    name, at = bins.add(length)
                    held.append((doc, k, start, length, zlib.crc32(own), task, name, at, 0,
                                 np.frombuffer(own, dtype="<i4") if keep_ids else None))

        columns = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "bin", "at", "fill", "ids"]
        for f in frames:
            ids, texts, size, first = f["doc_id"].tolist(), f["text"].tolist(), 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BATCH_CHARS or i == len(texts) - 1:
                    rows(ids[first:i + 1], texts[first:i + 1])
                    size, first = 0, i + 1
                    yield pd.DataFrame(held, columns=columns)
                    held.clear()
        # One row for each bin that is still open, with what it holds.
        held += [(None, -1, 0, 0, 0, task, name, 0, fill, None) for name, fill in bins.still_open().items()]
        yield pd.DataFrame(held, columns=columns)
    return run


def _second_round(capacity: int, open_bins: int, columns: list[str]):
    """Pieces of open bins once more, by the same packer.  As many as would fill ``open_bins`` bins are taken at a time, as the tasks
    left them, and handed over the longest first; so the bound holds here too, and hardly a bin closes before it is full."""
    def run(frame):
        frame = frame.sort_values(["task", "bin", "at"])
        frame["run"] = (frame["length"].cumsum() - frame["length"]) // (capacity * open_bins)
        frame = frame.sort_values(["run", "length"], ascending=[True, False], kind="stable")
        names, places, made = [], [], 0
        for _, lengths in frame.groupby("run", sort=True)["length"]:
            bins = BestFit(capacity, open_bins)
            for n in lengths:
                name, at = bins.add(n)
                names.append(made + name)
                places.append(at)
            made += bins.made
        return frame.assign(bin=names, at=places)[columns]
    return run


def pack(docs: DataFrame, capacity: int = 2048, open_bins: int = OPEN_BINS, vocabulary: str | None = None,
         end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset), and ``ids`` if asked for.

    A document is its ids and ``end_id``; only longer ones than ``capacity`` are cut, so that all but the first piece
    are full.  ``sequence_id`` names a sequence of at most ``capacity`` ids, ``offset`` the piece's place in it; a
    sequence has no gap.  ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers.

    Null and empty texts are documents of ``end_id`` alone.  Repeated rows are packed each, null ids kept; an empty
    table gives no row.  Other columns are not read.
    """
    ship(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, bin bigint, "
              "at bigint, fill bigint, ids array<int>")
    first = checkpoint(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
        .mapInPandas(_nullable(_pack_partition(path, capacity, open_bins, end_id, keep_ids)), schema))
    opened = first.where("piece < 0").select("task", "bin", F.lit(True).alias("opened"))
    pieces = first.where("piece >= 0").drop("fill").join(opened, ["task", "bin"], "left").withColumn(
        "together", F.floor(F.col("task") / TOGETHER))
    again = pieces.where("opened")
    again = again.groupBy("together").applyInPandas(_nullable_frame(_second_round(capacity, open_bins, again.columns)), again.schema)
    # Numbers of the two rounds do not meet: a closed bin is even, one of the second round odd.
    closed = F.shiftleft(F.col("task"), 33) + F.col("bin") * 2
    joined = F.shiftleft(F.col("together"), 33) + F.col("bin") * 2 + 1
    return pieces.where("opened IS NULL").unionByName(again).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.when(F.col("opened"), joined).otherwise(closed).alias("sequence_id"), F.col("at").alias("offset"),
        *(["ids"] if keep_ids else []))


def _nullable_frame(run):
    return lambda frame: run(frame).assign(doc_id=lambda f: f["doc_id"].astype("Int64"))


def _nullable(run):
    """pandas turns ids with nulls into floats; keep them whole numbers."""
    def wrapped(frames: Iterator) -> Iterator:
        exact = (f.assign(doc_id=f["doc_id"].astype("Int64").astype(object).where(f["doc_id"].notna(), None)) for f in frames)
        for out in run(exact):
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))
    return wrapped

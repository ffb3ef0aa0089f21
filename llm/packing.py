"""Best-fit packing of documents into fixed-length sequences.

Documents are tokenized, cut only where longer than a sequence, and range-sorted
by length, which gives every piece its rank among the pieces of its length. The
matching is a loop on the driver, one round per length, longest first. A round sweeps
the gaps upwards from its length, gives the smallest fitting gaps to the lowest
ranks (ranks resolve who gets which gap), and puts the used gaps back at their new
size. Equal gaps and equal pieces are runs, so the state of a round is at most one
histogram of `capacity` sizes however many documents there are; that is all the
driver holds. The rows find their place by (length, rank) in the table of runs.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.chunks import file_encoder
from llm.common import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# length, first rank, pieces, first sequence, pieces per sequence, offset
RUN = np.dtype([(n, np.int64) for n in ("length", "rank", "n", "sequence", "each", "offset")])


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: at most capacity tokens, only the first may be shorter.

    A null or empty text is the end id alone. Texts are encoded whole. A null id
    stays null; repeated rows are packed once each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = file_encoder(tokenizer)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for key, ids in zip(keys, encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids = np.append(ids, end_id).astype("<u4")
                start, first = 0, len(ids) % capacity or capacity
                for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                    rows.append((key, k, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start = end
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        encoder.forget()  # the worker lives on beside other stages

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """The runs that best-fit-decreasing makes of so many pieces of each length."""
    gaps: list[deque] = [deque() for _ in range(capacity + 1)]
    open_gaps, opened, runs = 0, 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fitting = open_gaps >> length
            gap = length + (fitting & -fitting).bit_length() - 1 if fitting else capacity
            each = gap // length
            take = max(1, left // each)  # sequences to fill with `each` pieces, or one with what is left
            each = min(each, left)
            if fitting:
                first, size = gaps[gap].popleft()
                if size > take:
                    gaps[gap].appendleft((first + take, size - take))
                take = min(take, size)
                if not gaps[gap]:
                    open_gaps &= ~(1 << gap)
            else:
                first, opened = opened, opened + take
            runs.append((length, rank, take * each, first, each, capacity - gap))
            rank, left = rank + take * each, left - take * each
            rest = gap - each * length
            if rest:
                gaps[rest].append((first, take))
                open_gaps |= 1 << rest
    return np.array(runs, RUN)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (a `length` of 1 to capacity, `doc_id`, `piece`), gapless from 0.

    Pieces of one length are spread over several range partitions where they are
    many; equal rows may lie in either order, which changes no length. They are
    stored first: a range sort samples its input before it reads it.
    """
    names = pieces.columns
    pieces = stored(pieces, "pieces")
    ranged = pieces.repartitionByRange(F.desc("length"), "doc_id", "piece").sortWithinPartitions(F.desc("length"), "doc_id", "piece")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            if not len(lengths):
                continue
            first = np.flatnonzero(np.concatenate([[True], lengths[1:] != lengths[:-1]]))
            within = np.arange(len(lengths)) - np.repeat(first, np.diff(np.append(first, len(lengths))))
            if lengths[0] == last:
                within[: first[1] if len(first) > 1 else len(lengths)] += seen
            last, seen = lengths[-1], int(within[-1]) + 1
            arrays = [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(within)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "_part", "_within"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    numbered = stored(ranged.mapInArrow(number, f"{kinds}, _part int, _within long"), "packing")
    # One row per range partition and length in it: the partitions plus the lengths, at most.
    found = numbered.groupBy("length", "_part").count().collect()
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for length, part, n in sorted(map(tuple, found)):
        before[length, part] = counts.get(length, 0)
        counts[length] = before[length, part] + n
    runs = best_fit(counts, capacity)
    order = runs["length"] << 40 | runs["rank"]
    runs = runs[np.argsort(order)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs["length"] << 40 | runs["rank"]
        for batch in batches:
            lengths, parts = batch.column("length").to_numpy(), batch.column("_part").to_numpy()
            shift = np.fromiter((before[k] for k in zip(lengths.tolist(), parts.tolist(), strict=True)), np.int64, len(lengths))
            ranks = batch.column("_within").to_numpy() + shift
            run = runs[np.searchsorted(keys, lengths << 40 | ranks, side="right") - 1]
            sequence, nth = np.divmod(ranks - run["rank"], run["each"])
            arrays = [batch.column(n) for n in names]
            arrays += [pa.array(run["sequence"] + sequence), pa.array(run["offset"] + nth * lengths)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")

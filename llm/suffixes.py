"""Substring dedup on bytes: prefix doubling over sampled suffixes.

A full suffix array has a row per byte. Here suffixes are ranked at sampled
positions only: in every THRESHOLD bytes the one whose first SEED bytes hash least,
so equal strings of the threshold have their sample at the same place.

Round 0 ranks the samples by their first SEED bytes. The next round ranks pairs
(rank at the position, rank at the position an offset later), which is past the
threshold already: both cover SEED bytes and the offset makes up the rest. Unique
ranks drop out after each round; what stays equal is covered whole. The ends of the
repeats, which lie between samples, are settled by ranking every threshold string
around the samples there, again by a pair: its halves at offset 0 and THRESHOLD / 2.

Every ranking is an exchange of packed records by hash. A task shows the others one
record of each value in its batch, so a string that a third of all documents share
costs a record per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import document_keys, real_id, spread_of, stored
from llm.passages import by_bucket

THRESHOLD, SEED = 400, 273
REACH = THRESHOLD - SEED + 1  # sampled positions are at most so far apart; a power of two
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 2**64)
SPOT = np.dtype([("h", "<u8"), ("at", "<u4"), ("n", "<u4")])
HEAD = np.dtype([("h", "<u8"), ("id", "<i8"), ("th", "<i4"), ("at", "<u4"), ("n", "<u4")])
# Records a map task packs at a time, and how many more buckets the many strings at the ends of repeats take.
HELD, FINER = 400_000, 4
PACKED = "bucket int, known boolean, heads binary, hashes binary, several binary"
SPOTS = "id long, th int, spots binary"


class Powers:
    """Powers of the base and its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.table = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = _powers(BASE, size), _powers(INVERSE, size)

    def prefixes(self, data: bytes) -> np.ndarray:
        self.upto(len(data) + 1)
        values = self.table[np.frombuffer(data, np.uint8)] * self.up[: len(data)]
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def strings(self, prefixes: np.ndarray, starts: np.ndarray | slice, length: int) -> np.ndarray:
        """Hash of the string of that length at each start."""
        ends = prefixes[length:][starts] if isinstance(starts, slice) else prefixes[starts + length]
        begun = prefixes[: len(prefixes) - length][starts] if isinstance(starts, slice) else prefixes[starts]
        down = self.down[: len(prefixes) - length][starts] if isinstance(starts, slice) else self.down[starts]
        return _mixed((ends - begun) * down)


def _powers(base: int, size: int) -> np.ndarray:
    """base to the 0, 1, ... modulo 2^64."""
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def samples(powers: Powers, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix hashes, hash of each SEED-byte string, sampled position of each THRESHOLD-byte string)."""
    prefixes = powers.prefixes(data)
    grams = powers.strings(prefixes, slice(None), SEED)
    least = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < REACH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return prefixes, grams, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _records(buckets: int, runs: bool, keys: np.ndarray, hashes: np.ndarray, heads: np.ndarray) -> pa.RecordBatch:
    """Packs places (heads, n = 1) with the hash to compare and the key that picks the bucket.

    Equal hashes have equal keys. Of each hash one place is shown to the others, marked if it isn't
    the only one; the rest are known to repeat and only travel on. runs: consecutive places share a head.
    """
    order = np.lexsort((heads["at"], heads["th"], heads["id"], hashes))
    keys, hashes, heads = keys[order], hashes[order], heads[order]
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    lead = heads[np.flatnonzero(first)[np.cumsum(first) - 1]]
    # A repeated row is the same place, not another one.
    other = (lead["id"] != heads["id"]) | (lead["th"] != heads["th"]) | (lead["at"] != heads["at"])
    several = np.logical_or.reduceat(other, np.flatnonzero(first)) if len(heads) else np.empty(0, bool)
    rest, rows = _merged(heads[other]) if runs else heads[other], []
    for b, at in by_bucket((rest["id"] ^ rest["th"]) % buckets, buckets):
        rows.append((b, True, rest[at].tobytes(), b"", b""))
    keys, hashes, heads = keys[first], hashes[first], heads[first]
    order = np.lexsort((heads["at"], heads["th"], heads["id"]))
    keys, hashes, heads, several = keys[order], hashes[order], heads[order], several[order]
    for b, at in by_bucket((keys % np.uint64(buckets)).astype(int), buckets):
        own = heads[at]
        joint = (own["id"][1:] == own["id"][:-1]) & (own["th"][1:] == own["th"][:-1]) & (own["at"][1:] == own["at"][:-1] + 1)
        begin = np.flatnonzero(np.concatenate([[True], ~(joint & runs)]))
        short = own[begin]
        if runs:
            short["n"] = np.diff(np.append(begin, len(own)))
        rows.append((b, False, short.tobytes(), hashes[at].tobytes(), several[at].tobytes()))
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "known", "heads", "hashes", "several"]
    )


def _merged(heads: np.ndarray) -> np.ndarray:
    """One head for each run of consecutive places, with its length in n."""
    heads = heads[np.lexsort((heads["at"], heads["th"], heads["id"]))]
    joint = (heads["id"][1:] == heads["id"][:-1]) & (heads["th"][1:] == heads["th"][:-1]) & (heads["at"][1:] == heads["at"][:-1] + 1)
    begin = np.flatnonzero(np.concatenate([[True], ~joint])) if len(heads) else np.empty(0, int)
    out = heads[begin]
    out["n"] = np.diff(np.append(begin, len(heads)))
    return out


def _reduce(strings: bool) -> Callable:
    """Places whose hash isn't unique, packed per document. strings: heads stand for runs of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, hashes, marks, known = [np.empty(0, HEAD)], [np.empty(0, np.uint64)], [np.empty(0, bool)], [np.empty(0, HEAD)]
        for batch in batches:
            for sure, head, values, several in zip(*(batch.column(c).to_pylist() for c in PLACES), strict=True):
                (known if sure else heads).append(np.frombuffer(head, HEAD))
                hashes.append(np.frombuffer(values, np.uint64))
                marks.append(np.frombuffer(several, bool))
        heads, hashes, repeated, known = (np.concatenate(x) for x in (heads, hashes, marks, known))
        places = heads
        if strings:
            places = np.repeat(heads, heads["n"])
            places["at"] += (np.arange(len(places)) - np.repeat(np.cumsum(heads["n"]) - heads["n"], heads["n"])).astype(np.uint32)
            places["n"] = 1
        order = np.argsort(hashes, kind="stable")
        places, hashes, repeated = places[order], hashes[order], repeated[order]
        # Not the only place of its hash: another batch has it at another place. A repeated row is the same place.
        first = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.empty(0, bool)
        if len(hashes):
            begin = np.flatnonzero(first)
            lead = places[begin[np.cumsum(first) - 1]]
            other = (lead["id"] != places["id"]) | (lead["th"] != places["th"]) | (lead["at"] != places["at"])
            group = np.logical_or.reduceat(other | repeated, begin)
            repeated = group[np.cumsum(first) - 1]
        found = places[repeated]
        if strings:
            found = np.concatenate([_merged(found), known])
            found["n"] += THRESHOLD - 1  # bytes that a run of strings covers
        else:
            found = np.concatenate([found, known])
        order = np.lexsort((found["at"], found["th"], found["id"]))
        found = found[order]
        if not len(found):
            return
        cut = np.flatnonzero(np.concatenate([[True], (found["id"][1:] != found["id"][:-1]) | (found["th"][1:] != found["th"][:-1])]))
        spots = np.empty(len(found), SPOT)
        for name in SPOT.names:
            spots[name] = found[name]
        blobs = [x.tobytes() for x in np.split(spots, cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found["id"][cut]), pa.array(found["th"][cut]), pa.array(blobs, pa.binary())], names=["id", "th", "spots"]
        )

    return run


PLACES = ("known", "heads", "hashes", "several")


def _heads(key: int, th: int, at: np.ndarray, h: np.ndarray | int = 0, n: np.ndarray | int = 1) -> np.ndarray:
    heads = np.empty(len(at), HEAD)
    heads["id"], heads["th"], heads["at"], heads["h"], heads["n"] = key, th, at, h, n
    return heads


def _map(buckets: int, runs: bool, places: Callable) -> Callable:
    """places(row values) gives (keys, hashes, heads) of one document, or nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            parts, held = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part := places(powers, *row):
                    parts.append(part)
                    held += len(part[0])
                if held >= HELD:
                    yield _records(buckets, runs, *(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts, held = [], 0
            if parts:
                yield _records(buckets, runs, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    return run


def _seed_places(powers: Powers, key: int, th: int, data: bytes):
    if len(data) >= THRESHOLD:
        _, grams, sampled = samples(powers, data)
        at = np.unique(sampled)
        # The room behind the sample stands in n.
        return grams[at], grams[at], _heads(key, th, at, grams[at], np.minimum(len(data) - at, THRESHOLD))
    return None


def _pair_places(_: Powers, key: int, th: int, found: list[bytes]):
    """Pairs of ranks: a sample with the first one that is far enough behind it to reach the threshold."""
    spots = np.sort(np.concatenate([np.frombuffer(x, SPOT) for x in found]), order="at")
    at = spots["at"].astype(np.int64)
    partner = np.minimum(np.searchsorted(at, at + THRESHOLD - SEED), len(at) - 1)
    offset = at[partner] - at
    fits = (offset >= THRESHOLD - SEED) & (offset <= SEED)  # the two strings leave no gap
    if not fits.any():
        return None
    later, spots, offset = spots["h"][partner[fits]], spots[fits], offset[fits]
    rank = _mixed(spots["h"] * np.uint64(BASE) + _mixed(later + offset.astype(np.uint64)))
    # The covered length stands in n.
    return rank, rank, _heads(key, th, spots["at"], rank, offset + SEED)


def _string_places(powers: Powers, key: int, th: int, data: bytes, shown: list[int]):
    """Strings of the threshold around the shown samples, ranked by the ranks of their halves."""
    prefixes, grams, sampled = samples(powers, data)
    wanted = np.zeros(len(grams), bool)
    wanted[shown] = True
    starts = np.flatnonzero(wanted[sampled])
    half = THRESHOLD // 2
    front, back = (powers.strings(prefixes, starts + k, half) for k in (0, half))
    return grams[sampled[starts]], _mixed(front * np.uint64(BASE) + back), _heads(key, th, starts)


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per sample with a repeated seed. open: some string of the threshold with it may reach bytes not yet covered."""
    for batch in batches:
        parts = [np.empty((0, 5), np.int64)]
        for key, th, found, covered in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spots = np.concatenate([np.frombuffer(x, SPOT) for x in found])
            at = spots["at"].astype(np.int64)
            left, right = np.maximum(at - (THRESHOLD - SEED), 0), at + spots["n"]
            open_bytes = np.concatenate([[0], np.cumsum(~_cover(int(right.max()), covered))])
            rows = np.empty((len(at), 5), np.int64)
            for k, column in enumerate((key, th, at, spots["h"].view(np.int64), open_bytes[right] > open_bytes[left])):
                rows[:, k] = column
            parts.append(rows)
        id_, th, at, h, reaches = np.concatenate(parts).T
        arrays = [pa.array(id_), pa.array(th.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(h), pa.array(reaches > 0)]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "th", "at", "h", "open"])


def _cover(n: int, spots: list[bytes] | None) -> np.ndarray:
    """Which of the first n bytes the spots cover."""
    change = np.zeros(n + 1, np.int64)
    for blob in spots or ():
        found = np.frombuffer(blob, SPOT)
        at = found["at"].astype(np.int64)
        np.add.at(change, np.minimum(at, n), 1)
        np.add.at(change, np.minimum(at + found["n"], n), -1)
    return np.cumsum(change[:-1]) > 0


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (bytes).

    Every byte in a string of THRESHOLD bytes that also starts elsewhere goes, in all its places. Null and
    empty texts have no bytes; null ids keep their row. Repeated rows (same id and text) are one document
    and don't repeat each other; equal texts under different ids do.
    """
    buckets = spread_of(docs.sparkSession)
    keyed = document_keys(docs, doc_id, text).withColumn("text", F.col("text").cast("binary"))

    def ranked(rows: DataFrame, places: Callable, purpose: str, strings: bool = False) -> DataFrame:
        n = buckets * FINER if strings else buckets
        moved = rows.mapInArrow(_map(n, strings, places), PACKED).repartition(n, "bucket")
        found = moved.mapInArrow(_reduce(strings), SPOTS).groupBy("id", "th").agg(F.collect_list("spots").alias("spots"))
        return stored(found, purpose)

    seeds = ranked(keyed, _seed_places, "suffix-seeds")
    pairs = ranked(seeds, _pair_places, "suffix-pairs")
    both = seeds.join(pairs.withColumnRenamed("spots", "covered"), ["id", "th"], "left")
    rows = stored(both.select("id", "th", "spots", "covered").mapInArrow(_sample_rows, "id long, th int, at int, h long, open boolean"), "suffix-samples")
    # A repeat that reaches open bytes in one document may lie inside covered ones of another: all samples of that rank show.
    shown = rows.join(rows.where("open").select("h").distinct(), "h", "left_semi").groupBy("id", "th").agg(F.collect_list("at").alias("shown"))
    ends = ranked(keyed.join(shown, ["id", "th"]).select("id", "th", "text", "shown"), _string_places, "suffix-ends", True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, data, covered, spots in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "covered", "spots")), strict=True):
                gone = _cover(len(data), covered) | _cover(len(data), spots)
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and bool(gone[0])))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if spans else data
                rows.append((key, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    removed = pairs.withColumnRenamed("spots", "covered").join(ends, ["id", "th"], "full")
    joined = keyed.join(removed, ["id", "th"], "left").select("id", "text", "covered", "spots")
    result = joined.mapInArrow(cut, RESULT).select(real_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    return result if with_bytes else result.drop("kept")

"""Substring dedup on words: seed and extend.

Seeds are winnowed: in every run of THRESHOLD words the SEED words with the least
hash are an anchor, so equal runs have equal anchors at equal places. Anchors are
joined on their hash; those that occur twice are extended both ways, by all splits
of the remaining words between left and right, and equal extensions are repeats.
Adjoining ones form the maximal repeats.

Each join packs its records by bucket in the map task and keeps, of what repeats
inside the task's batch, only the first for the others to see. A passage that a
third of all documents share is then one record per batch, not one per document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.chunks import OTHER_SPACE
from llm.common import document_keys, real_id, spread_of, stored

THRESHOLD, SEED = 20, 5
DOCUMENTS = 2000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
PLACE = np.dtype([("h", "<u8"), ("id", "<i8"), ("th", "<i4"), ("at", "<u4")])
HEAD = np.dtype([("id", "<i8"), ("th", "<i4"), ("at", "<u4"), ("n", "<u4")])
PACKED = "bucket int, known boolean, heads binary, hashes binary"
SPOTS = "id long, th int, spots binary"
HOMED = "home int, records binary"
SPOT = np.dtype([("id", "<i8"), ("th", "<i4"), ("at", "<u4")])


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of DOCUMENTS rows at most, which bounds what a map task packs at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, DOCUMENTS):
            yield batch.slice(start, DOCUMENTS)


def words_of(text: str) -> list[str]:
    return WORD.findall(text) if OTHER_SPACE.search(text) else text.split()


def _runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` words."""
    n = len(hashes) - length + 1
    out, factor = np.zeros(n, np.uint64), np.uint64(1)
    for k in range(length):
        out += hashes[k : k + n] * factor
        factor *= FACTOR
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def seeds(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, seed hashes, place of the anchor of each run of THRESHOLD words)."""
    with np.errstate(over="ignore"):
        hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        grams = _mixed(_runs(hashes, SEED))
    least = np.lib.stride_tricks.sliding_window_view(grams, THRESHOLD - SEED + 1).argmin(1)
    return hashes, grams, least + np.arange(len(least))


def by_bucket(buckets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its records)."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.searchsorted(buckets[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), order[cuts[b] : cuts[b + 1]]


def packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "known", "heads", "hashes"])


def spots(ids: np.ndarray, ths: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """One row per document: the places found in it."""
    order = np.lexsort((at, ths, ids))
    ids, ths, at = ids[order], ths[order], at[order].astype("<u4")
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1])])) if len(ids) else np.empty(0, int)
    blobs = [part.tobytes() for part in np.split(at, first[1:])] if len(ids) else []
    return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(ths[first]), pa.array(blobs, pa.binary())], names=["id", "th", "spots"])


def homed(ids: np.ndarray, ths: np.ndarray, at: np.ndarray, homes: int) -> pa.RecordBatch:
    """Places packed by the home of their document: rows follow the homes, not the documents."""
    found = np.empty(len(ids), SPOT)
    found["id"], found["th"], found["at"] = ids, ths, at
    rows = [(home, found[k].tobytes()) for home, k in by_bucket((found["id"] ^ found["th"]) % homes, homes)]
    columns = list(zip(*rows, strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], names=["home", "records"])


def _at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [np.frombuffer(x, SPOT) for batch in batches for x in batch.column("records").to_pylist()]
    found = np.concatenate([np.empty(0, SPOT), *parts])
    yield spots(found["id"], found["th"], found["at"])


def _map_seeds(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            parts = []
            for key, th, text in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "text")), strict=True):
                words = words_of(text)
                if len(words) < THRESHOLD:
                    continue
                _, grams, anchors = seeds(words)
                at = np.unique(anchors)
                part = np.empty(len(at), PLACE)
                part["h"], part["id"], part["th"], part["at"] = grams[at], key, th, at
                parts.append(part)
            if not parts:
                continue
            found = np.concatenate(parts)
            _, first, back, times = np.unique(found["h"], return_index=True, return_inverse=True, return_counts=True)
            rows = [(b, False, found[first[at]].tobytes(), (times[at] > 1).tobytes()) for b, at in by_bucket((found["h"][first] % np.uint64(buckets)).astype(int), buckets)]
            rest = np.ones(len(found), bool)
            rest[first] = False
            rest = found[rest & (times[back] > 1)]  # known to repeat; they only travel home
            rows += [(b, True, rest[at].tobytes(), b"") for b, at in by_bucket((rest["id"] ^ rest["th"]) % buckets, buckets)]
            yield packed(rows)

    return run


def _repeated_seeds(homes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, marks = [np.empty(0, PLACE)], [np.empty(0, bool)]
    for batch in batches:
        for known, heads, hashes in zip(*(batch.column(c).to_pylist() for c in ("known", "heads", "hashes")), strict=True):
            parts.append(np.frombuffer(heads, PLACE))
            marks.append(np.ones(len(parts[-1]), bool) if known else np.frombuffer(hashes, bool))
    found, several = np.concatenate(parts), np.concatenate(marks)
    del parts, marks
    order = np.argsort(found["h"], kind="stable")
    h = found["h"][order]
    same = h[1:] == h[:-1]
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    found = found[several]
    yield homed(found["id"], found["th"], found["at"], homes)


def _map_extensions(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hashes, anchors, places = [], [], []
            for key, th, text, found in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "text", "spots")), strict=True):
                words, wanted = words_of(text), np.unique(np.frombuffer(found, "<u4"))
                values, grams, anchor = seeds(words)
                start = np.flatnonzero(np.isin(anchor, wanted))
                with np.errstate(over="ignore"):
                    hashes.append(_runs(values, THRESHOLD)[start])
                anchors.append(grams[anchor[start]])
                place = np.empty(len(start), HEAD)
                place["id"], place["th"], place["at"], place["n"] = key, th, start, 1
                places.append(place)
            if not places:
                continue
            hashes, anchors, places = np.concatenate(hashes), np.concatenate(anchors), np.concatenate(places)
            order = np.lexsort((places["at"], places["th"], places["id"], hashes))
            hashes, anchors, places = hashes[order], anchors[order], places[order]
            later = _later(hashes, places)
            rows = [(b, True, places[later][at].tobytes(), b"") for b, at in by_bucket((places["id"][later] ^ places["th"][later]) % buckets, buckets)]
            hashes, anchors, places = hashes[~later], anchors[~later], places[~later]
            order = np.lexsort((places["at"], places["th"], places["id"]))
            hashes, anchors, places = hashes[order], anchors[order], places[order]
            for b, at in by_bucket((anchors % np.uint64(buckets)).astype(int), buckets):
                own = places[at]  # consecutive starts of a document share a head
                joint = (own["id"][1:] == own["id"][:-1]) & (own["th"][1:] == own["th"][:-1]) & (own["at"][1:] == own["at"][:-1] + 1)
                first = np.flatnonzero(np.concatenate([[True], ~joint]))
                heads = own[first]
                heads["n"] = np.diff(np.append(first, len(own)))
                rows.append((b, False, heads.tobytes(), hashes[at].tobytes()))
            yield packed(rows)

    return run


def _later(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of records in the order of hash and place: those whose hash was at another, earlier place."""
    if not len(hashes):
        return np.empty(0, bool)
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    lead = places[np.flatnonzero(first)[np.cumsum(first) - 1]]
    return (lead["id"] != places["id"]) | (lead["th"] != places["th"]) | (lead["at"] != places["at"])


def _repeated_extensions(homes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads, hashes, known = [np.empty(0, HEAD)], [np.empty(0, np.uint64)], [np.empty(0, HEAD)]
    for batch in batches:
        for sure, head, values in zip(*(batch.column(c).to_pylist() for c in ("known", "heads", "hashes")), strict=True):
            (known if sure else heads).append(np.frombuffer(head, HEAD))
            hashes.append(np.frombuffer(values, np.uint64))
    heads, hashes, known = np.concatenate(heads), np.concatenate(hashes), np.concatenate(known)
    places = np.repeat(heads, heads["n"])
    places["at"] += (np.arange(len(places)) - np.repeat(np.cumsum(heads["n"]) - heads["n"], heads["n"])).astype(np.uint32)
    order = np.lexsort((places["at"], places["th"], places["id"], hashes))
    places = places[order]
    found = np.concatenate([places[_later(hashes[order], places)], known])
    yield homed(found["id"], found["th"], found["at"], homes)


def exchange(packed_rows: DataFrame, buckets: int, reduce: Callable) -> DataFrame:
    """Records to their buckets, then all places of a document to its home, in one row."""
    found = packed_rows.repartition(buckets, "bucket").mapInArrow(partial(reduce, buckets), HOMED)
    return found.repartition(buckets, "home").mapInArrow(_at_home, SPOTS)


def repeats(docs: DataFrame) -> DataFrame:
    """(id, th, spots): starts, per document of (id, th, text), of the THRESHOLD-word runs that also start earlier."""
    buckets = spread_of(docs.sparkSession)
    anchors = stored(exchange(docs.mapInArrow(_map_seeds(buckets), PACKED), buckets, _repeated_seeds), "passage-seeds")
    seeded = docs.join(anchors, ["id", "th"]).select("id", "th", "text", "spots")
    return stored(exchange(seeded.mapInArrow(_map_extensions(buckets), PACKED), buckets, _repeated_extensions), "passages")


RESULT = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, then the columns named in carry and, if asked for, kept_text.

    kept_text is the text itself where nothing goes, else the kept words joined by spaces.
    Earlier means a smaller id (null smallest; under one id by the text's hash) or an earlier place in the
    same document. Null and empty texts have no words. Repeated rows are one document: it isn't earlier than
    itself, and each row gets its result.
    """
    carried = [f"_c{k}" for k in range(len(carry))]
    keyed = document_keys(docs, doc_id, text, dict(zip(carried, carry, strict=True)))
    found = repeats(keyed.select("id", "th", "text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "spots")), strict=True):
                words, removed = words_of(value), 0
                kept = " ".join(words)
                shown = value
                if starts:
                    change = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(np.frombuffer(starts, "<u4"))
                    np.add.at(change, at, 1)
                    np.add.at(change, at + THRESHOLD, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    removed = int(covered.sum())
                    kept = shown = " ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])
                digest = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(words), removed, digest, shown if with_text else None))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [batch.column(c) for c in ("id", *carried)] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", *carried, "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = keyed.join(found, ["id", "th"], "left").select("id", *carried, "text", "spots")
    kinds = "".join(f"{c} {t}, " for c, t in joined.dtypes if c in ("id", *carried))
    back = [F.col(c).alias(name) for c, name in zip(carried, carry, strict=True)]
    return joined.mapInArrow(cut, kinds + RESULT).select(real_id(), "n_words", "n_removed", "kept_sha256", *back, *["kept_text"] * with_text)

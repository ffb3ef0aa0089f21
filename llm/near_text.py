"""Near-duplicate texts by Order MinHash, verified by banded alignment.

The k-mers of a text are its five-word shingles, each labelled with its occurrence.
A sketch is the hash of the few least k-mers of a part of the hash range, put back
into text order: texts that differ by few edits share sketches, texts with the same
words in another order don't. Candidates share a sketch; the link is decided by an
alignment of the two shingle sequences inside the band that the threshold allows.

A bucket's members aren't compared pairwise: each text is compared with the lead it
shares most sketches with, linked texts become one component, and members of one bucket
that are still in different components are compared with each other if they share one of
their rarest shingles: sorted by rarity, two texts at the threshold can't miss each other
in so many shingles at the front as the threshold leaves open.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import connected_components, spread_of, stored, text_key
from llm.passages import words_of
from llm.suffixes import HELD, PACKED, SPOT, SPOTS, _heads, _map, _mixed, _reduce

SHINGLE, THRESHOLD = 5, 0.8
# The threshold as a fraction: sizes are compared in whole numbers, so that pairs at exactly the threshold are links.
PART, WHOLE = 4, 5
# Hash functions, parts of the hash range, least k-mers per part. A pair at the threshold shares a sketch with
# probability 0.8 ** LEAST, so it shares none of HASHES * PARTS with probability 5e-6.
HASHES, PARTS, LEAST = 10, 4, 6
CHUNK = 64  # partners that meet a lead's text in one group
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MARK = np.dtype([("h", "<u8"), ("id", "<i8"), ("n", "<u4")])
RARE = np.dtype([("h", "<u8"), ("texts", "<u4")])
SEEDS = _mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def labels(text: str) -> np.ndarray:
    """Hash of every shingle with its occurrence number, in text order; a text of fewer words is one shingle."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    values = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(SHINGLE, len(values))
    n = len(values) - size + 1
    out, factor = np.zeros(n, np.uint64), np.ones(1, np.uint64)
    for k in range(size):
        out += values[k : k + n] * factor
        factor = factor * FACTOR
    order = np.argsort(out, kind="stable")
    same = out[order]
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    nth = np.empty(n, np.uint64)
    nth[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return _mixed(out + nth * np.uint64(0xA24BAED4963EE407))


def sketches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sketch number, sketch hash) of the parts that hold any k-mer."""
    values = _mixed(marks * SEEDS[:, None])
    order = np.argsort(values, 1)
    ranked = np.take_along_axis(values, order, 1)
    limits = np.array([k * 2**64 // PARTS for k in range(PARTS)], np.uint64)
    starts = np.stack([np.searchsorted(row, limits) for row in ranked])
    ends = np.concatenate([starts[:, 1:], np.full((HASHES, 1), len(marks))], 1)
    at = starts[:, :, None] + np.arange(LEAST)
    inside = at < ends[:, :, None]
    places = np.take_along_axis(order, np.minimum(at, len(marks) - 1).reshape(HASHES, -1), 1).reshape(at.shape)
    places = np.sort(np.where(inside, places, len(marks)), 2)  # text order
    chosen = np.append(marks, np.uint64(0))[places]
    out = np.zeros(chosen.shape[:2], np.uint64)
    for k in range(LEAST):
        out = _mixed(out * FACTOR + chosen[:, :, k])
    out = out.ravel() + np.arange(HASHES * PARTS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    full = inside.any(2).ravel()
    return np.flatnonzero(full), out[full]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Aligned shingles over all shingles of both. Labels are unique in a text, so the best alignment is the longest
    increasing run of partners. A pair at the threshold aligns nothing farther apart than the band, which is
    (WHOLE - PART) / (WHOLE + PART) of both lengths."""
    if not len(a) or not len(b):
        return 0.0
    both = len(a) + len(b)
    band = (WHOLE - PART) * both // (WHOLE + PART)
    if abs(len(a) - len(b)) > band:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    partners = j[near][np.argsort(i[near])]
    aligned = len(partners)
    if WHOLE * aligned < PART * (both - aligned):
        return 0.0
    if (np.diff(partners) < 0).any():
        tails: list[int] = []
        for p in partners.tolist():
            k = bisect_left(tails, p)
            tails[k : k + 1] = [p]
        aligned = len(tails)
    return aligned / (both - aligned)


def _places(_, node: int, th: int, text: str):
    marks = labels(text)
    if not len(marks):
        return None
    numbers, values = sketches(marks)
    return values, values, _heads(node, th, numbers, values)


def _deal(buckets: int):
    """Shingles of (node, text), packed by the bucket of their hash."""

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        marks = np.concatenate(parts)
        bucket = (marks["h"] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, begin = np.unique(bucket[order], return_index=True)
        blobs = [x.tobytes() for x in np.split(marks[order], begin[1:])]
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(blobs, pa.binary())], names=["bucket", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = labels(text)
                marks = np.empty(len(values), MARK)
                marks["h"], marks["id"], marks["n"] = values, node, len(values)
                parts.append(marks)
                held += len(marks)
                if held >= HELD:
                    yield packed(parts)
                    parts, held = [], 0
            if held:
                yield packed(parts)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles in all, those that other texts have too, with their number of texts) by bucket."""
    held = [np.frombuffer(x, MARK) for batch in batches for x in batch.column("marks").to_pylist()]
    if not held:
        return
    marks = np.concatenate(held)
    _, place, texts = np.unique(marks["h"], return_inverse=True, return_counts=True)
    several = texts[place] > 1
    marks, texts = marks[several], texts[place][several]
    if not len(marks):
        return
    order = np.argsort(marks["id"], kind="stable")
    marks, texts = marks[order], texts[order]
    nodes, begin = np.unique(marks["id"], return_index=True)
    found = np.empty(len(marks), RARE)
    found["h"], found["texts"] = marks["h"], texts
    blobs = [x.tobytes() for x in np.split(found, begin[1:])]
    columns = [pa.array(nodes), pa.array(marks["n"][begin].astype(np.int32)), pa.array(blobs, pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "found"])


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, node, n, s, at, short) of the rarest shingles that a link can't all do without; s shingles are shared at all.

    Two texts of n <= m shingles that link share at least a = PART * (n + m) / (PART + WHOLE) of them, so one of the first
    n - a + 1 of the one is one of the first m - a + 1 of the other. at is the place in that order, in which shingles that
    no other text has come first. short: within reach as the shorter text, too.
    """
    for batch in batches:
        parts = []
        for node, n, found in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "found")), strict=True):
            spots = np.concatenate([np.frombuffer(x, RARE) for x in found])
            s = len(spots)
            at = np.arange(n - s, n - -(-PART * n // WHOLE) + 1)
            h = spots["h"][np.lexsort((spots["h"], spots["texts"]))][: len(at)]
            short = at <= n - -(-2 * PART * n // (PART + WHOLE))
            parts.append((h.view(np.int64), np.full(len(at), node), *(np.full(len(at), k, np.int32) for k in (n, s)), at.astype(np.int32), short))
        names = ["h", "node", "n", "s", "at", "short"]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sketch) rows."""
    for batch in batches:
        spots = [np.frombuffer(x, SPOT)["h"].view(np.int64) for x in batch.column("spots").to_pylist()]
        nodes = np.repeat(batch.column("id").to_numpy(), [len(x) for x in spots])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(spots) if spots else nodes)], names=["node", "sketch"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose texts are similar. A lead's text travels once per CHUNK of its partners."""
    texts = texts.select(F.col("node"), "text")
    dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(1 << 20)))
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = dealt.join(sizes, "a").withColumn("chunk", (F.col("chunk") % F.col("chunks")).cast("int")).select("a", "b", "chunk")
    theirs = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "text")
    own = dealt.select("a", "chunk").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    both = own.select("a", "chunk", F.lit(None).cast("long").alias("b"), "text").unionByName(theirs)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, marks = None, np.empty(0, np.uint64)
        for batch in batches:
            a_of, b_of = [], []
            for a, chunk, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b is None:
                    lead, marks = (a, chunk), labels(text)
                elif lead == (a, chunk) and similarity(marks, labels(text)) >= THRESHOLD:
                    a_of.append(a)
                    b_of.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_of, pa.int64()), pa.array(b_of, pa.int64())], names=["a", "b"])

    # The lead itself sorts first in its group: nulls first.
    return both.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "b").mapInArrow(align, "a long, b long")


def components(docs: DataFrame) -> DataFrame:
    """(node, component) of every text of (node, text) that is linked with a different one."""
    buckets = spread_of(docs.sparkSession)
    keyed = docs.select(F.col("node").alias("id"), F.lit(0).alias("th"), "text")
    moved = keyed.mapInArrow(_map(buckets, False, _places), PACKED).repartition(buckets, "bucket")
    shared = stored(moved.mapInArrow(_reduce(False), SPOTS), "sketches")
    members = stored(shared.mapInArrow(_spread, "node long, sketch long").distinct(), "sketch-members")
    nodes = members.select("node").distinct()
    texts = docs.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = stored(texts, "candidate-texts")

    # The lead of a bucket is the member whose buckets are largest in all: what copies were made from, rather than a copy.
    sizes = members.groupBy("sketch").agg(F.count("*").alias("size"))
    standing = members.join(sizes, "sketch").groupBy("node").agg(F.sum("size").alias("standing"))
    known = members.join(standing, "node")
    leads = known.groupBy("sketch").agg(F.max(F.struct("standing", "node")).alias("lead")).select("sketch", F.col("lead.node").alias("lead"))
    best = members.join(leads, "sketch").where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("n"))
    best = best.groupBy("node").agg(F.max(F.struct("n", "lead")).alias("best"))
    first = stored(best.select(F.col("best.lead").alias("a"), F.col("node").alias("b")), "lead-pairs")
    links = stored(verified(first, texts), "links")
    found = connected_components(links, "near-text")

    # Members of buckets with several components, and their rarest shingles.
    placed = members.join(found, "node", "left").select("sketch", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("sketch").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("sketch")
    placed = stored(placed.join(mixed, "sketch", "left_semi"), "open-buckets")
    open_nodes = placed.groupBy("node").agg(F.first("component").alias("component"), F.collect_set("sketch").alias("sketches"))
    meant = texts.join(placed.select("node").distinct(), "node", "left_semi").select("node", "text")
    moved = meant.mapInArrow(_deal(buckets), "bucket int, marks binary").repartition(buckets, "bucket")
    rare = moved.mapInArrow(_shared, "node long, n int, found binary").groupBy("node").agg(F.first("n").alias("n"), F.collect_list("found").alias("found"))
    rare = rare.mapInArrow(_rarest, "h long, node long, n int, s int, at int, short boolean")
    rare = stored(rare.join(open_nodes.select("node", "component"), "node"), "rare-shingles")

    shorter = rare.where("short").select("h", *[F.col(c).alias(f"{c}1") for c in ("node", "component", "n", "s", "at")])
    longer = rare.select("h", *[F.col(c).alias(f"{c}2") for c in ("node", "component", "n", "s", "at")])
    least, both = F.lit(PART) * (F.col("n1") + F.col("n2")), PART + WHOLE  # of their shingles, a link shares least / both
    reach = [both * (F.col(f"n{k}") - F.col(f"at{k}")) >= least for k in (1, 2)]
    fit = (F.col("n1") <= F.col("n2")) & reach[0] & reach[1] & (both * F.least("s1", "s2") >= least)
    meeting = shorter.join(longer, "h").where((F.col("component1") != F.col("component2")) & fit)
    meeting = meeting.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()
    for end in ("a", "b"):
        meeting = meeting.join(open_nodes.select(F.col("node").alias(end), F.col("sketches").alias(f"{end}_sketches")), end)
    crossing = meeting.where(F.arrays_overlap("a_sketches", "b_sketches")).select("a", "b")
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(verified(crossing.join(tried, ["a", "b"], "left_anti"), texts), "links")
    return connected_components(links.unionByName(more), "near-text")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its class), kept (it is that one), text_key.

    Equal texts are one class whatever else; null counts as empty, and texts without words link with their
    exact copies only. Texts are told apart by a 64-bit hash. A null id is kept only where its class has no other id.
    Repeated rows are one document: both stay or go.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("node", text_key("text"))
    found = components(rows.select("node", "text"))
    placed = rows.select("doc_id", "node").join(found, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    classes = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return placed.join(classes, "component").select("doc_id", "class_id", F.expr("doc_id <=> class_id").alias("kept"), F.col("node").alias("text_key"))

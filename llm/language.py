"""Language identification by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

LETTER = re.compile(r"[^\W\d_]")
DIMENSIONS = 8192  # bins of hashed n-grams: half for pairs, half for triples of characters
CENTROIDS = 4
UNKNOWN = "und"
# Documents per language and in all that centroids are fitted on (in expectation); counts and weights cover all.
PER_LANGUAGE, IN_ALL = 600, 4000
# A document is rejected if its cosine is below this part of the language's lowest percentile in training.
REJECT_BELOW = 0.3


def features(text: str) -> np.ndarray:
    """Counts of hashed character pairs and triples of the whole text, lower-cased; runs of other characters are one gap."""
    half = DIMENSIONS // 2
    words = re.sub(r"[\W\d_]+", " ", text.lower())
    codes = np.frombuffer((" " + words + " ").encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
    pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0x27D4EB2F) + codes[2:] * np.uint32(0xC2B2AE3D)
    shift = np.uint32(33 - DIMENSIONS.bit_length() + 1)
    bins = np.concatenate([pairs >> shift, (triples >> shift) + np.uint32(half)])
    return np.bincount(bins, minlength=DIMENSIONS)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def _cluster(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids of one language's sample, and the cosine below which its documents are rejected."""
    centers = x[np.linspace(0, len(x) - 1, min(CENTROIDS, len(x))).astype(int)]
    for _ in range(10):
        near = np.argmax(x @ centers.T, 1)
        centers = np.stack([x[near == k].sum(0) if (near == k).any() else centers[k] for k in range(len(centers))])
        centers = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return centers, REJECT_BELOW * float(np.quantile((x @ centers.T).max(1), 0.01))


class Centroids:
    """cosines(text) with every centroid; the best per language decides."""

    def __init__(self, idf: np.ndarray, fitted: dict[str, tuple[np.ndarray, float]]):
        self.idf, self.langs = idf, sorted(fitted)
        parts = [fitted[k][0] for k in self.langs]
        self.floor = {k: fitted[k][1] for k in self.langs}
        self.of = [lang for lang, c in zip(self.langs, parts, strict=True) for _ in c]
        self.centers = np.concatenate(parts) if parts else np.empty((0, len(idf)))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        if not text or not self.langs or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        cosines = self.centers @ _weigh(features(text), self.idf)
        best = int(np.argmax(cosines))
        score = min(1.0, max(0.0, float(cosines[best])))
        return self.of[best], score, score < self.floor[self.of[best]]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Centroids:
    """Learns from rows that have text and language; give it the training rows only.

    Document frequencies are counted over all of them, in the tasks; one row per bin and task is
    summed by Spark. The rows whose hash falls below a share set by each language's count are the
    sample for the centroids.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id)).alias("h"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    wanted = min(PER_LANGUAGE, max(1, IN_ALL // max(1, len(sizes))))
    # As a share of all hashes; a language with few documents is taken whole.
    limits = {k: min(1.0, wanted / n) for k, n in sizes.items()}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, kept = np.zeros(DIMENSIONS, np.int64), 0, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "lang", "h"))
            for value, language, h in zip(*columns, strict=True):
                if not LETTER.search(value):
                    continue
                counts = features(value)
                seen += counts > 0
                n += 1
                if (h / 2.0**64 + 0.5) <= limits[language]:
                    kept.append((language, counts.astype("<u4").tobytes()))
        names = ["bin", "n", "lang", "counts"]
        used = np.flatnonzero(seen)
        bins, sums = [*used.tolist(), DIMENSIONS, *[None] * len(kept)], [*seen[used].tolist(), n, *[None] * len(kept)]
        langs, blobs = [None] * (len(used) + 1) + [k for k, _ in kept], [None] * (len(used) + 1) + [b for _, b in kept]
        arrays = [pa.array(bins, pa.int32()), pa.array(sums, pa.int64()), pa.array(langs, pa.string()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    learned = stored(rows.mapInArrow(learn, "bin int, n long, lang string, counts binary"), "language")
    frequency = np.zeros(DIMENSIONS + 1)
    for r in learned.where("bin is not null").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        frequency[r["bin"]] = r["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1

    def cluster(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sample = np.stack([_weigh(np.frombuffer(c, "<u4"), idf).astype(np.float32) for c in sorted(rows["counts"])])
        centers, floor = _cluster(sample)
        return pd.DataFrame({"lang": [key[0]] * len(centers), "center": [c.astype("<f4").tobytes() for c in centers], "k": range(len(centers)), "floor": floor})

    # A language's sample is a task's group: about PER_LANGUAGE rows. The driver gets the centroids only.
    groups = learned.where("lang is not null").select("lang", "counts").groupBy("lang")
    fitted: dict[str, tuple[list[np.ndarray], float]] = {}
    for r in sorted(groups.applyInPandas(cluster, "lang string, center binary, k int, floor double").collect(), key=lambda r: (r["lang"], r["k"])):
        fitted.setdefault(r["lang"], ([], r["floor"]))[0].append(np.frombuffer(r["center"], "<f4"))
    return Centroids(idf, {k: (np.stack(c), floor) for k, (c, floor) in fitted.items()})


def predict(docs: DataFrame, model: Centroids, text: str = "text", with_text: bool = False) -> DataFrame:
    """All columns of docs, its text only if with_text, then lang_pred, score and rejected (in place of columns so named), from the whole text alone.

    `und`, score 0 and rejected: the text is null, empty or has no letter, or nothing was learned.
    Other columns may have any name.
    """
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score", "rejected")]
    sent = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]  # so that no name clashes
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x CENTROIDS x DIMENSIONS doubles
    names = [*keep, *([text] if with_text else []), "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("judged")
            found = [shared.value.predict(t.as_py()) for t in texts]
            langs, scores, rejected = zip(*found, strict=True) if found else ((), (), ())
            arrays = [*(batch.column(f"c{k}") for k in range(len(keep))), *([texts] if with_text else [])]
            arrays += [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    types = dict(docs.dtypes)
    kinds = "".join(f"`{c}` {types[c]}, " for c in names[:-3])
    return docs.select(*sent, F.col(text).alias("judged")).mapInArrow(run, f"{kinds}lang_pred string, score double, rejected boolean")

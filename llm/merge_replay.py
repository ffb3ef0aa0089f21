"""Byte-level BPE by replaying the merges over a block of the corpus.

The distinct words of a block are laid out as one array of tokens. An inverted
index leads from each rank to the positions whose pair has it; ranks are taken in
ascending order and a merge touches its positions and their two neighbours only,
whose new pairs enter the index. Words don't interact, so blocks (the batches of
each Spark task) need no shuffle. Where a merge makes a pair of a lower rank than
the one just replayed, that word is finished by itself in strict order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.chunks import ChunkEncoder

NONE = np.int32(2**31 - 1)
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class MergeRanks:
    """A rank file: token bytes by id, and the rank of each pair of tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(self.keys)
        self.keys, self.of_key = self.keys[order], np.fromiter(pairs.values(), np.int32, len(pairs))[order]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.of_key[at], NONE)

    def one_word(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost on ties: a heap over a linked list, so long words stay n log n."""
        ids = [self.ranks[bytes([b])] for b in word]
        nxt, prv = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        parts: list[bytes | None] = [bytes([b]) for b in word]
        heap: list[tuple[int, int, bytes]] = []

        def offer(p: int) -> None:
            if p >= 0 and nxt[p] < len(ids) and (r := self.ranks.get(both := parts[p] + parts[nxt[p]])) is not None:
                heapq.heappush(heap, (r, p, both))

        for p in range(len(ids)):
            offer(p)
        while heap:
            rank, p, both = heapq.heappop(heap)
            q = nxt[p] if parts[p] is not None else len(ids)
            if q >= len(ids) or parts[p] + parts[q] != both:
                continue
            parts[p], parts[q], ids[p], nxt[p] = both, None, rank, nxt[q]
            if nxt[p] < len(ids):
                prv[nxt[p]] = p
            offer(prv[p])
            offer(p)
        return [i for i, part in zip(ids, parts, strict=True) if part is not None]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = int(sizes.sum())
        if not n:
            return np.empty(0, np.int32), sizes
        word_of = np.repeat(np.arange(len(words)), sizes)
        token = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int32, len(words))
        nxt, prv = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        word_of = np.append(word_of, -1)
        # A pair exists where both places are of one word, and that word isn't a token already.
        rank = np.full(n + 1, NONE, np.int32)
        rank[: n - 1] = self.pair_ranks(token[:-1], token[1:])
        rank[: n - 1][(word_of[: n - 1] != word_of[1:n]) | (whole[word_of[: n - 1]] >= 0)] = NONE
        token, alive, odd = np.append(token, -1), np.ones(n, bool), set()
        index: dict[int, list[np.ndarray]] = defaultdict(list)

        def enter(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            if not len(at):
                return
            found = rank[at]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1], [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                r = int(found[a])
                if r not in index:
                    heapq.heappush(heap, r)
                index[r].append(at[a:b])

        heap: list[int] = []
        enter(np.arange(n))
        while heap:
            now = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(now)))
            at = at[(rank[at] == now) & alive[at]]
            if not len(at):
                continue
            after = nxt[at]
            if (rank[after] == now).any():  # pairs that share a token: leftmost first
                taken, used = [], -1
                for p, q in zip(at.tolist(), after.tolist(), strict=True):
                    if p != used:
                        taken.append(p)
                        used = q
                at = np.array(taken, at.dtype)
                after = nxt[at]
            token[at], alive[after], rank[after] = now, False, NONE
            nxt[at] = nxt[after]
            prv[nxt[at]] = at
            left = prv[at]
            touched = np.concatenate([at, left[left >= 0]])
            beyond = nxt[touched]
            same = word_of[touched] == word_of[beyond]
            rank[touched] = np.where(same, self.pair_ranks(token[touched], token[beyond]), NONE)
            if (low := rank[touched] < now).any():
                words_low = np.unique(word_of[touched[low]])
                odd.update(words_low.tolist())
                for w in words_low.tolist():
                    end = int(sizes[: w + 1].sum())
                    rank[end - sizes[w] : end] = NONE
            enter(np.unique(touched))
        keep = alive & (whole[word_of[:n]] < 0)
        first = np.cumsum(sizes) - sizes
        keep[first[whole >= 0]] = True
        token[first[whole >= 0]] = whole[whole >= 0]
        counts = np.bincount(word_of[:n][keep], minlength=len(words)).astype(np.int64)
        ids = token[:n][keep]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in odd:
                parts[w] = np.array(self.one_word(words[w]), np.int32)
                counts[w] = len(parts[w])
            ids = np.concatenate(parts)
        return ids, counts


_LOADED: dict[tuple[str, str], tuple[MergeRanks, ChunkEncoder]] = {}


def replay_encoder(path: str, pattern: str) -> tuple[MergeRanks, ChunkEncoder]:
    if (path, pattern) not in _LOADED:
        import regex

        ranks, split = MergeRanks(path), regex.compile(pattern)

        def encode_new(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            words = [split.findall(c) for c in chunks]
            distinct: dict[str, int] = {}
            at = np.fromiter((distinct.setdefault(w, len(distinct)) for x in words for w in x), np.int64)
            ids, sizes = ranks.replay([w.encode("utf-8") for w in distinct])
            per_word = sizes[at]
            from llm.chunks import gather

            flat = gather(ids, (np.cumsum(sizes) - sizes)[at], per_word)
            ends = np.concatenate([[0], np.cumsum(per_word)])[np.cumsum([0, *map(len, words)])]
            return flat.astype(np.int32), np.diff(ends)

        _LOADED.clear()
        _LOADED[path, pattern] = ranks, ChunkEncoder(encode_new)
    return _LOADED[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes they decode to.

    A null text is an empty one: no ids, digests of nothing. Every row is handled by
    itself, so null ids, repeated rows and ties stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, encoder = replay_encoder(path, pattern)
        for batch in batches:
            sizes, ids_hash, text_hash = [], [], []
            for ids in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                sizes.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(b"".join(map(ranks.tokens.__getitem__, ids.tolist()))).hexdigest())
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)

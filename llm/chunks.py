"""Encode whole texts by encoding every distinct chunk of them once.

A chunk is a run of ASCII white space with the run of other characters after
it. No tokenizer used here lets a token span the border before white space that
follows another character, so a text's ids are its chunks' ids in order. Texts
with other white space characters, where that isn't certain, are one chunk.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from itertools import count, islice

import numpy as np

CHUNK = re.compile(r"\s*\S+|\s+", re.ASCII)
OTHER_SPACE = re.compile("[\x1c-\x1f\x85   -​    　]")
# Distinct chunks a worker remembers between batches, and the characters worked on at a time.
REMEMBERED, BATCH_CHARS = 300_000, 2_000_000

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + length], concatenated."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class Remembered:
    """The ids of strings, each encoded once. encode_new turns distinct strings into (all ids, ids per string)."""

    def __init__(self, encode_new: Encode):
        self.encode_new = encode_new
        self.forget()

    def forget(self) -> None:
        # A new string gets the next number as it is looked up.
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.ids, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per string)."""
        at = np.fromiter(map(self.known.__getitem__, strings), np.int64, len(strings))
        if fresh := list(islice(reversed(self.known), len(self.known) - len(self.lengths))):
            ids, lengths = self.encode_new(fresh[::-1])
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        lengths = self.lengths[at]
        return gather(self.ids, self.starts[at], lengths), lengths


class ChunkEncoder:
    """encode_new turns distinct chunks into (all ids, ids per chunk). The memory is bounded and affects speed only.

    words: what encode_new itself remembers; forgotten along with the chunks.
    """

    def __init__(self, encode_new: Encode, remembered: int = REMEMBERED, words: Remembered | None = None):
        self.chunks, self.remembered, self.words = Remembered(encode_new), remembered, words

    def forget(self) -> None:
        self.chunks.forget()
        if self.words:
            self.words.forget()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found: list[np.ndarray] = []
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= BATCH_CHARS:
                found += self._encode(group)
                group, chars = [], 0
        return found + self._encode(group) if group else found

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.chunks.known) > self.remembered:
            self.forget()
        split = [[t] if OTHER_SPACE.search(t) else CHUNK.findall(t) for t in texts]
        flat, lengths = self.chunks.find([c for s in split for c in s])
        ends = per_group(lengths, [*map(len, split)])
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def per_group(lengths: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Where each group's items begin, and the end: groups are the next so many items, each of its length."""
    return np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *sizes])]


# Characters on which Python and the library agree about case, letters and white space.
PLAIN = re.compile("[\t-\r\x20-\x7e¡-ɏ]*")
# Printable stand-ins of bytes, as byte-level vocabularies write them.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
STAND_INS = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
# Strings are joined by NUL, which no plain chunk holds, to be worked on in one go. Words are told apart by its stand-in.
BORDER = STAND_INS[0]
# Most plain chunks are a blank or none, letters that stay such in lower case, and marks or none.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and ord(c.lower()) < 0x250)
MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
SIMPLE = re.compile(f" ?[{LETTERS}]+[{re.escape(MARKS)}]*")
# Patterns of words that make such letters one word, with the blank or without it, and such marks another.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d|"
SIMPLE_WORDS = {
    CONTRACTIONS + r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": re.compile(f" ?[{LETTERS}]+|[{re.escape(MARKS)}]+"),
    CONTRACTIONS + r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": re.compile(f"[{LETTERS}]+|[{re.escape(MARKS)}]+"),
}
# Strings given to the library in one call.
A_CALL = 10_000


def word_rule(spec: dict) -> tuple[str, bool] | None:
    """(pattern of words, lower case or not) of a byte-level tokenizer file, or None where its steps are others than these."""
    steps = lambda x, key: [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    normal = steps(spec["normalizer"], "normalizers")
    blank = [x for x in normal if x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "]
    before = steps(spec["pre_tokenizer"], "pretokenizers")
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or not before or before[-1]["type"] != "ByteLevel" or before[-1]["add_prefix_space"]:
        return None
    if any(x["type"] not in ("NFC", "Lowercase") and x not in blank for x in normal):
        return None
    if len(before) == 1 and before[0]["use_regex"] and not blank:
        import public_tokenizers

        return public_tokenizers.PATTERN, any(x["type"] == "Lowercase" for x in normal)
    if len(before) == 2 and before[0]["type"] == "Split" and before[0]["behavior"] == "Removed" and before[0]["invert"] and not before[1]["use_regex"]:
        return before[0]["pattern"].get("Regex"), any(x["type"] == "Lowercase" for x in normal)
    return None


_ENCODERS: dict[str, ChunkEncoder] = {}


def file_encoder(path: str) -> ChunkEncoder:
    """The tokenizers library's encoder of a vocabulary file, one per worker process.

    Plain chunks go by words to the library's merge model, which costs a part of what its whole chain of steps
    does for such short texts; all others, and those with an added token, take the whole chain.
    """
    if path not in _ENCODERS:
        import json
        import os

        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        rule, merges = word_rule(spec), Tokenizer(tokenizer.model)
        merges.pre_tokenizer = Split(BORDER, "isolated")
        border = merges.encode(BORDER, add_special_tokens=False).ids
        split, lower = (regex.compile(rule[0]), rule[1]) if rule and rule[0] and len(border) == 1 else (None, False)
        simple_words = SIMPLE_WORDS.get(rule[0]) if split else None
        added = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"]) or "(?!)")

        def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, lengths = [], []
            for k in range(0, len(words), A_CALL):
                printed = "\0".join([*words[k : k + A_CALL], ""]).encode().decode("latin-1").translate(STAND_INS)
                found = np.array(merges.encode_batch_fast([printed], add_special_tokens=False)[0].ids, np.int32)
                ends = np.flatnonzero(found == border[0])
                lengths.append(np.diff(ends, prepend=-1) - 1)
                ids.append(np.delete(found, ends))
            return np.concatenate(ids), np.concatenate(lengths)

        words = Remembered(encode_words)

        def encode_new(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            some_added = added.search("\0".join(chunks))
            simple, plain, others = [], [], []
            for k, chunk in enumerate(chunks):
                if not split or some_added and added.search(chunk):
                    others.append(k)
                elif simple_words and SIMPLE.fullmatch(chunk):
                    simple.append(k)
                else:
                    (plain if PLAIN.fullmatch(chunk) else others).append(k)
            case = str.lower if lower else str
            split_up = simple_words.findall(case("\0".join([chunks[k] for k in simple]))) if simple else []
            sizes = [1 + (chunks[k][-1] in MARKS) for k in simple]
            for k in plain:
                found = split.findall(case(chunks[k]))
                split_up += found
                sizes.append(len(found))
            ids, per_word = words.find(split_up)
            whole: list[np.ndarray] = []
            for k in range(0, len(others), A_CALL):
                found = tokenizer.encode_batch_fast([chunks[i] for i in others[k : k + A_CALL]], add_special_tokens=False)
                whole += [np.array(e.ids, np.int32) for e in found]
            ids = np.concatenate([ids, *whole])
            lengths = np.concatenate([np.diff(per_group(per_word, sizes)), np.array([*map(len, whole)], np.int64)])
            order = np.argsort(np.array(simple + plain + others))
            return gather(ids, (np.cumsum(lengths) - lengths)[order], lengths[order]), lengths[order]

        _ENCODERS.clear()
        _ENCODERS[path] = ChunkEncoder(encode_new, 2 * REMEMBERED, words)
    return _ENCODERS[path]

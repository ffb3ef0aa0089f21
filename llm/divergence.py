"""How far the word use of sources differs: iceberg prefix refinement of terms, then exact divergences.

The terms of a language that occur in enough of its documents are found level by level. A level counts, per
language, the documents with each byte prefix of that level's length; prefixes in too few documents are
dropped with all their extensions, and only terms under a surviving prefix are extended to the next level.
Terms no longer than a level are complete there and kept or dropped for good. So the long tail of rare terms
is never shuffled or counted one by one.

Documents are read once, into blocks: the sorted terms of a block and, per document, term numbers and counts.
Survivors reach the tasks as a bitmap of fixed size. A wrong bit lets a prefix be counted in vain; it can't
change a result, as every level counts exactly.

Defined results: a row is a document, also when rows repeat; null text, lang and source are ''; a text without
terms adds its (lang, source) group only; an empty table gives no rows; ties of a value go by the item's
bytes. Only the named columns are read, so other columns may have any name. Neither documents nor terms
reach the driver.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import arrow_batches, stored

# Terms are runs of ASCII letters and bytes beyond ASCII, A-Z in lower case; every other byte parts them.
PARTED = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
LEAST_DOCUMENTS, SCALE, SMOOTHING, TOP_TERMS = 10, 1_000_000_000, 2, 10
FIRST_LEVEL = 4
# Text of one block; sums that a task holds before it hands them on; bits of the survivors' bitmap, 2 MB for
# each task whatever the corpus.
BLOCK_BYTES, HELD_SUMS, BITMAP_BITS = 4_000_000, 200_000, 1 << 24
DOCUMENTS_AT_A_TIME, BLOCKS_AT_A_TIME = 500, 1
# Parts that a large group is dealt into.
SALTS = 1 << 16
# Cells (terms x sources) of one task that sums divergences.
TASK_CELLS = 100_000

# Numbers of sources and terms share a long.
WIDTH = 1 << 32

BLOCK_SCHEMA = (
    "langs array<string>, sources array<string>, doc_lang binary, doc_source binary, "
    "terms binary, term_ends binary, term_lang binary, doc_ends binary, doc_terms binary, doc_counts binary"
)


def _block(texts: list[bytes], langs: list[str], sources: list[str]) -> dict:
    lang_ids, source_ids = defaultdict(count().__next__), defaultdict(count().__next__)
    vocabularies: dict[int, defaultdict] = {}
    doc_lang = np.array([lang_ids[x] for x in langs], np.int32)
    doc_source = np.array([source_ids[x] for x in sources], np.int32)
    local: list[np.ndarray] = []
    for text, lang in zip(texts, doc_lang.tolist(), strict=True):
        vocabulary = vocabularies.setdefault(lang, defaultdict(count().__next__))
        local.append(np.fromiter(map(vocabulary.__getitem__, text.translate(PARTED).split()), np.int64))
    # Terms are numbered in the order (language, bytes), so a document's terms with one prefix stand together.
    terms, term_lang, numbers = [], [], {}
    for lang in sorted(vocabularies):
        words = list(vocabularies[lang])
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        number = np.empty(len(words), np.int64)
        number[order] = np.arange(len(words)) + len(terms)
        numbers[lang] = number
        terms += [words[k] for k in order.tolist()]
        term_lang += [lang] * len(words)
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in local])
    term = np.concatenate([numbers[g][x] for g, x in zip(doc_lang.tolist(), local, strict=True)]) if local else np.empty(0, np.int64)
    width = max(len(terms), 1)
    keys, counts = np.unique(doc * width + term, return_counts=True)
    return {
        "langs": list(lang_ids), "sources": list(source_ids), "doc_lang": doc_lang.tobytes(), "doc_source": doc_source.tobytes(),
        "terms": b"".join(terms), "term_ends": np.cumsum([0, *map(len, terms)], dtype=np.int64).tobytes(),
        "term_lang": np.array(term_lang, np.int32).tobytes(),
        "doc_ends": np.searchsorted(keys, np.arange(len(texts) + 1) * width).astype(np.int64).tobytes(),
        "doc_terms": (keys % width).astype(np.int32).tobytes(), "doc_counts": counts.astype(np.int32).tobytes(),
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple[list, list, list] = ([], [], [])
    size = 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([_block(*held)], BLOCK_ARROW)

    for batch in batches:
        columns = [batch.column(0).cast(pa.binary()), batch.column(1), batch.column(2)]
        for k in range(0, batch.num_rows, 256):
            text, lang, source = (c.slice(k, 256).to_pylist() for c in columns)
            for values, more in zip(held, (text, lang, source), strict=True):
                values.extend(more)
            size += sum(map(len, text))
            if size >= BLOCK_BYTES:
                yield made()
                held, size = ([], [], []), 0
    if held[0]:
        yield made()


_LIST, _BYTES = pa.list_(pa.string()), pa.binary()
BLOCK_ARROW = pa.schema([(f.split()[0], _LIST if "array" in f else _BYTES) for f in BLOCK_SCHEMA.split(", ")])


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Documents as blocks of sorted terms and term counts, see BLOCK_SCHEMA.

    They are range-partitioned by language and source, so a task meets few groups and sums up most of what it
    finds; rows of a large group are dealt by a number, so ranges split it.
    """
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    dealt = plain.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return dealt.repartitionByRange("lang", "source", "salt").drop("salt").mapInArrow(_blocks, BLOCK_SCHEMA)


class _Opened:
    """A block's arrays."""

    def __init__(self, row: dict):
        ints = {k: np.frombuffer(row[k], np.int64 if k in ("term_ends", "doc_ends") else np.int32) for k in (
            "doc_lang", "doc_source", "term_ends", "term_lang", "doc_ends", "doc_terms", "doc_counts")}
        self.langs, self.sources = row["langs"], row["sources"]
        self.doc_source, self.term_lang, self.doc_terms, self.doc_counts = (ints[k] for k in ("doc_source", "term_lang", "doc_terms", "doc_counts"))
        ends = ints["term_ends"].tolist()
        self.terms = [row["terms"][a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.doc_of_pair = np.repeat(np.arange(len(self.doc_source)), np.diff(ints["doc_ends"]))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[_Opened]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Opened(batch.slice(k, 1).to_pylist()[0])


def _place(lang: str, prefix: bytes, complete: bool, bits: int) -> int:
    """Bit of a prefix; ``_place_column`` is the same in Spark."""
    return zlib.crc32(lang.encode() + (b"\x01" if complete else b"\x02") + prefix) % bits


def _place_column(bits: int) -> Column:
    mark = F.when(F.col("complete"), F.lit(b"\x01")).otherwise(F.lit(b"\x02"))
    return F.crc32(F.concat(F.col("lang").cast("binary"), mark, F.col("prefix"))) % F.lit(bits)


def bitmap(survivors: DataFrame, bits: int) -> bytes:
    """The survivors' bitmap: at most bits / 64 words reach the driver, however many survivors there are."""
    place = survivors.select(_place_column(bits).alias("place"))
    words = place.groupBy(F.expr("place div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("mask"))
    found = words.toPandas()
    mask = np.zeros(bits // 64, np.int64)
    mask[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64)
    return mask.tobytes()


def _has(mask: np.ndarray, place: int) -> bool:
    return bool(mask[place >> 3] >> (place & 7) & 1)


def _changes(lang: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before it."""
    first = np.ones(len(lang), bool)
    first[1:] = lang[1:] != lang[:-1]
    for c in columns:
        first[1:] |= c[1:] != c[:-1]
    return first


def _prefixes(block: _Opened, length: int, above: int, mask: np.ndarray | None, bits: int) -> tuple[list[tuple[str, bytes, bool]], np.ndarray]:
    """The prefixes (lang, prefix, complete) of a block's terms under surviving ones, and for each pair its prefix or -1."""
    sizes = np.array([len(t) for t in block.terms], np.int64)
    place = np.arange(len(sizes))
    if mask is not None:
        place = np.flatnonzero(sizes > above)
        lang, upper = block.term_lang[place], np.array([block.terms[k][:above] for k in place.tolist()], f"S{above}")
        first = _changes(lang, upper)
        alive = [_has(mask, _place(block.langs[g], u, False, bits)) for g, u in zip(lang[first].tolist(), upper[first].tolist(), strict=True)]
        place = place[np.array(alive, bool)[np.cumsum(first) - 1]] if alive else place
    lang, complete = block.term_lang[place], sizes[place] <= length
    cut = np.array([block.terms[k][:length] for k in place.tolist()], f"S{length}")
    first = _changes(lang, cut, complete)
    keys = [(block.langs[g], c, bool(w)) for g, c, w in zip(lang[first].tolist(), cut[first].tolist(), complete[first].tolist(), strict=True)]
    group = np.full(len(sizes), -1, np.int64)
    group[place] = np.cumsum(first) - 1
    return keys, group[block.doc_terms]


def level_counts(blocked: DataFrame, length: int, above: int, survivors: bytes | None, bits: int) -> DataFrame:
    """(lang, prefix, complete, docs): documents with each prefix of ``length`` bytes, under the survivors of length ``above``.

    A term of at most ``length`` bytes is its own, complete prefix.
    """
    schema = "lang string, prefix binary, complete boolean, docs bigint"
    arrow = pa.schema([("lang", pa.string()), ("prefix", pa.binary()), ("complete", pa.bool_()), ("docs", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, sums = None if survivors is None else np.frombuffer(survivors, np.uint8), {}

        def made() -> pa.RecordBatch:
            columns = [*zip(*sums, strict=True), sums.values()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

        for block in _opened(batches):
            keys, of_pair = _prefixes(block, length, above, mask, bits)
            doc, of_pair = block.doc_of_pair[of_pair >= 0], of_pair[of_pair >= 0]
            first = np.ones(len(doc), bool)
            first[1:] = (doc[1:] != doc[:-1]) | (of_pair[1:] != of_pair[:-1])
            for key, docs in zip(keys, np.bincount(of_pair[first], minlength=len(keys)).tolist(), strict=True):
                sums[key] = sums.get(key, 0) + docs
            if len(sums) > HELD_SUMS:
                yield made()
                sums = {}
        if sums:
            yield made()

    return blocked.mapInArrow(counted, schema).groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs"))


def kept_terms(blocked: DataFrame, least: int = LEAST_DOCUMENTS, bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, prefix, complete): the complete terms in at least ``least`` documents of their language, stored."""
    kept, length, above, mask = None, FIRST_LEVEL, 0, None
    while True:
        with arrow_batches(blocked.sparkSession, BLOCKS_AT_A_TIME):
            level = stored(level_counts(blocked, length, above, mask, bits).where(F.col("docs") >= least).drop("docs"), f"terms-{length}")
        done = level.where("complete")
        kept = done if kept is None else kept.unionByName(done)
        going = level.where("not complete")
        if going.isEmpty():
            return kept
        mask, above, length = bitmap(going, bits), length, length * 2


def term_counts(blocked: DataFrame, kept: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, source, term, count) of kept terms that a group has."""
    survivors = bitmap(kept, bits)
    schema = "lang string, source string, prefix binary, count bigint"
    arrow = pa.schema([("lang", pa.string()), ("source", pa.string()), ("prefix", pa.binary()), ("count", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.frombuffer(survivors, np.uint8)
        terms, sources, held = defaultdict(count().__next__), defaultdict(count().__next__), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        def made() -> pa.RecordBatch:
            (keys, sums), names = merged(), list(terms)
            pick = keys % WIDTH
            langs, words = (pa.array([n[x] for n in names], t).take(pa.array(pick)) for x, t in ((0, pa.string()), (1, pa.binary())))
            groups = pa.array(list(sources), pa.string()).take(pa.array(keys // WIDTH))
            return pa.RecordBatch.from_arrays([langs, groups, words, pa.array(sums)], schema=arrow)

        for block in _opened(batches):
            number = np.full(len(block.terms), -1, np.int64)
            for k, (term, g) in enumerate(zip(block.terms, block.term_lang.tolist(), strict=True)):
                if _has(mask, _place(block.langs[g], term, True, bits)):
                    number[k] = terms[block.langs[g], term]
            source = np.array([sources[x] for x in block.sources], np.int64)
            of_pair = number[block.doc_terms]
            held.append(((source[block.doc_source][block.doc_of_pair] * WIDTH + of_pair)[of_pair >= 0], block.doc_counts[of_pair >= 0]))
            if sum(len(k) for k, _ in held) > 2 * HELD_SUMS:
                held = [merged()]
            if len(terms) > HELD_SUMS or len(held[0][0]) > HELD_SUMS:
                yield made()
                terms.clear(), sources.clear(), held.clear()
                terms.default_factory, sources.default_factory = count().__next__, count().__next__
        if held:
            yield made()

    summed = blocked.mapInArrow(counted, schema).groupBy("lang", "source", "prefix").agg(F.sum("count").alias("count"))
    return summed.join(kept.select("lang", "prefix"), ["lang", "prefix"], "left_semi").withColumn("term", F.col("prefix").cast("string")).drop("prefix")


def _share(counted: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / (N + SMOOTHING * V)), exact: in longs while they fit, else in Python's integers."""
    kind = np.int64 if counted.max(initial=0) < 9_000_000_000 else object
    up, down = (counted.astype(kind) + SMOOTHING) * SCALE, total.astype(kind) + SMOOTHING * terms
    return (1 + up // down).astype(np.int64)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so squares fit a long."""
    return (p - q) ** 2 // (p + q)


def _compared(top: int):
    def compare(key: tuple, rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        """What some terms of one language add to each pair of sources, and the ``top`` terms of each source among them."""
        groups = groups.sort_values("source").reset_index(drop=True)
        names, totals, terms = groups["source"].to_numpy(object), groups["N"].to_numpy(np.int64), int(groups["V"].iloc[0])
        column, items = pd.factorize(rows["term"])
        counts = np.zeros((len(names), len(items)), np.int64)
        counts[pd.Index(names).get_indexer(rows["source"]), column] = rows["count"].to_numpy(np.int64)
        p, q = _share(counts, totals[:, None], terms), _share(counts.sum(axis=0), groups["lang_N"].to_numpy(np.int64)[:1], terms)
        sums = np.array([_divergence(p, row).sum(axis=1) for row in p])
        one, other = np.nonzero(~np.eye(len(names), dtype=bool))
        found = [pd.DataFrame({"source": names[one], "part": "pair", "item": names[other], "value": sums[one, other]})]
        by_bytes = np.argsort(np.argsort([x.encode() for x in items]))
        for row, name in enumerate(names):
            typical = np.flatnonzero((counts[row] > 0) & (p[row] > q))
            value = _divergence(p[row, typical], q[typical])
            best = np.lexsort((by_bytes[typical], -value))[:top]
            found.append(pd.DataFrame({"source": name, "part": "term", "item": np.asarray(items, object)[typical[best]], "value": value[best]}))
        return pd.concat([x for x in found if len(x)] or found[:1]).assign(lang=key[0])[["lang", "source", "part", "item", "value"]]

    return compare


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, bits: int = BITMAP_BITS, task_cells: int = TASK_CELLS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every source from each other one, and its ``top`` most typical terms.

    A language's terms are dealt to tasks; each holds the counts of its terms in all sources as a matrix. So no
    row is made per pair and term, and a common term or a large source costs a cell like any other.
    """
    spark = docs.sparkSession
    with arrow_batches(spark, DOCUMENTS_AT_A_TIME):
        blocked = stored(blocks(docs, text, lang, source), "term-blocks")
    kept = kept_terms(blocked, least, bits)
    with arrow_batches(spark, BLOCKS_AT_A_TIME):
        counts = stored(term_counts(blocked, kept, bits), "term-counts")

    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))])
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    groups = plain.distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["V", "N"])
    groups = stored(groups, "source-groups")

    # How many tasks a language's terms are dealt to follows from its number of cells.
    widths = groups.groupBy("lang").agg(F.sum("N").alias("lang_N"), F.max("V").alias("of_lang"), F.count(F.lit(1)).alias("sources")).where("of_lang > 0")
    widths = widths.select("lang", "lang_N", F.ceil(F.col("sources") * F.col("of_lang") / F.lit(task_cells)).cast("int").alias("parts"))
    rows = counts.join(widths, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("cell"), "source", "term", "count")
    sides = groups.join(widths, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("cell"), "source", "N", "V", "lang_N")
    schema = "lang string, source string, part string, item string, value bigint"
    found = stored(rows.groupBy("lang", "cell").cogroup(sides.groupBy("lang", "cell")).applyInPandas(_compared(top), schema), "compared")

    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(found.where("part = 'term'"), "term").where(F.col("rank") <= top))

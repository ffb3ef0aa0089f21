"""Near-duplicate embeddings: inverted lists with product-quantised residuals, exact rerank.

No link is lost: a vector meets every list that the list's radius and the plane between centres
don't rule out, and codes only exclude what must be too far. Lists near each other form a zone; the
members of a zone are written once, in blocks, to the shared folder, and tasks read the blocks they
compare from there: no vector is shuffled to those it meets. Of two blocks one asks the other, and a
link counts for both its ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.session import work_dir
from llm.common import connected_components, stored


@dataclass(frozen=True)
class IndexSettings:
    """sample: vectors the codebooks are fitted on, at most; list_size: vectors per list aimed at, up to
    max_lists lists; subspaces, codes: the residual code; block: members in a zone, as a mean, and in one
    block, at most; asking: rows that ask together; slot: members of a zone that one task writes, as a mean."""

    sample: int = 16_000
    list_size: int = 128
    max_lists: int = 8_192
    subspaces: int = 8
    codes: int = 256
    block: int = 4_096
    asking: int = 16_384
    slot: int = 65_536


def _kmeans(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    rng = np.random.default_rng(7)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = _nearest(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centers))[:, None]
        centers = np.where(n > 0, sums / np.maximum(n, 1), centers)
    return centers


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers**2).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 2048] @ centers.T - half, 1) for i in range(0, len(x), 2048)] or [np.empty(0, int)])


class Codebooks:
    """Coarse centres and, per subspace, the codewords of residuals."""

    def __init__(self, sample: np.ndarray, lists: int, zones: int, settings: IndexSettings):
        self.centers = _kmeans(sample, lists)
        self.norms = (self.centers**2).sum(1)
        own = _nearest(sample, self.centers)
        self.zone_of = _nearest(self.centers, _kmeans(self.centers, min(zones, len(self.centers)))).astype(np.int32)
        self.share = np.bincount(self.zone_of[own], minlength=int(self.zone_of.max()) + 1) / len(sample)
        rest = sample - self.centers[own]
        self.bounds = np.linspace(0, sample.shape[1], min(settings.subspaces, sample.shape[1]) + 1).astype(int)
        self.words = [_kmeans(rest[:, a:b], settings.codes) for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, distance from its centre, codes, how far the coded vector is from the true one)."""
        own = _nearest(x, self.centers)
        rest = x - self.centers[own]
        codes = np.stack([_nearest(rest[:, a:b], w) for a, b, w in self._parts()], 1)
        return own, np.sqrt((rest**2).sum(1)), codes.astype(np.uint8), np.sqrt(((rest - self._decoded(codes)) ** 2).sum(1))

    def _parts(self):
        return zip(self.bounds[:-1], self.bounds[1:], self.words, strict=True)

    def _decoded(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([w[codes[:, m]] for m, w in enumerate(self.words)], 1)

    def possible(self, x: np.ndarray, own: np.ndarray, lists: np.ndarray, radius: np.ndarray, reach: float) -> np.ndarray:
        """Per query and list: can a member lie within reach? It is within the radius given for the list of its centre, and on that side of the plane to the query's own centre."""
        c = self.centers[lists]
        far = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + self.norms[lists], 0)
        near = np.sqrt(far) <= reach + radius + 1e-6
        owns, at = np.unique(own, return_inverse=True)
        o = self.centers[owns]
        apart = np.sqrt(np.maximum(self.norms[owns][:, None] - 2 * o @ c.T + self.norms[lists], 0))
        home = ((x - self.centers[own]) ** 2).sum(1)
        return near & (far - home[:, None] <= 2 * reach * apart[at] + 1e-6)

    def offsets(self, of_list: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What coded members add to every query's squared distance."""
        return ((self.centers[of_list] + self._decoded(codes)) ** 2).sum(1)

    def distances(self, x: np.ndarray, lists: np.ndarray, at: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Asymmetric: squared distances of coded members (list lists[at]) to queries, by table lookup."""
        total = (x @ self.centers[lists].T).T[at]
        for m, (a, b, w) in enumerate(self._parts()):
            total += (w @ x[:, a:b].T).take(codes[:, m], 0)
        return (x * x).sum(1) + offsets[:, None] - 2 * total


def asks(mine: np.ndarray, other: np.ndarray | int) -> np.ndarray:
    """Every block asks itself; of two blocks exactly one asks the other, each about half of them."""
    return (mine == other) | ((other > mine) == ((mine + other) % 2 == 1))


def usable(vector: Column) -> Column:
    """Neither null nor empty, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


MEMBER = "slot int, list int, rep long, copies long, vector binary, codes binary, off double, far double"
BLOCK = "path string, batch int, lists array<int>, radius array<double>"
FOUND = "kind int, rep long, other long, n long"
# Tasks that compare blocks, at most; parts that the blocks one asks are dealt into, at most.
TASKS, PARTS = 20_000, 64


def _padded(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors as rows, in their own precision; the shorter ones end in zeros."""
    sizes, values = column.value_lengths().to_numpy(), column.flatten().to_numpy()
    if (sizes == dim).all():
        return values.reshape(-1, dim)
    x = np.zeros((len(sizes), dim), values.dtype)
    x[np.arange(dim) < sizes[:, None]] = values
    return x


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision. Scaled first, so squares neither vanish nor overflow."""
    x = rows.astype(np.float64)
    if not x.size:
        return x
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _rows(column: pa.Array, kind: str) -> np.ndarray:
    """A binary column of equally long arrays as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


class BlockWriter:
    """Rows in the order of slots and lists, as blocks: the record batches of one Arrow file, which counts once its rows are returned."""

    def __init__(self, folder: str, most: int):
        self.folder, self.most, self.held, self.n = folder, most, [], 0
        self.sink = self.file = self.path = None

    def add(self, batch: pa.RecordBatch) -> Iterator[dict]:
        """Takes rows; a block is written where it is full or the slot changes."""
        slots = batch.column("slot").to_numpy()
        start = 0
        for end in [*(np.flatnonzero(np.diff(slots)) + 1), len(slots)]:
            if self.held and self.held[-1].column("slot")[0] != batch.column("slot")[start]:
                yield from self._flush(True)
            self.held.append(batch.slice(start, end - start))
            yield from self._flush(False)
            start = end

    def _flush(self, last: bool) -> Iterator[dict]:
        rows = pa.Table.from_batches(self.held).combine_chunks() if self.held else None
        while rows and (len(rows) >= self.most or last):
            block, rows = rows.slice(0, self.most).combine_chunks().to_batches()[0], rows.slice(self.most)
            if self.file is None:
                from pyarrow import fs

                store, base = fs.FileSystem.from_uri(self.folder)
                store.create_dir(base)
                self.path = f"{base}/blocks-{uuid.uuid4().hex}.arrow"
                self.sink = store.open_output_stream(self.path)
                self.file = pa.ipc.new_file(self.sink, block.schema)
            self.file.write_batch(block)
            lists, of = np.unique(block.column("list").to_numpy(), return_inverse=True)
            radius = np.zeros(len(lists))
            np.maximum.at(radius, of, block.column("far").to_numpy())
            yield {"path": self.path, "batch": self.n, "lists": lists.tolist(), "radius": radius.tolist()}
            self.n += 1
        self.held = rows.to_batches() if rows else []

    def close(self) -> Iterator[dict]:
        yield from self._flush(True)
        if self.file:
            self.file.close()
            self.sink.close()


class BlockReader:
    """Blocks by place; the file read last stays open."""

    def __init__(self, folder: str, kind: str):
        from pyarrow import fs

        self.store, _ = fs.FileSystem.from_uri(folder)
        self.kind, self.path, self.file = kind, None, None

    def read(self, path: str, batch: int) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        """Unit vectors, codes and the other columns."""
        if path != self.path:
            self.path, self.file = path, pa.ipc.open_file(self.store.open_input_file(path))
        rows = self.file.get_batch(batch)
        return _unit(_rows(rows.column("vector"), self.kind)), _rows(rows.column("codes"), "u1"), rows


def write_blocks(distinct: DataFrame, books, slots: np.ndarray, dim: int, kind: str, folder: str, settings: IndexSettings) -> list:
    """Index the vectors and write them to the folder in blocks; where each block is, its lists and their radius in it.

    A zone's members are dealt to `slots[zone]` tasks, so a zone that holds most of the vectors is not one task's.
    """
    first = np.cumsum(slots) - slots

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _padded(batch.column("vector"), dim).astype(kind)
            own, far, codes, off = books.value.encode(_unit(x))
            zone = books.value.zone_of[own]
            slot = first[zone] + batch.column("deal").to_numpy() % slots[zone]
            arrays = [pa.array(slot, pa.int32()), pa.array(own, pa.int32()), batch.column("rep"), batch.column("copies")]
            arrays += [pa.array([row.tobytes() for row in matrix], pa.binary()) for matrix in (x, codes)]
            arrays += [pa.array(off, pa.float64()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in MEMBER.split(", ")])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BlockWriter(folder, settings.block)
        found = [block for batch in batches if batch.num_rows for block in writer.add(batch)]
        found += writer.close()
        kinds = (pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()))
        names = [f.split()[0] for f in BLOCK.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([b[n] for b in found], k) for n, k in zip(names, kinds, strict=True)], names=names)

    dealt = distinct.select("rep", "copies", "vector", F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).alias("deal"))
    members = dealt.mapInArrow(index, MEMBER).repartition(int(slots.sum()), "slot").sortWithinPartitions("slot", "list")
    return members.mapInArrow(write, BLOCK).collect()  # a row per block


def links(distinct: DataFrame, threshold: float, settings: IndexSettings) -> tuple[DataFrame, DataFrame]:
    """(rep, n) link counts weighted with copies, and edges (a, b) that connect what is linked.

    `distinct` has rep, copies and vector (array of float or double), each vector once.
    """
    spark = distinct.sparkSession
    kind = "<f4" if distinct.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    size = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    n, dim = size[0], size[1]
    lists = int(min(settings.max_lists, max(1, n // settings.list_size)))
    taken = distinct.orderBy(F.xxhash64("rep"), "rep").limit(settings.sample).select("vector").toPandas()
    sample = _unit(np.array([np.pad(np.asarray(v, np.float64), (0, dim - len(v))) for v in taken["vector"]]))
    if not len(sample):
        empty = spark.createDataFrame([], FOUND)
        return empty.select("rep", "n"), empty.select(F.col("rep").alias("a"), F.col("other").alias("b"))
    model = Codebooks(sample, lists, -(-n // settings.block), settings)
    books = spark.sparkContext.broadcast(model)  # max_lists x dimension doubles at most
    folder = work_dir(spark, "vector-blocks")
    slots = np.ceil(np.maximum(model.share * n / settings.slot, 1)).astype(np.int64)
    reach = np.sqrt(2 - 2 * threshold) + 1e-6

    written = write_blocks(distinct, books, slots, dim, kind, folder, settings)
    blocks = [(b["path"], b["batch"], np.array(b["lists"]), np.array(b["radius"])) for b in written]
    blocks = spark.sparkContext.broadcast(blocks)  # max_lists lists, more where they lie in several blocks
    together = max(1, settings.asking // settings.block)  # blocks that ask in one go
    groups = -(-len(written) // together)
    part = max(4, -(-len(written) // PARTS))  # blocks that are asked in one go
    parts = -(-len(written) // part)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, group = BlockReader(folder, kind), -1
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                if unit // parts != group:
                    group = unit // parts
                    mine = range(group * together, min((group + 1) * together, len(blocks.value)))
                    asking = _together([(k, *reader.read(*blocks.value[k][:2])) for k in mine])
                asked = range(unit % parts * part, min((unit % parts + 1) * part, len(blocks.value)))
                out = np.array(_meet(books.value, asking, asked, blocks.value, reader, threshold, reach), np.int64).reshape(-1, 4)
                columns = [pa.array(out[:, 0], pa.int32()), *(pa.array(out[:, k]) for k in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "rep", "other", "n"])

    units = spark.range(0, groups * parts, 1, min(TASKS, groups * parts))
    found = stored(units.mapInArrow(compare, FOUND), "vector-links")
    counts = found.where("kind = 0").groupBy("rep").agg(F.sum("n").alias("n"))
    return counts, found.where("kind = 1").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def _together(blocks: list[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]) -> tuple[np.ndarray, ...]:
    """(block, list, rep, copies, unit vector) of the members of some blocks, in the order of their lists."""
    block = np.concatenate([np.full(len(x), k) for k, x, _, _ in blocks])
    own, reps, copies = (np.concatenate([rows.column(c).to_numpy() for *_, rows in blocks]) for c in ("list", "rep", "copies"))
    order = np.argsort(own, kind="stable")
    return tuple(a[order] for a in (block, own, reps, copies, np.concatenate([x for _, x, _, _ in blocks])))


def _meet(books: Codebooks, asking: tuple[np.ndarray, ...], asked: range, blocks: list, reader: BlockReader, threshold: float, reach: float) -> list[tuple[int, int, int, int]]:
    """What the asking members find in the blocks they ask, as FOUND; a block that none of them can reach is not read."""
    block, own, ids, held, vectors = asking
    out: list[tuple[int, int, int, int]] = []
    total, parent = np.zeros(len(ids), np.int64), {}
    for k in asked:
        path, at, lists, radius = blocks[k]
        turn = np.flatnonzero(asks(block, k))
        turn = turn[books.possible(vectors[turn], own[turn], lists, radius, reach).any(1)] if len(turn) else turn
        if not len(turn):
            continue
        y, codes, rows = reader.read(path, at)
        reps, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        of = np.searchsorted(lists, rows.column("list").to_numpy())
        off = rows.column("off").to_numpy()
        fixed, most = books.offsets(lists[of], codes), (off + reach) ** 2 + 1e-6
        extra = np.zeros(len(reps), np.int64)
        for s in range(0, len(turn), 128):
            some = turn[s : s + 128]
            x = vectors[some]
            open_lists = books.possible(x, own[some], lists, radius, reach).any(0)
            near_at = np.flatnonzero(open_lists[of])
            near = books.distances(x, lists, of[near_at], codes[near_at], fixed[near_at]) <= most[near_at][:, None]
            near_at = near_at[near.any(1)]
            j, i = np.nonzero(y[near_at] @ x.T >= threshold - 1e-9)
            j = near_at[j]
            other = ids[some[i]] != reps[j]
            i, j = i[other], j[other]
            if not len(i):
                continue
            cosine = np.concatenate([(x[i[c : c + 4096]] * y[j[c : c + 4096]]).sum(1) for c in range(0, len(i), 4096)])
            i, j = some[i[cosine >= threshold]], j[cosine >= threshold]
            np.add.at(total, i, copies[j])
            # The member counts the query as well, unless it asks for itself: within a block both do.
            back = block[i] != k
            np.add.at(extra, j[back], held[i[back]])
            out += _forest(parent, ids[i], reps[j])
        out += [(0, int(reps[r]), 0, int(extra[r])) for r in np.flatnonzero(extra)]
    return out + [(0, int(ids[r]), 0, int(total[r])) for r in np.flatnonzero(total)]


def _forest(parent: dict[int, int], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Edges that connect the same vectors as all links so far do, no more than there are vectors; `parent` is what earlier links connect."""

    def root(v: int) -> int:
        while (p := parent.setdefault(v, v)) != v:
            parent[v] = v = parent[p]
        return v

    edges = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q:
            parent[max(p, q)] = min(p, q)
            edges.append((1, a, b, 0))
    return edges


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, settings: IndexSettings = IndexSettings(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are indexed once and counted as often as they occur. Codes only ever exclude a
    member whose true distance must exceed the threshold; what is left is compared exactly. Vectors
    that are null, empty, zero or not finite link with nothing. A shorter vector counts as ending in
    zeros. A row with a null id links with nothing (component null, kept). Repeated rows are vectors
    of their own with one id.
    """
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"  # half the bytes, the same numbers
    of_kind = F.col(vector) if single else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), of_kind.alias("vector"))
    fit = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    keyed = rows.withColumn("vector", F.when(fit, F.col("vector"))).withColumn("key", F.when(fit, F.xxhash64("vector")))
    distinct = keyed.where("vector is not null").groupBy("key", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    distinct = stored(distinct.select("rep", "copies", "vector", "key"), "distinct-vectors")
    counts, edges = links(distinct, threshold, settings)
    components = connected_components(edges, "vectors")
    known = distinct.join(counts, "rep", "left").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select(F.col("key").alias("known"), F.col("vector").alias("same"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("smallest"))
    # Vectors are shuffled for this join only if one of their hashes belongs to two of them.
    shared = distinct.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    same = F.col("key") == F.col("known")
    joined = keyed.join(known, same & (F.col("vector") == F.col("same")), "left") if shared else keyed.drop("vector").join(known.drop("same"), same, "left")
    component = F.coalesce("smallest", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

"""The warehouse layers as partitioned parquet tables under one folder.

A history table is a *base* plus the *deltas* after it:

* a base load holds all live rows, and the rows that ended since the base
  before it;
* a delta load holds the versions it opened, and for each row it ended only
  the row's identity (key, content hash, opening run) and end time;
* all of them are split into parts by a hash of the key, so a load reads and
  compaction rewrites only the parts whose keys it touches;
* where versions carry as-of columns, an incremental load also notes the keys
  it confirmed and as of when, and a full one the time of its extract.

So a load writes what changed and never rewrites what is stored; compaction
folds the deltas into a new base of the changed parts, and older bases keep the
others. Readers see a load only once its commit row exists: a load lost
half-way leaves nothing visible and can simply run again. What no recent state
of the table reaches any more can be removed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom.constants import HASHDIFF, IS_CURRENT, IS_DELETED, VALID_TO
from layerloom.functions.hashing import packed, unpacked

LOAD, STATE, PART, DAY = "_load", "_state", "_part", "_day"
LIVE, PAST = "live", "past"
BASE, DELTA = "base", "delta"
ENDED_ROWS, AS_OF = "_ended_rows", "_as_of"
COMMIT_SCHEMA = (
    "load string, position bigint, kind string, resets boolean, full_as_of timestamp_ntz, "
    "keys array<struct<name: string, type: string>>, parts int, written array<int>"
)
# A part of this many rows is read by a few tasks; the driver lists at most MAX_PARTS folders of a base.
ROWS_PER_PART, MAX_PARTS = 2_000_000, 4096
# Up to so many parts, every task writes its own file of each part; beyond, rows are first brought together by part.
FEW_PARTS = 128
# Content hashes are hex text, which only an entropy coder packs.
CODEC = "zstd"
_NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_name(run_id: str) -> str:
    """Partition value of a run; the prefix keeps Spark from reading it as a number."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id {run_id!r} does not fit a folder name")
    return f"run-{run_id}"


@dataclass(frozen=True)
class Base:
    """A base load: its number of parts, and those it wrote (None: all)."""

    load: str
    parts: int = 1
    written: frozenset[int] | None = None


@dataclass(frozen=True)
class Commits:
    """The committed loads that make up a history, oldest first."""

    bases: tuple[Base, ...] = ()
    deltas: tuple[str, ...] = ()
    position: int = 0
    loads: frozenset[str] = frozenset()
    # When the newest full extract was taken; nothing older may change a row.
    full_as_of: datetime | None = None
    # Key columns with their stored types: a part is found by the hash of the stored type.
    keys: tuple[tuple[str, str], ...] = ()

    @property
    def parts(self) -> int:
        return self.bases[-1].parts if self.bases else 1

    def owners(self) -> list[tuple[Base, frozenset[int]]]:
        """Bases that hold live rows, each with its parts: a part belongs to the newest base that wrote it."""
        left, found = set(range(self.parts)), []
        for base in reversed(self.bases):
            own = frozenset(left if base.written is None else left & base.written)
            left -= own
            if own:
                found.append((base, own))
            if base.written is None:
                break
        return found

    def part(self) -> Column:
        if self.parts == 1 or not self.keys:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(t) for k, t in self.keys]), F.lit(self.parts)).cast("int")


def folded(log: Sequence) -> Commits:
    """The state after some entries of the commit log."""
    bases: list[Base] = []
    deltas: list[str] = []
    full_as_of, keys = None, ()
    for entry in log:
        full_as_of = max(filter(None, (entry["full_as_of"], None if entry["resets"] else full_as_of)), default=None)
        if entry["kind"] == BASE:
            written = None if entry["written"] is None else frozenset(entry["written"])
            bases, deltas = [*([] if entry["resets"] else bases), Base(entry["load"], entry["parts"] or 1, written)], []
            keys = tuple((k["name"], k["type"]) for k in entry["keys"] or ())
        else:
            deltas.append(entry["load"])
    position = log[-1]["position"] if log else 0
    return Commits(tuple(bases), tuple(deltas), position, frozenset(r["load"] for r in log), full_as_of, keys)


def _same_row(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of row identities; a NULL key part equals NULL here."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


@dataclass(frozen=True)
class Layers:
    spark: SparkSession
    root: str
    rows_per_part: int = ROWS_PER_PART

    def parts_for(self, rows: int) -> int:
        return max(1, min(MAX_PARTS, -(-rows // self.rows_per_part)))

    def path(self, layer: str, table: str, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), layer, table.lower(), *parts])

    def _read(self, *paths: str, root: str | None = None) -> DataFrame | None:
        reader = self.spark.read if root is None else self.spark.read.option("basePath", root)
        try:
            return reader.parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() in _NO_FILES:
                return None
            raise

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def find(self, layer: str, table: str) -> DataFrame | None:
        return self._read(self.path(layer, table))

    # -- raw, reference and log tables ---------------------------------------

    def replace(self, layer: str, table: str, rows: DataFrame, *partitions: str) -> str:
        path = self.path(layer, table)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", CODEC)
            .partitionBy(*partitions)
            .parquet(path)
        )
        return path

    def _write_load(self, path: str, rows: DataFrame, run_id: str, *partitions: str) -> str:
        """(Re)write one run's partition as a whole, so a retry leaves no stale files."""
        target = f"{path}/{LOAD}={load_name(run_id)}"
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", CODEC)
            .partitionBy(*partitions)
            .parquet(target)
        )
        return target

    def append(self, layer: str, table: str, rows: DataFrame, run_id: str) -> str:
        """Add one run's rows; running the same run again replaces them."""
        path = self.path(layer, table)
        self._write_load(path, rows, run_id)
        return path

    def load_rows(self, layer: str, table: str, run_id: str, schema: StructType | None = None) -> DataFrame:
        """The rows one run added (a pruned partition); with a ``schema`` where runs before may lack columns."""
        stored = self.read(layer, table) if schema is None else self.spark.read.schema(schema).parquet(self.path(layer, table))
        return stored.filter(F.col(LOAD) == load_name(run_id)).drop(LOAD)

    # -- dated logs -------------------------------------------------------------

    def _folders(self, pattern: str) -> list[str]:
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        glob = jvm.org.apache.hadoop.fs.Path(pattern)
        return [f.getPath().toString() for f in glob.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(glob) or []]

    def append_log(self, table: str, rows: DataFrame, run_id: str, ts_column: str) -> str:
        """Add one run's rows to a log that is split by day; running the same run again replaces them."""
        path = self.path("monitoring", table)
        for stale in self._folders(f"{path}/{DAY}=*/{LOAD}={load_name(run_id)}"):
            self._remove(stale)
        dated = rows.withColumn(DAY, F.to_date(ts_column)).withColumn(LOAD, F.lit(load_name(run_id)))
        dated.write.mode("append").partitionBy(DAY, LOAD).parquet(path)
        return path

    def log_rows(self, table: str) -> DataFrame:
        return self.read("monitoring", table).drop(DAY, LOAD)

    def purge_log(self, table: str, expired: Column, until: Column) -> dict[str, int]:
        """Drop expired rows of a dated log; days after ``until`` hold none and are not read.

        A day without rows to keep is dropped as a folder, a day without
        expired rows is left alone, and only days that have both are rewritten.
        The driver sees one row of counts per day.
        """
        path = self.path("monitoring", table)
        old = self.read("monitoring", table).filter(F.col(DAY) <= until.cast("date"))
        days = old.groupBy(DAY).agg(F.count_if(expired).alias("gone"), F.count_if(~expired).alias("kept")).filter("gone > 0").collect()
        for day in days:
            folder = f"{path}/{DAY}={day[DAY]}"
            if day["kept"]:
                staged = f"{path}/_kept-{day[DAY]}"
                kept = self.spark.read.parquet(folder).filter(~expired)
                kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(LOAD).parquet(staged)
                self._swap(staged, folder)
            else:
                self._remove(folder)
        return {"deleted_records": sum(d["gone"] for d in days), "rewritten_days": sum(d["kept"] > 0 for d in days)}

    def _swap(self, new: str, folder: str) -> None:
        """Put a folder in another's place. The old one waits under a hidden name, so a lost driver loses no rows."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (new, folder, re.sub(r"/([^/]+)$", r"/_old-\1", folder))]
        store = paths[0].getFileSystem(context._jsc.hadoopConfiguration())
        store.rename(paths[1], paths[2])
        store.rename(paths[0], paths[1])
        store.delete(paths[2], True)

    # -- staging ---------------------------------------------------------------

    def stage(self, table: str, rows: DataFrame, run_id: str, reset: bool) -> DataFrame:
        """Write a staging batch and return it; ``reset`` drops all earlier batches."""
        if reset:
            self.replace("staging", table, rows.withColumn(LOAD, F.lit(load_name(run_id))), LOAD)
        else:
            self.append("staging", table, rows, run_id)
        return self.load_rows("staging", table, run_id)

    # -- history: commits --------------------------------------------------------

    def log(self, table: str) -> list:
        """The commit log, oldest first: one short row per load, so the driver reads it whole."""
        try:
            return sorted(self.spark.read.schema(COMMIT_SCHEMA).parquet(self.path("ods", table, "commits")).collect(), key=lambda r: r["position"])
        except AnalysisException as error:
            if error.getCondition() not in _NO_FILES:
                raise
            return []

    def commits(self, table: str) -> Commits:
        """Bases since the last reset and deltas since the last base."""
        return folded(self.log(table))

    def commit(
        self,
        table: str,
        commits: Commits,
        run_id: str,
        kind: str,
        resets: bool = False,
        full_as_of: datetime | None = None,
        base: Base | None = None,
    ) -> None:
        """Make a written load visible: one small file, written atomically."""
        entry = (load_name(run_id), commits.position + 1, kind, resets, full_as_of)
        if base is None:
            entry += (None, None, None)
        else:
            entry += (list(commits.keys), base.parts, None if base.written is None else sorted(base.written))
        row = self.spark.createDataFrame([entry], COMMIT_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path("ods", table, "commits"))

    # -- history: reading ----------------------------------------------------------
    # ``parts`` names the parts to read, None all of them: Spark lists and opens no other folder's files.

    def _base_folder(self, table: str, load: str, state: str) -> str:
        return self.path("ods", table, "base", f"{LOAD}={load}", f"{STATE}={state}")

    @staticmethod
    def _of_parts(rows: DataFrame | None, parts: Sequence[int] | None) -> DataFrame | None:
        if rows is None:
            return None
        found = rows if parts is None else rows.filter(F.col(PART).isin(*parts))
        return found.drop(PART)

    def _base_live(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame:
        held = []
        for base, own in commits.owners():
            wanted = None if len(own) == commits.parts and parts is None else sorted(own if parts is None else own & set(parts))
            if wanted != [] and (rows := self._read(self._base_folder(table, base.load, LIVE))) is not None:
                held.append(self._of_parts(rows, wanted))
        # a base without live rows has no live folder, but knows its schema
        if held:
            return reduce(DataFrame.unionByName, held)
        return self.spark.read.parquet(self._base_folder(table, commits.bases[-1].load, "schema")).drop(PART)

    def _delta(self, table: str, kind: str, loads: Sequence[str], parts: Sequence[int] | None = None) -> DataFrame | None:
        folders = [self.path("ods", table, kind, f"{LOAD}={load}") for load in loads]
        rows = self._read(*folders, root=self.path("ods", table, kind)) if folders else None
        return None if rows is None else self._of_parts(rows.drop(LOAD), parts)

    def _versions(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame:
        """Rows live at the last base and rows opened since, ended ones included."""
        base = self._base_live(table, commits, parts)
        opened = self._delta(table, "opened", commits.deltas, parts)
        return base if opened is None else base.unionByName(opened)

    def _identity(self, ended: DataFrame) -> list[str]:
        return [c for c in ended.columns if c not in (VALID_TO, IS_DELETED, ENDED_ROWS)]

    def live(self, table: str, commits: Commits | None = None, parts: Sequence[int] | None = None) -> DataFrame | None:
        """Live rows; the ends recorded since the last base are few and narrow."""
        commits = commits or self.commits(table)
        if not commits.bases:
            return None
        versions, ended = self._versions(table, commits, parts), self._delta(table, "ended", commits.deltas, parts)
        if ended is None:
            return versions
        return versions.join(ended, _same_row(versions, ended, self._identity(ended)), "left_anti")

    def _with_ends(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame:
        """Rows live at the last base or opened since, each with the end recorded for it: one join serves live and ended rows."""
        versions, ended = self._versions(table, commits, parts), self._delta(table, "ended", commits.deltas, parts)
        if ended is None:
            return versions
        names = self._identity(ended)
        versions, ended = (rows.withColumn(HASHDIFF, packed(HASHDIFF)) for rows in (versions, ended))  # both are shuffled
        ends = ended.select(*names, VALID_TO, IS_DELETED, F.lit(True).alias("_hit"))
        joined, hit = versions.join(ends, _same_row(versions, ends, names), "left"), ends["_hit"].isNotNull()
        values = {VALID_TO: ends[VALID_TO], IS_CURRENT: F.lit(False), IS_DELETED: ends[IS_DELETED]}
        taken = {c: F.when(hit, v).otherwise(versions[c]) for c, v in values.items()} | {HASHDIFF: unpacked(versions[HASHDIFF])}
        return joined.select(*[taken.get(c, versions[c]).alias(c) for c in versions.columns])

    def _ended_since_base(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame | None:
        ended = self._delta(table, "ended", commits.deltas, parts)
        if ended is None:
            return None
        versions = self._versions(table, commits, parts)
        joined = versions.join(ended, _same_row(versions, ended, self._identity(ended)))
        values = {VALID_TO: ended[VALID_TO], IS_CURRENT: F.lit(False), IS_DELETED: ended[IS_DELETED]}
        return joined.select(*[values.get(c, versions[c]).alias(c) for c in versions.columns])

    def _base_past(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame:
        """Ended rows of the bases since the last reset, read from their own folders only."""
        held = []
        for base in commits.bases:
            # the parts of a base with another number of parts are others
            wanted = parts if base.parts == commits.parts else None
            if (rows := self._read(self._base_folder(table, base.load, PAST))) is not None:
                held.append(self._of_parts(rows, wanted))
        return reduce(DataFrame.unionByName, held) if held else self._base_live(table, commits).filter(F.lit(False))

    def past(self, table: str, commits: Commits | None = None) -> DataFrame | None:
        """Ended rows of every committed load since the last reset."""
        commits = commits or self.commits(table)
        if not commits.bases:
            return None
        stored, ended = self._base_past(table, commits), self._ended_since_base(table, commits)
        return stored if ended is None else stored.unionByName(ended)

    def history(self, table: str) -> DataFrame | None:
        commits = self.commits(table)
        if not commits.bases:
            return None
        return self._base_past(table, commits).unionByName(self._with_ends(table, commits))

    def confirmed(self, table: str, commits: Commits, parts: Sequence[int] | None = None) -> DataFrame | None:
        """Keys that loads since the last reset confirmed, with the newest as-of of each."""
        loads = [*[b.load for b in commits.bases[-1:]], *commits.deltas]
        folders = [self.path("ods", table, "confirmed", f"{LOAD}={load}") for load in loads]
        found = [rows for f in folders if (rows := self._read(f)) is not None]  # not every load confirms
        if not found:
            return None
        rows = self._of_parts(reduce(DataFrame.unionByName, found), parts)
        return rows.groupBy(*[c for c in rows.columns if c != AS_OF]).agg(F.max(AS_OF).alias(AS_OF))

    def known_keys(self, table: str, keys: Sequence[str], commits: Commits, parts: Sequence[int] | None = None) -> DataFrame:
        """Keys of every stored version, live or ended; no join, key columns of the named parts only."""
        versions = self._versions(table, commits, parts).select(*keys)
        return versions.unionByName(self._base_past(table, commits, parts).select(*keys))

    # -- history: writing ------------------------------------------------------------

    @staticmethod
    def _split(rows: DataFrame, commits: Commits) -> DataFrame:
        """Rows with their part. Many parts get few files each; a part that one key fills is split by AQE."""
        split = rows.withColumn(PART, commits.part())
        return split.hint("rebalance", PART) if commits.parts > FEW_PARTS else split

    def write_base(self, table: str, rows: DataFrame, run_id: str, commits: Commits) -> DataFrame:
        """Write live and ended rows in one job, split into the parts of ``commits``; not yet visible."""
        state = F.when(F.col(IS_CURRENT), F.lit(LIVE)).otherwise(F.lit(PAST))
        split = self._split(rows.withColumn(STATE, state), commits)
        target = self._write_load(self.path("ods", table, "base"), split, run_id, STATE, PART)
        empty = self.spark.createDataFrame([], rows.schema)
        empty.write.mode("overwrite").option("compression", CODEC).parquet(f"{target}/{STATE}=schema/{PART}=0")
        return self.spark.read.schema(rows.schema).parquet(target)

    def _write_delta(self, table: str, kind: str, rows: DataFrame, run_id: str, commits: Commits | None) -> DataFrame:
        split = self._split(rows, commits or self.commits(table))
        target = self._write_load(self.path("ods", table, kind), split, run_id, PART)
        return self.spark.read.schema(rows.schema).parquet(target)

    def write_opened(self, table: str, rows: DataFrame, run_id: str, commits: Commits | None = None) -> DataFrame:
        return self._write_delta(table, "opened", rows, run_id, commits)

    def write_ended(self, table: str, rows: DataFrame, run_id: str, commits: Commits | None = None) -> DataFrame:
        return self._write_delta(table, "ended", rows, run_id, commits)

    def write_confirmed(self, table: str, rows: DataFrame, run_id: str, commits: Commits | None = None) -> None:
        self._write_delta(table, "confirmed", rows, run_id, commits)

    def work(self, table: str, step: str, rows: DataFrame, run_id: str) -> DataFrame:
        """Rows of one step of a load, stored until :meth:`drop_work`."""
        target = self._write_load(self.path("ods", table, "work", step), rows, run_id)
        return self.spark.read.schema(rows.schema).parquet(target)

    def _remove(self, path: str) -> None:
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def drop_work(self, table: str, run_id: str, steps: Sequence[str]) -> None:
        for step in steps:
            self._remove(self.path("ods", table, "work", step, f"{LOAD}={load_name(run_id)}"))

    def changed_parts(self, table: str, commits: Commits) -> list[int]:
        """Parts that the deltas since the last base touched: at most MAX_PARTS numbers, read from folder names."""
        folders = [f for kind in ("opened", "ended") for load in commits.deltas for f in self._folders(self.path("ods", table, kind, f"{LOAD}={load}", f"{PART}=*"))]
        return sorted({int(f.rsplit("=", 1)[1]) for f in folders})

    def compact(self, table: str) -> bool:
        """Fold the deltas into a new base of the changed parts; the history reads the same before and after.

        All parts are rewritten when most of them changed, or when the table has
        outgrown their number.
        """
        commits = self.commits(table)
        if not commits.deltas:
            return False
        changed = self.changed_parts(table, commits)
        grown = self.parts_for(self._versions(table, commits).count())  # from row group counts
        if grown > 2 * commits.parts or 2 * len(changed) >= commits.parts:
            changed, base = None, Base("", max(grown, commits.parts))
        else:
            base = Base("", commits.parts, frozenset(changed))
        run_id = f"compact-{commits.position + 1}"
        resized = replace(commits, bases=(*commits.bases, base))
        self.write_base(table, self._with_ends(table, commits, changed), run_id, resized)
        if (seen := self.confirmed(table, commits)) is not None:
            self.write_confirmed(table, seen, run_id, resized)
        self.commit(table, commits, run_id, BASE, base=base)
        return True

    def purge(self, table: str, keep: int = 2) -> list[str]:
        """Remove what none of the last ``keep + 1`` states of the table reaches; returns the removed folders.

        ``keep`` is the horizon for readers: a query that began up to so many
        loads ago still finds its files. Ended rows stay until a reset.
        """
        log = self.log(table)
        reached: set[str] = set()
        for end in range(max(1, len(log) - keep), len(log) + 1):
            state = folded(log[:end])
            owners = {base.load for base, _ in state.owners()} | {base.load for base in state.bases[-1:]}
            for base in state.bases:
                reached.add(self._base_folder(table, base.load, PAST))
                if base.load in owners:
                    reached |= {self._base_folder(table, base.load, kind) for kind in (LIVE, "schema")}
            for load in (*[base.load for base in state.bases[-1:]], *state.deltas):
                reached |= {self.path("ods", table, kind, f"{LOAD}={load}") for kind in ("opened", "ended", "confirmed")}
        known = set()
        for entry in log:
            known |= {self._base_folder(table, entry["load"], kind) for kind in (LIVE, "schema", PAST)} if entry["kind"] == BASE else set()
            known |= {self.path("ods", table, kind, f"{LOAD}={entry['load']}") for kind in ("opened", "ended", "confirmed")}
        removed = sorted(known - reached)
        for folder in removed:
            self._remove(folder)
        return removed

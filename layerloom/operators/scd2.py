"""Slowly changing history (type 2) as row branches.

Spark has no row-level UPDATE on parquet, so a merge is a pure function of the
old history and the batch: untouched history, then every live row *kept*,
*closed* or *deleted*, then the *inserted* versions. Live rows and the batch
meet on the key in one left join that carries only key and hash of the batch;
Catalyst broadcasts that side when its size allows and AQE splits a skewed key
on the live side. History rows (closed or deleted) are never joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import (
    FULL,
    FULL_RESET,
    HASHDIFF,
    INCREMENTAL,
    IS_CURRENT,
    IS_DELETED,
    LOAD_MODES,
    ROW_POSITION,
    RUN_ID,
    SCD2_COLUMNS,
    VALID_FROM,
    VALID_TO,
)
from layerloom.functions.hashing import hashdiff, packed, unpacked
from layerloom.operators.keyed import latest_per_key, moment, skew_safe_join, unmatched

KEEP, CLOSE, DELETE = "keep", "close", "delete"
INSERT, NOOP = "insert", "noop"


@dataclass(frozen=True)
class History:
    """What a merge needs to know about one table.

    ``order`` names the columns that pick the winner among batch rows of one
    key, largest first. By default the newest staging row wins: latest run, then
    extraction, file and row in the file. The hash breaks remaining ties, so the winner's content is always the same.

    ``as_of`` names the columns that say when a row was true (``ROW_POSITION``:
    extraction time first). They pick the winner unless ``order`` is given,
    travel with every version, and guard the merge: a row that is older than
    what is live, or was confirmed or deleted since, changes nothing.
    """

    keys: tuple[str, ...]
    columns: tuple[str, ...]
    hash_columns: tuple[str, ...] | None = None
    order: tuple[str, ...] = ()
    as_of: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("history needs at least one key column")

    @property
    def hash_expression(self) -> Column:
        return hashdiff(self.columns if self.hash_columns is None else self.hash_columns)

    def winner_order(self, batch: DataFrame) -> list[Column]:
        newest = tuple(c for c in (VALID_FROM, *ROW_POSITION) if c in batch.columns)
        return [F.desc(c) for c in (*(self.order or self.as_of or newest), HASHDIFF)]

    def moment_of(self, prefix: str = "") -> Column:
        """The as-of columns as one value that compares; a row without a position is older than any other."""
        return F.struct(*[F.col(f"{prefix}{c}") for c in self.as_of])


def with_hash(batch: DataFrame, table: History) -> DataFrame:
    """The batch with its content hash; a hash stored at staging time is reused."""
    if HASHDIFF in batch.columns:
        return batch
    return batch.withColumn(HASHDIFF, table.hash_expression)


def incoming(batch: DataFrame, table: History) -> DataFrame:
    """One row per key: business columns, hash and as-of columns."""
    if _order_decides(batch, table):
        # The hash can't break a tie then, so it is taken of the winners and doesn't travel.
        winners = with_hash(latest_per_key(batch, table.keys, table.winner_order(batch)[:-1]), table)
    else:
        hashed = with_hash(batch, table)
        winners = latest_per_key(hashed, table.keys, table.winner_order(hashed))
    return winners.select(*table.columns, HASHDIFF, *table.as_of)


def _order_decides(batch: DataFrame, table: History) -> bool:
    """Whether rows that agree in key and order columns have the same hash. Equal floats and collated texts may differ in theirs."""
    hashed = table.columns if table.hash_columns is None else table.hash_columns
    if HASHDIFF in batch.columns or not table.order or not set(hashed) <= {*table.keys, *table.order}:
        return False
    types = [batch.schema[c].dataType.simpleString() for c in hashed]
    return not any(word in t for t in types for word in ("float", "double", "collate"))


STALE = "_stale"


def newest_known(known: DataFrame, source: DataFrame, table: History) -> DataFrame:
    """Per source key, the newest as-of of ``known`` rows (key and as-of columns)."""
    narrow = known.select(*table.keys, *table.as_of)
    matched = skew_safe_join(narrow, source.select(*table.keys), table.keys, "left_semi")
    return matched.groupBy(*table.keys).agg(F.max(table.moment_of()).alias("_newest"))


def marked_stale(source: DataFrame, known: DataFrame, table: History, horizon: datetime | None = None) -> DataFrame:
    """Source rows with ``_stale``: older than what is known of their key, or than the last full extract.

    Stale rows still count as present, so a FULL load does not delete their keys.
    """
    if not table.as_of:
        return source
    joined = source.join(newest_known(known, source, table), list(table.keys), "left")
    stale = F.coalesce(table.moment_of() < F.col("_newest"), F.lit(False))
    if horizon is not None:
        stale = stale | F.coalesce(F.col(table.as_of[0]) < moment(horizon), F.lit(False))
    return joined.select(*source.columns, stale.alias(STALE))


def _is_stale(source: DataFrame) -> Column:
    return F.col(STALE) if STALE in source.columns else F.lit(False)


def horizon_of(source: DataFrame, table: History) -> datetime | None:
    """When the newest row of a batch was extracted."""
    return source.agg(F.max(table.as_of[0])).first()[0] if table.as_of else None


def opened(rows: DataFrame, table: History, run_ts: datetime | str | Column, run_id: str) -> DataFrame:
    """Hashed rows as current versions of this run."""
    return rows.select(
        *table.columns,
        moment(run_ts).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        F.lit(False).alias(IS_DELETED),
        F.col(HASHDIFF),
        F.lit(run_id).alias(RUN_ID),
        *table.as_of,
    )


def open_versions(batch: DataFrame, table: History, run_ts: datetime | str, run_id: str) -> DataFrame:
    """First load and FULL_RESET: every batch row becomes current, duplicates too."""
    return opened(with_hash(batch, table), table, run_ts, run_id)


def is_live() -> Column:
    return F.col(IS_CURRENT) & ~F.col(IS_DELETED)


def current_view(history: DataFrame) -> DataFrame:
    return history.filter(is_live())


def check_mode(mode: str) -> None:
    if mode not in LOAD_MODES:
        raise ValueError(f"unknown load mode {mode!r}")


def decided(
    live: DataFrame,
    source: DataFrame,
    table: History,
    mode: str,
    horizon: datetime | None = None,
    carry: Sequence[Column] = (),
    stored: bool = False,
) -> DataFrame:
    """Live rows with ``_action``: close a changed row, delete a missing key (FULL only).

    A NULL key never matches, so in FULL mode such rows are deleted. Rows that
    were extracted after the ``horizon`` of a full extract are not missing from
    it. A row that a newer source row confirms takes over its as-of. Columns to
    ``carry`` may look at the match (``_hit``, ``_src_hash``). A ``stored``
    source isn't grouped by key, so a plain join shuffles both sides and AQE
    can split a hot key without an extra column.
    """
    narrow = source.select(
        *table.keys,
        F.col(HASHDIFF).alias("_src_hash"),
        _is_stale(source).alias("_src_stale"),
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_src{c}") for c in table.as_of],
    )
    joined = live.join(narrow, list(table.keys), "left") if stored else skew_safe_join(live, narrow, table.keys, "left")
    changed = F.col("_hit") & ~F.col("_src_stale") & ~F.col(HASHDIFF).eqNullSafe(F.col("_src_hash"))
    action = F.when(changed, F.lit(CLOSE))
    if mode == FULL:
        missing = F.col("_hit").isNull()
        if horizon is not None:
            missing = missing & F.coalesce(F.col(table.as_of[0]) <= moment(horizon), F.lit(True))
        action = action.when(missing, F.lit(DELETE))
    acted = joined.withColumn("_action", action.otherwise(F.lit(KEEP)))
    newer = (F.col("_action") == KEEP) & F.col("_hit") & ~F.col("_src_stale")
    return acted.select(
        *[F.when(newer, F.col(f"_src{c}")).otherwise(F.col(c)).alias(c) if c in table.as_of else c for c in live.columns], "_action", *carry
    )


def _applied(rows: DataFrame, run_ts: Column) -> DataFrame:
    ended = F.col("_action") != KEEP
    return rows.withColumns(
        {
            VALID_TO: F.when(ended, run_ts).otherwise(F.col(VALID_TO)),
            IS_CURRENT: ~ended,
            IS_DELETED: F.col("_action") == DELETE,
        }
    ).drop("_action")


def close_changed(history: DataFrame, batch: DataFrame, table: History, run_ts: datetime | str) -> DataFrame:
    """Only the rows a merge closes because their content changed."""
    live = current_view(history)
    rows = decided(live, marked_stale(incoming(batch, table), live, table), table, INCREMENTAL)
    return _applied(rows.filter(F.col("_action") == CLOSE), moment(run_ts))


def soft_delete(history: DataFrame, batch: DataFrame, table: History, run_ts: datetime | str) -> DataFrame:
    """Only the rows a FULL merge deletes because their key is gone."""
    source = incoming(batch, table)
    rows = decided(current_view(history), source, table, FULL, horizon_of(source, table))
    return _applied(rows.filter(F.col("_action") == DELETE), moment(run_ts))


def to_insert(live: DataFrame, source: DataFrame, table: History) -> DataFrame:
    """Fresh source rows with no live version of the same key and content."""
    fresh = source.filter(~F.col(STALE)).drop(STALE) if STALE in source.columns else source
    return unmatched(fresh, live, [*table.keys, HASHDIFF], table.keys)


def new_keys(history: DataFrame, source: DataFrame, table: History) -> DataFrame:
    """Source rows whose key has no version at all, live or past."""
    return unmatched(source, history, table.keys, table.keys)


def _null_key(table: History) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in table.keys])


def insert_versions(
    history: DataFrame,
    batch: DataFrame,
    table: History,
    run_ts: datetime | str,
    run_id: str,
    mode: str = INCREMENTAL,
) -> DataFrame:
    """New, changed and resurrected rows as open versions.

    In FULL mode the delete step follows the insert and cannot match a NULL
    key, so such a row goes out closed and deleted in the same run.
    """
    live = current_view(history)
    source = marked_stale(incoming(batch, table), live, table)
    stamp = moment(run_ts)
    rows = opened(to_insert(live, source, table), table, stamp, run_id)
    if mode != FULL:
        return rows
    lost = _null_key(table)
    return rows.withColumns(
        {
            VALID_TO: F.when(lost, stamp).otherwise(F.col(VALID_TO)),
            IS_CURRENT: ~lost,
            IS_DELETED: lost,
        }
    )


def changed_rows(
    live: DataFrame, batch: DataFrame, table: History, mode: str, run_ts: datetime | str, run_id: str
) -> DataFrame:
    """Every live row after the merge plus the inserted versions; no older history."""
    check_mode(mode)
    source = marked_stale(incoming(batch, table), live, table)
    horizon = horizon_of(source, table) if mode == FULL else None
    rows = _applied(decided(live, source, table, mode, horizon), moment(run_ts))
    added = insert_versions(live, batch, table, run_ts, run_id, mode)
    return rows.select(*table.columns, *SCD2_COLUMNS, *table.as_of).unionByName(added)


def merge(
    history: DataFrame | None,
    batch: DataFrame,
    table: History,
    mode: str,
    run_ts: datetime | str,
    run_id: str,
) -> DataFrame:
    """The whole history after one load."""
    check_mode(mode)
    if history is None or mode == FULL_RESET:
        return open_versions(batch, table, run_ts, run_id)
    ordered = history.select(*table.columns, *SCD2_COLUMNS, *table.as_of)
    past = ordered.filter(~is_live())
    return past.unionByName(changed_rows(current_view(ordered), batch, table, mode, run_ts, run_id))



def fates(
    live: DataFrame, source: DataFrame, table: History, mode: str, horizon: datetime | None = None
) -> DataFrame:
    """What becomes of live rows, by identity (key, hash, opening run): ``_action``, ``_rows`` that share it, and ``_same`` where the batch says the same.

    No business column is read. Outside FULL mode only rows whose key is in the batch are listed.
    Rows of one key are counted where the join left them, without a shuffle of their own.
    """
    same = F.coalesce(F.col(HASHDIFF) == F.col("_src_hash"), F.lit(False)).alias("_same")
    narrow = live.select(*table.keys, packed(HASHDIFF).alias(HASHDIFF), RUN_ID, *table.as_of)
    rows = decided(narrow, source.withColumn(HASHDIFF, packed(HASHDIFF)), table, mode, horizon, carry=(same, F.col("_hit")), stored=True)
    listed = rows if mode == FULL else rows.filter("_hit")
    counted = listed.groupBy(*table.keys, HASHDIFF, RUN_ID, "_action", "_same").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.withColumn(HASHDIFF, unpacked(F.col(HASHDIFF)))


def ended(acted: DataFrame, table: History, run_ts: datetime | str) -> DataFrame:
    """The rows a merge ends, as identities with end time.

    Rows that share an identity share their fate, so the identity is enough to
    apply the ends later.
    """
    rows = acted.filter(F.col("_action") != KEEP)
    counts = [c for c in acted.columns if c == "_rows"]
    return rows.select(
        *table.keys, HASHDIFF, RUN_ID, moment(run_ts).alias(VALID_TO), (F.col("_action") == DELETE).alias(IS_DELETED), *counts
    )


def endings(
    live: DataFrame, source: DataFrame, table: History, mode: str, run_ts: datetime | str, horizon: datetime | None = None
) -> DataFrame:
    """What a merge ends, in one step."""
    narrow = live.select(*table.keys, HASHDIFF, RUN_ID, *table.as_of)
    return ended(decided(narrow, source, table, mode, horizon), table, run_ts)


def unmatchable(rows: DataFrame, table: History, run_ts: datetime | str) -> DataFrame:
    """Versions with a NULL key part, as endings: a FULL load deletes them at once."""
    return rows.filter(_null_key(table)).select(
        *table.keys, HASHDIFF, RUN_ID, moment(run_ts).alias(VALID_TO), F.lit(True).alias(IS_DELETED)
    )


STATS = ("total_rows", "new_records", "updated_records", "closed_records", "inserted_records", "deleted_records")


def one_row(metrics: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """``(metric, n)`` frames turned into a single row, without a cross join."""
    rows = reduce(DataFrame.unionByName, metrics)
    return rows.agg(
        *[F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("n"))), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def metric(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")


COUNTED = ("closed", "missing", "matched", "known", "source", "null_keys")


def _metrics(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """A one-row frame as ``(metric, n)`` rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.coalesce(n, F.lit(0)).cast("bigint").alias("n")) for n in names])
    return rows.select(F.inline(pairs))


def _key_counts(history: DataFrame, source: DataFrame, table: History, mode: str) -> DataFrame:
    """Rows closed and missing, keys already live with this content, keys known at all.

    All four come from one join of key and hash over every stored version.
    """
    narrow = source.select(*table.keys, F.col(HASHDIFF).alias("_src_hash"), F.lit(True).alias("_hit"))
    versions = history.select(*table.keys, HASHDIFF, is_live().alias("_live"))
    hit = F.coalesce("_hit", F.lit(False))
    same = F.col(HASHDIFF).eqNullSafe(F.col("_src_hash"))
    gone = F.col("_live") & ~hit if mode == FULL else F.lit(False)
    per_key = (
        skew_safe_join(versions, narrow, table.keys, "left")
        .groupBy(*table.keys)
        .agg(
            F.count_if(F.col("_live") & hit & ~same).alias("closed"),
            F.count_if(gone).alias("missing"),
            F.count_if(F.col("_live") & hit & same).alias("same"),
            F.count_if(hit).alias("hits"),
        )
    )
    totals = per_key.agg(
        F.sum("closed").alias("closed"),
        F.sum("missing").alias("missing"),
        F.count_if(F.col("same") > 0).alias("matched"),
        F.count_if(F.col("hits") > 0).alias("known"),
    )
    return _metrics(totals, ("closed", "missing", "matched", "known"))


def _source_counts(source: DataFrame, table: History) -> DataFrame:
    totals = source.agg(F.count(F.lit(1)).alias("source"), F.count_if(_null_key(table)).alias("null_keys"))
    return _metrics(totals, ("source", "null_keys"))


def merge_stats(history: DataFrame | None, batch: DataFrame, table: History, mode: str) -> DataFrame:
    """Counts of one merge: closed = updated, total = closed + inserted + deleted."""
    check_mode(mode)
    if history is None or mode == FULL_RESET:
        counts = one_row([metric(batch, "inserted")], ("inserted",))
        zero = F.lit(0).cast("bigint")
        n = F.col("inserted")
        values = dict(zip(STATS, (n, n, zero, zero, n, zero), strict=True))
    else:
        source = incoming(batch, table).select(*table.keys, HASHDIFF)
        counts = one_row([_key_counts(history, source, table, mode), _source_counts(source, table)], COUNTED)
        closed, added = F.col("closed"), F.col("source") - F.col("matched")
        deleted = F.col("missing") + (F.col("null_keys") if mode == FULL else F.lit(0))
        new = F.col("source") - F.col("known")
        values = dict(zip(STATS, (closed + added + deleted, new, closed, closed, added, deleted), strict=True))
    return counts.select(*[v.alias(k) for k, v in values.items()])


def decide(existing_hash: Column, incoming_hash: Column, is_current: Column, is_deleted: Column) -> Column:
    """What one incoming row means for the stored version of its key."""
    return (
        F.when(is_deleted, INSERT)
        .when(existing_hash.isNull(), INSERT)
        .when(~is_current, INSERT)
        .when(existing_hash != incoming_hash, CLOSE)
        .otherwise(NOOP)
    )


def decisions(history: DataFrame, batch: DataFrame, table: History) -> DataFrame:
    """Per incoming key, the decision against its newest stored version."""
    newest = latest_per_key(
        history.select(*table.keys, VALID_FROM, IS_CURRENT, IS_DELETED, F.col(HASHDIFF).alias("existing_hash")),
        table.keys,
        [F.desc(VALID_FROM), F.desc(IS_CURRENT), F.desc("existing_hash")],
    ).drop(VALID_FROM)
    source = incoming(batch, table).select(*table.keys, F.col(HASHDIFF).alias("incoming_hash"))
    joined = source.join(newest, list(table.keys), "left")
    action = decide(
        F.col("existing_hash"),
        F.col("incoming_hash"),
        F.coalesce(F.col(IS_CURRENT), F.lit(True)),
        F.coalesce(F.col(IS_DELETED), F.lit(False)),
    )
    return joined.select(*table.keys, "existing_hash", "incoming_hash", action.alias("action"))

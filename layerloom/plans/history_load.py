"""One history load: decide on keys and hashes, write what changed, count, commit."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.constants import FULL, FULL_RESET, HASHDIFF, IS_DELETED
from layerloom.functions.hashing import packed, unpacked
from layerloom.operators import scd2
from layerloom.operators.scd2 import History
from layerloom.session import hot_keys_split
from layerloom.sources.layers import AS_OF, BASE, DELTA, ENDED_ROWS, PART, Base, Layers, load_name

# An hourly load then rewrites the live rows once a day.
COMPACT_AFTER = 24


def _delta_stats(opened: DataFrame, ended: DataFrame, known: DataFrame, table: History) -> dict[str, int]:
    """Merge counters read back from what the load wrote.

    They need narrow columns only, and hold whatever tasks were retried on the
    way. New keys are the inserted ones without an earlier version.
    """
    sums = ended.agg(
        F.sum(F.when(~F.col(IS_DELETED), F.col(ENDED_ROWS))).alias("closed"),
        F.sum(F.when(F.col(IS_DELETED), F.col(ENDED_ROWS))).alias("deleted"),
    ).first()
    inserted, closed, deleted = opened.count(), sums["closed"] or 0, sums["deleted"] or 0
    new = scd2.new_keys(known, opened, table).count() if inserted else 0
    values = (inserted + closed + deleted, new, closed, closed, inserted, deleted)
    return dict(zip(scd2.STATS, values, strict=True))


def load_history(
    layers: Layers,
    name: str,
    batch: DataFrame,
    table: History,
    mode: str,
    run_ts: datetime | str,
    run_id: str,
    compact_after: int = COMPACT_AFTER,
) -> dict[str, int]:
    """Merge a batch into a stored history and return its counters.

    Of the stored rows only key, hash and opening run are read, and an
    INCREMENTAL load reads only the parts its keys fall into; live rows are
    rewritten by compaction only, every ``compact_after`` loads, changed parts
    alone. A run that is already committed is
    skipped, so a retried caller does no harm. Rows that are older than what
    the history knows of their key (``History.as_of``) change nothing, so files
    may come late and staging may be replayed.
    """
    scd2.check_mode(mode)
    commits = layers.commits(name)
    if load_name(run_id) in commits.loads:
        return dict.fromkeys(scd2.STATS, 0)
    if mode == FULL_RESET or not commits.bases:
        rows = scd2.open_versions(batch, table, run_ts, run_id)
        keys = tuple((k, rows.schema[k].dataType.simpleString()) for k in table.keys)
        base = Base("", layers.parts_for(batch.count()))
        written = layers.write_base(name, rows, run_id, replace(commits, bases=(base,), keys=keys))
        whole = scd2.horizon_of(written, table) if mode in (FULL, FULL_RESET) else None
        layers.commit(name, replace(commits, keys=keys), run_id, BASE, resets=True, full_as_of=whole, base=base)
        n = written.count()
        return dict(zip(scd2.STATS, (n, n, 0, 0, n, 0), strict=True))

    # The batch is hashed and deduplicated once; every later step reads it, or its narrow columns, back.
    winners = layers.work(name, "winners", scd2.incoming(batch, table).withColumn(PART, commits.part()), run_id)
    parts = None if mode == FULL else sorted(r[0] for r in winners.select(PART).distinct().collect())
    source, live = winners.drop(PART), layers.live(name, commits, parts)
    whole = scd2.horizon_of(source, table) if mode == FULL else None
    if table.as_of:
        at = [*table.keys, *table.as_of]
        seen, known = layers.confirmed(name, commits, parts), live.select(*at)
        if seen is not None:
            known = known.unionByName(seen.select(*table.keys, f"{AS_OF}.*"))
        source = layers.work(name, "source", scd2.marked_stale(source, known, table, commits.full_as_of), run_id)
    # One narrow join of live rows and batch says what ends, what is there already, and what is confirmed.
    with hot_keys_split(layers.spark):
        fates = layers.work(name, "fates", scd2.fates(live, source, table, mode, whole), run_id)
    fresh = source.filter(~F.col(scd2.STALE)).drop(scd2.STALE) if table.as_of else source
    same = fates.filter("_same").select(*table.keys).distinct()
    if HASHDIFF not in batch.columns and set(table.hash_columns or ()) <= set(table.columns):
        # the hash of a whole row is taken again rather than shuffled with it
        missing = scd2.with_hash(fresh.drop(HASHDIFF).join(same, list(table.keys), "left_anti"), table)
    else:
        missing = fresh.withColumn(HASHDIFF, packed(HASHDIFF)).join(same, list(table.keys), "left_anti")
        missing = missing.withColumn(HASHDIFF, unpacked(F.col(HASHDIFF)))
    opened = layers.write_opened(name, scd2.opened(missing, table, run_ts, run_id), run_id, commits)
    ends = scd2.ended(fates, table, run_ts).withColumnRenamed("_rows", ENDED_ROWS)
    if mode == FULL:
        # opened rows are one per key and of this run, so none repeats an identity
        ends = ends.unionByName(scd2.unmatchable(opened, table, run_ts).withColumn(ENDED_ROWS, F.lit(1).cast("bigint")))
    ended = layers.write_ended(name, ends, run_id, commits)
    if table.as_of and mode != FULL:
        seen_now = fresh.join(same, list(table.keys), "left_semi").select(*table.keys, table.moment_of().alias(AS_OF))
        layers.write_confirmed(name, seen_now, run_id, commits)
    stats = _delta_stats(opened, ended, layers.known_keys(name, table.keys, commits, parts), table)
    layers.commit(name, commits, run_id, DELTA, full_as_of=whole)
    layers.drop_work(name, run_id, ("winners", "source", "fates"))
    if len(commits.deltas) + 1 >= compact_after:
        layers.compact(name)
        layers.purge(name)
    return stats


def replay_from_staging(
    layers: Layers, name: str, staging: DataFrame, table: History, run_ts: datetime | str, run_id: str
) -> dict[str, int]:
    """Recover a history from its staging rows, of one run or several: a FULL merge, refused on empty staging.

    Of each key the newest version counts, whichever run staged it.
    """
    if staging.isEmpty():
        raise ValueError(f"no staging rows to replay for {name}")
    return load_history(layers, name, staging, table, FULL, run_ts, run_id)

"""Conversion statistics of the day kept up to date without reading the day again.

A run reads the conversions that were loaded after the last one, by the load clock, and stores their
totals as one more layer: per offer and combination of affiliate, country and zone, once for both clocks.
Totals add up, and the distinct values of an offer are those of its combinations, so the snapshot of the
day comes from the layers, as large as the number of combinations and not as the log. A run therefore
writes as much as was loaded since the last one; when there are many layers, it joins them into one.
Conversions that are loaded before they happen wait in the store until their time has come.

Every run stores its layer and waiting rows in folders of its own and then notes the run with all layers
of its totals. It begins from the latest noted run before it, so a run that is repeated gives the same, and
one that died was never noted. A layer goes with the last noted run that has it.
A batch time must not lie after the latest load, or rows that are loaded late for it are never read.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import as_utc, day_start, minute_key, time_literal
from clicktally.operators.conversions import (
    CLOCKS,
    DIMENSIONS,
    as_conversion_snapshot,
    by_marked_type,
    combination_totals,
    conversion_rejects,
    merge_combinations,
    window_marks,
)
from clicktally.plans.jobs import fitting_rows
from clicktally.plans.rejects import write_rejects
from clicktally.schemas import CONVERSION_LOG, CONVERSION_SNAPSHOT
from clicktally.session import delete_path, fresh_path
from clicktally.sinks import write_run

HAPPENED, LOADED = CLOCKS["C"], CLOCKS["R"]
TOTALS = ("click_count", "received", "paid")
NOTES_SCHEMA = "as_of long, since long, noted timestamp, layers array<string>, name string"

# The columns that tell on which clocks the rows of a combination count.
MARKS = tuple(CLOCKS)

# Batch times whose runs are kept; older ones are deleted when a run has been noted.
KEPT_RUNS = 2

# Layers of totals beyond which a run joins them into one.
MOST_LAYERS = 8


def _seconds(moment: datetime) -> int:
    return int(as_utc(moment).replace(tzinfo=timezone.utc).timestamp())


def _noted_runs(spark: SparkSession, path: str) -> list[Row]:
    """The noted runs, the latest of each batch time last; a handful, since old ones are deleted."""
    try:
        notes = spark.read.schema(NOTES_SCHEMA).parquet(f"{path}/notes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(notes.collect(), key=lambda note: (note.as_of, note.noted))


def _note_run(
    spark: SparkSession, path: str, name: str, as_of: datetime, since: datetime, layers: list[str]
) -> None:
    note = spark.range(1).select(
        F.lit(_seconds(as_of)).cast("long").alias("as_of"),
        F.lit(_seconds(since)).cast("long").alias("since"),
        F.current_timestamp().alias("noted"),
        F.array(*map(F.lit, layers)).alias("layers"),
    )
    note.write.parquet(f"{path}/notes/name={name}")


def _forget(spark: SparkSession, path: str) -> None:
    """Delete what is older than the last batch times, each note before its run and layers."""
    runs = _noted_runs(spark, path)
    latest = {note.as_of: note for note in runs}
    kept = [latest[as_of] for as_of in sorted(latest)[-KEPT_RUNS:]]
    names, layers = {note.name for note in kept}, {layer for note in kept for layer in note.layers or ()}
    for note in runs:
        if note.name not in names:
            delete_path(spark, f"{path}/notes/name={note.name}", f"{path}/notes")
            delete_path(spark, f"{path}/{note.name}", path)
            for layer in set(note.layers or ()) - layers:
                delete_path(spark, f"{path}/layers/{layer}", f"{path}/layers")


def _run_before(spark: SparkSession, path: str, as_of: datetime, since: datetime) -> Row | None:
    """The latest noted run of the same window before ``as_of``.

    Notes of a store without layers, as earlier versions wrote them, are passed over.
    """
    runs = [
        note
        for note in _noted_runs(spark, path)
        if note.as_of < _seconds(as_of) and note.since == _seconds(since) and note.layers
    ]
    return runs[-1] if runs else None


def _newly_loaded(
    log: DataFrame, before: datetime | None, as_of: datetime, since: datetime
) -> Column:
    """Whether a run has to read a conversion; can be pushed to a scan.

    The first run of a window reads what happens in it or later and what was loaded in it.
    """
    kinds = {clock: log.schema[clock].dataType for clock in (HAPPENED, LOADED)}
    until = F.col(LOADED) <= time_literal(as_of, kinds[LOADED])
    if before is not None:
        return until & (F.col(LOADED) > time_literal(before, kinds[LOADED]))
    in_time = [F.col(clock) >= time_literal(since, kind) for clock, kind in kinds.items()]
    return until & (in_time[0] | in_time[1])


def new_totals(
    loaded: DataFrame, waited: DataFrame, as_of: datetime, since: datetime
) -> DataFrame:
    """Totals per clocks, offer and combination of newly loaded conversions and of those that waited.

    The latter were counted on the load clock when they were loaded.
    """
    marks = window_marks(loaded, as_of, since)
    rows = loaded.withColumns(marks).unionByName(
        waited.withColumns({**marks, "R": F.lit(None).cast("boolean")})
    )
    counted = rows.filter(F.coalesce(*MARKS).isNotNull())
    return combination_totals(counted, *MARKS)


def join_totals(layers: DataFrame) -> DataFrame:
    """One row per clocks, offer and combination; sums keep the type of their parts."""
    sums = [F.sum(name).cast(layers.schema[name].dataType).alias(name) for name in TOTALS]
    return layers.groupBy(*MARKS, "offer_id", *DIMENSIONS).agg(*sums)


def _read_layers(spark: SparkSession, path: str, layers: list[str]) -> DataFrame:
    return spark.read.parquet(*(f"{path}/layers/{layer}" for layer in layers))


def refresh_totals(
    log: DataFrame, path: str, as_of: datetime, since: datetime | None = None
) -> DataFrame:
    """The totals of the window up to ``as_of``, brought up to date.

    They are rows of all layers, so a combination of an offer may have one in each. The window opens at the start of the day, or at ``since``. ``log`` is read from the last noted run of
    the same window on, or from the start of the window if there is none.
    """
    spark = log.sparkSession
    since = day_start(as_of) if since is None else as_utc(since)
    before = _run_before(spark, path, as_of, since)
    mark = before and datetime.fromtimestamp(before.as_of, timezone.utc)
    loaded = log.select(*CONVERSION_LOG.names).filter(_newly_loaded(log, mark, as_of, since))
    waited = spark.read.parquet(f"{path}/{before.name}/waiting") if before else loaded.limit(0)
    name = fresh_path(spark, "run").rpartition("/")[2]
    new_totals(loaded, waited, as_of, since).write.parquet(f"{path}/layers/{name}")
    layers = [*(before.layers if before else []), name]
    if len(layers) > MOST_LAYERS:
        joined = fresh_path(spark, "joined").rpartition("/")[2]
        join_totals(_read_layers(spark, path, layers)).write.parquet(f"{path}/layers/{joined}")
        delete_path(spark, f"{path}/layers/{name}", f"{path}/layers")
        layers = [joined]
    to_come = F.col(HAPPENED) > time_literal(as_of, log.schema[HAPPENED].dataType)
    loaded.unionByName(waited).filter(to_come).write.parquet(f"{path}/{name}/waiting")
    _note_run(spark, path, name, as_of, since, layers)
    _forget(spark, path)
    return _read_layers(spark, path, layers)


def totals_snapshot(totals: DataFrame, as_of: datetime) -> DataFrame:
    """The snapshot of stored totals, stamped with the batch time."""
    statistics = merge_combinations(by_marked_type(totals, *MARKS), "key_type")
    return as_conversion_snapshot(statistics, F.lit(minute_key(as_of)))


def unplaced_conversions(log: DataFrame) -> DataFrame:
    """Conversions without an offer, and those without a load time, which no run reads."""
    timeless = log.filter(F.col("offer_id").isNotNull() & F.col(LOADED).isNull())
    return conversion_rejects(log).unionByName(timeless.withColumn("reason", F.lit("no load time")))


def run_conversion_refresh(
    log: DataFrame,
    as_of: datetime,
    snapshots_path: str,
    totals_path: str,
    rejects_path: str | None = None,
    since: datetime | None = None,
) -> None:
    """Store the snapshot of the day so far on both clocks, from what was loaded since the last run.

    The result is that of ``run_conversion_statistics`` over all that was loaded by ``as_of``. With a path
    for rejects the log of the day is scanned for them.
    """
    totals = refresh_totals(log, totals_path, as_of, since)
    run = as_utc(as_of).strftime("%Y-%m-%dT%H%M")
    snapshot = totals_snapshot(totals, as_of)
    with fitting_rows(snapshot, CONVERSION_SNAPSHOT, rejects_path, run) as rows:
        write_run(rows, snapshots_path, as_of)
    if rejects_path is not None:
        opens = day_start(as_of) if since is None else as_utc(since)
        kind = log.schema[HAPPENED].dataType
        seen = log.filter(F.col(HAPPENED).between(time_literal(opens, kind), time_literal(as_of, kind)))
        write_rejects(unplaced_conversions(seen), f"{rejects_path}/conversions", run)

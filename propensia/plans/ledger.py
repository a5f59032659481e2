"""The ledger of the weekly runs: which stage of which run has finished on what.

An append-only table, one row an event. A finished stage has an entry name and
keeps the entry names of the stages it read, so it is current as long as those
are the latest of theirs: a run that failed goes on at its first stage that
isn't current, and a stage that is run again makes the ones after it due.
Appending never rewrites a row, so runs of different dates can share a ledger.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run_date date, stage string, entry string, state string, inputs array<string>, output string, rows long, error string, at timestamp"
)
DONE, FAILED = "done", "failed"


@dataclass(frozen=True)
class Stage:
    """``run`` does the work and returns the rows it wrote to ``output``; ``after`` names the stages it reads."""

    name: str
    after: tuple[str, ...]
    output: str
    run: Callable[[], int]


def history(spark: SparkSession, path: str) -> DataFrame:
    """All events so far."""
    from propensia.sources.lake import require_files

    try:
        require_files(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last event of each stage of each run."""
    last = F.max(F.struct("at", "entry", "state", "inputs", "output", "rows", "error")).alias("last")
    return history(spark, path).groupBy("run_date", "stage").agg(last).select("run_date", "stage", "last.*")


def record(spark: SparkSession, path: str, run_date: _dt.date, stage: Stage, state: str, inputs: list[str], rows: int | None = None, error: str | None = None) -> str:
    entry = uuid.uuid4().hex
    now = _dt.datetime.now(_dt.timezone.utc)
    row = (run_date, stage.name, entry, state, inputs, stage.output, rows, error, now)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return entry


def run_stages(
    spark: SparkSession, path: str, run_date: _dt.date, stages: list[Stage], *, resume: bool = True, watch: Callable[[str], None] | None = None
) -> list[str]:
    """Run the stages that are due, in order; returns their names.

    ``resume=False`` makes all of them due. ``watch`` is told a stage's name
    before it runs. An error is recorded and raised; the next call starts at
    the stage that failed.
    """
    done = {r["stage"]: r for r in latest(spark, path).filter((F.col("run_date") == F.lit(run_date)) & (F.col("state") == DONE)).collect()}
    entries = {name: r["entry"] for name, r in done.items()}
    ran = []
    for stage in stages:
        inputs = [entries[name] for name in stage.after]
        if resume and stage.name in done and done[stage.name]["inputs"] == inputs:
            continue
        try:
            if watch:
                watch(stage.name)
            rows = stage.run()
        except Exception as error:
            record(spark, path, run_date, stage, FAILED, inputs, error=f"{type(error).__name__}: {str(error)[:500]}")
            raise
        entries[stage.name] = record(spark, path, run_date, stage, DONE, inputs, rows)
        ran.append(stage.name)
    return ran

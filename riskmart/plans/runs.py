"""Gold runs: each writes below its own id, and one new file says which run is the published one.

A run's files are never touched by another run, so any number of runs may work at once.
``publish`` makes one empty file ``published/<number>-<run>``, with a number above all that
are there; the greatest name is the published run. Nothing is overwritten, so two runs
that publish at once both succeed, and every reader agrees which of them is the last.
``published`` resolves it, so the three marts that a reader opens are of one run. The
catalog's gold tables are pointed at the published run afterwards, again if another was
published meanwhile, so they end at the last one.

The ``KEPT`` newest runs stay (a reader may still hold the one before); older published
ones are removed with their files. A run that was never published is not touched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from riskmart.plans.layout import file_system

KEPT = 2


def new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def run_root(gold: str, run: str) -> str:
    return f"{gold}/runs/{run}"


def _entries(spark: SparkSession, gold: str) -> list[tuple[str, str]]:
    """(number, run) of every publication, newest first."""
    fs, folder = file_system(spark, f"{gold}/published")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted((tuple(n.split("-", 1)) for n in names if n[:1].isdigit()), reverse=True)


def history(spark: SparkSession, gold: str) -> list[str]:
    """The published run and the kept ones before it, newest first."""
    return [run for _, run in _entries(spark, gold)]


def published(spark: SparkSession, gold: str) -> str | None:
    """The root of the published run, if there is one."""
    runs = history(spark, gold)
    return run_root(gold, runs[0]) if runs else None


def publish(spark: SparkSession, gold: str, run: str, kept: int = KEPT) -> None:
    """Make ``run`` the published one by creating one file, and remove published runs beyond ``kept``."""
    before = _entries(spark, gold)
    number = int(before[0][0]) + 1 if before else 1
    fs, entry = file_system(spark, f"{gold}/published/{number:012d}-{run}")
    fs.create(entry, False).close()
    for old_number, old in _entries(spark, gold)[kept:]:
        for path in (run_root(gold, old), f"{gold}/published/{old_number}-{old}"):
            fs.delete(file_system(spark, path)[1], True)

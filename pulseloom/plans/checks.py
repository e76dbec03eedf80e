"""Counting what a table has gained since the last check, every row exactly once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from pulseloom.operators import live


class Check(NamedTuple):
    """Rows a table has ever been given, before and now."""

    path: str
    before: int
    now: int

    @property
    def new(self) -> int:
        return self.now - self.before


def _marks(spark: SparkSession, mark: str) -> int:
    """Rows seen by the last check that was completed; marks are lists like those of tables."""
    return live.load(spark, mark).get("rows", 0)


def since_last(spark: SparkSession, path: str, mark: str) -> Check:
    """Rows committed to a table since the check whose mark lies in folder ``mark``.

    Commits carry their row counts, so neither compaction nor expiry nor a retried batch
    changes the answer, and no row is read. The mark moves with ``done`` only: a check that
    fails before leaves its rows to the next one.
    """
    return Check(path, _marks(spark, mark), live.load(spark, path).get("rows", 0))


def done(spark: SparkSession, check: Check, mark: str) -> None:
    """The check has been dealt with; of two that ran at once, the further one counts."""
    def change(state: dict) -> None:
        state["rows"] = max(check.now, state.get("rows", 0))

    live.commit(spark, mark, change)


def as_rows(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """One row for each check, in order."""
    rows = [(n, check.new, check.now) for n, check in enumerate(checks)]
    return spark.createDataFrame(rows, "check_no bigint, new_rows bigint, total bigint")

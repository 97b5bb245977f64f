"""Counts taken in passing: what clashes, what matches nothing, what is dropped.

Each count is a metric of a step that runs anyway, gathered by the tasks that write the step's
table: no job, shuffle or scan of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class Checks:
    """Counts by name.  A switched-off one leaves every DataFrame as it is."""

    on: bool = True
    seen: list[Observation] = field(default_factory=list)

    def count(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """``df``, which counts the rows that meet each condition when it first runs."""
        sums = {name: F.when(condition, 1).otherwise(0) for name, condition in conditions.items()}
        return self.sum(df, **sums)

    def sum(self, df: DataFrame, **amounts: Column) -> DataFrame:
        if not self.on:
            return df
        self.seen.append(Observation())
        totals = [
            F.coalesce(F.sum(amount.cast("bigint")), F.lit(0)).alias(name)
            for name, amount in amounts.items()
        ]
        return df.observe(self.seen[-1], *totals)

    def report(self) -> dict[str, int]:
        """All counts; the steps must have run, else this waits until they have."""
        return {name: n for one in self.seen for name, n in one.get.items()}

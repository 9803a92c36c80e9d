"""Counts of a load, taken while its rows are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class LoadReport:
    """Counts per step of a load.

    A count is an observation on the frame that a step writes: it is taken by the tasks of that
    write, so no row is read or computed again for it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._steps: list[tuple[str, Observation]] = []

    def counting(self, step: str, df: DataFrame, **measures: Column) -> DataFrame:
        """The frame, whose rows are counted by the next action on it. Each measure is an
        aggregate; ``rows`` counts all rows."""
        observation = Observation()
        self._steps.append((step, observation))
        counts = {"rows": F.count(F.lit(1)), **measures}
        return df.observe(observation, *[c.cast("bigint").alias(n) for n, c in counts.items()])

    def rows(self) -> list[tuple[str, str, int]]:
        """(step, measure, n_rows). Every counted frame must have been written."""
        return [
            (step, measure, count or 0)
            for step, observation in self._steps
            for measure, count in observation.get.items()
        ]

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows(), "step string, measure string, n_rows bigint")

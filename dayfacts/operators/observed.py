"""Metrics of a run, taken on the way: counts at several points of one plan, read after its write."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Watch:
    """The points of one plan at which rows are counted, for one run of it.

    ``at`` adds a point; the first action over the whole plan fills all of them, and ``read`` gives
    the counts. No row is read a second time. A task that runs again, as its executor was lost
    after it had ended, counts again: the rows of the result are right then, the counts may be
    too high, and ``quality.run_metrics`` counts anew.
    """

    def __init__(self) -> None:
        self.points: dict[str, Observation] = {}
        self.names: list[str] = []

    def at(self, df: DataFrame, point: str, **counts: Column) -> DataFrame:
        if point in self.points:
            raise ValueError(f"{point} is watched already; a run needs a watch of its own")
        self.points[point] = Observation(point)
        self.names += counts
        return df.observe(self.points[point], *[c.alias(name) for name, c in counts.items()])

    def read(self) -> dict:
        """The counts by name, after the action; None at points that Spark left out of the plan, as it
        knew that no row can come there."""
        out = dict.fromkeys(self.names)
        for seen in self.points.values():
            try:
                out |= seen.get
            except Py4JJavaError:  # such a point has a row of no columns, which Spark cannot hand over
                continue
        return out

"""State that grows step by step inside one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import materialise

FAN_IN = 4  # parts of one rank that are merged


class Growing:
    """Rows added in many steps, as few tables.

    Every step adds a part of rank 0; ``FAN_IN`` parts of a rank are merged into one of the
    next rank. So a row is rewritten log(steps) times at most, and reading
    the state after n steps means reading about ``FAN_IN`` * log(n) tables, not n.
    """

    def __init__(self, spark: SparkSession, schema: str, name: str, first: DataFrame | None = None):
        self.empty, self.name = spark.createDataFrame([], schema), name
        self.columns = self.empty.columns
        self.parts: list[tuple[int, DataFrame]] = []
        # what was there before is not rewritten
        self.before = None if first is None else first.select(*[first[c].cast(self.empty.schema[c].dataType).alias(c) for c in self.columns])

    def add(self, rows: DataFrame) -> None:
        """Add rows that are already materialised."""
        self.parts.append((0, rows.select(*self.columns)))
        while len(self.parts) >= FAN_IN and len({rank for rank, _ in self.parts[-FAN_IN:]}) == 1:
            rank = self.parts[-1][0]
            merged = materialise(_union([df for _, df in self.parts[-FAN_IN:]]), self.name)
            self.parts[-FAN_IN:] = [(rank + 1, merged)]

    def added(self) -> DataFrame:
        """All rows added so far."""
        return _union([df for _, df in self.parts]) if self.parts else self.empty

    def rows(self) -> DataFrame:
        """All rows, those of before included."""
        return self.added() if self.before is None else self.before.unionByName(self.added())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out

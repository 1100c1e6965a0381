"""The daily rollup: mergeable pieces and the columns made of them.

Batch queries, models and streams share it. Pieces of any parts of a group add
up to the pieces of the group, in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.rounding import coarse_part, fine_part, round_average, round_to

COUNT = "observation_count"


@dataclass(frozen=True)
class Rollup:
    """Output columns in their order: (name, source, F.avg, F.min or F.max)."""

    columns: tuple[tuple[str, str, Callable], ...]

    def _means(self) -> list[tuple[str, str]]:
        return [(name, source) for name, source, pick in self.columns if pick is F.avg]

    def _bounds(self) -> list[tuple[str, str, Callable]]:
        return [column for column in self.columns if column[2] is not F.avg]

    def pieces(self) -> list[Column]:
        """The aggregates of raw rows."""
        found = [F.count(F.lit(1)).alias(COUNT)]
        for name, source in self._means():
            value = F.col(source).cast("double")
            found += [
                F.sum(coarse_part(value)).alias(f"coarse_{name}"),
                F.sum(fine_part(value)).alias(f"fine_{name}"),
                F.count(value).alias(f"n_{name}"),
            ]
        return found + [pick(source).alias(name) for name, source, pick in self._bounds()]

    def merged(self) -> list[Column]:
        """The aggregates of pieces, which are pieces again."""
        sums = [COUNT, *(f"{part}_{name}" for name, _ in self._means() for part in ("coarse", "fine", "n"))]
        return [F.sum(c).alias(c) for c in sums] + [pick(name).alias(name) for name, _, pick in self._bounds()]

    def finished(self) -> list[Column]:
        """The rollup of a group from its pieces, to two decimals."""

        def value(name: str, pick: Callable) -> Column:
            if pick is not F.avg:
                return round_to(F.col(name), 2)
            return round_average((F.col(f"coarse_{name}") + F.col(f"fine_{name}")) / F.col(f"n_{name}"), 2)

        rounded = [value(name, pick).alias(name) for name, _, pick in self.columns]
        return [F.col(COUNT), *rounded]


def rolled_up(df: DataFrame, keys: list[str], rollup: Rollup) -> DataFrame:
    """One row per group of ``keys``."""
    return df.groupBy(*keys).agg(*rollup.pieces()).select(*keys, *rollup.finished())

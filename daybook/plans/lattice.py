"""Coarser cubes stored beside the cube, and the smallest one that answers.

A view is the cube grouped by some of its dimensions, always by day among them, so it is
kept and replaced by day like the cube. Which to store is chosen greedily by what they
save to the questions asked: a question reads the smallest stored view that has its
dimensions, so a view saves, to each question that it is the best for, the rows it has
fewer than the one read until then. Sizes are estimated in one pass over the cube.

Views hold sums and mergeable sketches. Their answers are those of the cube: sums the
same, counts of incidents too while a sketch is exact, and within its bounds beyond.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.sketches import merged_sketch
from daybook.operators.conform import align
from daybook.plans.pipeline import Warehouse
from daybook.plans.rollups import CUBE_MEASURES, SKETCH, merge_cube
from daybook.sources.schemas import CUBE_DAY, TableSpec
from daybook.sources.tables import replace_all, replace_days

Dimensions = frozenset[str]


def estimated_sizes(cube: DataFrame, candidates: Iterable[Dimensions]) -> dict[Dimensions, int]:
    """About how many rows the cube has by each choice of dimensions, and as it is."""
    wanted = list(dict.fromkeys(frozenset(c) for c in candidates))
    counts = [
        F.approx_count_distinct(F.xxhash64(*sorted(c))).alias(f"n{i}") for i, c in enumerate(wanted)
    ]
    row = cube.agg(F.count(F.lit(1)).alias("whole"), *counts).first()
    return {c: min(row[f"n{i}"], row["whole"]) for i, c in enumerate(wanted)} | {
        frozenset(cube.columns): row["whole"]
    }


def chosen_views(
    sizes: dict[Dimensions, int], questions: dict[Dimensions, float], most: int
) -> list[Dimensions]:
    """Up to ``most`` views that save the questions the most rows, in order of choice.

    ``questions`` weighs each choice of dimensions by how often it is asked.
    """
    whole = max(sizes, key=len)
    read = {q: sizes[whole] for q in questions}
    chosen: list[Dimensions] = []

    def saved(view: Dimensions) -> float:
        return sum(w * max(0, read[q] - sizes[view]) for q, w in questions.items() if q <= view)

    while len(chosen) < most:
        left = [v for v in sizes if v != whole and v not in chosen]
        best = max(left, key=lambda v: (saved(v), -sizes[v], sorted(v)), default=None)
        if best is None or saved(best) <= 0:
            break
        chosen.append(best)
        read = {q: min(n, sizes[best]) if q <= best else n for q, n in read.items()}
    return chosen


@dataclass
class Lattice:
    """The cube's table and the views stored beside it."""

    warehouse: Warehouse
    cube: str = "crashes_cube"
    views: dict[str, Dimensions] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def _spec(self, view: str) -> TableSpec:
        held = self.warehouse.ensure(self.cube).schema
        names = [*sorted(self.views[view] - {CUBE_DAY}), *CUBE_MEASURES, SKETCH]
        columns = ", ".join(f"`{n}` {held[n].dataType.simpleString()}" for n in names)
        return TableSpec(view, columns, CUBE_DAY, time_column=None, key_column=None)

    def _grouped(self, dimensions: Dimensions, days: Iterable[dt.date] | None = None) -> DataFrame:
        """From the smallest stored view that has the dimensions."""
        source = self.source(dimensions)
        return self.warehouse.read(source, days).groupBy(*sorted(dimensions)).agg(
            *[F.sum(name).alias(name) for name in CUBE_MEASURES],
            merged_sketch(F.col(SKETCH)).alias(SKETCH),
        )

    def store(self, name: str, dimensions: Iterable[str]) -> None:
        """Store a view of all days, from the smallest view that can give it."""
        wanted = frozenset(dimensions) | {CUBE_DAY}
        rows = self._grouped(wanted)
        self.views[name] = wanted
        spec = self.warehouse.ensure(name, self._spec(name))
        replace_all(align(rows, spec.stored_schema), self.warehouse.table(name), spec)
        self.rows[name] = self.warehouse.read(name).count()

    def refresh(self, days: Sequence[dt.date]) -> None:
        """Replace days of every view after days of the cube were replaced, the finest
        first, so that coarser ones can be made of them."""
        for name in sorted(self.views, key=lambda n: -len(self.views[n])):
            wanted, spec = self.views[name], self.warehouse.ensure(name)
            others = {n: d for n, d in self.views.items() if wanted < d}
            finer = Lattice(self.warehouse, self.cube, others, self.rows)
            replace_days(finer._grouped(wanted, days), self.warehouse.table(name), spec, days)
            self.rows[name] = self.warehouse.read(name).count()

    def source(self, dimensions: Iterable[str]) -> str:
        """The stored table of fewest rows that has the dimensions."""
        wanted = frozenset(dimensions)
        fitting = [n for n, held in self.views.items() if wanted <= held]
        return min(fitting, key=lambda n: (self.rows[n], n), default=self.cube)

    def merge(self, dimensions: Sequence[str]) -> DataFrame:
        """The cube by these dimensions, with the incidents of each group counted."""
        return merge_cube(self.warehouse.read(self.source(dimensions)), dimensions)


def stored_views(
    warehouse: Warehouse, questions: dict[Dimensions, float], most: int, cube: str = "crashes_cube"
) -> Lattice:
    """Choose views for the questions and store them: the questions with the day, and
    what two of them have together, are the candidates."""
    dated = [frozenset(q) | {CUBE_DAY} for q in questions]
    candidates = [*dated, *(a | b for i, a in enumerate(dated) for b in dated[:i])]
    sizes = estimated_sizes(warehouse.read(cube), candidates)
    lattice = Lattice(warehouse, cube)
    for number, view in enumerate(sorted(chosen_views(sizes, questions, most), key=len, reverse=True)):
        lattice.store(f"{cube}_view_{number}", view)
    return lattice

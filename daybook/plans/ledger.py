"""What has been finished for a day, and of which inputs.

A step's entry is written last. It holds checksums of what the step read and of the rows
it wrote, and the names of the files it left, which no other write gives. So an entry
whose files are no longer there proves nothing, whatever wrote over them or died on the
way; nothing has to be marked before a step begins. A step whose last entry has equal
inputs and the files of now is proven, and a rerun leaves it out.

Entries of a day are one small partition: a run reads those of its own days only.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from daybook.sources.schemas import LEDGER, TABLES
from daybook.sources.tables import read_table, replace_day

#: Stands for the whole table where a step is not of a day.
WHOLE = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Entry:
    step: str
    inputs: str | None = None
    output: str | None = None
    files: str | None = None
    report: str | None = None


def checksum(*parts: str) -> str:
    """Of the parts in their order."""
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()


class Ledger:
    """The entries of a warehouse, through its table; those read are kept."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table, self.spec = spark, table, TABLES[LEDGER]
        self._days: dict[dt.date, dict[str, Entry]] = {}

    def read(self, days: Iterable[dt.date]) -> None:
        """Read the entries of days not read before, in one job."""
        new = [d for d in dict.fromkeys(days) if d not in self._days]
        if new:
            self._days |= {d: {} for d in new}
            for row in read_table(self.spark, self.table, self.spec, new).collect():  # a row per step
                entry = Entry(*(row[c] for c in Entry.__dataclass_fields__))
                self._days[row[self.spec.day_column]][entry.step] = entry

    def entry(self, step: str, day: dt.date = WHOLE) -> Entry | None:
        self.read([day])
        return self._days[day].get(step)

    def proven(self, step: str, day: dt.date, inputs: str, files: str) -> bool:
        entry = self.entry(step, day)
        return entry is not None and (entry.inputs, entry.files) == (inputs, files)

    def content(self, step: str, day: dt.date, files: str) -> str:
        """Equal for equal rows, where the entry of the files of now knows their
        checksum, and else for the same files only."""
        entry = self.entry(step, day)
        if entry is not None and entry.files == files and entry.output:
            return entry.output
        return f"files {files}"

    def _store(self, day: dt.date, entries: dict[str, Entry]) -> None:
        rows = [tuple(vars(e).values()) for e in entries.values()]
        table = self.spark.createDataFrame(rows, self.spec.schema).coalesce(1)
        replace_day(table, self.table, self.spec, day)
        self._days[day] = entries

    def note(self, entry: Entry, day: dt.date) -> None:
        """Let later steps of this run know of an entry that is stored at its end."""
        self.read([day])
        self._days[day][entry.step] = entry

    def done(self, entries: Iterable[Entry], day: dt.date = WHOLE) -> None:
        self.read([day])
        self._store(day, self._days[day] | {e.step: e for e in entries})

    def forget(self, steps: Iterable[str], day: dt.date = WHOLE) -> None:
        """Before a write after which the steps are no longer done."""
        self.read([day])
        held = {s: e for s, e in self._days[day].items() if s not in set(steps)}
        if held != self._days[day]:
            self._store(day, held)

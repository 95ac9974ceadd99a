"""The daily run: land, ingest and roll up one local day."""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.times import DEFAULT_ZONE, local_day
from daybook.operators.aggregates import KEY
from daybook.operators.conform import align, debug_frame
from daybook.operators.transforms import TRANSFORMS, counted_transform, transform
from daybook.plans import rollups
from daybook.plans.days import DayBounds, publish_parameters
from daybook.plans.ledger import Entry, Ledger, checksum
from daybook.sources import day_index
from daybook.sources.checksums import checksum_of
from daybook.sources.landing import (
    ROWS_PER_FILE,
    Landed,
    day_identity,
    extract_day,
    land_day,
    land_days,
    read_day,
    read_days,
)
from daybook.sources.manifest import digest
from daybook.sources.schemas import (
    CHILD_DAYS,
    CUBE_DAY,
    CUBE_PARTS,
    LEDGER,
    SERVICE_DAY,
    TABLES,
    TableSpec,
)
from daybook.sources.tables import (
    day_files,
    ensure_table,
    in_catalog,
    read_table,
    replace_all,
    replace_day,
    replace_days,
)

log = logging.getLogger(__name__)

#: Part of every step's inputs; another number has all of them run again.
RULES = "1"


@dataclass(frozen=True)
class Dataset:
    """A dataset to land and ingest; ``transform`` names how to type it.

    ``raw_columns`` declares the landed columns as DDL. Without it the footers
    of all landed files are read to find them.
    """

    name: str
    time_column: str = "crash_date"
    columns: tuple[str, ...] | None = None
    transform: str | None = None
    raw_columns: str | None = None

    def __post_init__(self) -> None:
        if self.transform is None and self.name in TRANSFORMS:
            object.__setattr__(self, "transform", self.name)

    @property
    def raw_schema(self) -> T.StructType | None:
        return T.StructType.fromDDL(self.raw_columns) if self.raw_columns else None


DATASETS = tuple(Dataset(name) for name in TRANSFORMS)


@dataclass(frozen=True)
class Warehouse:
    """A catalog database, and the folder of its tables if it is not the default."""

    spark: SparkSession
    database: str = "default"
    location: str | None = None
    _specs: dict[str, TableSpec] = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ensure(self, name: str, spec: TableSpec | None = None) -> TableSpec:
        """The table's spec with the columns of the catalog, which has it from now on."""
        if name in self._specs and self.has(name):
            return self._specs[name]
        if spec is None and name not in TABLES:
            raise ValueError(f"no declared table named {name}")
        spec = spec or TABLES[name]
        folder = self.location.rstrip("/") if self.location else None
        place = f" LOCATION '{folder}'" if folder else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        ensure_table(self.spark, self.table(name), spec, folder and f"{folder}/{name}")
        self._specs[name] = in_catalog(self.spark, self.table(name), spec)
        return self._specs[name]

    def read(self, name: str, days: Iterable[dt.date] | None = None) -> DataFrame:
        return read_table(self.spark, self.table(name), self.ensure(name), days)

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def files(self, name: str, days: Iterable[dt.date]) -> str:
        """Tells what is stored of the days from what any other write leaves."""
        return digest(day_files(self.spark, self.table(name), self.ensure(name), days))

    def ledger(self) -> Ledger:
        self.ensure(LEDGER)
        return Ledger(self.spark, self.table(LEDGER))


def land_datasets(
    sources: Mapping[str, DataFrame],
    root: str,
    day: dt.date,
    datasets: Iterable[Dataset] = DATASETS,
    rows_per_file: int = ROWS_PER_FILE,
    closed_end: bool = False,
) -> dict[str, int]:
    """Land the day of every dataset; the number of rows of each."""
    counts = {}
    for dataset in datasets:
        columns = list(dataset.columns) if dataset.columns else None
        rows = extract_day(
            sources[dataset.name], dataset.time_column, day, columns, closed_end
        )
        counts[f"num_recs_{dataset.name}"] = land_day(
            rows, f"{root.rstrip('/')}/{dataset.name}", day, rows_per_file, dataset.time_column
        )
    return counts


@dataclass(frozen=True)
class IngestReport:
    rows: int
    rejects: dict[str, int] = field(default_factory=dict)


@contextmanager
def _changing(warehouse: Warehouse, ledger: Ledger, names: Iterable[str], day: dt.date) -> Iterator[None]:
    """While a day's incidents or children change, all runs are told that it may hold
    children of theirs; a run that dies on the way leaves it so."""
    names = set(names)
    indexes = [
        (child, index)
        for child, index in CHILD_DAYS.items()
        if (child in names or ("crashes" in names and warehouse.has(child))) and ledger.entry(index)
    ]
    for _, index in indexes:
        unknown = day_index.unknown_day(warehouse.read(index))
        replace_day(unknown, warehouse.table(index), warehouse.ensure(index), day)
    yield
    for child, index in indexes:
        cells = day_index.strays(warehouse.read(child, [day]), warehouse.read("crashes", [day]), KEY, SERVICE_DAY)
        replace_day(cells, warehouse.table(index), warehouse.ensure(index), day)


def _complete_index(warehouse: Warehouse, ledger: Ledger, child: str) -> None:
    """Fill the index of all days stored, unless its entry says that it is."""
    index = CHILD_DAYS[child]
    if ledger.entry(index) is None:
        cells = day_index.strays(warehouse.read(child), warehouse.read("crashes"), KEY, SERVICE_DAY)
        replace_all(cells, warehouse.table(index), warehouse.ensure(index))
        ledger.done([Entry(index)])


@dataclass(frozen=True)
class _Ingest:
    """One dataset's day to ingest: what it is made of, and the report if that is proven."""

    dataset: Dataset
    spec: TableSpec
    folder: str
    inputs: str
    report: IngestReport | None


def _to_ingest(
    warehouse: Warehouse, ledger: Ledger, root: str, day: dt.date, dataset: Dataset, zone: str, spec: TableSpec | None
) -> _Ingest:
    spec = warehouse.ensure(dataset.name, spec)
    folder = f"{root.rstrip('/')}/{dataset.name}"
    landed = day_identity(warehouse.spark, folder, day)
    inputs = checksum(
        RULES, landed, spec.columns, zone, dataset.transform or "", dataset.raw_columns or ""
    )
    report = None
    if ledger.proven(dataset.name, day, inputs, warehouse.files(dataset.name, [day])):
        report = IngestReport(**json.loads(ledger.entry(dataset.name, day).report))
    return _Ingest(dataset, spec, folder, inputs, report)


def _ingested(
    warehouse: Warehouse, day: dt.date, job: _Ingest, zone: str
) -> tuple[IngestReport, Entry]:
    name, spec = job.dataset.name, job.spec
    raw = read_day(warehouse.spark, job.folder, day, job.dataset.raw_schema)
    seen, stored = Observation(), Observation()
    debug_frame(transform(job.dataset.transform, raw, spec.schema, zone), name)
    typed = counted_transform(job.dataset.transform, raw, spec.schema, seen, zone)
    replace_day(typed, warehouse.table(name), spec, day, stored)
    report = _report(seen)
    log.info("ingested %s for %s: %s", name, day, report)
    files = warehouse.files(name, [day])
    return report, Entry(name, job.inputs, checksum_of(stored), files, json.dumps(asdict(report)))


def _ingest_all(
    warehouse: Warehouse,
    root: str,
    day: dt.date,
    datasets: Iterable[Dataset],
    zone: str,
    spec: TableSpec | None = None,
) -> dict[str, IngestReport]:
    ledger, reports = warehouse.ledger(), {}
    jobs = [_to_ingest(warehouse, ledger, root, day, d, zone, spec) for d in datasets]
    open_jobs = [job for job in jobs if job.report is None]
    reports = {job.dataset.name: job.report for job in jobs}
    if open_jobs:
        entries = []
        with _changing(warehouse, ledger, [job.dataset.name for job in open_jobs], day):
            for job in open_jobs:
                reports[job.dataset.name], entry = _ingested(warehouse, day, job, zone)
                entries.append(entry)
        ledger.done(entries, day)
    return reports


def ingest_day(
    warehouse: Warehouse,
    root: str,
    day: dt.date,
    dataset: Dataset,
    zone: str = DEFAULT_ZONE,
    spec: TableSpec | None = None,
) -> IngestReport:
    """Type one landed day and make it that day of the dataset's table.

    Rows and unreadable values are counted while the day is written. Debug output
    comes from a frame of its own, so it does not count. A day whose rows are proven
    to be those landed is left as it is.
    """
    return _ingest_all(warehouse, root, day, [dataset], zone, spec)[dataset.name]


def _report(seen: Observation) -> IngestReport:
    counts = seen.get
    rejected = {n.removeprefix("rejected."): c for n, c in counts.items() if n != "rows" and c}
    return IngestReport(counts["rows"], rejected)


def ingest_days(
    warehouse: Warehouse,
    root: str,
    dataset: Dataset,
    zone: str = DEFAULT_ZONE,
    spec: TableSpec | None = None,
) -> IngestReport:
    """Type every landed day in one job and replace those days of the table."""
    if dataset.name == "crashes" or dataset.name in CHILD_DAYS:
        changed = CHILD_DAYS.values() if dataset.name == "crashes" else [CHILD_DAYS[dataset.name]]
        warehouse.ledger().forget(changed)
    spec = warehouse.ensure(dataset.name, spec)
    raw = read_days(warehouse.spark, f"{root.rstrip('/')}/{dataset.name}", dataset.raw_schema)
    seen = Observation()
    gathered = raw.hint("rebalance", "year", "month", "day")
    typed = counted_transform(dataset.transform, gathered, spec.schema, seen, zone)
    dated = typed.withColumn(spec.day_column, F.make_date("year", "month", "day"))
    replace_days(dated, warehouse.table(dataset.name), spec, gathered=True)
    return _report(seen)


def land_and_ingest_days(
    warehouse: Warehouse,
    sources: Mapping[str, DataFrame],
    root: str,
    datasets: Iterable[Dataset] = DATASETS,
    rows_per_file: int = ROWS_PER_FILE,
    zone: str = DEFAULT_ZONE,
) -> dict[str, tuple[Landed, IngestReport]]:
    """A backfill: land and ingest all days of every dataset; the counts of each."""
    done = {}
    for d in datasets:
        landed = land_days(sources[d.name], f"{root.rstrip('/')}/{d.name}", d.time_column, rows_per_file)
        done[d.name] = (landed, ingest_days(warehouse, root, d, zone))
    return done


def ingest_datasets(
    warehouse: Warehouse,
    root: str,
    day: dt.date,
    datasets: Iterable[Dataset] = DATASETS,
    zone: str = DEFAULT_ZONE,
) -> dict[str, IngestReport]:
    """Every dataset in turn; the first failure ends the run."""
    return _ingest_all(warehouse, root, day, datasets, zone)


Build = Callable[..., DataFrame]
Days = Callable[[DayBounds], list[dt.date]]
#: The days of each table that a stage reads.
Reads = dict[str, list[dt.date]]


@dataclass(frozen=True)
class Stage:
    """One rollup into the table of its name: a function, or SQL text.

    ``days`` names the days of the target the run replaces: rows of other days
    are an error, and days without rows become empty. Without it the days
    present in the result are replaced.

    ``reads`` names all that the function reads, which it then gets as its third
    argument; a rerun leaves the stage out while those days hold the same rows.
    """

    name: str
    build: Build | None = None
    sql: str | None = None
    days: Days | None = None
    reads: Callable[[Warehouse, DayBounds, Ledger], Reads] | None = None

    def result(
        self, warehouse: Warehouse, bounds: DayBounds, reads: Reads | None = None
    ) -> DataFrame:
        if self.build is not None and self.reads is not None:
            reads = reads or self.reads(warehouse, bounds, warehouse.ledger())
            return self.build(warehouse, bounds, reads)
        if self.build is not None:
            return self.build(warehouse, bounds)
        args = {**bounds.sql_args(), "database": warehouse.database}
        return warehouse.spark.sql(self.sql, args=args)


def _service_day(bounds: DayBounds) -> list[dt.date]:
    return [bounds.day]


def _around(first: dt.date, last: dt.date, margin: int) -> list[dt.date]:
    start = first - dt.timedelta(days=margin)
    return [start + dt.timedelta(days=n) for n in range((last - first).days + 2 * margin + 1)]


def _complete_parts(warehouse: Warehouse, ledger: Ledger, days: Iterable[dt.date]) -> None:
    """Make the partial cubes of local days whose summary is not the one they were made
    of; of the days around a run that is mostly the run's own."""
    source = "crashes_people_vehicle_summary"
    spec, days = warehouse.ensure(CUBE_PARTS), list(days)
    ledger.read(days)
    for day in days:
        files = warehouse.files(source, [day])
        inputs = checksum(RULES, spec.columns, ledger.content(source, day, files))
        kept = warehouse.files(CUBE_PARTS, [day])
        if ledger.proven(CUBE_PARTS, day, inputs, kept) or files == kept == digest([]):
            continue
        seen = Observation()
        part = rollups.cube(warehouse.read(source, [day]))
        replace_day(align(part, spec.schema), warehouse.table(CUBE_PARTS), spec, day, seen)
        ledger.done([Entry(CUBE_PARTS, inputs, checksum_of(seen), warehouse.files(CUBE_PARTS, [day]))], day)


def daily_stages() -> tuple[Stage, ...]:
    """The three rollups for a day's run.

    People and vehicles of the day's incidents may be stored on any day. Those of other
    days are indexed beside their tables, and only the days named there are read.
    """

    def with_children(
        warehouse: Warehouse, ledger: Ledger, name: str, incidents: DataFrame, day: dt.date
    ) -> list[dt.date]:
        _complete_index(warehouse, ledger, name)
        index = warehouse.read(CHILD_DAYS[name])
        return sorted({day, *day_index.named_days(index, incidents, KEY, SERVICE_DAY)})

    def incidents_of(warehouse: Warehouse, bounds: DayBounds) -> DataFrame:
        stored = warehouse.read("crashes", [bounds.day])
        return stored.filter(bounds.contains(F.col("crash_date")))

    def people_reads(warehouse: Warehouse, bounds: DayBounds, ledger: Ledger) -> Reads:
        incidents = incidents_of(warehouse, bounds)
        named = with_children(warehouse, ledger, "crashes_people", incidents, bounds.day)
        return {"crashes": [bounds.day], "crashes_people": named}

    def people(warehouse: Warehouse, bounds: DayBounds, reads: Reads) -> DataFrame:
        found = warehouse.read("crashes_people", reads["crashes_people"])
        return rollups.people_summary(incidents_of(warehouse, bounds), found, narrow=True)

    def vehicles_reads(warehouse: Warehouse, bounds: DayBounds, ledger: Ledger) -> Reads:
        summary = warehouse.read("crashes_people_summary", [bounds.day])
        named = with_children(warehouse, ledger, "crashes_vehicles", summary, bounds.day)
        return {"crashes_people_summary": [bounds.day], "crashes_vehicles": named}

    def vehicles(warehouse: Warehouse, bounds: DayBounds, reads: Reads) -> DataFrame:
        summary = warehouse.read("crashes_people_summary", [bounds.day]).drop(SERVICE_DAY)
        found = warehouse.read("crashes_vehicles", reads["crashes_vehicles"])
        return rollups.vehicle_summary(summary, found, narrow=True)

    def cube_reads(warehouse: Warehouse, bounds: DayBounds, ledger: Ledger) -> Reads:
        """The UTC days the run touches reach into neighbouring local days."""
        touched = bounds.utc_days()
        nearby = _around(touched[0], touched[-1], 1)
        _complete_parts(warehouse, ledger, nearby)
        return {CUBE_PARTS: nearby}

    def cube(warehouse: Warehouse, bounds: DayBounds, reads: Reads) -> DataFrame:
        """The UTC days the run touches, whole."""
        parts = warehouse.read(CUBE_PARTS, reads[CUBE_PARTS])
        return rollups.merged_days(parts.filter(F.col(CUBE_DAY).isin(bounds.utc_days())))

    return (
        Stage("crashes_people_summary", people, days=_service_day, reads=people_reads),
        Stage("crashes_people_vehicle_summary", vehicles, days=_service_day, reads=vehicles_reads),
        Stage("crashes_cube", cube, days=DayBounds.utc_days, reads=cube_reads),
    )


STAGES = daily_stages()


def load_sql_stages(path: str) -> list[Stage]:
    """Stages from JSON ``{"cubelets": [{"name": ..., "sql": ...}, ...]}``.

    The text may use ``:start_time`` and ``:end_time``, both of the day,
    ``:end_before``, ``:service_day`` and ``IDENTIFIER(:database || '.table')``,
    or the view ``job_params``. ``"replaces"`` says which days of the target a run
    replaces: ``"day"``, the ``"utc_days"`` it touches, or those ``"present"`` in
    the result. Without it, a table kept by service day is replaced by day and
    any other by UTC days.
    """
    with open(path, encoding="utf-8") as file:
        return [
            Stage(s["name"], sql=s["sql"], days=_replaced(s["name"], s.get("replaces")))
            for s in json.load(file).get("cubelets", [])
        ]


def _replaced(name: str, replaces: str | None) -> Days | None:
    choices = {"day": _service_day, "utc_days": DayBounds.utc_days, "present": None}
    if replaces is None:
        by_day = name not in TABLES or TABLES[name].day_column == SERVICE_DAY
        replaces = "day" if by_day else "utc_days"
    if replaces not in choices:
        raise ValueError(f"stage {name}: unknown choice of days: {replaces}")
    return choices[replaces]


def _with_day(rows: DataFrame, spec: TableSpec, zone: str) -> DataFrame:
    if spec.day_column in rows.columns or spec.time_column is None:
        return rows
    return rows.withColumn(spec.day_column, local_day(F.col(spec.time_column), zone))


def _stage_inputs(
    warehouse: Warehouse, ledger: Ledger, stage: Stage, spec: TableSpec, bounds: DayBounds, reads: Reads
) -> str:
    """Of the rules, and of the rows of every day that the stage reads."""
    ledger.read(day for days in reads.values() for day in days)
    read = [
        f"{name} {day} {ledger.content(name, day, warehouse.files(name, [day]))}"
        for name, days in sorted(reads.items())
        for day in days
    ]
    return checksum(RULES, spec.columns, repr(bounds), *read)


def run_stages(
    warehouse: Warehouse, bounds: DayBounds, stages: Iterable[Stage] = STAGES
) -> None:
    """Run the stages in order; each one may read what earlier ones wrote."""
    publish_parameters(warehouse.spark, bounds)
    ledger = warehouse.ledger()
    entries: list[Entry] = []
    try:
        for stage in stages:
            entries += _run_stage(warehouse, ledger, bounds, stage)
    finally:  # what was finished before a failure is not run again
        if entries:
            ledger.done(entries, bounds.day)


def _run_stage(
    warehouse: Warehouse, ledger: Ledger, bounds: DayBounds, stage: Stage
) -> list[Entry]:
    """The entry of a stage that says what it reads, unless it was proven already."""
    spec = warehouse.ensure(stage.name)
    table = warehouse.table(stage.name)
    days = stage.days(bounds) if stage.days else None
    reads = stage.reads(warehouse, bounds, ledger) if stage.reads and days else None
    inputs = ""
    if reads is not None:
        inputs = _stage_inputs(warehouse, ledger, stage, spec, bounds, reads)
        if ledger.proven(stage.name, bounds.day, inputs, warehouse.files(stage.name, days)):
            log.info("%s for %s is of the same rows", stage.name, bounds.day)
            return []
    rows, seen = stage.result(warehouse, bounds, reads), Observation()
    debug_frame(rows, stage.name)
    if stage.build and spec.day_column == SERVICE_DAY and days == [bounds.day]:
        replace_day(align(rows, spec.schema), table, spec, bounds.day, seen)
    else:
        replace_days(_with_day(rows, spec, bounds.zone), table, spec, days, seen=seen)
    if reads is None:
        return []
    entry = Entry(stage.name, inputs, checksum_of(seen), warehouse.files(stage.name, days))
    ledger.note(entry, bounds.day)
    return [entry]


def run_day(
    warehouse: Warehouse,
    sources: Mapping[str, DataFrame],
    root: str,
    bounds: DayBounds,
    datasets: Iterable[Dataset] = DATASETS,
    stages: Iterable[Stage] = STAGES,
) -> dict[str, int]:
    """Land, ingest and roll up one day; the landed counts."""
    datasets = list(datasets)
    counts = land_datasets(sources, root, bounds.day, datasets, closed_end=bounds.closed_end)
    ingest_datasets(warehouse, root, bounds.day, datasets, zone=bounds.zone)
    run_stages(warehouse, bounds, stages)
    return counts


def rebuild(warehouse: Warehouse, zone: str = DEFAULT_ZONE) -> None:
    """Recompute every rollup table from the base tables, all days at once."""

    def store(rows: DataFrame, name: str) -> None:
        spec = warehouse.ensure(name)
        replace_all(_with_day(rows, spec, zone), warehouse.table(name), spec)

    dated = warehouse.read("crashes").filter(F.col("crash_date").isNotNull())
    people = warehouse.read("crashes_people")
    store(rollups.people_summary(dated, people), "crashes_people_summary")
    summary = warehouse.read("crashes_people_summary").drop(SERVICE_DAY)
    vehicles = warehouse.read("crashes_vehicles")
    store(rollups.vehicle_summary(summary, vehicles), "crashes_people_vehicle_summary")
    store(rollups.cube(warehouse.read("crashes_people_vehicle_summary")), "crashes_cube")

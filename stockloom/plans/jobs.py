"""Load jobs: landed files → warehouse tables, in dependency order."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import model
from stockloom.operators import dimensions, extract, gate, prices, quality, ratios, statements
from stockloom.sources import raw
from stockloom.sources.landing import LandingZone, conform
from stockloom.sources.scan import RECORD, Scan
from stockloom.sources.scratch import delete_folder, scratch_path, stage, staging
from stockloom.sources.warehouse import LOAD, CatalogSink, Sink

MAP_PATH = "reference/industry_map.csv"


# --- raw documents → landed files -----------------------------------------------


def land(zone: LandingZone, name: str, df: DataFrame) -> str | None:
    """Land one raw table. Rows of pages and replies come without a shuffle, so testing for one is cheap."""
    folder, _, file_name = model.LANDED_PATHS[name].rpartition("/")
    return zone.save_dataframe(df, folder, file_name.removesuffix(".csv"), "csv")


def land_industries(zone: LandingZone, pages: DataFrame) -> str | None:
    rows = extract.industry_rows(pages)
    return land(zone, "industries", rows.select(*model.RAW_INDUSTRY.names))


def land_enterprises(zone: LandingZone, pages: DataFrame) -> str | None:
    """``pages`` holds one profile page per company, with its code."""
    return land(zone, "enterprise", extract.enterprise_profile(pages))


def land_subsidiaries(zone: LandingZone, payloads: DataFrame) -> str | None:
    return land(zone, "subsidiaries", extract.subsidiary_rows(payloads))


# --- landed files → tables ------------------------------------------------------


@dataclass
class LoadReport:
    """What a load did: rows written and rejected by table, cells that weren't readable, broken keys, jobs skipped."""

    rows: dict[str, int] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)
    unreadable: dict[tuple[str, str], int] = field(default_factory=dict)
    violations: list[tuple] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


@dataclass
class Load:
    """One load of one or several jobs, which may run at once: a table is written when those it refers to are.

    ``resume`` leaves out jobs that the ledger holds for the same input files. With ``references`` off, rows whose
    parents are missing are written, as into a database without foreign keys, and jobs wait for no other.
    """

    zone: LandingZone
    sink: Sink
    resume: bool = False
    references: bool = True
    report: LoadReport = field(default_factory=LoadReport)
    pending: dict[str, Future] = field(default_factory=dict)

    def plan(self, jobs: Collection[str]) -> None:
        """Tables of these jobs are to be waited for."""
        self.pending |= {table: Future() for job in jobs for table in JOBS[job][1]}

    def settle(self, tables: Iterable[str], error: Exception | None = None) -> None:
        """Tables are written, or won't be. What is settled stays so."""
        for table in tables:
            waited = self.pending.get(table)
            if waited is not None and not waited.done():
                waited.set_exception(error) if error else waited.set_result(None)

    def parents(self, table: str) -> dict[str, DataFrame]:
        """Tables that ``table`` refers to, once they are written; none if the sink can't be read."""
        names = {r.parent for r in model.WAREHOUSE[table].references} if self.references else set()
        for name in names & self.pending.keys():
            self.pending[name].result()
        return {name: self.sink.read(name) for name in names} if isinstance(self.sink, CatalogSink) else {}


@dataclass
class Job:
    """A job of a load. Rows that their table's contract refuses go to ``rejects/<table>`` of the zone, with reasons.

    The load id follows from the files that the job reads, so a repeated job replaces its own rows and rejects.
    """

    load: Load
    name: str
    load_id: str
    inputs: DataFrame
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def zone(self) -> LandingZone:
        return self.load.zone

    def write(self, df: DataFrame, table: str, mode: str = "append", unique: bool = True) -> None:
        """Gate the rows and write them; with ``unique`` off rows may repeat the table's natural key."""
        contract = model.WAREHOUSE[table]
        contract = contract if unique else replace(contract, unique=())
        parents, sink = self.load.parents(table), self.load.sink
        readable = isinstance(sink, CatalogSink)
        existing = sink.others(table, self.load_id) if readable and mode == "append" else None
        checked = gate.gated(df, contract, parents, existing)
        refused = F.size("faults") > 0
        # One evaluation: refused rows lie in files of their own.
        split = stage(checked.withColumn("__refused", refused), table, ["__refused"])
        report = self.load.report
        bad = split.where("__refused").drop("__refused")
        self._reject(bad, table, quality.reject_lines(bad, table, df.columns))
        good = split.where("not __refused").drop("__refused", "faults")
        extra = {} if unique or not readable else {"stable_ids": False}
        rows = sink.write(good, table, mode, self.load_id, **extra)
        self.counts[table] = rows
        report.rows[table] = report.rows.get(table, 0) + rows
        self.load.settle([table])

    def _reject(self, bad: DataFrame, table: str, lines: DataFrame) -> None:
        """Write ``lines``, one per row of ``bad``, into the partition of this load; delete what it has had there before."""
        path = self.zone.path(f"rejects/{table}.json/{LOAD}={self.load_id}")
        if bad.isEmpty():
            delete_folder(self.zone.spark, path)
            return
        counted = Observation()
        lines.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
        report = self.load.report
        report.rejects[table] = report.rejects.get(table, 0) + counted.get["rows"]

    def text(self, name: str) -> DataFrame:
        """The sound records of a landed table, parsed once and staged; the others go to the rejects."""
        cells = raw.scan(self.zone, name).cells
        staged = stage(cells.withColumn("__bad", F.col(RECORD).isNotNull()), name, ["__bad"])
        bad = Scan(staged.where("__bad").drop("__bad"))
        self._reject(bad.cells, name, bad.rejects())
        return Scan(staged.where("not __bad").drop("__bad")).rows()

    def scan(self, name: str, schema: T.StructType) -> DataFrame:
        """A landed table by its types; cells that don't fit are null, and counted."""
        text = self.text(name)
        for line in quality.unreadable_cells(text, schema, name).collect():
            self.load.report.unreadable[name, line.column_name] = line.violations
        return conform(text, schema)


def _run(
    zone: LandingZone, sink: Sink | Load, name: str, work: Callable[[Job], None], *paths: str, whole: bool = True
) -> LoadReport:
    """Run a job unless it is done; ``whole`` tells whether it loads all its tables, hence counts as done."""
    load = sink if isinstance(sink, Load) else Load(zone, sink)
    inputs = zone.files(*paths)
    job = Job(load, name, f"{name}-{zone.fingerprint(inputs)}", inputs)
    kept = isinstance(load.sink, CatalogSink)
    if kept and load.resume and load.sink.is_recorded(job.load_id):
        load.report.skipped.append(name)
    else:
        with staging(zone.spark):
            work(job)
        if kept and whole:
            load.sink.record(job.load_id, inputs, job.counts)
    load.settle(JOBS[name][1])
    return load.report


def load_industry(zone: LandingZone, sink: Sink | Load) -> LoadReport:
    def work(job: Job) -> None:
        job.write(conform(job.text("industries"), model.RAW_INDUSTRY), "dim_industry")

    return _run(zone, sink, "industry", work, model.LANDED_PATHS["industries"])


def load_enterprise(zone: LandingZone, sink: Sink | Load, map_path: str | None = None) -> LoadReport:
    def work(job: Job) -> None:
        industry_map = raw.read_industry_map(zone, map_path or zone.path(MAP_PATH))
        companies = conform(job.text("enterprise"), model.RAW_ENTERPRISE)
        job.write(dimensions.enterprise_enriched(companies, industry_map), "dim_enterprise")

    return _run(zone, sink, "enterprise", work, model.LANDED_PATHS["enterprise"], map_path or MAP_PATH)


def load_subsidiaries(zone: LandingZone, sink: Sink | Load) -> LoadReport:
    def work(job: Job) -> None:
        job.write(dimensions.fact_subsidiary(job.scan("subsidiaries", model.RAW_SUBSIDIARY)), "fact_subsidiary")

    return _run(zone, sink, "subsidiaries", work, model.LANDED_PATHS["subsidiaries"])


def load_leadership(
    zone: LandingZone, sink: Sink | Load, shareholders: DataFrame | None = None
) -> LoadReport:
    """Two tables from one scan, which is staged so that the text is parsed once."""

    def work(job: Job) -> None:
        officers = job.scan("leadership", model.RAW_LEADERSHIP)
        job.write(dimensions.dim_holder(officers, shareholders), "dim_holder_info")
        job.write(dimensions.fact_ownership(officers, shareholders, typed=False), "fact_ownership")

    return _run(zone, sink, "leadership", work, model.LANDED_PATHS["leadership"])


def load_financials(
    zone: LandingZone, sink: Sink | Load, merge_ratios: bool = True, tables: Collection[str] | None = None
) -> LoadReport:
    """Reports, prices, dates and ratios, or those of them in ``tables``. Each landed file is parsed once, then staged.

    ``merge_ratios`` joins both statements of a quarter before the ratios, which gives the one
    row per company and quarter that the table's key asks for. Without it there are two.
    """
    wanted = set(JOBS["financials"][1] if tables is None else tables)

    def work(job: Job) -> None:
        income = balance = quotes = report = price_fact = None
        if wanted - {"dim_date"}:
            balance = raw.read_balance(zone, job.text("balance"))
        if wanted & {"dim_date", "fact_price_history", "fact_financial_ratio"}:
            quotes = raw.read_prices(zone, job.text("prices"))
        if "dim_date" in wanted:
            job.write(dimensions.dim_date(quotes), "dim_date", "overwrite")
        if wanted & {"fact_financial_report", "fact_financial_ratio"}:
            income = raw.read_income(zone, job.text("income"))
            report = stage(statements.financial_report(income, balance), "report")
        if "fact_financial_report" in wanted:
            job.write(report, "fact_financial_report", "overwrite")
        if wanted & {"fact_price_history", "fact_financial_ratio"}:
            price_fact = stage(prices.price_history(quotes, balance), "price-fact")
        if "fact_price_history" in wanted:
            job.write(price_fact, "fact_price_history", "overwrite")
        if "fact_financial_ratio" in wanted:
            rows = statements.merged_report(report) if merge_ratios else report
            ratio = ratios.financial_ratio(rows, price_fact)
            job.write(ratio, "fact_financial_ratio", "overwrite", unique=merge_ratios)

    paths = (model.LANDED_PATHS[n] for n in ("income", "balance", "prices"))
    return _run(zone, sink, "financials", work, *paths, whole=wanted == set(JOBS["financials"][1]))


#: Jobs, with the tables they write.
JOBS: dict[str, tuple[Callable[..., LoadReport], tuple[str, ...]]] = {
    "industry": (load_industry, ("dim_industry",)),
    "enterprise": (load_enterprise, ("dim_enterprise",)),
    "subsidiaries": (load_subsidiaries, ("fact_subsidiary",)),
    "leadership": (load_leadership, ("dim_holder_info", "fact_ownership")),
    "financials": (
        load_financials,
        ("dim_date", "fact_financial_report", "fact_price_history", "fact_financial_ratio"),
    ),
}


def job_of(table: str) -> str:
    """The job that loads a table."""
    return next(name for name, (_, tables) in JOBS.items() if table in tables)


def load_warehouse(
    zone: LandingZone,
    sink: Sink,
    merge_ratios: bool = True,
    jobs: Collection[str] = tuple(JOBS),
    resume: bool = False,
    verify: bool = True,
    tables: Collection[str] | None = None,
    references: bool = True,
) -> LoadReport:
    """All jobs, or some, at once: each writes a table as soon as the tables it refers to are written.

    A job that fails stops those that wait for its tables only; when all have ended, the first error is raised. With
    ``resume`` the next call repeats what has failed and skips jobs that the ledger holds for the same files.
    Where the sink can be read, rows, keys and references of the loaded tables are checked as well (``verify``).
    ``tables`` restricts the job of reports and prices to these tables.
    """
    load = Load(zone, sink, resume, references)
    load.plan(jobs)

    def one(name: str) -> None:
        zone.spark.sparkContext.setJobGroup(f"load-{name}", f"load job {name}")
        work, written = JOBS[name]
        try:
            options = {"merge_ratios": merge_ratios, "tables": tables and set(tables) & set(written)}
            work(zone, load, **(options if name == "financials" else {}))
        except Exception as error:
            load.settle(written, RuntimeError(f"load job {name} failed: {error}"))
            raise

    with ThreadPoolExecutor(len(JOBS)) as pool:
        ended = {name: pool.submit(one, name) for name in jobs}
    for future in ended.values():
        future.result()
    if verify and isinstance(sink, CatalogSink):
        found = quality.warehouse_violations({name: sink.read(name) for name in model.WAREHOUSE}).collect()
        load.report.violations = sorted(map(tuple, found))  # one row per broken check at most
    return load.report


# --- driver tables as landed files ----------------------------------------------


#: Raw tables that each job reads.
_INPUTS = {
    "industry": ("industries",),
    "enterprise": ("enterprise",),
    "subsidiaries": ("subsidiaries",),
    "leadership": ("leadership",),
    "financials": ("income", "balance", "prices"),
}


def land_shapes(zone: LandingZone, sf_dir: str, jobs: Collection[str] = tuple(JOBS)) -> None:
    """Land the reshaped driver tables where the load jobs expect the raw files."""
    from stockloom.plans import shapes

    spark = zone.spark
    sales = functools.cache(lambda: shapes.staged_sales(spark, sf_dir))
    tables = {
        "industries": lambda: shapes.industries(spark, sf_dir),
        "enterprise": lambda: shapes.enterprise(spark, sf_dir),
        "subsidiaries": lambda: shapes.subsidiaries(spark, sf_dir),
        "leadership": lambda: shapes.leadership(spark, sf_dir),
        "income": lambda: shapes.raw_income(sales()),
        "balance": lambda: shapes.raw_balance(sales()),
        "prices": lambda: shapes.raw_prices(spark, sf_dir).withColumn("time", F.col("time").cast("string")),
    }
    for job in jobs:
        for name in _INPUTS[job]:
            land(zone, name, tables[name]())
    if "enterprise" in jobs:
        folder, _, file_name = MAP_PATH.rpartition("/")
        zone.save_dataframe(
            shapes.industry_map(spark, sf_dir), folder, file_name.removesuffix(".csv"), "csv"
        )


def scratch_warehouse(spark: SparkSession) -> CatalogSink:
    sink = CatalogSink(spark, f"mart_{uuid.uuid4().hex[:12]}", scratch_path(spark, "mart"))
    sink.initialise()
    return sink

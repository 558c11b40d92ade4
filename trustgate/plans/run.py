"""The four jobs of a product: take in feeds, gate, publish, answer.

Jobs hand over through tables and share a run id. A job reports what blocks the next one;
its facts are stored either way.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.functions.expressions import quoted
from trustgate.operators import gate, governance, harmonize, marts, metrics, profile, statistics
from trustgate.plans.spec import ProductSpec
from trustgate.plans.views import governance_views, rename_view
from trustgate.sources import feeds, tables

logger = logging.getLogger(__name__)

LAYERS = ("raw", "clean", "consumption", "governance")
FACTS = ("data_profile", "dq_validation_result", "fitness_for_use_result")
#: A run's counts per period and failed rules, from which later facts are summed up.
STATISTICS = "run_statistics"
#: Property of a published table or view: the run whose rows it shows.
SHOWS = "trustgate.run"


@dataclass(frozen=True)
class Store:
    """Where a product's tables live.

    ``prefix`` goes before the layer names, so that several products share one catalog.
    ``location`` is the folder for new namespaces, the warehouse by default. ``rebalance``
    shuffles the gated rows into their partitions before they are written; turn it off where
    landing parts already hold a period each and a few small files cost less than the shuffle.
    ``publish_blocked`` replaces tables and views even when a rule blocks the run.
    """

    catalog: str = ""
    prefix: str = ""
    location: str | None = None
    fmt: str = "parquet"
    rebalance: bool = True
    publish_blocked: bool = False

    def schema(self, layer: str) -> str:
        return self.prefix + layer

    def name(self, layer: str, table: str) -> str:
        return tables.qualified(self.schema(layer), table, self.catalog)

    def prepare(self, spark: SparkSession) -> None:
        namespaces = [
            ".".join(part for part in (self.catalog, self.schema(layer)) if part)
            for layer in LAYERS
        ]
        tables.ensure_namespaces(spark, namespaces, self.location)


@dataclass(frozen=True)
class JobResult:
    job: str
    blocked_by: tuple[str, ...] = ()
    rows: dict[str, int] = field(default_factory=dict)
    skipped: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return not self.blocked_by


@dataclass(frozen=True)
class Run:
    """One run of one product over one store.

    ``attempt`` tells repeated runs of one id apart: each writes tables of its own, and its facts
    take the place of the earlier attempt's. An attempt that is blocked while rows of an earlier
    one are published keeps its facts under ``run_id/attempt``, so that the run's facts go on
    describing the rows that readers see.
    """

    spark: SparkSession
    spec: ProductSpec
    store: Store
    run_id: str
    captured_at: str | None = None
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.store.name(layer, name))

    def append(self, facts: DataFrame, name: str, label: str = "", **keys: object) -> None:
        """Store facts of this run; ``keys`` tell its parts of one facts table apart.

        ``label`` is the run they are stored under, if not this one's id.
        """
        target, run = self.store.name("governance", name), label or self.run_id
        labelled = facts.withColumn("run_id", F.lit(run))
        tables.replace_facts(labelled, target, {"run_id": run, **keys}, self.store.fmt)

    def label(self, layer: str, blocked: Sequence[str]) -> str:
        """The run that facts about a layer's new rows belong to."""
        shown = tables.noted(self.spark, self.store.name(layer, self.spec.table), SHOWS)
        kept = blocked and not self.store.publish_blocked and shown == self.run_id
        return f"{self.run_id}/{self.attempt}" if kept else self.run_id

    def facts(self, name: str) -> DataFrame:
        """This run's facts, as stored."""
        return self.table("governance", name).where(F.col("run_id") == F.lit(self.run_id))

    @property
    def quarantine(self) -> str:
        return f"{self.spec.table}_quarantine"

    def profile(self, facts: DataFrame, layer: str, table: str, label: str = "") -> None:
        self.append(facts, "data_profile", label, layer=layer, table_name=table)

    def canonical(self) -> DataFrame:
        raw = [(self.table("raw", feed.raw_table), feed) for feed in self.spec.feeds]
        return harmonize.canonical(raw, self.spec)


def names_in(df: DataFrame) -> tuple[str, ...]:
    """Names of failed rules: never more than the product declares."""
    return tuple(sorted(row[0] for row in df.collect()))


def ingest(run: Run, template: str) -> JobResult:
    """Landing parts to one raw table per feed, and a profile of the harmonised whole.

    ``template`` is the path of a part, with ``{feed}`` and ``{period}`` to fill in.
    An empty feed blocks; a profile that Spark cannot take does not, but the result names it.
    """
    spec = run.spec
    run.store.prepare(run.spark)
    rows = {}
    for feed in spec.feeds:
        df = feeds.read_feed(
            run.spark, template, feed.label, spec.landing_parts, spec.drifting_types
        )
        name = run.store.name("raw", feed.raw_table)
        stamped = feeds.with_provenance(df, feed.label, run.captured_at, f"{spec.category}_hint")
        tables.write_table(stamped, name, fmt=run.store.fmt)
        rows[name] = run.spark.table(name).count()
    empty = tuple(name for name, n in rows.items() if n == 0)
    skipped: tuple[str, ...] = ()
    if not empty:
        projected = f"{spec.table}_projected"
        try:
            facts = profile.profile(
                run.canonical(), spec.profile, run.run_id, "raw", projected, run.captured_at
            )
            run.profile(facts, "raw", projected)
        except PySparkException:
            logger.exception("raw profile skipped in run %s", run.run_id)
            skipped = ("raw profile",)
    return JobResult("ingest", empty, rows, skipped)


def gated_table(run: Run) -> str:
    """The marked rows of one attempt: no two run ids, nor attempts of one, share the name."""
    return run.store.name(
        "clean", f"{run.spec.table}_gated_{run.run_id.encode().hex()}_{run.attempt}"
    )


def publish_governance(run: Run) -> None:
    """The governance views whose facts exist so far; a blocked run shows its scorecard too."""
    store, spark = run.store, run.spark
    needed = [store.name("governance", f) for f in FACTS] + [store.name("clean", run.quarantine)]
    missing = [name for name in needed if not spark.catalog.tableExists(name)]
    views = {
        name: text
        for name, text in governance_views(store, run.spec).items()
        if not any(m in text for m in missing)
    }
    if views:
        tables.publish_views(spark, views, store.schema("governance"), store.catalog)


def build_clean(run: Run) -> JobResult:
    """Raw to clean and quarantine, every rule scored, the clean layer profiled.

    The marked rows are written once, to a table of the run, and read once for all that is
    counted (``statistics``); distinct keys are a second pass over the key's columns. Then the
    clean and quarantine views are pointed at the table's partitions, unless a rule blocks.
    """
    spec, store, spark = run.spec, run.store, run.spark
    canonical = run.canonical()
    marked = gate.mark(canonical, spec.row_rules, run.run_id, run.captured_at)
    name = gated_table(run)
    partitions = ["dq_quarantined", spec.period]
    tables.write_table(marked, name, partitions, store.fmt, rebalance=store.rebalance)

    gated = spark.table(name)
    stats = tables.staged(statistics.statistics(gated, spec))
    # One row for each side.
    sides = dict(stats.groupBy("dq_quarantined").agg(F.sum("n")).collect())
    if not sides:
        return JobResult("build_clean", ("empty input",))
    rows = {spec.table: sides.get(False, 0), run.quarantine: sides.get(True, 0)}
    keys = statistics.distinct_keys(gated, spec.business_key)
    measures = statistics.as_measures(stats, keys, spec.row_rules)
    facts = tables.staged(metrics.validation_rows(measures, spec, run.run_id, run.captured_at))
    blocked = names_in(metrics.blocking(facts))
    blocked += statistics.wrong_categories(stats, gated, spec)
    label = run.label("clean", blocked)
    run.append(stats.withColumn("run_id", F.lit(label)), STATISTICS, label)
    run.append(facts, "dq_validation_result", label)
    run.profile(profile_of(run, stats, "clean"), "clean", spec.table, label)
    if store.publish_blocked or not blocked:
        columns = ", ".join(quoted(c) for c in canonical.columns)
        trail = ", ".join(gate.trail_columns(spec.row_rules, run.run_id))
        views = {
            spec.table: f"SELECT {columns} FROM {name} WHERE NOT dq_quarantined",
            run.quarantine: f"SELECT {columns}, {trail} FROM {name} WHERE dq_quarantined",
        }
        for view in tables.publish_views(spark, views, store.schema("clean"), store.catalog):
            tables.note(spark, view, SHOWS, run.run_id, "VIEW")
    publish_governance(run)
    return JobResult("build_clean", blocked, rows)


def profile_of(run: Run, stats: DataFrame, layer: str) -> DataFrame:
    """The profile of the clean rows, as a layer's table shows them, from the run's statistics."""
    spec = run.spec
    shown = spec.consumption_columns if layer == "consumption" else None
    kept = profile.Layer(layer, spec.table, "NOT dq_quarantined", shown)
    return statistics.as_profile(
        stats,
        run.canonical().columns,
        spec.profile,
        run.run_id,
        [kept],
        run.captured_at,
    )


def publish_consumption(run: Run) -> JobResult:
    """Clean to the consumer table and its renamed view, checked for fitness and profiled.

    Fitness looks at the rows about to be published; the table is replaced unless it blocks. The
    rows written are counted against the run's statistics, from which their profile comes too.
    """
    spec, store, spark = run.spec, run.store, run.spark
    published = marts.consumption(run.table("clean", spec.table), spec.consumption_columns)
    stats = run.facts(STATISTICS)
    clean = stats.where("NOT dq_quarantined").agg(F.sum("n"))
    rows = {spec.table: clean.first()[0] or 0}
    if rows[spec.table] == 0:
        return JobResult("publish_consumption", ("empty consumption",), rows)
    facts = tables.staged(
        metrics.fitness_rows(
            metrics.fitness_measures(published, spec),
            spec.fitness_rules,
            run.run_id,
            run.captured_at,
        )
    )
    blocked = names_in(metrics.blocking_fitness(facts, spec.fitness_rules))
    run.append(facts, "fitness_for_use_result", run.label("consumption", blocked))
    publish_governance(run)

    if store.publish_blocked or not blocked:
        name = store.name("consumption", spec.table)
        # The gated table already lies in period order, file by file: no second shuffle.
        tables.write_table(
            published, name, [spec.period], store.fmt, rebalance=False, expected=rows[spec.table]
        )
        tables.note(spark, name, SHOWS, run.run_id)
        if spec.interface:
            views = {spec.interface: rename_view(name, spec)}
            tables.publish_views(spark, views, store.schema("consumption"), store.catalog)
        run.profile(profile_of(run, stats, "consumption"), "consumption", spec.table)
    return JobResult("publish_consumption", blocked, rows)


def analyse(run: Run) -> JobResult:
    """Consumption to the KPI tables; too few rows in any block and leave the old tables.

    All KPIs come from one scan of the consumer table.
    """
    spec, store = run.spec, run.store
    if not spec.kpis:
        return JobResult("analyse")
    cube = tables.staged(marts.kpi_cube(run.table("consumption", spec.table), spec))
    made = {
        kpi.name: marts.kpi_rows(cube, spec, kpi.name, run.run_id, run.captured_at)
        for kpi in spec.kpis
    }
    checks = feeds.union_parts(
        marts.completeness(made[kpi.name], kpi.name, **kpi.needed(spec)) for kpi in spec.kpis
    )
    found = checks.collect()
    short = tuple(row["kpi"] for row in found if not row["passed"])
    if store.publish_blocked or not short:
        ready = {name: (lambda df=df: df) for name, df in made.items()}
        tables.publish_tables(
            run.spark, ready, store.schema("consumption"), catalog=store.catalog, fmt=store.fmt
        )
    return JobResult("analyse", short, {row["kpi"]: row["row_count"] for row in found})


def run_product(
    spark: SparkSession,
    spec: ProductSpec,
    store: Store,
    run_id: str,
    template: str,
    captured_at: str | None = None,
) -> list[JobResult]:
    """All jobs in order, stopping after the first that blocks.

    Periods and hours are those of UTC: the session's time zone is set to it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    run = Run(spark, spec, store, run_id, captured_at)
    results = []
    jobs = (partial(ingest, template=template), build_clean, publish_consumption, analyse)
    for job in jobs:
        result = job(run)
        results.append(result)
        if not result.ok:
            logger.error("%s blocked in run %s by %s", result.job, run_id, result.blocked_by)
            break
    return results


def lineage(run: Run) -> DataFrame:
    """Rows of every table on the way from the feeds to the consumer."""
    table = run.spec.table
    stored = [("raw", feed.raw_table) for feed in run.spec.feeds]
    stored += [("clean", table), ("clean", run.quarantine), ("consumption", table)]
    return governance.layer_counts(
        {f"{layer}.{name}": run.table(layer, name) for layer, name in stored}
    )

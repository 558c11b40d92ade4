"""Typed declarations of a data product. Bad values raise when a spec is built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

# The vocabularies a rule may use.
DIMENSIONS = ("accuracy", "completeness", "consistency", "timeliness", "validity", "uniqueness")
SEVERITIES = ("error", "warning")
COMPARATORS = {
    "gte": "gte", ">=": "gte",
    "lte": "lte", "<=": "lte",
    "eq": "eq", "==": "eq",
    "gt": "gt", ">": "gt",
    "lt": "lt", "<": "lt",
}
PROFILE_METRICS = ("row_count", "null_rate", "min", "max", "avg")

# Declared column types and the Spark types that satisfy them.
DECLARED_TYPES = {
    "long": ("bigint",),
    "integer": ("int",),
    "double": ("double",),
    "string": ("string",),
    "timestamp": ("timestamp", "timestamp_ntz"),
}


class SpecError(ValueError):
    """A declaration that cannot be run."""


def _one_of(kind: str, value: str, allowed, owner: str) -> str:
    if value not in allowed:
        raise SpecError(f"{owner}: unknown {kind} {value!r}")
    return value


def _unique(kind: str, names: Sequence[str]) -> None:
    repeated = sorted({n for n in names if list(names).count(n) > 1})
    if repeated:
        raise SpecError(f"repeated {kind}: {repeated}")


@dataclass(frozen=True)
class RowRule:
    """A predicate every row should pass; NULL counts as a failure.

    ``error`` rules are hard and move a row to quarantine, ``warning`` rules only score.
    """

    name: str
    dimension: str
    severity: str
    expression: str

    def __post_init__(self):
        if not self.name or "," in self.name or self.name != self.name.strip():
            raise SpecError(f"rule name {self.name!r} cannot be stored in a trail")
        if not self.expression:
            raise SpecError(f"{self.name}: a row rule needs an expression")
        _one_of("dimension", self.dimension, DIMENSIONS, self.name)
        _one_of("severity", self.severity, SEVERITIES, self.name)

    @property
    def hard(self) -> bool:
        return self.severity == "error"


@dataclass(frozen=True)
class AggregateRule:
    """A threshold on one metric of the whole gated table."""

    name: str
    dimension: str
    metric: str
    threshold: float
    comparator: str = "gte"
    severity: str = "warning"

    def __post_init__(self):
        _one_of("dimension", self.dimension, DIMENSIONS, self.name)
        _one_of("severity", self.severity, SEVERITIES, self.name)
        _one_of("comparator", self.comparator, COMPARATORS, self.name)


@dataclass(frozen=True)
class FitnessRule:
    """A threshold deciding whether published data can answer one use case."""

    name: str
    metric: str
    threshold: float
    comparator: str = "gte"
    severity: str = "error"
    use_case: str = ""

    def __post_init__(self):
        _one_of("severity", self.severity, SEVERITIES, self.name)
        _one_of("comparator", self.comparator, COMPARATORS, self.name)
        if not self.use_case:
            object.__setattr__(self, "use_case", self.name)


@dataclass(frozen=True)
class FailedRowsCheck:
    """A predicate stated as a failure; NULL does not count, as in a WHERE clause."""

    name: str
    condition: str
    severity: str = "error"

    def __post_init__(self):
        _one_of("severity", self.severity, SEVERITIES, self.name)


@dataclass(frozen=True)
class ProfileSpec:
    columns: tuple[str, ...]
    metrics: tuple[str, ...] = PROFILE_METRICS

    def __post_init__(self):
        for metric in self.metrics:
            _one_of("profile metric", metric, PROFILE_METRICS, "profile")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    required: bool = False
    enum: tuple[str, ...] = ()

    def __post_init__(self):
        _one_of("column type", self.type, DECLARED_TYPES, self.name)


@dataclass(frozen=True)
class FeedSpec:
    """How one feed's columns map to the canonical record: ``columns`` is canonical -> source.

    ``table`` names the feed's raw table, by default after its label.
    """

    label: str
    columns: Mapping[str, str]
    carry: tuple[str, ...] = ("source_file", "ingest_ts")
    label_override: str | None = None
    table: str = ""

    @property
    def raw_table(self) -> str:
        return self.table or f"{self.label}_raw"


@dataclass(frozen=True)
class KpiSpec:
    """A business question: measures of published rows per value of a grain.

    ``grain`` names the key column and ``grain_sql`` computes it; ``only`` picks the rows, and may
    name settings of the product in braces. A measure is one aggregate call. ``exactly`` or
    ``at_least`` says how many rows the answer needs: a number, or a setting of the product that
    is one or has a length.
    """

    name: str
    grain: str
    measures: Mapping[str, str]
    grain_sql: str = ""
    only: str = "true"
    exactly: int | str | None = None
    at_least: int | str | None = None

    def __post_init__(self):
        if not self.measures:
            raise SpecError(f"{self.name}: a KPI needs a measure")
        for measure in self.measures.values():
            if "(" not in measure or not measure.endswith(")"):
                raise SpecError(f"{self.name}: {measure!r} isn't one aggregate call")
        if (self.exactly is None) == (self.at_least is None):
            raise SpecError(f"{self.name}: state either the exact or the least number of rows")

    @property
    def key(self) -> str:
        return self.grain_sql or f"`{self.grain}`"

    def condition(self, product: ProductSpec) -> str:
        return self.only.format_map(vars(product))

    def needed(self, product: ProductSpec) -> dict[str, int]:
        """``exactly`` or ``at_least`` with its number."""
        kind = "exactly" if self.at_least is None else "at_least"
        value = getattr(self, kind)
        value = getattr(product, value) if isinstance(value, str) else value
        return {kind: value if isinstance(value, int) else len(value)}


@dataclass(frozen=True)
class ProductSpec:
    """One governed product: feeds, rules, declared columns and the key facts about its tables.

    ``table`` names its tables and views, ``interface`` the view under older column names (none if
    empty), ``kpis`` the questions it answers. ``period`` is the event time in ``period_format`` and nothing else: equal event times share
    a period. ``mandatory_rules`` names row rules that must be declared, with the severity each
    must have. ``periods`` are the periods it promises to cover, ``parts`` the landing parts of each feed
    where they are not one per period.
    """

    table: str = "records"
    interface: str = ""
    kpis: tuple[KpiSpec, ...] = ()
    feeds: tuple[FeedSpec, ...] = ()
    row_rules: tuple[RowRule, ...] = ()
    aggregate_rules: tuple[AggregateRule, ...] = ()
    fitness_rules: tuple[FitnessRule, ...] = ()
    checks: tuple[FailedRowsCheck, ...] = ()
    mandatory_rules: Mapping[str, str] = field(default_factory=dict)
    profile: ProfileSpec = field(default_factory=lambda: ProfileSpec(()))
    models: Mapping[str, tuple[ColumnSpec, ...]] = field(default_factory=dict)
    business_key: tuple[str, ...] = ()
    event_time: str = "pickup_datetime"
    period: str = "year_month"
    period_format: str = "yyyy-MM"
    category: str = "taxi_type"
    expected_categories: tuple[str, ...] = ()
    critical_columns: tuple[str, ...] = ()
    consumption_columns: tuple[str, ...] = ()
    renamed_columns: Mapping[str, str] = field(default_factory=dict)
    periods: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    drifting_types: Mapping[str, str] = field(default_factory=dict)
    monthly_category: str = ""
    hourly_period: str = ""
    min_hours: int = 20

    def __post_init__(self):
        _unique("rule names", [r.name for r in (*self.row_rules, *self.aggregate_rules)])
        _unique("fitness rule names", [r.name for r in self.fitness_rules])
        _unique("check names", [c.name for c in self.checks])
        _unique("KPI names", [k.name for k in self.kpis])
        declared = {r.name: r.severity for r in self.row_rules}
        for name, severity in self.mandatory_rules.items():
            if declared.get(name) != severity:
                raise SpecError(f"{name}: must be a row rule of severity {severity}")

    @property
    def hard_rules(self) -> tuple[RowRule, ...]:
        return tuple(r for r in self.row_rules if r.hard)

    @property
    def soft_rules(self) -> tuple[RowRule, ...]:
        return tuple(r for r in self.row_rules if not r.hard)

    @property
    def landing_parts(self) -> tuple[str, ...]:
        return self.parts or self.periods

    @property
    def key_fixes_period(self) -> bool:
        """True when equal business keys always share a period, so counts add up over periods."""
        return self.period in self.business_key or self.event_time in self.business_key

    def with_rule(self, name: str, expression: str) -> ProductSpec:
        """The same product with one row rule restated."""
        if name not in {r.name for r in self.row_rules}:
            raise SpecError(f"no row rule {name!r}")
        return replace(
            self,
            row_rules=tuple(
                replace(r, expression=expression) if r.name == name else r for r in self.row_rules
            ),
        )

    @classmethod
    def from_contract(
        cls,
        contract: Mapping[str, Any],
        checks: Mapping[str, Any] | None = None,
        **settings: Any,
    ) -> ProductSpec:
        """Build a product from a data contract given as plain mappings (parsed YAML or JSON).

        ``quality`` holds row and aggregate rules, ``fitness_for_use`` the readiness rules,
        ``profiling`` the profile and ``models`` the declared columns. ``checks`` is a
        ``{"checks for <table>": [{"failed rows": {...}}]}`` mapping. Everything a contract
        does not state (business key, periods, expected categories) comes as ``settings``.
        A contract without fitness rules or profiled columns is refused.
        """
        if not contract.get("fitness_for_use"):
            raise SpecError("a contract needs fitness_for_use rules")
        if not (contract.get("profiling") or {}).get("columns"):
            raise SpecError("a contract needs profiling columns")
        row_rules, aggregate_rules = [], []
        for rule in contract.get("quality") or ():
            missing = [k for k in ("name", "dimension", "scope", "severity") if k not in rule]
            if missing:
                raise SpecError(f"quality rule {rule.get('name', rule)} lacks {missing}")
            if _one_of("scope", rule["scope"], ("row", "aggregate"), rule["name"]) == "row":
                row_rules.append(
                    RowRule(
                        rule["name"],
                        rule["dimension"],
                        rule["severity"],
                        rule.get("expression", ""),
                    )
                )
            else:
                aggregate_rules.append(
                    AggregateRule(
                        rule["name"],
                        rule["dimension"],
                        rule["metric"],
                        float(rule["threshold"]),
                        rule.get("comparator", "gte"),
                        rule["severity"],
                    )
                )
        fitness = tuple(
            FitnessRule(
                rule["name"],
                rule["metric"],
                float(rule["threshold"]),
                rule.get("comparator", "gte"),
                rule.get("severity", "error"),
                rule.get("use_case", ""),
            )
            for rule in contract["fitness_for_use"]
        )
        profiling = contract["profiling"]
        models = {
            name: tuple(
                ColumnSpec(
                    column,
                    declared["type"],
                    bool(declared.get("required", False)),
                    tuple(declared.get("enum") or ()),
                )
                for column, declared in (model.get("fields") or {}).items()
            )
            for name, model in (contract.get("models") or {}).items()
        }
        failed_rows = []
        for group in (checks or {}).values():
            for entry in group:
                body = entry["failed rows"]
                soft = "warn condition" in body
                failed_rows.append(
                    FailedRowsCheck(
                        body["name"],
                        body["warn condition" if soft else "fail condition"],
                        "warning" if soft else "error",
                    )
                )
        return cls(
            row_rules=tuple(row_rules),
            aggregate_rules=tuple(aggregate_rules),
            fitness_rules=fitness,
            checks=tuple(failed_rows),
            profile=ProfileSpec(
                tuple(profiling["columns"]),
                tuple(profiling.get("metrics") or PROFILE_METRICS),
            ),
            models=models,
            **settings,
        )

"""View texts over the stored tables, for readers who come with SQL."""

from __future__ import annotations

from typing import TYPE_CHECKING

from trustgate.functions.expressions import quoted
from trustgate.plans.spec import ProductSpec

if TYPE_CHECKING:
    from trustgate.plans.run import Store


def rename_view(table: str, spec: ProductSpec) -> str:
    """The consumer table under the names its older readers know."""
    columns = ", ".join(
        f"{quoted(c)} AS {quoted(spec.renamed_columns.get(c, c))}" for c in spec.consumption_columns
    )
    return f"SELECT {columns} FROM {table}"


def governance_views(store: Store, spec: ProductSpec) -> dict[str, str]:
    validation = store.name("governance", "dq_validation_result")
    profiles = store.name("governance", "data_profile")
    fitness = store.name("governance", "fitness_for_use_result")
    quarantine = store.name("clean", f"{spec.table}_quarantine")
    return {
        "vw_dq_scorecard": f"""
            SELECT run_id, dimension,
                   count(1) AS rules_evaluated,
                   count_if(passed) AS rules_passed,
                   avg(CAST(passed AS DOUBLE)) AS pass_rate,
                   max(measured) FILTER (WHERE rule = 'hard_quarantine_rate') AS quarantine_rate,
                   max(measured) FILTER (WHERE rule = 'uniqueness_rate') AS uniqueness_metric
            FROM {validation}
            GROUP BY ALL""",
        "vw_incident_quarantine_top_rules": f"""
            WITH trails AS (
              SELECT dq_run_id AS run_id, split(dq_failed_rules, ',') AS rules, count(1) AS n
              FROM {quarantine}
              GROUP BY ALL
            ), named AS (
              SELECT run_id, trim(name) AS rule, n FROM trails, LATERAL explode(rules) AS e(name)
            )
            SELECT run_id, rule, sum(n) AS incident_count
            FROM named
            WHERE rule <> ''
            GROUP BY ALL""",
        "vw_profile_latest": f"""
            SELECT * FROM {profiles}
            WHERE run_id = (SELECT max_by(run_id, struct(captured_at, run_id)) FROM {profiles})""",
        "vw_fitness_summary": f"""
            SELECT run_id, use_case, rule, passed, measured, expected, captured_at
            FROM {fitness}""",
    }

"""trustgate: governed data products as Spark jobs.

Harmonise batch feeds, gate every row against declared rules, score the result,
profile each layer, publish marts and triage incidents. Every public function
takes and returns DataFrames; nothing is collected between input and result.
"""

from trustgate.plans.spec import (
    AggregateRule,
    ColumnSpec,
    FailedRowsCheck,
    FeedSpec,
    FitnessRule,
    KpiSpec,
    ProductSpec,
    ProfileSpec,
    RowRule,
    SpecError,
)

__all__ = [
    "AggregateRule",
    "ColumnSpec",
    "FailedRowsCheck",
    "FeedSpec",
    "FitnessRule",
    "KpiSpec",
    "ProductSpec",
    "ProfileSpec",
    "RowRule",
    "SpecError",
]

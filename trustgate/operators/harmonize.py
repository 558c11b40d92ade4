"""Feeds with their own vocabularies become one canonical record."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from trustgate.functions.expressions import literal, quoted
from trustgate.plans.spec import FeedSpec, ProductSpec


def to_canonical(df: DataFrame, feed: FeedSpec, spec: ProductSpec) -> DataFrame:
    """Rename one feed's columns, add its label and derive the period from the event time."""
    label = literal(feed.label)
    if feed.label_override:
        label = f"coalesce({quoted(feed.label_override)}, {label})"
    columns = {name: quoted(source) for name, source in feed.columns.items()}
    columns |= {name: quoted(name) for name in feed.carry if name in df.columns}
    columns[spec.category] = label
    columns[spec.period] = f"date_format({columns[spec.event_time]}, {literal(spec.period_format)})"
    return df.selectExpr(*[f"{sql} AS {quoted(name)}" for name, sql in columns.items()])


def canonical(feeds: Iterable[tuple[DataFrame, FeedSpec]], spec: ProductSpec) -> DataFrame:
    """Bag union of all feeds in canonical form; nothing is deduplicated."""
    return reduce(
        DataFrame.unionByName, [to_canonical(df, feed, spec) for df, feed in feeds]
    )

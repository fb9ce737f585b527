"""All plans by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    plan: Plan
    sql: str | None


class Catalog:
    """Collects plans, each with the SQL text that must give the same rows."""

    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Plan], Plan]:
        def register(plan: Plan) -> Plan:
            key = name or plan.__name__
            if key in self.entries:
                raise ValueError(f"plan {key} exists twice")
            self.entries[key] = Entry(plan, sql)
            return plan

        return register


def all_entries() -> dict[str, Entry]:
    from tidelight.plans import datasets, files, images, kpis, streams, timelines

    merged: dict[str, Entry] = {}
    for module in (files, kpis, timelines, datasets, images, streams):
        merged.update(module.PLANS.entries)
    return merged

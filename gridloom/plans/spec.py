"""Declarative descriptions of a dataset: what its links, headers, columns and types look like."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """Column kinds (text when not listed), wanted order, and columns that get a redaction flag."""

    datetime: tuple[str, ...] = ()
    date: tuple[str, ...] = ()
    time: tuple[str, ...] = ()
    logical: tuple[str, ...] = ()
    integer: tuple[str, ...] = ()
    double: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    redaction_flags: tuple[str, ...] = ()

    def kind(self, column: str) -> str:
        for kind in ("datetime", "date", "time", "logical", "integer", "double"):
            if column in getattr(self, kind):
                return kind
        return "text"


@dataclass(frozen=True)
class DatasetProfile:
    """Everything that differs between one kind of release and another."""

    kind: str
    link_terms: tuple[str, ...]
    too_specific_terms: tuple[str, ...]
    header_terms: tuple[str, ...]
    crosswalk: Mapping[str, tuple[str, ...]]
    part_date_columns: tuple[str, ...]
    monthly_date_columns: tuple[str, ...]
    weekly_date_columns: tuple[str, ...]
    table: TableSpec
    benchmark_component: str | None = None
    reporting_start: str = "2020-01-01"
    excluded_parts: tuple[str, ...] = field(default=())

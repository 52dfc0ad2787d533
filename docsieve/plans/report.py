"""Exporting the result tables of a run as CSV, one folder per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from docsieve.sources.tables import write_table


def export_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], folder: str) -> list[str]:
    """Write each ``name: (table, order)`` under ``folder`` and return the paths."""
    paths = []
    for name, (table, order) in tables.items():
        path = f"{folder}/{name}"
        write_table(table, path, order)
        paths.append(path)
    return paths

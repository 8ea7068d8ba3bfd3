"""Column roles: selection and the pre-append metadata check."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.spec import DatasetMetadata, IngestSpec, SpecError


def metadata_columns(rows: DataFrame, spec: IngestSpec) -> DataFrame:
    """Project dimensions ∪ metrics (Catalyst prunes everything else)."""
    return rows.select(*DatasetMetadata.of(spec).columns)


def require_match(existing: DatasetMetadata | None, spec: IngestSpec) -> DatasetMetadata:
    """Refuse to append when the table's roles differ from the spec's (as sets)."""
    mine = DatasetMetadata.of(spec)
    if existing is not None and not existing.matches(mine):
        raise SpecError(f"metadata mismatch: table has {existing.to_json()}, spec has {mine.to_json()}")
    return mine

"""Curated-zone output of a batch question.

Every question's result goes to the curated zone as JSON and, when an index
connector is configured, to a search index; the result is computed once and
persisted for both writes instead of re-running the plan per sink.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from cinelake.sources import zones


def publish_result(df: DataFrame, name: str, curated_root: str,
                   index_format: str | None = None, index_options: Mapping[str, str] | None = None,
                   show: bool = False) -> None:
    """Write ``df`` to ``curated_root/name`` (JSON, overwrite) and optionally
    to an index (``index_format`` is the connector's format name, e.g. its
    data source class; ``index_options`` carry nodes, credentials and the
    resource name). ``show`` prints a preview first."""
    targets = [{"path": f"{curated_root.rstrip('/')}/{name}", "fmt": "json"}]
    if index_format:
        targets.append({"path": None, "fmt": index_format, "options": dict(index_options or {})})
    if show:
        zones.preview(df)
    zones.write_many(df, targets)

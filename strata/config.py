"""Typed views of the two work-order records: a source registration and a
replay request.  Their defaults live here and in the column rules that
normalise control rows before they are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

from strata.functions.options import DEFAULT_DELETED_VALUES, INCREMENTAL_MODES

DEFAULT_TRANSFORM = "scd2_current_history"
DEFAULT_PUBLISH = "publish_current_snapshot"

# Bronze audit columns added to every landed row.
SYSTEM_COLUMNS = ("pipeline_batch_id", "bronze_load_ts", "source_name", "load_mode", "record_hash")


def from_row(kind, row):
    """A typed record from a normalised control row: its columns of the record's
    field names; NULL leaves the field's default."""
    values = row.asDict(recursive=True)
    if isinstance(values.get("options"), dict):
        values["options"] = {k: v for k, v in values["options"].items() if v is not None}
    return kind(**{f.name: values[f.name] for f in fields(kind) if values.get(f.name) is not None})


@dataclass
class SourceRegistration:
    source_name: str
    bronze_table: str
    source_object: str | None = None
    domain_name: str | None = None
    source_type: str | None = None
    enabled: bool = True
    load_mode: str = "FULL"
    base_extract_sql: str | None = None
    watermark_column: str | None = None
    watermark_type: str | None = None
    primary_keys: list[str] = field(default_factory=list)
    sequence_column: str | None = None
    delete_indicator_column: str | None = None
    silver_current_table: str | None = None
    silver_history_table: str | None = None
    gold_table: str | None = None
    silver_transform_name: str = DEFAULT_TRANSFORM
    gold_publish_name: str = DEFAULT_PUBLISH
    quality_rule_set: str | None = None
    replay_mode_default: str | None = None
    options: dict[str, Any] = field(default_factory=dict)
    last_successful_watermark: str | None = None
    last_batch_id: int | None = None

    @property
    def ordering_column(self) -> str | None:
        """Versions are ordered by the sequence column, else the watermark column."""
        return self.sequence_column or self.watermark_column

    @property
    def is_incremental(self) -> bool:
        """Bounds apply only to incremental load modes with an ordering column."""
        return self.load_mode in INCREMENTAL_MODES and bool(self.ordering_column)

    @property
    def required_columns(self) -> list[str]:
        return list(self.options.get("required_columns", []))

    @property
    def deleted_values(self) -> list[str]:
        return list(self.options.get("deleted_values", DEFAULT_DELETED_VALUES))

    @property
    def fold_mode(self) -> str:
        return str(self.options.get("fold_mode") or "incremental").lower()


@dataclass
class ReplayRequest:
    replay_request_id: int
    source_name: str
    replay_mode: str = "FULL_REBUILD"
    start_watermark: str | None = None
    end_watermark: str | None = None
    entity_predicate: str | None = None
    snapshot_id: int | None = None
    target_table: str | None = None
    requested_by: str | None = None
    request_status: str = "REQUESTED"

"""Column expressions shared by operators (all JVM-side, no Python UDFs)."""

from strata.functions.hashing import record_hash_col
from strata.functions.options import DEFAULT_DELETED_VALUES, INCREMENTAL_MODES, json_field, normalize_list_col, options_col
from strata.functions.watermark import mark_literal, mark_text_col, normalize_tag

__all__ = [
    "DEFAULT_DELETED_VALUES",
    "INCREMENTAL_MODES",
    "json_field",
    "mark_literal",
    "mark_text_col",
    "normalize_list_col",
    "normalize_tag",
    "options_col",
    "record_hash_col",
]

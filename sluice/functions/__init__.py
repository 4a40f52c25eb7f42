"""Column expressions; all of them stay inside Spark's generated code."""

from sluice.functions.columns import (
    array_of_strings,
    json_records,
    present_columns,
    quoted,
    rebuilt_struct,
    row_digest,
    row_hash,
    typed_bound,
)

__all__ = [
    "array_of_strings",
    "json_records",
    "present_columns",
    "quoted",
    "rebuilt_struct",
    "row_digest",
    "row_hash",
    "typed_bound",
]

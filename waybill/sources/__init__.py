from waybill.sources.readers import (
    lines_from_values,
    read_activity,
    read_legacy_activity,
    read_lines,
    read_location_names,
    read_support_calls,
)
from waybill.sources.writers import (
    conform,
    replace_files,
    replace_table,
    write_lines,
    write_many,
    write_records,
    write_routed,
    write_table,
)

__all__ = [
    "conform",
    "lines_from_values",
    "read_activity",
    "read_legacy_activity",
    "read_lines",
    "read_location_names",
    "read_support_calls",
    "replace_files",
    "replace_table",
    "write_lines",
    "write_many",
    "write_records",
    "write_routed",
    "write_table",
]

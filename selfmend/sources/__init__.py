"""Scans and schema handling for delimited ticket files."""

from selfmend.sources.delimited import (
    all_string_table, contract_schema, csv_inferred, drop_repeated_headers,
    header_names, positional_cast, read_csv_strings, read_delimited, scan_text,
    split_fields, typed_table,
)

__all__ = ["all_string_table", "contract_schema", "csv_inferred", "drop_repeated_headers",
           "header_names", "positional_cast", "read_csv_strings", "read_delimited",
           "scan_text", "split_fields", "typed_table"]

"""Writers for tables, single-file exports, headers and per-row files."""

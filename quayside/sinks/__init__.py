"""Writers for dated files, tables, run logs and reports."""

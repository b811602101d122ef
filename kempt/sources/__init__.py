"""Sources and sinks: files, catalog tables, upserts, marts and versions."""

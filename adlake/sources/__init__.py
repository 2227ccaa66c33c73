"""Sources and sinks: typed loads, idempotent writes, sheets, fixtures."""

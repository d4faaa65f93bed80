"""Sources and sinks: files, tables, metrics, models, test-table adapters."""

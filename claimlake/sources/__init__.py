"""Sources and sinks: bronze/silver/gold tables, config-driven extracts, schemas."""

"""Sources (tables, readers) and sinks."""

"""Declared schemas, as files: `sinks.txt` for the row jobs' results, `<table>.json` for extracts."""

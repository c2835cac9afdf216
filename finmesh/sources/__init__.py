"""Sources (landed API pages, raw dumps, tables, typed CSV) and sinks."""

"""Data sources and sinks: retail interactions, CSV tables, list datasets, chunked CSV export."""

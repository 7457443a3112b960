"""Scans and sinks: article CSV files, the warehouse tables, result files."""

"""Readers: warehouse tables, streams, JDBC dimensions, change-log records."""

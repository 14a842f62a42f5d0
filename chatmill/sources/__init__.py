"""Scans and sinks: declared schemas, file readers/writers, and the adapter
that stages the driver's tables as QA sources."""
